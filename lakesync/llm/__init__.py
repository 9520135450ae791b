"""Operators for preparing training text, one module each; nothing else in the library imports them.

Every operator reads ``doc_id`` and ``text`` (or the columns it names) by name and ignores other columns, whatever they
are called. A null text is an empty text. Each row is a document of its own, also when ids repeat or are null.
"""
