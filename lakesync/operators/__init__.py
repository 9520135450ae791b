"""Relational operators: change windows, newest-row selection, delta application, tree walk, checks."""
