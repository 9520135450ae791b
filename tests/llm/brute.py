"""Slow, plain versions of the operators to compare with."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def edges_to_roots(nodes, linked):
    """Smallest node reachable, by repeated lookup."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def passages_removed(rows, window=13):
    """[(doc_id, text)] -> [(doc_id, n_words, n_removed, kept words)], in the order given."""
    first, split = {}, [(i, [w for w in re.split(r"[ \t-\r]+", t or "") if w]) for i, t in rows]
    for i, words in split:
        for at in range(len(words) - window + 1 if i is not None else 0):
            key = tuple(words[at:at + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - window + 1 if i is not None else 0):
            if first[tuple(words[at:at + window])] < i:
                gone.update(range(at, at + window))
        out.append((i, len(words), len(gone), [w for at, w in enumerate(words) if at not in gone]))
    return out


def plain_line(line):
    return line.strip(" \t\r\x0b\x0c").lower()


def lines_removed(rows, size=9, least=0.8):
    """[(doc_id, text)] in order of rows -> per row (kept text, number of removed lines)."""
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, r))
    first, found = {}, defaultdict(list)
    for r in order:
        for at, line in enumerate((rows[r][1] or "").split("\n")):
            if plain_line(line):
                first.setdefault(plain_line(line), (order.index(r), r, at))
    names = list(first)
    sets = [frozenset(p[i:i + size] for i in range(max(1, len(p) - size + 1))) for p in names]
    linked = []
    for a, shingles in enumerate(sets):
        for b, both in Counter(b for s in shingles for b in found[s]).items():
            if both >= least * (len(shingles) + len(sets[b]) - both):
                linked.append((a, b))
        for s in shingles:
            found[s].append(a)
    roots = edges_to_roots(range(len(names)), linked)
    best = {}
    for number, name in enumerate(names):
        best[roots[number]] = min(best.get(roots[number], first[name]), first[name])
    number_of, out = {name: n for n, name in enumerate(names)}, []
    for r, (_, text) in enumerate(rows):
        kept, lost = [], 0
        for at, line in enumerate((text or "").split("\n")):
            if plain_line(line) and best[roots[number_of[plain_line(line)]]][1:] != (r, at):
                lost += 1
            else:
                kept.append(line)
        out.append((text if not lost else "\n".join(kept), lost))
    return out


def check_pieces(pieces, want, length=4096):
    """Every id of every document in one piece, sequences gapless and within the length; returns the padding share.

    ``want`` maps doc_id to the list of its possible token arrays (repeated ids give several).
    """
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    assert set(docs) == set(want)
    for doc_id, parts in docs.items():
        if len(want[doc_id]) > 1:
            assert sum(p["length"] for p in parts) == sum(map(len, want[doc_id]))
            continue
        ids, at = want[doc_id][0], 0
        for p in sorted(parts, key=lambda p: p["start"]):
            some = ids[at:at + p["length"]]
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), zlib.crc32(np.asarray(some, "<u4").tobytes()))
            assert list(p["ids"]) == list(some)
            at += p["length"]
        assert at == len(ids)
    total = padded = 0
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= length
        total += at
        padded += 0 if at & (at - 1) == 0 else length - at
    return padded / max(1, total)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
