"""Chains of landed pages against a plain walk."""

import random
from collections import Counter, defaultdict

import pytest

from lakesync.operators import paging

COLUMNS = "listing string, asked string, token string, is_last boolean"


def plain_faults(pages):
    """The same faults, following each chain page by page."""
    out, listings = set(), defaultdict(dict)
    for listing, asked, token, is_last in set(pages):
        listings[listing].setdefault(asked, set()).add(None if is_last else token)
    for listing, answers in listings.items():
        following = {asked: min((t for t in tokens if t is not None), default=None) for asked, tokens in answers.items()}
        names = Counter(t for t in following.values() if t is not None)
        out |= {(listing, paging.ANSWERS, asked) for asked, tokens in answers.items() if len(tokens) > 1}
        out |= {(listing, paging.TWICE, t) for t, n in names.items() if n > 1}
        out |= {(listing, paging.BEFORE, asked) for asked in following if asked is not None and asked not in names}
        if None not in following:
            out.add((listing, paging.FIRST, None))
        opened = sorted(t for t in names if t not in following)
        ends = sum(t is None for t in following.values())
        if ends > 1:
            out.add((listing, paging.ENDS, None))
        if not ends:
            out.add((listing, paging.LAST, opened[0] if len(opened) == 1 else None))
            opened = opened if len(opened) > 1 else []
        out |= {(listing, paging.NEXT, t) for t in opened}
        heads = [a for a in following if a is None or names[a] != 1]
        reached = set()
        for at in heads:
            while True:
                reached.add(at)
                at = following[at]
                if at is None or at not in following or names[at] != 1:
                    break
        loops = set(following) - reached
        while loops:
            ring, at = [], next(iter(loops))
            while at not in ring:
                ring.append(at)
                at = following[at]
            out.add((listing, paging.LOOP, min(ring)))
            loops -= set(ring)
    return out


def faults(spark, rows, **options):
    frame = spark.createDataFrame(rows, COLUMNS)
    return {tuple(r) for r in paging.chain_faults(frame, **options).collect()}


def chain(listing, length):
    cursors = [None, *(f"c{n:04}" for n in range(1, length))]
    return [(listing, a, b, b is None) for a, b in zip(cursors, [*cursors[1:], None])]


@pytest.mark.parametrize("lost, fault", [
    ([], set()),
    ([0], {(paging.FIRST, None), (paging.BEFORE, "c0001")}),
    ([5], {(paging.NEXT, "c0005"), (paging.BEFORE, "c0006")}),
    ([5, 6, 7], {(paging.NEXT, "c0005"), (paging.BEFORE, "c0008")}),
    ([19], {(paging.LAST, "c0019")}),
    ([3, 19], {(paging.NEXT, "c0003"), (paging.NEXT, "c0019"), (paging.BEFORE, "c0004"), (paging.LAST, None)}),
    (range(1, 20), {(paging.LAST, "c0001")})])
def test_lost_pages_are_named(spark, lost, fault):
    pages = [page for n, page in enumerate(chain("a", 20)) if n not in lost]
    assert faults(spark, pages + chain("whole", 33) + chain("one", 1)) == {("a", *f) for f in fault}


def test_loops_and_contradictions(spark):
    back = chain("back", 9)[:-1] + [("back", "c0008", "c0003", False)]
    ring = chain("ring", 4) + [("ring", "x", "y", None), ("ring", "y", "z", None), ("ring", "z", "x", None)]
    again = chain("again", 5) * 2 + [("again", "c0002", "c0003", None)]
    other = chain("other", 5) + [("other", "c0002", "c0004", None)]
    empty = [("empty", "", None, None), ("empty", None, "", None)]  # an empty cursor is one like any other
    rows = back + ring + again + other + empty
    want = plain_faults(rows)
    assert faults(spark, rows) == want
    assert want >= {("ring", paging.LOOP, "x"), ("back", paging.TWICE, "c0003"), ("other", paging.ANSWERS, "c0002")}
    assert not {f for f in want if f[0] in ("again", "empty")}
    assert ("back", paging.TWICE, "c0003") not in faults(spark, rows, tolerated=[paging.TWICE])
    assert faults(spark, []) == set()


def test_random_links(spark):
    rng = random.Random(11)
    rows = []
    for listing in range(60):
        names = [None, *"abcdefg"]
        for asked in rng.sample(names, rng.randrange(1, 8)):
            rows.append((str(listing), asked, rng.choice([*names, "z"]), rng.random() < 0.2))
    assert faults(spark, rows) == plain_faults(rows)


def test_long_chain_in_few_rounds(spark, monkeypatch):
    """5,000 pages of one listing, dealt in any order, find their places in thirteen joins."""
    rows = chain("long", 5000)
    random.Random(1).shuffle(rows)
    rounds = []
    cut = paging.Scratch.cut
    monkeypatch.setattr(paging.Scratch, "cut", lambda self, df: rounds.append(1) or cut(self, df))
    found = {r["asked"]: (r["run"], r["place"]) for r in paging.page_places(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert found == {asked: (None, n) for n, (_, asked, _, _) in enumerate(chain("long", 5000))}
    assert len(rounds) <= 2 + 13
