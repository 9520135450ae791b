"""Prefix trie against SQL and against a plain trie."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lakesync.llm import trie
from lakesync.llm.queries import ORACLES, QUERIES
from tests.conftest import SF
from tests.llm.brute import sha
from tools.compare import connect, differences


def told(rows, every=100, heads=6):
    """[(conv_id, turn, role, text)] -> {conv_id: rebuilt [(role, text)]}"""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said = (role or "", text or "")
            own[c].append((turn is not None, turn or 0, sha(f"{len(said[0])}:{said[0]}{said[1]}"), said))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (c % every if c >= 0 else -(-c % every))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    out = []
    for node, convs in members.items():
        leaves = saved = 0
        todo = [node]
        while todo:
            one = todo.pop()
            leaves += not children[one]
            saved += (len(members[one]) - 1) * (len(one[-1][1]) if one else 0)
            todo += children[one]
        ends = ",".join(map(str, sorted(c for c in convs if len(conversations[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), leaves, saved, sha(ends)))
    return out


def test_query_matches_sql(spark):
    assert differences(spark, connect(SF), QUERIES["op13_prefix_trie"], ORACLES["op13_prefix_trie"], SF) == ""


def hard_rows():
    rng = random.Random(8)
    says = [("user", "hi"), ("assistant", "ok"), ("user", ""), (None, None), ("", "user:x"), ("u", "ser"), ("us", "er"), ("user", "日本😀"), ("user", "x" * 30000)]
    rows = []
    for c in [*range(0, 260), -7, -250, -200, 10**15, 10**15 + 1]:
        rows += [(c, n, *rng.choice(says[:2] if c % 3 else says)) for n in range(rng.randrange(1, 9))]
    rows += [(c, n, "user", "same") for c in range(300, 340) for n in range(7)]  # the base holds what follows
    rows += [(399, None, "b", "2"), (399, None, "a", "1"), (399, 5, "c", "3"), (399, 5, "c", "3"), (5, 0, "user", "twice"), (5, 0, "user", "twice")]
    rows += [(None, 0, "user", "hi"), (None, None, None, None)]
    rows += [(n, 40 + m, "user", f"deep {m}") for n in (401, 405) for m in range(600)]
    return rows


def test_hard_rows(spark):
    rows = hard_rows()
    frame = spark.createDataFrame([(*row, 1, "k", b"p") for row in rows], "conv_id long, turn long, role string, text string, depth int, base string, path binary").repartition(5)
    got = [tuple(r) for r in trie.prefix_trie(frame).collect()]
    want = plain(told(rows))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(r[1] == 0 and r[4] > 5 for r in got) and max(r[1] for r in got) > 590
    assert trie.prefix_trie(frame.limit(0)).count() == 0
    other = [tuple(r) for r in trie.prefix_trie(frame, every=7, heads=3).collect()]
    assert sorted(other, key=repr) == sorted(plain(told(rows, 7, 3)), key=repr)


def test_all_turnless(spark):
    rows = [(c, 0, "user", "gone") for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (root,) = trie.prefix_trie(frame).collect()
    ids = [r[0] for r in rows]
    assert tuple(root) == (min(ids), 0, None, len(ids), 0, 1, 0, sha(",".join(map(str, ids))))


@pytest.mark.parametrize("size", [1, 3, 50])
def test_shards_of_any_size_give_the_same(monkeypatch, size):
    """One task, cut into shards of some conversations, by the functions that run in tasks."""
    monkeypatch.setattr(trie, "SHARD_CONVERSATIONS", size)
    conversations = told([row for row in hard_rows() if row[0] is not None and row[0] < 300])
    groups = [(c, [(c, 0, [(hashlib.md5(repr(t).encode()).digest(), len(t[1])) for t in conversations[c]])]) for c in sorted(conversations)]
    shards = list(trie._shards(groups))
    assert [c for shard in shards for c, _ in shard] == sorted(conversations) and all(len(s) <= size for s in shards)
    counts, lows, ends = defaultdict(int), {}, defaultdict(list)
    for shard in shards:
        for node in trie.shard_trie(shard):
            counts[node.path] += node.count
            lows[node.path] = min(node.low, lows.get(node.path, node.low))
            ends[node.path] += node.ends
    got = sorted((lows[p], counts[p], sha(",".join(map(str, ends[p])))) for p in counts)
    assert got == sorted((w[0], w[3], w[7]) for w in plain(conversations))
