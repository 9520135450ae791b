"""Prefix trie of conversations by vertical bitmaps: which conversations begin with the same turns.

1. Turns become ``conv_id, digest, chars``, dealt by ranges of ids, so that conversations and the one they begin like
   meet in a task, in order. A task cuts its range into shards of some thousand conversations.
2. Each shard has an index of bit sets: for every (position, turn) the conversations that have it there. The shard's
   trie is walked depth first: the bits of a node, cut with a posting of the next position, are a child; their number is
   its count, those that end there its end list.
3. Nodes of all shards meet by path. The one with the least member owns the node: it alone counts it in the sums over
   subtrees, which so need neither the whole trie nor a round per level.
4. Back in its shard, each node sums up its subtree, and a last meeting by path adds the shards' shares and hashes the
   end lists in the order of the shards, as a stream.

Shards bring one row per node to each meeting, so a first turn that a third of all conversations share is one row a
shard, and its end list is never held in one piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.llm.shared import partitions
from lakesync.session import Scratch

#: Conversations and turns after which a shard is closed; a conversation and those that begin like it stay together.
SHARD_CONVERSATIONS, SHARD_TURNS = 4096, 1 << 16
ROOT = bytes(16)

Turn = tuple[bytes, int]


@dataclass
class Node:
    """A node of one shard's trie."""

    path: bytes
    parent: int
    depth: int
    low: int
    count: int
    chars: int
    ends: list[int] = field(default_factory=list)


def path_of(parent: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(parent + turn, digest_size=16).digest()


def postings(conversations: list[tuple[int, list[Turn]]]) -> dict[tuple[int, bytes], int]:
    """For every (position, turn) the set of conversations with it, as bits of a number."""
    index: dict[tuple[int, bytes], int] = {}
    for at, (_, turns) in enumerate(conversations):
        bit = 1 << at
        for position, (turn, _) in enumerate(turns):
            index[position, turn] = index.get((position, turn), 0) | bit
    return index


def shard_trie(conversations: list[tuple[int, list[Turn]]]) -> list[Node]:
    """Nodes of a shard, parents before children; conversations go by rising id."""
    index = postings(conversations)
    lasting: dict[int, int] = {}  # position -> conversations with a turn there
    for (position, _), bits in index.items():
        lasting[position] = lasting.get(position, 0) | bits
    nodes: list[Node] = []
    stack = [(ROOT, -1, 0, (1 << len(conversations)) - 1, 0)]
    while stack:
        path, parent, depth, bits, chars = stack.pop()
        least = (bits & -bits).bit_length() - 1
        rest = bits & lasting.get(depth, 0)
        node = Node(path, parent, depth, conversations[least][0], bits.bit_count(), chars)
        ended = bits ^ rest
        while ended:
            at = (ended & -ended).bit_length() - 1
            node.ends.append(conversations[at][0])
            ended &= ended - 1
        here = len(nodes)
        nodes.append(node)
        while rest:
            turn, size = conversations[(rest & -rest).bit_length() - 1][1][depth]
            child = bits & index[depth, turn]
            stack.append((path_of(path, turn), here, depth + 1, child, size))
            rest &= ~child
    return nodes


def rebuilt(base: list[Turn], own: list[Turn], head: int) -> list[Turn]:
    return base[:head] + own[head:]


_NODE = pa.schema([("shard", pa.int64()), ("at", pa.int32()), ("parent", pa.int32()), ("path", pa.binary()), ("depth", pa.int64()), ("low", pa.int64()),
                   ("count", pa.int64()), ("ended", pa.int64()), ("chars", pa.int64()), ("ends", pa.string())])
_NODE_DDL = "shard long, at int, parent int, path binary, depth long, low long, count long, ended long, chars long, ends string"


def _grouped(parts: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, int, list[Turn]]]]]:
    """Runs of conversations that begin like the same one: its id, and ``conv_id, head, turns`` of each."""
    now, held = None, []
    for part in parts:
        for base, name, head, turn, chars in zip(*(column.to_pylist() for column in part.columns)):
            if now is not None and base != now:
                yield now, held
                held = []
            now = base
            if not held or held[-1][0] != name:
                held.append((name, head, []))
            held[-1][2].append((turn, chars))
    if held:
        yield now, held


def _shards(groups: Iterable[tuple[int, list[tuple[int, int, list[Turn]]]]]) -> Iterator[list[tuple[int, list[Turn]]]]:
    held, size = [], 0
    for base, members in groups:
        first = next((turns for name, _, turns in members if name == base), [])
        for name, head, turns in members:
            held.append((name, rebuilt(first, turns, head)))
            size += len(held[-1][1])
        if len(held) >= SHARD_CONVERSATIONS or size >= SHARD_TURNS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*rows), schema)], schema=schema)


def _batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[-1]) if isinstance(row[-1], str) else 0
        if len(held) >= size or weight > 8 << 20:
            yield _columns(held, schema)
            held, weight = [], 0
    if held:
        yield _columns(held, schema)


def _local(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for members in _shards(_grouped(parts)):
            shard = members[0][0]  # ids of shards do not mix, so this names and orders them
            for at, node in enumerate(shard_trie(members)):
                yield (shard, at, node.parent, node.path, node.depth, node.low, node.count, len(node.ends), node.chars, ",".join(map(str, node.ends)))

    yield from _batched(rows(), _NODE)


_SHARE = pa.schema([("path", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("low", pa.int64()),
                    ("count", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())])
_SHARE_DDL = "path binary, conv_id long, depth long, parent_conv_id long, low long, count long, children long, leaves long, saved long, ends string"


def _shares(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each node of a shard adds to its subtree's sums; rows come by shard and ``at``."""

    def summed(nodes: list[dict]) -> Iterator[tuple]:
        children, leaves, saved = ([0] * len(nodes) for _ in range(3))
        for at in range(len(nodes) - 1, -1, -1):
            node = nodes[at]
            owned = node["conv_id"] == node["low"]
            leaves[at] += owned and node["childless"]
            saved[at] += (node["count"] - owned) * node["chars"]
            if node["parent"] >= 0:
                children[node["parent"]] += owned
                leaves[node["parent"]] += leaves[at]
                saved[node["parent"]] += saved[at]
        for at, node in enumerate(nodes):
            above = nodes[node["parent"]]["conv_id"] if node["parent"] >= 0 else None
            yield (node["path"], node["conv_id"], node["depth"], above, node["low"], node["count"], children[at], leaves[at], saved[at], node["ends"])

    def rows() -> Iterator[tuple]:
        held = []
        for part in parts:
            for node in part.to_pylist():
                if held and held[0]["shard"] != node["shard"]:
                    yield from summed(held)
                    held = []
                held.append(node)
        if held:
            yield from summed(held)

    yield from _batched(rows(), _SHARE)


_OUT = pa.schema([*((name, pa.int64()) for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", pa.string())])
_OUT_DDL = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole nodes of shares that come by path and ``low``."""

    def rows() -> Iterator[tuple]:
        now, head, sums, ends, some = None, (), [], None, False
        for part in parts:
            for path, name, depth, above, _, count, children, leaves, saved, listed in zip(*(column.to_pylist() for column in part.columns)):
                if path != now:
                    if now is not None:
                        yield (*head, *sums, ends.hexdigest())
                    now, head, sums, ends, some = path, (name, depth, above), [0] * 4, hashlib.sha256(), False
                sums = [a + b for a, b in zip(sums, (count, children, leaves, saved))]
                if listed:
                    ends.update((b"," if some else b"") + listed.encode())
                    some = True
        if now is not None:
            yield (*head, *sums, ends.hexdigest())

    yield from _batched(rows(), _OUT)


def turns_of(conversations: DataFrame, every: int, heads: int) -> DataFrame:
    """``base, conv_id, head, turn, chars`` with the place of each turn; ``turn`` is 128 bits of a digest of role and text."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    name = F.col("conv_id").cast("long")
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where(name.isNotNull()).select(
        (name - name % every).alias("base"), name.alias("conv_id"), (F.crc32(name.cast("string")) % heads).cast("int").alias("head"),
        F.col("turn").alias("place"), F.substring(F.unhex(said), 1, 16).alias("turn"), F.length(text).cast("long").alias("chars"))


def prefix_trie(conversations: DataFrame, every: int = 100, heads: int = 6, scratch: Scratch | None = None) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    Conversation ``c`` is rebuilt from the first ``h`` turns of conversation ``c - c % every`` (the sign of ``%`` is that
    of ``c``), none if there is no such one, and its own turns after the first ``h``; ``h`` is ``crc32(c) % heads``. Turns
    go by ``turn``, nulls first, equal ones by digest. Null roles and texts are empty.

    ``conv_id`` is the least member, ``n_convs`` the number of members, ``n_leaves`` that of childless nodes below, the
    node included, ``saved_tokens`` the code points of last texts in the subtree, each once less than it has members,
    and ``ends_sha256`` the digest of the ids that end here, rising and joined by commas. A conversation may be left
    without turns; it is a member of the root and ends there. Repeated rows are repeated turns. Rows without ``conv_id``
    belong to no conversation and take no part; an empty table gives no rows. Other columns are not read. The digests of
    one conversation's turns (some 100 bytes each) are held by one task.
    """
    scratch = scratch or Scratch(conversations.sparkSession)
    count = partitions(conversations.sparkSession)
    turns = turns_of(conversations, every, heads).repartitionByRange(count, "base")
    turns = turns.sortWithinPartitions("base", "conv_id", F.asc_nulls_first("place"), "turn").drop("place")
    local = scratch.cut(turns.mapInArrow(_local, _NODE_DDL))
    whole = local.groupBy("path").agg(F.min("low").alias("conv_id"), (F.sum("count") == F.sum("ended")).alias("childless"))
    placed = local.join(whole, "path").repartition(count, "shard").sortWithinPartitions("shard", "at")
    shares = placed.mapInArrow(_shares, _SHARE_DDL)
    return shares.repartition(count, "path").sortWithinPartitions("path", "low").mapInArrow(_merged, _OUT_DDL)
