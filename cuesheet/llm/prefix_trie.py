"""Prefix trie of conversations, families first (operator 12).

Conversation c takes its first h turns from conversation ``c - c % 100``, its base (h: crc32 of its decimal id
modulo 6), and then goes on with its own turns after its first h. A turn becomes 16 bytes (MD5 of role
and text) and its length before anything moves; then all turns of a base and its conversations meet, the
base's in front, so that each family is rebuilt in one pass and put into a small trie. A node is known by
the MD5 of its parent's key and its last turn. Only combined nodes move on: a node's conversations are
counted in its family (and over the families of a task), then over all.

Sums over subtrees take as many rounds as the *logarithm* of the depth: families also know each node's
ancestors 1, 2, 4, 8 ... levels up, so round k adds what the nodes 2**k levels down have gathered. Each round
aggregates (a node with very many children is combined where its children lie) and joins on unique keys.
The ids of the conversations that end in one node are sorted over all tasks, written as pieces of text, and
the pieces hashed in order.

Defined cases: turns go by ``turn``, null first, ties by their MD5; a null role or text is empty; repeated
rows are turns of their own; rows without a conversation id belong to none and are left out; columns of any other
name are not read; an empty table gives an empty result, without a root. A task holds one
conversation's keys (16 bytes a turn) and a bounded table of nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, looked_up

FAMILY = 100
SHARED = 6
ROOT = bytes(16)
#: Nodes and endings that a task combines before it sends them on.
HELD = 200_000
#: Characters of a piece of joined ids.
PIECE = 65_536
NO_IDS = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id: Column) -> Column:
    """h: how many turns a conversation takes from its base."""
    return F.crc32(conv_id.cast("string").cast("binary")) % SHARED


def turns_of(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``base, conv_id, h, digest, n_chars`` of every turn; those of a family in one partition, its base first, in order."""
    role, text, conv = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit("")), F.col(conv_col).cast("long")
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    t = conversations.where(conv.isNotNull()).select(
        (conv - conv % FAMILY).alias("base"), conv.alias("conv_id"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.char_length(text).cast("long").alias("n_chars"))
    own = F.when(F.col("conv_id") == F.col("base"), 0).otherwise(1)
    t = t.repartition("base").sortWithinPartitions("base", own, "conv_id", F.col("turn").asc_nulls_first(), "digest")
    return t.select("base", "conv_id", shared_turns(F.col("conv_id")).cast("long").alias("h"), "digest", "n_chars")


class _Families:
    """The tries of families that come one after the other, in one table of bounded size."""

    def __init__(self):
        self.nodes: dict[bytes, list] = {}
        self.n_ends = 0
        self.base = self.conv = None
        self.opening: list[tuple[bytes, int]] = []

    def _visit(self, n_chars: int) -> None:
        node = self.nodes.get(self.key)
        if node is None:
            path, depth = self.path, len(self.path) // 16 - 1
            up = b"".join(bytes(path[16 * (depth - (1 << k)):16 * (depth - (1 << k) + 1)]) for k in range(depth.bit_length()))
            self.nodes[self.key] = [depth, n_chars, up, self.conv, 1, []]
        else:
            node[3], node[4] = min(node[3], self.conv), node[4] + 1

    def _step(self, digest: bytes, n_chars: int) -> None:
        self.key = hashlib.md5(self.key + digest).digest()
        self.path += self.key
        self.last = n_chars
        self._visit(n_chars)

    def end(self) -> None:
        """The conversation read last ends at the node it has come to."""
        if self.conv is None:
            return
        if self.key not in self.nodes:
            self._visit(self.last)
            self.nodes[self.key][4] = 0
        self.nodes[self.key][5].append(self.conv)
        self.n_ends += 1

    def turn(self, base: int, conv: int, h: int, digest: bytes, n_chars: int) -> None:
        if conv != self.conv:
            self.end()
            if base != self.base:
                self.base, self.opening = base, []
            self.conv, self.own, self.h, self.key, self.path, self.last = conv, 0, h, ROOT, bytearray(ROOT), 0
            self._visit(0)
            if conv != base:
                for x in self.opening[:h]:
                    self._step(*x)
        self.own += 1
        if conv == base:
            if self.own < SHARED:
                self.opening.append((digest, n_chars))
            self._step(digest, n_chars)
        elif self.own > h:
            self._step(digest, n_chars)

    def full(self) -> bool:
        return len(self.nodes) + self.n_ends >= HELD

    def flush(self) -> pa.RecordBatch:
        rows = [(k, *v[:5], sorted(v[5])) for k, v in self.nodes.items()]
        self.nodes, self.n_ends = {}, 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES, strict=True)], _NAMES)


_NAMES = ["key", "depth", "n_chars", "up", "conv_id", "n_convs", "ends"]
_TYPES = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]


def family_nodes(turns: DataFrame) -> DataFrame:
    """``key, depth, n_chars, up, conv_id, n_convs, ends``: combined nodes of the families of each task, from :func:`turns_of`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = _Families()
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                tries.turn(*row)
                if tries.full():
                    yield tries.flush()
        tries.end()
        if tries.nodes:
            yield tries.flush()

    return turns.mapInArrow(run, "key binary, depth long, n_chars long, up binary, conv_id long, n_convs long, ends array<long>")


def hashed_ids(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256`` from ``key, id``: SHA-256 of each key's ids in ascending order, with commas between.

    Ids are sorted over all tasks by key and id; runs become pieces of text, so the task that hashes a key reads few rows."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, size = None, [], 0
        for b in batches:
            out = []
            for k, i in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k != key or size > PIECE:
                    out += piece(key, ids)
                    key, ids, size = k, [], 0
                ids.append(i)
                size += len(str(i)) + 1
            yield batch(out)
        yield batch(piece(key, ids))

    def piece(key: bytes, ids: list) -> list:
        return [(key, ids[0], ",".join(map(str, ids)))] if ids else []

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.binary(), pa.int64(), pa.string()), strict=True)], ["key", "id", "text"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sha = None
        for b in batches:
            keys, sums = [], []
            for k, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if k == key:
                    sha.update(b"," + text.encode())
                    continue
                if key is not None:
                    keys.append(key)
                    sums.append(sha.hexdigest())
                key, sha = k, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sums, pa.string())], ["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()], pa.string())], ["key", "ends_sha256"])

    pieces = ends.repartitionByRange("key", "id").sortWithinPartitions("key", "id").mapInArrow(joined, "key binary, id long, text string")
    return pieces.repartition("key").sortWithinPartitions("key", "id").mapInArrow(hashed, "key binary, ends_sha256 string")


def _ancestor(k: int) -> Column:
    """The key of the node 2**k levels up."""
    return F.substring("up", 16 * k + 1, 16)


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``key`` and what all nodes below it have in ``values``; nodes without any below are left out. ``nodes`` is a written
    table of ``key, depth, up`` and the values."""
    sums = [F.sum(v).cast("long").alias(v) for v in values]
    below, deep, k = None, nodes.select("key", "depth", "up", *values), 0
    while (deep := deep.where(F.col("depth") >= 1 << k)).limit(1).count():
        found = durable(deep.groupBy(_ancestor(k).alias("key")).agg(*sums), "subtrees")
        below = found if below is None else below.unionByName(found)
        more = found.select("key", *(F.col(v).alias(f"more_{v}") for v in values))
        deep = durable(deep.where(F.col("depth") >= 2 << k).join(more, "key", "left").select("key", "depth", "up", *((F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values)), "deep")
        k += 1
    return (nodes.select("key", *values).limit(0) if below is None else below).groupBy("key").agg(*sums)


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, node_key``."""
    families = durable(family_nodes(turns_of(conversations, conv_col, turn_col, role_col, text_col)), "families")
    merged = durable(families.groupBy("key", "depth", "n_chars", "up").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs")), "nodes")
    children = merged.where("depth > 0").groupBy(_ancestor(0).alias("key")).agg(F.count("*").alias("n_children"))
    nodes = merged.join(children, "key", "left").select(
        "key", "depth", "up", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved"))
    nodes = durable(nodes, "nodes-with-children")
    below = subtree_sums(nodes, ["leaves", "saved"]).select("key", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    ends = families.where(F.size("ends") > 0).select("key", F.explode("ends").alias("id"))
    rows = nodes.join(below, "key", "left").join(hashed_ids(ends), "key", "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, _ancestor(0)).alias("parent"), "n_convs", "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"), F.hex("key").alias("node_key"))
    rows = durable(rows, "trie")
    parents = durable(nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("weight")), "parents")
    return looked_up(rows, parents, ["parent"], "weight", nodes.count(), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "node_key")
