"""Embedding near duplicates by randomised-rotation binary codes (operator 9).

Vectors are normalised and rotated by fixed random rotations. A vector's code is the signs of the
first rotation, its correction factor c the inner product of code and vector; for a vector q the
value <code, q> / c is an unbiased estimate of the inner product, within
``EPSILON * sqrt((1 - c^2) / (c^2 (D - 1)))`` but for a chance of about exp(-EPSILON^2 / 2) (3 in 10,000;
measured on pairs at the threshold: none in 20,000). A pair goes to exact recomputation, in double
precision, only if both its estimates reach the threshold within their bounds; q itself is stored
as one byte a component, whose error widens the bound.

Pairs are looked for where two vectors of a label agree in all signs of one of several groups of
signs from further rotations. ``key_plan`` sets the signs of a group by the label's own number of vectors,
so that few unlike vectors meet at any size, and the number of groups by ``MISS``, the chance that
a pair at the threshold meets in none of them. Rows that meet are first compared by one word of
64 signs (a pair at 0.98 differs in over 16 of them with a chance of one in a million);
only those with a partner get their codes and vectors. A pair is decided in the first group in which it
meets and nowhere else. A crowded key is split into blocks, and every pair of blocks is a unit of work
of its own. A unit gives each row's number of links and the smallest row it is connected to: two
numbers a row, however many pairs are linked.

Equal vectors are one class, whose copies count as links without being compared.

Defined cases: a vector that is null, zero, or has null or non-finite components, or whose label is
null, has no links and is a component of its own; labels are of any type that can be compared, and equal when
their values are; vectors of different length never link; null ids
take part and are smallest of nothing (a component without any id has a null id); repeated rows are
copies; columns of any other name are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import durable, small_or_not
from .components import connected_components
from .meeting import glanced, runs

THRESHOLD = 0.98
#: Chance that a pair at the threshold meets under no key.
MISS = 1e-6
#: Signs of a key at least and at most.
FEWEST, MOST = 8, 24
EPSILON = 4.0
#: Rows of a key (estimated on every ``THIN``-th vector) from which on it is dealt as blocks, and rows of a block.
CROWDED, THIN, BLOCK = 2048, 16, 1024
SEED = 9
BROADCAST_KEYS = 100_000


def key_plan(n: Column, threshold: float = THRESHOLD) -> tuple[Column, Column]:
    """Signs of a key, and number of keys, for a label of ``n`` vectors."""
    bits = F.least(F.lit(MOST), F.greatest(F.lit(FEWEST), F.ceil(F.log2(F.greatest(n, F.lit(2)))) - 6)).cast("int")
    none = F.log(1 - F.pow(F.lit(1 - math.acos(min(1.0, threshold)) / math.pi), bits))
    return bits, F.coalesce(F.ceil(F.lit(math.log(MISS)) / none), F.lit(1)).cast("int")


def glance_bits(threshold: float = THRESHOLD) -> int:
    """Signs of 64 in which a pair at the threshold differs at most, but for six standard errors."""
    p = math.acos(min(1.0, threshold)) / math.pi
    return math.ceil(64 * p + 6 * math.sqrt(64 * p * (1 - p)))


@cache
def rotations(dim: int, signs: int) -> tuple[np.ndarray, np.ndarray]:
    """The rotation of the codes, and ``signs`` further rotated axes (the first 64 for the glance)."""
    rng = np.random.default_rng(SEED)
    turn = lambda: np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    first = turn()
    return first, np.concatenate([turn() for _ in range(math.ceil(signs / dim))], axis=1)[:, :signs]


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of normalised rows: rotated components as bytes, and factors (correction, size of a byte's step)."""
    r = x @ rotations(x.shape[1], 64)[0]
    c = np.abs(r).sum(axis=1) / math.sqrt(x.shape[1])
    scale = np.abs(r).max(axis=1, keepdims=True)
    q = np.rint(r / scale * 127).astype(np.int8)
    return q, np.stack([c, scale[:, 0] / 127], axis=1).astype(np.float32)


def sign_keys(x: np.ndarray, bits: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Of normalised rows: the glance word and the keys (n, tables)."""
    signs = x @ rotations(x.shape[1], 64 + bits * tables)[1] > 0
    word = np.packbits(signs[:, :64], axis=1, bitorder="little").view(np.int64)[:, 0]
    return word, (signs[:, 64:].reshape(len(x), tables, bits) @ (1 << np.arange(bits))).astype(np.int32)


def estimates(q: np.ndarray, factors: np.ndarray, other_q: np.ndarray, other_factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of each code with each other vector, and the bound of each code's error."""
    d = q.shape[1]
    c = factors[:, :1]
    code = np.where(q >= 0, 1, -1).astype(np.float32) / (math.sqrt(d) * c)
    value = code @ (other_q.astype(np.float32) * other_factors[:, 1:]).T
    bound = EPSILON * np.sqrt(np.maximum(0, 1 - c * c) / (c * c * max(1, d - 1))) + math.sqrt(d) / 2 * other_factors[:, 1] / c
    return value, bound


def linked_pairs(x: np.ndarray, q: np.ndarray, factors: np.ndarray, keys: np.ndarray, table: int, threshold: float, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs between two sets of rows (of one set with itself: each once) that no earlier
    table decides: both estimates within their bounds of the threshold, then the exact cosine."""
    a, bound_a = estimates(q[left], factors[left], q[right], factors[right])
    b, bound_b = estimates(q[right], factors[right], q[left], factors[left])
    maybe = (a + bound_a >= threshold) & (b + bound_b >= threshold).T
    if left is right:
        maybe &= np.tri(len(left), k=-1, dtype=bool).T
    i, j = np.nonzero(maybe)
    i, j = left[i], right[j]
    good = np.zeros(len(i), bool)
    for lo in range(0, len(i), 8192):
        u, v = i[lo:lo + 8192], j[lo:lo + 8192]
        exact = np.einsum("ij,ij->i", x[u], x[v]) >= threshold
        good[lo:lo + 8192] = exact & ~(keys[u, :table] == keys[v, :table]).any(axis=1)
    return i[good], j[good]


def connected(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows is connected to by the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def normalised(raw: list[bytes]) -> np.ndarray:
    """Unit vectors, in double precision, of equally long vectors of any size."""
    x = np.frombuffer(b"".join(raw)).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``label, key, node, glance`` of ``label, bits, tables, node, vector``; a key names length, table and signs."""
    for b in batches:
        label, bits, tables, node, raw = (c.to_numpy(zero_copy_only=False) for c in b.columns)
        form = np.stack([bits, np.array([len(r) for r in raw], np.int64)], axis=1)
        for k in np.unique(form, axis=0):
            rows = np.flatnonzero((form == k).all(axis=1))
            for lo in range(0, len(rows), 2048):
                at = rows[lo:lo + 2048]
                n = int(tables[at[0]])
                word, keys = sign_keys(normalised(raw[at].tolist()), int(k[0]), n)
                key = (np.int64(k[1]) << 40 | np.arange(n, dtype=np.int64)[:, None] << 24 | keys.T.astype(np.int64)).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (np.tile(label[at], n), key, np.tile(node[at], n), np.tile(word, n))], ["label", "key", "node", "glance"])


def _units(threshold: float):
    """Decides the pairs of each unit; rows come sorted by unit (label, key, two blocks), then
    bits, tables, node, side, copies, vector. Gives ``a, b, n``: a row, the smallest node it is connected
    to in its unit, and its links there."""
    def decide(key: int, one: int, two: int, bits: int, tables: int, node: np.ndarray, side: np.ndarray, copies: np.ndarray, raw: np.ndarray):
        order = np.argsort(node)
        node, side, copies = node[order], side[order], copies[order]
        x = normalised(raw[order].tolist())
        (q, f), (_, keys) = encode(x), sign_keys(x, bits, tables)
        left = np.flatnonzero(side == one)
        right = left if one == two else np.flatnonzero(side == two)
        if not len(left) or not len(right):
            return None
        i, j = linked_pairs(x, q, f, keys, key >> 24 & 0xFFFF, threshold, left, right)
        if not len(i):
            return None
        n = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
        at = np.flatnonzero(n)
        return node[at], node[connected(len(node), i, j)[at]], n[at].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, (_, key, one, two, bits, tables, *rest) in runs(batches, 4):
            out = []
            for lo, hi in zip(start, np.r_[start[1:], len(key)], strict=True):
                if hi - lo > 1 and (got := decide(int(key[lo]), int(one[lo]), int(two[lo]), int(bits[lo]), int(tables[lo]), *(c[lo:hi] for c in rest))):
                    out.append(got)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*out, strict=True)], ["a", "b", "n"])

    return run


def link_counts(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b, n`` as in :func:`_units`, of ``node, label, copies, vector`` (a written table, vectors as doubles in bytes)."""
    bits, tables = key_plan(F.col("n"), threshold)
    sizes = durable(classes.groupBy(F.col("label").alias("of")).agg(F.count("*").alias("n")).select("of", bits.alias("bits"), tables.alias("tables")), "embedding-plan")
    planned = classes.join(small_or_not(sizes, BROADCAST_KEYS), F.col("label") == F.col("of"))
    form = "label long, key long, node long, glance long"
    keyed = lambda df: df.select("label", "bits", "tables", "node", "vector").mapInArrow(_keyed, form)
    thin = keyed(planned.where(F.pmod(F.xxhash64("node"), F.lit(THIN)) == 0)).groupBy(F.col("label").alias("l"), F.col("key").alias("k")).agg((F.count("*") * THIN).alias("n"))
    hot = durable(thin.where(F.col("n") >= CROWDED).select("l", "k", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "embedding-crowded")
    few, rows, by = small_or_not(hot, BROADCAST_KEYS), keyed(planned), ["label", "key"]
    same = (F.col("label") == F.col("l")) & (F.col("key") == F.col("k"))
    close = rows.join(few, same, "left_anti").repartition(*by).sortWithinPartitions(*by).mapInArrow(glanced(2, glance_bits(threshold)), "label long, key long, node long")
    close = close.select(*by, "node", F.lit(0).alias("side"), F.lit(0).alias("other"))
    crowd = rows.join(few, same).withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    crowd = crowd.select(*by, "node", "side", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = durable(close.unionByName(crowd), "embedding-meetings")
    full = met.join(planned.select("node", "bits", "tables", "copies", "vector"), "node")
    full = full.select(*by, F.least("side", "other").alias("one"), F.greatest("side", "other").alias("two"), "bits", "tables", "node", "side", "copies", "vector")
    unit = [*by, "one", "two"]
    return durable(full.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(_units(threshold), "a long, b long, n long"), "embedding-links")


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, a list of numbers, as doubles in bytes."""
    for b in batches:
        flat = b.columns[-1].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends = np.cumsum(b.columns[-1].value_lengths().to_numpy())
        raw = [flat[lo:hi].tobytes() for lo, hi in zip(np.r_[0, ends[:-1]], ends, strict=True)]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(raw, pa.binary())], b.schema.names)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with their ``label``, of any type that can be compared, as a whole number: whole numbers stay, others get
    a 64-bit hash with the first seed under which no two labels share one."""
    kind = rows.schema["label"].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return rows.withColumn("label", F.col("label").cast("long"))
    label = F.col("label") + F.lit(0.0) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col("label")  # one zero
    for seed in count():
        found = rows.select(label.alias("label"), F.xxhash64(label, F.lit(seed)).alias("h")).where("label IS NOT NULL").groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        if not found.where("lo <> hi").limit(1).count():
            return rows.withColumn("label", F.when(label.isNotNull(), F.xxhash64(label, F.lit(seed))))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vector."""
    own = numbered(vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding")))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    two = [F.xxhash64("label", "embedding").alias("h1"), F.xxhash64("embedding", F.lit(1), "label").alias("h2")]
    own = own.withColumn("usable", usable)
    classes = own.where("usable").select("vec_id", "label", "embedding", *two).groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    id_type = vectors.schema[id_col].dataType.simpleString()
    classes = classes.mapInArrow(_as_bytes, f"h1 long, h2 long, label long, first_id {id_type}, copies long, vector binary")
    classes = durable(classes.withColumn("node", F.monotonically_increasing_id()), "embedding-classes")
    links = link_counts(classes, threshold)
    counted = links.groupBy("a").agg(F.sum("n").alias("others"))
    parts = connected_components(links.where("a <> b"))
    rooted = classes.join(counted, F.col("node") == F.col("a"), "left").drop("a").join(parts.withColumnRenamed("node", "p"), F.col("node") == F.col("p"), "left")
    rooted = durable(rooted.select("h1", "h2", "first_id", F.coalesce("root", "node").alias("root"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "embedding-roots")
    of_root = rooted.groupBy("root").agg(F.min("first_id").alias("component"))
    found = rooted.join(of_root, "root").select("h1", "h2", "n_links", "component")
    rows = own.select("vec_id", "usable", *two)
    done = rows.join(found, ["h1", "h2"], "left")
    done = done.select("vec_id", F.when(F.col("usable"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
                       F.when(F.col("usable"), F.col("component")).otherwise(F.col("vec_id")).alias("component_id"))
    return done.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
