"""SimHash near duplicates at a stated similarity of word shingles (operator 7, for pipelines).

The wide form of :mod:`.simhash`: a fingerprint has ``WIDE`` x 64 bits, set by majority over the
distinct five-word shingles, so that two texts of similarity (Jaccard) s differ in a share
``acos(2 s / (1 + s)) / pi`` of the bits; at 0.8 that is 15 %, known here to about 1.5 %. Candidates
meet through Golay codewords: a table's key is a codeword near one 23-bit segment (one to six for
each text, as in :mod:`.simhash`) with some plain bits of another segment. ``key_plan`` sets the number
of plain bits by the number of fingerprints and the number of tables by the wanted recall at the
threshold itself; closer texts are missed far more rarely.

Rows that share a key are first compared by one word of the fingerprint kept for that (``GLANCE``
bits); those with a partner get their whole fingerprints, and a walk over each key's rows names links
that connect what is connected by pairs within three standard errors of the threshold. A key with very many
rows (found by counting on every 64th fingerprint; the path taken does not change the links) is dealt as blocks that
share some of its rows, and afterwards only rows outside the key's main component are compared with
all of it. So links of a key of n close texts number about n, not n squared.

Fingerprints only propose: the texts that they connect are read once more, one of each class, and meet again with
their sorted shingle hashes, keyed by their proposed component. There the same walk links a pair only if its exact
similarity reaches the threshold, and the components of those links are the result. Very large components are dealt as blocks
in the same way.

Defined cases: texts without words are equal, shorter ones are a single shingle; whole texts are
read, however long; null and repeated ids are told apart by row; repeated rows are copies; columns of any
name stay as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, small_or_not
from .components import connected_components
from .meeting import glanced, runs
from .simhash import BROADCAST_IDS, codeword_keys

SHINGLE = 5
SIMILARITY = 0.8
#: Recall of candidates at the threshold.
RECALL = 0.985
#: Words of 64 bits in a fingerprint; the last is compared first, the others hold segments.
WIDE = 9
SEGMENT, SEGMENTS = 23, 22
#: Share of 23-bit words that share a codeword key when each bit differs with a chance of 0.1515 (measured).
MEET = 0.6037
#: Bits of the last word in which rows of a key may differ to be looked at closely; at 0.8 one pair in 2,000 differs in more.
GLANCE = 19
#: Rows of a key (estimated on every ``THIN``-th fingerprint) from which on it is dealt as blocks.
CROWDED, THIN = 4096, 64
HUBS, BROADCAST_KEYS = 64, 100_000
#: Bytes of shingle hashes from which on a proposed component is dealt as blocks.
CROWDED_BYTES = 64 << 20
#: Distinct words whose hashes a task remembers.
REMEMBERED = 500_000


def most_bits(similarity: float = SIMILARITY) -> int:
    """Differing bits up to which texts may be similar: what is expected at ``similarity``, and three standard errors."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    n = 64 * WIDE
    return math.floor(p * n + 3 * math.sqrt(p * (1 - p) * n))


def key_plan(n: int, recall: float = RECALL, similarity: float = SIMILARITY) -> tuple[int, int]:
    """Plain bits of a key, and tables, for ``n`` fingerprints."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    bits = min(SEGMENT, max(8, math.ceil(math.log2(max(2, n))) - 14))
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - MEET * (1 - p) ** bits))


def bit_counts(rows: np.ndarray) -> np.ndarray:
    """How many of the rows (n, words) have each bit set, by full adders over whole words."""
    waiting, out, weight = {0: [rows]}, np.zeros(64 * rows.shape[1], np.int64), 0
    while weight in waiting:
        x = np.concatenate(waiting.pop(weight))
        while len(x) > 1:
            k = max(1, len(x) // 3)
            a, b, c = x[:k], x[k:2 * k], x[2 * k:3 * k] if len(x) > 2 else np.zeros_like(x[:1])
            either = a ^ b
            waiting.setdefault(weight + 1, []).append(a & b | either & c)
            x = np.concatenate([either ^ c, x[3 * k:]])
        out += np.unpackbits(x[0].view(np.uint8), bitorder="little").astype(np.int64) << weight
        weight += 1
    return out


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) > REMEMBERED:
            self.clear()
        out = self[word] = xxh64_intdigest(word)
        return out


def shingle_hashes(text: str | None, hashes: _WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of a text's shingles; none without words."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w))
    width = min(shingle, len(w))
    n = len(w) - width + 1
    g = h[:n].copy()
    for i in range(1, width):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[i:n + i]
    return np.unique(g)


def wide_fingerprint(g: np.ndarray) -> np.ndarray:
    """``WIDE`` words from distinct shingle hashes: a bit is set if it is in over half of them."""
    ones = np.zeros(64 * WIDE, np.int64)
    for lo in range(0, len(g), 1 << 14):
        part = g[lo:lo + (1 << 14)]
        words = np.empty((len(part), WIDE), np.uint64)
        for k in range(WIDE):  # a mix of each hash for each word
            z = part + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            words[:, k] = z ^ z >> np.uint64(31)
        ones += bit_counts(words)
    return np.packbits(2 * ones > len(g), bitorder="little").view(np.uint64)


def wide_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``; fp is the fingerprint as bytes."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for b in batches:
            texts = b.column(1)
            fp = [wide_fingerprint(shingle_hashes(texts[i].as_py(), hashes, shingle)).tobytes() for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.binary())], ["doc_id", "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {id_type}, fp binary")


def _words(fp: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(fp), np.uint64).reshape(-1, WIDE)


def segments(fp: np.ndarray) -> np.ndarray:
    """The 23-bit segments (n, SEGMENTS) of all words but the last."""
    bits = np.unpackbits(np.ascontiguousarray(fp[:, :-1]).view(np.uint8), axis=1, bitorder="little")[:, :SEGMENT * SEGMENTS]
    return bits.reshape(len(fp), SEGMENTS, SEGMENT).astype(np.int64) @ (1 << np.arange(SEGMENT))


def _keyed(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                node, fp = part.column(0).to_numpy(zero_copy_only=False), _words(part.column(1).to_pylist())
                seg, glance = segments(fp), fp[:, -1].view(np.int64)
                for t in range(tables):
                    own, other = t % SEGMENTS, (t + 1 + t // SEGMENTS) % SEGMENTS
                    near = codeword_keys(seg[:, own])
                    r, c = np.nonzero(near >= 0)
                    key = np.int64(t) << 44 | near[r, c] << 32 | (seg[r, other] & (1 << bits) - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, node[r], glance[r])], ["key", "node", "glance"])

    return run


Near = Callable[[int, np.ndarray], np.ndarray]


def by_bits(most: int) -> Callable[[np.ndarray], Near]:
    """From fingerprints as bytes a test of one row against others: whether they differ in at most so many bits."""
    def prepared(raw: np.ndarray) -> Near:
        fp = _words(raw)
        return lambda x, others: np.bitwise_count(fp[others] ^ fp[x]).sum(axis=1, dtype=np.int64) <= most

    return prepared


def by_similarity(most: int, similarity: float) -> Callable[[np.ndarray], Near]:
    """From fingerprints followed by sorted shingle hashes: whether the exact similarity is reached. The bits, and the sizes, only
    spare the looking."""
    def prepared(raw: np.ndarray) -> Near:
        sets = [np.frombuffer(r, np.uint64)[WIDE:] for r in raw]
        size = np.array([len(x) for x in sets])
        close = by_bits(most)([r[:8 * WIDE] for r in raw])

        def near(x: int, others: np.ndarray) -> np.ndarray:
            maybe = close(x, others) & (np.minimum(size[others], size[x]) >= similarity * np.maximum(size[others], size[x]))
            for k in np.flatnonzero(maybe):
                shared = len(np.intersect1d(sets[x], sets[others[k]], assume_unique=True))
                maybe[k] = shared >= similarity * (size[x] + size[others[k]] - shared)
            return maybe

        return near

    return prepared


def walk(n: int, near: Near) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links (two lists of row numbers) that connect ``n`` rows exactly as all near pairs do."""
    a, b, left, ahead = [], [], np.arange(1, n), [0]
    while len(left):
        if not ahead:
            ahead, left = [int(left[0])], left[1:]
            continue
        x = ahead.pop()
        found = near(x, left)
        if found.any():
            a.append(np.full(int(found.sum()), x))
            b.append(left[found])
            ahead.extend(left[found].tolist())
            left = left[~found]
    return a, b


def _walked(prepared: Callable[[np.ndarray], Near], width: int):
    """Links inside the runs of rows sorted by the first ``width`` columns, which node and fp follow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, cols in runs(batches, width):
            node, raw = cols[width], cols[width + 1]
            one, two = [], []
            for lo, hi in zip(start, np.r_[start[1:], len(node)], strict=True):
                if hi - lo > 1:
                    a, b = walk(hi - lo, prepared(raw[lo:hi]))
                    one.extend(node[lo + x] for x in a)
                    two.extend(node[lo + x] for x in b)
            if one:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (one, two)], ["a", "b"])

    return run


def _across(prepared: Callable[[np.ndarray], Near]):
    """Links between rows of side 1 and side 0 in the runs of (key, block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, (_, _, side, node, raw) in runs(batches, 2):
            for lo, hi in zip(start, np.r_[start[1:], len(node)], strict=True):
                own, near = node[lo:hi], prepared(raw[lo:hi])
                all_ = np.flatnonzero(side[lo:hi] == 0)
                for x in np.flatnonzero(side[lo:hi] == 1):
                    others = all_[own[all_] != own[x]]
                    others = others[near(x, others)]
                    if len(others):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(others), own[x])), pa.array(own[others])], ["a", "b"])

    return run


def crowd_links(crowd: DataFrame, data: DataFrame, prepared: Callable[[np.ndarray], Near], links: DataFrame | None) -> DataFrame:
    """``links`` and those inside crowded keys. ``crowd``, a written table: key, node, n and blocks of the key; ``data``: node, fp."""
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    hub = F.pmod(F.xxhash64("node", F.lit(2)), F.col("n")) < HUBS
    dealt = crowd.select("key", F.explode(F.when(hub, every).otherwise(F.array(own))).alias("block"), "node").join(data, "node")
    unit = ["key", "block"]
    inside = dealt.select(*unit, "node", "fp").repartition(*unit).sortWithinPartitions(*unit).mapInArrow(_walked(prepared, 2), "a long, b long")
    links = durable((inside if links is None else links.unionByName(inside)).distinct(), "similar-links")
    rooted = crowd.join(connected_components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = durable(rooted, "similar-rooted")
    main = rooted.groupBy("key", "root").count().groupBy(F.col("key").alias("k")).agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    apart = rooted.join(main, F.col("key") == F.col("k")).where("root <> main").select("key", F.explode(every).alias("block"), F.lit(1).alias("side"), "node")
    keys = durable(apart, "similar-apart")
    if keys.isEmpty():
        return links
    asked = keys.select("key").distinct()
    both = crowd.join(asked, "key").select("key", own.alias("block"), F.lit(0).alias("side"), "node").unionByName(keys).join(data, "node")
    more = both.select(*unit, "side", "node", "fp").repartition(*unit).sortWithinPartitions(*unit).mapInArrow(_across(prepared), "a long, b long")
    return durable(links.unionByName(more).distinct(), "similar-links")


def similar_links(classes: DataFrame, most: int, recall: float = RECALL) -> DataFrame:
    """Links ``a, b`` between the nodes of ``node, fp`` (a written table of distinct fingerprints)
    whose components are those of all candidates within ``most`` bits."""
    bits, tables = key_plan(classes.count(), recall)
    form = "key long, node long, glance long"
    keyed = classes.select("node", "fp").mapInArrow(_keyed(bits, tables), form)
    thin = classes.where(F.pmod(F.xxhash64("node"), F.lit(THIN)) == 0).select("node", "fp").mapInArrow(_keyed(bits, tables), form)
    hot = durable(thin.groupBy("key").agg((F.count("*") * THIN).alias("n")).where(F.col("n") >= CROWDED).withColumnRenamed("key", "hot_key"), "similar-crowded")
    few = small_or_not(hot, BROADCAST_KEYS)
    fps = classes.select("node", "fp")
    plain = keyed.join(few.select("hot_key"), F.col("key") == F.col("hot_key"), "left_anti")
    close = durable(plain.repartition("key").sortWithinPartitions("key").mapInArrow(glanced(1, GLANCE), "key long, node long"), "similar-close")
    close = close.join(fps, "node").select("key", "node", "fp").repartition("key").sortWithinPartitions("key")
    links = durable(close.mapInArrow(_walked(by_bits(most), 1), "a long, b long").distinct(), "similar-links")
    if hot.isEmpty():
        return links
    crowd = keyed.join(few, F.col("key") == F.col("hot_key")).select("key", "node", "n", F.ceil(F.col("n") / CROWDED).cast("int").alias("blocks"))
    return crowd_links(durable(crowd, "similar-crowd"), fps, by_bits(most), links)


def with_shingles(docs: DataFrame, chosen: DataFrame, shingle: int) -> DataFrame:
    """``key, node, fp``: the classes of ``chosen`` (doc_id, key, node, fp; one document each) with their shingle hashes behind their
    fingerprints. ``docs``: doc_id, text; where ids are repeated, the text whose fingerprint it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for b in batches:
            out = []
            for key, node, fp, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                g = shingle_hashes(text, hashes, shingle)
                if wide_fingerprint(g).tobytes() == fp:
                    out.append((key, node, fp + g.tobytes()))
            cols = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["key", "node", "fp"])

    few = small_or_not(chosen.withColumnRenamed("doc_id", "of"), BROADCAST_IDS)
    found = docs.join(few, docs["doc_id"].eqNullSafe(F.col("of"))).select("key", "node", "fp", "text").mapInArrow(run, "key long, node long, fp binary")
    return found.groupBy("key", "node").agg(F.first("fp").alias("fp"))


def verified_links(members: DataFrame, most: int, similarity: float) -> DataFrame:
    """Links between the nodes of ``key, node, fp`` (a written table of :func:`with_shingles`), those of pairs of one key that reach the
    similarity exactly; they connect what all such pairs connect."""
    near = by_similarity(most, similarity)
    sizes = members.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n"), F.sum(F.octet_length("fp")).alias("size"))
    blocks = F.ceil(F.greatest(F.col("n") / CROWDED, F.col("size") / CROWDED_BYTES)).cast("int")
    hot = durable(sizes.select("k", "n", blocks.alias("blocks")).where("blocks > 1"), "similar-large")
    few, same = small_or_not(hot, BROADCAST_KEYS), F.col("key") == F.col("k")
    plain = members.join(few.select("k"), same, "left_anti").repartition("key").sortWithinPartitions("key")
    links = durable(plain.select("key", "node", "fp").mapInArrow(_walked(near, 1), "a long, b long").distinct(), "similar-exact")
    if hot.isEmpty():
        return links
    crowd = durable(members.join(few, same).select("key", "node", "n", "blocks"), "similar-crowd")
    return crowd_links(crowd, members.select("node", "fp"), near, links)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, component_id`` for every document: the smallest id reachable by similar texts."""
    fps = durable(wide_fingerprints(docs, id_col, text_col, shingle), "similar-fingerprints")
    classes = durable(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")).withColumn("node", F.monotonically_increasing_id()), "similar-classes")
    proposed = connected_components(similar_links(classes, most_bits(similarity)))
    chosen = durable(classes.join(proposed, "node").select(F.col("first_id").alias("doc_id"), F.col("root").alias("key"), "node", "fp"), "similar-proposed")
    members = durable(with_shingles(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), chosen, shingle), "similar-members")
    parts = connected_components(verified_links(members, most_bits(similarity), similarity))
    rooted = classes.join(parts, "node", "left").select("fp", "first_id", F.coalesce("root", "node").alias("root"))
    rooted = durable(rooted, "similar-roots")
    of_root = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps.join(rooted.join(of_root, "root").select("fp", "component_id"), "fp").select("doc_id", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows with the smallest id of their group of similar texts, with their own columns; of a
    group without any id, one row. Rows are told apart by a number written with them, not by their ids."""
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own")
    rows = durable(docs.select(own, F.monotonically_increasing_id().alias("at")), "similar-rows")
    doc_id = F.col("own")[id_col]
    rank = F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), "at")
    found = similar_groups(rows.select(rank.alias("rank"), F.col("own")[text_col].alias("text")), "rank", "text", shingle, similarity)
    gone = durable(found.where("doc_id.at <> component_id.at").select(F.col("doc_id.at").alias("gone")), "similar-dropped")
    return rows.join(small_or_not(gone, BROADCAST_IDS), F.col("at") == F.col("gone"), "left_anti").select("own.*")
