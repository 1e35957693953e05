"""SimHash near duplicates by Golay-code fuzzy hashing (operator 7).

A 64-bit fingerprint is cut into three segments of at most 23 bits. Of up to two wrong bits, some
two segments hold at most one together, so for some ordered pair one segment is equal and the
other differs in one bit or none. The other is decoded by the perfect Golay (23, 12) code: its keys
are the index of the codeword within distance 3 and, if that lies at distance 3 exactly, those of
the five codewords at distance 4. Words one bit apart always share a key, so rows that meet under
(pair, equal segment, codeword index) hold every link; each is verified by its differing bits.

Fingerprints are first made distinct. A key that more than ``BUCKET`` fingerprints share is not
expanded into pairs: its members are linked through midpoints instead (two fingerprints differ in
two bits at most if and only if some word lies within one bit of both), which needs 65 rows a
fingerprint and finds the same links. Components are taken over fingerprints.

Defined cases: a null text has no words and fingerprint 0; null ids take part and are smallest of
nothing (a component with no id at all has a null id); repeated rows share a fingerprint; texts are
read whole, however long; columns of any other name are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, small_or_not
from .components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
BUCKET = 24
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the Golay code.
GENERATOR = 0b110001110101
#: Ids up to which a list of dropped documents is broadcast.
BROADCAST_IDS = 1_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    from xxhash import xxh64_intdigest

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    ones, n = np.zeros(64, np.int64), max(1, len(w) - shingle + 1)
    for lo in range(0, n, 1 << 16):
        part = w[lo:lo + (1 << 16) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)), strict=False)) if len(w) >= shingle else [b" ".join(w)]
        h = np.array([xxh64_intdigest(g, seed) for g in grams], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``; fp is the fingerprint as a signed long."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            fp = np.array([fingerprint(texts[i].as_py(), shingle) for i in range(b.num_rows)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {id_type}, fp long")


def _syndrome(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of bytes at each of three places, and the error patterns of each syndrome (6, -1 where there are fewer)."""
    places = np.array([[_syndrome(b << 8 * p & 0x7FFFFF) for b in range(256)] for p in range(3)], np.int32)
    errors = np.full((2048, 6), -1, np.int32)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            errors[_syndrome(e), 0] = e
    filled = np.ones(2048, int)
    for bits in combinations(range(23), 4):
        e = sum(1 << b for b in bits)
        s = _syndrome(e)
        errors[s, filled[s]] = e
        filled[s] += 1
    return places, errors


def codeword_keys(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords near each 23-bit word; shape (n, 6), -1 where there are fewer."""
    places, errors = golay_tables()
    s = places[0][words & 255] ^ places[1][words >> 8 & 255] ^ places[2][words >> 16 & 127]
    e = errors[s]
    return np.where(e < 0, -1, (words[:, None] ^ e) >> 11)


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of fingerprints (unsigned)."""
    segments = [(fp >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    near = [codeword_keys(s) for s in segments]
    rows, keys = [], []
    for i in range(3):
        for j in range(3):
            if i != j:
                r, c = np.nonzero(near[j] >= 0)
                rows.append(r)
                keys.append((np.int64(3 * i + j) << 40) | segments[i][r] << 12 | near[j][r, c])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False)
        rows, keys = fuzzy_keys(fp.view(np.uint64))
        for lo in range(0, len(rows), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[lo:lo + 100_000]), pa.array(fp[rows[lo:lo + 100_000]])], ["key", "fp"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Sorted (key, fp) rows, in pieces that each begin with the last ``BUCKET`` rows of the
    previous one: key, fp, rows of the key so far, and whether the row is new."""
    key, fp, nth = (np.empty(0, np.int64) for _ in range(3))
    for b in batches:
        if not b.num_rows:
            continue
        old = len(key)
        key = np.concatenate([key, b.column(0).to_numpy(zero_copy_only=False)])
        fp = np.concatenate([fp, b.column(1).to_numpy(zero_copy_only=False)])
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        start = np.repeat(first, np.diff(np.r_[first, len(key)]))
        base = np.where(start == 0, nth[0] if old else 0, 0)
        nth = np.arange(len(key)) - start + base
        yield key, fp, nth, np.arange(len(key)) >= old
        key, fp, nth = key[-BUCKET:], fp[-BUCKET:], nth[-BUCKET:]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links inside keys; from the ``BUCKET``-th row of a key on, and for the rows
    before, the fingerprints are named for linking by midpoints (as links with themselves)."""
    for key, fp, nth, new in _runs(batches):
        a, b = [], []
        for d in range(1, BUCKET):
            at = np.flatnonzero(new[d:] & (key[d:] == key[:-d]) & (nth[d:] < BUCKET)) if len(key) > d else np.empty(0, int)
            if not len(at):
                break
            good = at[np.bitwise_count((fp[at] ^ fp[at + d]).view(np.uint64)) <= MAX_BITS]
            a.append(fp[good])
            b.append(fp[good + d])
        for d in range(BUCKET + 1):  # a row past the bucket names itself, the first of them also those before
            at = np.flatnonzero(new[d:] & (key[d:] == key[:len(key) - d]) & ((nth[d:] == BUCKET) if d else (nth >= BUCKET)))
            a.append(fp[at])
            b.append(fp[at])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])


def _midpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.r_[np.uint64(0), np.uint64(1) << np.arange(64, dtype=np.uint64)]
    for b in batches:
        for lo in range(0, b.num_rows, 4096):
            fp = b.column(0).slice(lo, 4096).to_numpy(zero_copy_only=False)
            z = (fp.view(np.uint64)[:, None] ^ flips).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(z.view(np.int64)), pa.array(np.repeat(fp, 65))], ["key", "fp"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a key with the key's first row."""
    key0, fp0 = None, None
    for b in batches:
        if not b.num_rows:
            continue
        key, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        new = np.r_[key[0] != key0, key[1:] != key[:-1]]
        at = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        head = np.where(at < 0, fp0 if fp0 is not None else 0, fp[at])
        key0, fp0 = key[-1], head[-1]
        yield pa.RecordBatch.from_arrays([pa.array(head[~new]), pa.array(fp[~new])], ["a", "b"])


def links(distinct: DataFrame) -> DataFrame:
    """Links ``a, b`` whose components are those of all pairs at ``MAX_BITS`` or fewer bits; ``distinct`` has distinct ``fp``."""
    found = durable(distinct.select("fp").mapInArrow(_keyed, "key long, fp long").repartition("key").sortWithinPartitions("key", "fp")
                    .mapInArrow(_pairs, "a long, b long"), "simhash-pairs")
    crowded = found.where("a = b").select(F.col("a").alias("fp")).distinct()
    by_midpoint = crowded.mapInArrow(_midpoints, "key long, fp long").repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_stars, "a long, b long")
    return found.where("a <> b").unionByName(by_midpoint)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every document."""
    fps = durable(fingerprints(docs, id_col, text_col, shingle), "simhash-fingerprints")
    classes = durable(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    parts = connected_components(links(classes))
    rooted = classes.join(parts, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = durable(rooted, "simhash-roots")
    of_root = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = rooted.join(of_root, "root").select("fp", "component_id")
    return fps.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
