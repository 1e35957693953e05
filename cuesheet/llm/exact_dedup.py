"""Exact duplicates by composable polynomial fingerprints (operator 13).

The fingerprint of a text is its bytes read as the digits of a number, modulo two primes. A part of a
text is the element ``(n_bytes, a, sa, b, sb)``: its two remainders, and the powers of the two bases that
shift what stands before it by its length. Elements compose: ``a = a1 * sa2 + a2``, ``sa = sa1 * sa2``. So
chunks are hashed side by side, as the rows of one matrix product, and combined by their lengths, in
whatever way a text was cut: :func:`fingerprints` cuts whole texts, :func:`part_fingerprints` takes texts that
lie in parts over many rows and tasks.

Texts of equal fingerprint and length are compared chunk by chunk: the chunks of one place meet in order,
neighbours are compared, and nothing but the chunk before is held. A task sends a chunk once, however
often it meets it again; very large groups are compared in units, whose first chunks are compared in turn.
Texts that a fingerprint does not tell apart are told apart by their SHA-256 and compared once more.

Defined cases: texts are equal when identical after lower-casing A-Z only; a null text is an empty one; of
equal texts the row with the largest id stays, a null id being the smallest, and one row only where that id is
repeated; whole texts are read and compared, however long; columns of any other name are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, looked_up

#: Two primes under 2**31 and a base for each.
MODULI = (2_147_483_647, 2_147_483_629)
BASES = (911_382_323, 972_663_749)
#: Bytes hashed by one row of a matrix product: 255 * 2**31 * 2**13 < 2**53, so doubles hold every sum exactly.
CHUNK = 8192
#: Bytes compared at once.
COMPARED = 65_536
#: Rows that may meet in one comparison of chunks.
UNIT = 1000
#: Bytes of chunks that a task remembers having sent.
REMEMBERED = 64 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
KEY = ["fingerprint", "n_bytes"]


def element(data: bytes, powers: np.ndarray, moduli=MODULI, bases=BASES) -> tuple[int, int, int, int, int]:
    """``(n_bytes, a, sa, b, sb)`` of some bytes: chunks hashed together, then combined."""
    x = np.frombuffer(data, np.uint8)
    whole = len(x) // CHUNK
    sums = [x[:whole * CHUNK].reshape(whole, CHUNK).astype(np.float64) @ powers, x[whole * CHUNK:].astype(np.float64)[None] @ powers[CHUNK - len(x) + whole * CHUNK:]]
    out = [len(x)]
    for m, base, found in zip(moduli, bases, np.concatenate(sums).T.astype(np.int64).tolist(), strict=True):
        shift, value = pow(base, CHUNK, m), 0
        for v in found[:-1]:
            value = (value * shift + v) % m
        out += [(value * pow(base, len(x) % CHUNK, m) + found[-1]) % m, pow(base, len(x), m)]
    return tuple(out)


def powers_of(moduli=MODULI, bases=BASES) -> np.ndarray:
    """Powers of the bases from ``CHUNK - 1`` down to 0, a column for each base."""
    cols = []
    for m, base in zip(moduli, bases, strict=True):
        p = [1]
        for _ in range(CHUNK - 1):
            p.append(p[-1] * base % m)
        cols.append(p[::-1])
    return np.array(cols, np.float64).T.copy()


def composed(elements: Column, moduli=MODULI) -> Column:
    """One element of an array of them in order; the products stay under 2**62."""
    start = F.struct(F.lit(0).cast("long").alias("n_bytes"), *(F.lit(v).cast("long").alias(k) for k, v in (("a", 0), ("sa", 1), ("b", 0), ("sb", 1))))

    def step(x: Column, y: Column) -> Column:
        on = lambda v, s, m: ((x[v] * y[s] + y[v]) % m).alias(v)
        shift = lambda s, m: (x[s] * y[s] % m).alias(s)
        return F.struct((x["n_bytes"] + y["n_bytes"]).alias("n_bytes"), on("a", "sa", moduli[0]), shift("sa", moduli[0]), on("b", "sb", moduli[1]), shift("sb", moduli[1]))

    return F.aggregate(elements, start, step)


def fingerprint(e: Column) -> Column:
    return F.shiftleft(e["a"], 31).bitwiseOR(e["b"])


def part_fingerprints(parts: DataFrame, key: str, order: str, text_col: str, moduli=MODULI, bases=BASES) -> DataFrame:
    """``key, fingerprint, n_bytes`` of texts that lie in parts: each part is hashed where it lies, and a text
    moves 40 bytes for each of its parts. Equal to :func:`fingerprints` of the parts put together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = powers_of(moduli, bases)
        for b in batches:
            found = [element((x.as_py() or b"").translate(_LOWER), powers, moduli, bases) for x in b.column(2)]
            cols = [pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 5)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], ["key", "nth", "n_bytes", "a", "sa", "b", "sb"])

    kind = {c: parts.schema[c].dataType.simpleString() for c in (key, order)}
    rows = parts.select(F.col(key), F.col(order), F.col(text_col).cast("binary")).mapInArrow(run, f"key {kind[key]}, nth {kind[order]}, n_bytes long, a long, sa long, b long, sb long")
    each = rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("nth", "n_bytes", "a", "sa", "b", "sb"))).alias("parts")).select("key", composed(F.col("parts"), moduli).alias("e"))
    return each.select(F.col("key").alias(key), fingerprint(F.col("e")).alias("fingerprint"), F.col("e.n_bytes").alias("n_bytes"))


def _fingerprinted(docs: DataFrame, text_col: str, own: list[Column], with_text: bool, moduli, bases) -> DataFrame:
    """``own`` columns, ``fingerprint, n_bytes, text_sha256`` and, if asked for, the lower-cased bytes of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = powers_of(moduli, bases)
        for b in batches:
            texts = [(x.as_py() or b"").translate(_LOWER) for x in b.column(width)]
            found = [element(t, powers, moduli, bases) for t in texts]
            cols = [pa.array([a << 31 | z for _, a, _, z, _ in found], pa.int64()), pa.array([e[0] for e in found], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
            yield pa.RecordBatch.from_arrays(b.columns[:width] + cols + [pa.array(texts, pa.binary())] * with_text, names)

    width = len(own)
    rows = docs.select(*own, F.col(text_col).cast("binary").alias("text"))
    names = rows.columns[:-1] + [*KEY, "text_sha256"] + ["text"] * with_text
    schema = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1]] + ["fingerprint long, n_bytes long, text_sha256 string"] + ["text binary"] * with_text
    return rows.mapInArrow(run, ", ".join(schema))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", moduli=MODULI, bases=BASES) -> DataFrame:
    """``nth, doc_id, fingerprint, n_bytes, text_sha256`` of every row; no row moves. ``nth`` tells rows apart once the table is written."""
    return _fingerprinted(docs, text_col, [F.monotonically_increasing_id().alias("nth"), F.col(id_col).alias("doc_id")], False, moduli, bases)


def groups_of(prints: DataFrame, by: list[str]) -> DataFrame:
    """Keys that several rows share: their number and the row that stays."""
    return prints.groupBy(*by).agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "nth")).alias("top")).where("n > 1")


def _chunks(members: DataFrame, by: list[str]) -> DataFrame:
    """``by, units, at, unit, chunk``: the chunks of the texts, each once for each task and place."""
    width = len(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sent, held = TaskContext.get().partitionId(), OrderedDict(), 0
        for b in batches:
            out, size = [], 0
            for *key, units, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for at in range(0, len(text), COMPARED):
                    place, chunk = (*key, at), text[at:at + COMPARED]
                    if sent.get(place) == chunk:
                        sent.move_to_end(place)
                        continue
                    held += len(chunk) - len(sent.pop(place, b""))
                    sent[place] = chunk
                    while held > REMEMBERED:
                        held -= len(sent.popitem(last=False)[1])
                    out.append((*key, units, at, here % units, chunk))
                    size += len(chunk)
                    if size > REMEMBERED:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names)

    names = [*by, "units", "at", "unit", "chunk"]
    types = [pa.int64(), pa.int64(), pa.string()][:width] + [pa.int64()] * 3 + [pa.binary()]
    kind = ["long", "long", "string"][:width] + ["long"] * 3 + ["binary"]
    return members.select(*by, "units", "text").mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kind, strict=True)))


def _compared(chunks: DataFrame, by: list[str]) -> DataFrame:
    """A row for each unit whose chunks differ and for the first chunk of each unit that has others beside it."""
    places = [*by, "at", "unit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = last = None
        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                *place, units, chunk = row
                if place != before:
                    before, last = place, chunk
                    if units > 1:
                        out.append((*place[:-1], place[-1] // UNIT, -(-units // UNIT), chunk, False))
                elif chunk != last:
                    out.append((*place[:-1], 0, 1, None, True))
            cols = list(zip(*out)) if out else [[]] * (len(places) + 3)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    names = [*places, "units", "chunk", "differs"]
    types = [pa.int64(), pa.int64(), pa.string()][:len(by)] + [pa.int64()] * 3 + [pa.binary(), pa.bool_()]
    kind = ["long", "long", "string"][:len(by)] + ["long"] * 3 + ["binary", "boolean"]
    rows = chunks.select(*places, "units", "chunk").repartition(*places).sortWithinPartitions(*places)
    return rows.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kind, strict=True)))


def differing(texts: DataFrame, groups: DataFrame, by: list[str], total: int) -> DataFrame:
    """Keys of ``groups`` under which two texts differ, by comparing all their chunks. ``texts`` are rows of
    :func:`_fingerprinted` with their bytes."""
    members = looked_up(texts, groups.select(*by, "n", F.ceil(F.col("n") / UNIT).alias("units")), by, "n", total)
    found = durable(_compared(_chunks(members, by), by), "compared")
    bad = found.where("differs").select(*by)
    while (more := found.where("chunk IS NOT NULL")).limit(1).count():
        found = durable(_compared(more, by), "compared")
        bad = bad.unionByName(found.where("differs").select(*by))
    return bad.distinct()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", moduli=MODULI, bases=BASES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    prints = durable(fingerprints(docs, id_col, text_col, moduli, bases), "fingerprints")
    total = prints.count()
    texts = _fingerprinted(docs, text_col, [], True, moduli, bases)

    def result(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
        r = looked_up(rows, groups, by, "n", total, "left")
        return r.select("doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                        F.coalesce(F.col("nth") == F.col("top.nth"), F.lit(True)).alias("kept"), "text_sha256")

    groups = durable(groups_of(prints, KEY), "equal-prints")
    bad = durable(differing(texts, groups, KEY, total), "differing")
    if not bad.limit(1).count():
        return result(prints, groups, KEY)
    finer = [*KEY, "text_sha256"]
    torn = durable(prints.join(bad, KEY, "left_semi"), "torn")
    parts = durable(groups_of(torn, finer), "equal-sums")
    if differing(texts, parts, finer, total).limit(1).count():
        raise ValueError("different texts have the same SHA-256")
    return result(prints.join(bad, KEY, "left_anti"), groups.join(bad, KEY, "left_anti"), KEY).unionByName(result(torn, parts, finer))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text a row of larger id has. Ids must tell rows apart."""
    gone = exact_duplicates(docs, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias(id_col))
    return docs.join(gone, id_col, "left_anti")
