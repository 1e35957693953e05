"""Operator 13 against plain grouping, with fingerprints that collide, and composition over parts."""

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cuesheet.llm import common, exact_dedup, queries

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").translate(LOWER)].append(d)
    out = []
    for t, ids in groups.items():
        top = max(ids, key=lambda d: (d is not None, d or 0))
        first = True
        for d in ids:
            out.append((d, top, len(ids), first and d == top, hashlib.sha256(t.encode()).hexdigest()))
            first = first and d != top
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def slow_hash(data, m, base):
    h = 0
    for c in data:
        h = (h * base + c) % m
    return h


def test_elements_equal_horner():
    powers = exact_dedup.powers_of()
    for n in (0, 1, 100, exact_dedup.CHUNK - 1, exact_dedup.CHUNK, exact_dedup.CHUNK + 1, 3 * exact_dedup.CHUNK + 17):
        data = np.random.default_rng(n).integers(0, 256, n, np.uint8).tobytes() if n % 2 else b"\xff" * n
        e = exact_dedup.element(data, powers)
        assert e == (n, slow_hash(data, exact_dedup.MODULI[0], exact_dedup.BASES[0]), pow(exact_dedup.BASES[0], n, exact_dedup.MODULI[0]),
                     slow_hash(data, exact_dedup.MODULI[1], exact_dedup.BASES[1]), pow(exact_dedup.BASES[1], n, exact_dedup.MODULI[1]))


def test_parts_compose_to_the_whole(spark):
    """Texts cut anywhere, parts in any order over many tasks, give the fingerprint of the whole."""
    rng = random.Random(3)
    texts = {k: "".join(rng.choice("aAbé\n ") for _ in range(n)) for k, n in enumerate((0, 1, 50, 20_000, 70_000))}
    parts = []
    for k, t in texts.items():
        cuts = sorted({0, len(t), *(rng.randrange(len(t) + 1) for _ in range(7))})
        parts += [(k, i, t[a:b]) for i, (a, b) in enumerate(zip(cuts, cuts[1:] or cuts))]
    rng.shuffle(parts)
    df = spark.createDataFrame(parts, "doc_id long, part int, text string").repartition(5)
    got = {r.doc_id: (r.fingerprint, r.n_bytes) for r in exact_dedup.part_fingerprints(df, "doc_id", "part", "text").collect()}
    whole = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert got == {r.doc_id: (r.fingerprint, r.n_bytes) for r in exact_dedup.fingerprints(whole).collect()}


def test_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SMALL}/documents.parquet'")
    assert rows_of(queries.op13_exact_dedup(spark, SMALL).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == sorted(
        con.sql(f"select doc_id, keep_id, group_size, kept, text_sha256 from ({queries.ORACLE_SQL['op13_exact_dedup']})").fetchall(), key=str)


@pytest.mark.parametrize("moduli", [exact_dedup.MODULI, (3, 2)])
def test_equals_plain_grouping(spark, monkeypatch, moduli):
    """Copies from two to hundreds, odd rows, long texts that differ late; with fingerprints of 6 values every
    group is torn by the comparison. Units of 3 make several levels of comparison."""
    monkeypatch.setattr(exact_dedup, "UNIT", 3)
    monkeypatch.setattr(exact_dedup, "COMPARED", 64)
    monkeypatch.setattr(common, "FEW_ROWS", 0)
    long = "All the same words again. " * 400
    rows = [(i, f"text {i % 40}") for i in range(120)] + [(1000 + i, "COPY" if i % 2 else "copy") for i in range(300)]
    rows += [(2000, long), (2001, long + "x"), (2002, long + "y"), (2003, long.upper() + "X"), (2004, "É"), (2005, "é"), (2006, "K"), (2007, "K"), (2008, "k")]
    rows += [(None, "copy"), (None, None), (None, ""), (7, None), (8, "lone null id"), (None, "only null"), (None, "only null"), (9, "again"), (9, "again"), (9, "again")]
    df = spark.createDataFrame([(d, t, 1, "n", b"z") for d, t in rows], "doc_id long, text string, nth int, top string, chunk binary").repartition(40)
    assert rows_of(exact_dedup.exact_duplicates(df, moduli=moduli)) == plain(rows)
    assert exact_dedup.exact_duplicates(df.limit(0), moduli=moduli).count() == 0


def test_one_of_each(spark):
    df = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, "c"), (4, None), (5, "")], "doc_id long, text string").withColumn("kept", F.lit("own"))
    assert sorted(map(tuple, exact_dedup.one_of_each(df).collect())) == [(2, "a B", "own"), (3, "c", "own"), (5, "", "own")]
