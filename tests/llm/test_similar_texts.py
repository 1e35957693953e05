"""The wide SimHash: exact similarities, crowded keys, odd rows."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cuesheet.llm import similar_texts as st

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def made(rng, n=120):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def edited(rng, words, edits):
    out = list(words)
    for i in rng.sample(range(len(out)), edits):
        out[i] = f"x{rng.randrange(10**6)}"
    return out


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], SCHEMA)


def jaccard(a, b):
    s, t = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(s & t) / len(s | t)


def test_bit_counts():
    x = np.random.default_rng(1).integers(0, 1 << 63, (1001, st.WIDE), dtype=np.uint64)
    for n in (1, 2, 3, 4, 100, 1001):
        assert (st.bit_counts(x[:n]) == np.unpackbits(x[:n].view(np.uint8), axis=1, bitorder="little").sum(axis=0)).all()


def test_walk_connects_like_all_pairs():
    rng = np.random.default_rng(2)
    fp = rng.integers(0, 1 << 63, (60, st.WIDE), dtype=np.uint64)
    fp = np.concatenate([fp, fp ^ (np.uint64(1) << rng.integers(0, 63, (60, st.WIDE), dtype=np.uint64))])
    a, b = st.walk(len(fp), st.by_bits(12)([x.tobytes() for x in fp]))
    assert sorted(zip(np.concatenate(a) % 60, np.concatenate(b) % 60)) == [(i, i) for i in range(60)]


def test_similar_texts_meet_and_others_do_not(spark):
    rng = random.Random(3)
    base = [made(rng) for _ in range(60)]
    copies = [(k, edited(rng, base[k], e)) for e in (1, 2, 9) for k in range(60)]
    texts = [" ".join(w) for w in base] + [" ".join(w).upper() if i % 7 == 0 else " \n ".join(w) for i, (_, w) in enumerate(copies)]
    got = {r.doc_id: r.component_id for r in st.similar_groups(frame(spark, texts)).collect()}
    caught = total = 0
    for i, (k, w) in enumerate(copies):
        j = jaccard([x.upper() for x in w], [x.upper() for x in base[k]])
        if j >= 0.8:
            total += 1
            caught += got[60 + i] == k
        if j < 0.6:
            assert got[60 + i] == 60 + i
    assert total > 80 and caught >= 0.97 * total


@pytest.mark.parametrize("n", [300])
def test_crowded_keys_find_the_same_groups(spark, monkeypatch, n):
    """One text with very many close copies that differ from each other, and others around."""
    rng = random.Random(4)
    one = made(rng, 400)
    texts = [" ".join(one)] + [" ".join(edited(rng, one, rng.randint(1, 6))) for _ in range(n)] + [" ".join(made(rng)) for _ in range(40)]
    df = frame(spark, texts)
    plain = {r.doc_id: r.component_id for r in st.similar_groups(df).collect()}
    monkeypatch.setattr(st, "CROWDED", 32)
    monkeypatch.setattr(st, "THIN", 1)
    monkeypatch.setattr(st, "HUBS", 2)
    monkeypatch.setattr(st, "CROWDED_BYTES", 40_000)
    crowded = {r.doc_id: r.component_id for r in st.similar_groups(df).collect()}
    assert plain == crowded and {plain[i] for i in range(n + 1)} == {0} and all(plain[i] == i for i in range(n + 1, n + 41))


def test_rows_outside_the_main_component_meet_all_rows(spark):
    """Sides of a crowded key that only some of their rows link."""
    rng = np.random.default_rng(5)
    fp = rng.integers(0, 1 << 63, (1, st.WIDE), dtype=np.uint64).repeat(40, axis=0)
    fp[:, 0] = np.arange(40)
    rows = [(0, 0, 0, i, fp[i].tobytes()) for i in range(20)] + [(0, 0, 1, i, fp[i].tobytes()) for i in (3, 30)]
    df = spark.createDataFrame([(k, b, s, n, bytearray(f)) for k, b, s, n, f in rows], "key long, block int, side int, node long, fp binary").repartition(1).sortWithinPartitions("key", "block")
    got = {(r.a, r.b) for r in df.mapInArrow(st._across(st.by_bits(1)), "a long, b long").collect()}
    assert got == {(a, b) for a in (3, 30) for b in range(20) if a != b and (a ^ b).bit_count() <= 1}


def similar_pairs(sets, least):
    """All pairs of the sets (number: frozenset) that reach ``least``: those that share one of the rarest members that a pair must share."""
    often = Counter(x for s in sets.values() for x in s)
    index, out = defaultdict(list), {}
    for k, s in sorted(sets.items(), key=lambda x: len(x[1])):
        first = sorted(s, key=lambda x: (often[x], x))[:len(s) - math.ceil(least * len(s)) + 1]
        met = {j for x in first for j in index[x]}
        for j in met:
            t = sets[j]
            if len(t) >= least * len(s) and (v := len(s & t) / len(s | t)) >= least:
                out[j, k] = v
        for x in first:
            index[x].append(k)
    return out


def exact_sets(texts):
    """Distinct sets of five words (fewer: all), A-Z in lower case, and the texts that have each."""
    of = defaultdict(list)
    for k, t in texts.items():
        w = (t or "").encode().lower().split()
        of[frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)])].append(k)
    return of


def test_groups_by_exact_similarity(spark):
    """Over 10,000 documents: no group but of pairs of 0.8 or more, and of those pairs, band by band, over 95 % found; nothing here reads fingerprints."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    of = exact_sets(texts)
    sets = dict(enumerate(of))
    pairs = similar_pairs(sets, 0.8)
    root = dict(zip(sets, sets))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    exact = {d: find(k) for k, s in sets.items() for d in of[s]}
    got = {r.doc_id: r.component_id for r in st.similar_groups(docs).collect()}
    groups = defaultdict(set)
    for d, c in got.items():
        groups[c].add(exact[d])
    assert all(len(x) == 1 for x in groups.values())
    assert all(len({got[d] for d in ids}) == 1 for ids in of.values())
    bands = defaultdict(list)
    for (a, b), v in pairs.items():
        bands[min(3, int((v - 0.8) / 0.025))].append(got[of[sets[a]][0]] == got[of[sets[b]][0]])
    print({k: (sum(v), len(v)) for k, v in sorted(bands.items())})
    assert len(pairs) > 40 and all(sum(v) >= 0.95 * len(v) for v in bands.values())


def test_one_of_each_tells_rows_apart(spark):
    """Null ids and repeated ids with different texts: only rows whose group keeps another go."""
    text = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(5)]
    rows = [(3, text[0]), (5, text[0]), (5, text[1]), (None, text[0]), (None, text[2]), (None, text[3]), (None, text[3]), (7, text[4]), (7, text[4]), (8, None), (9, ""), (10, "x " * 30_000)]
    df = spark.createDataFrame([(i, t, "en", str(n), 0, n, 1) for n, (i, t) in enumerate(rows)], SCHEMA + ", at long, own int")
    got = st.one_of_each(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == sorted([(3, text[0]), (5, text[1]), (0, text[2]), (0, text[3]), (7, text[4]), (8, ""), (10, "x " * 30_000)])
    assert st.one_of_each(df.limit(0)).count() == 0 and st.similar_groups(df.limit(0)).count() == 0
