"""Operators 8, 9 and 10: held-out accuracy, brute force, and normalisation."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cuesheet.llm import crf_quality, embedding_dedup, lbl_lm, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows(spark):
    return spark.createDataFrame([(1, None, "en", "a", 0), (None, "one two\n\nthree", "en", "a", 3), (3, "", "en", None, 9), (3, "x\ty " * 4000, "en", None, 9)], SCHEMA)


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_marginals_equal_enumeration():
    from itertools import product

    rng = np.random.default_rng(1)
    u, trans, lengths = rng.normal(size=(3, 5, 2)), rng.normal(size=(2, 2)), np.array([1, 3, 5])
    bad, moves, z = crf_quality.marginals(u, lengths, trans)
    for d, n in enumerate(lengths):
        paths = list(product((0, 1), repeat=n))
        s = np.array([sum(u[d, t, y] for t, y in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:])) for p in paths])
        assert np.isclose(z[d], np.log(np.exp(s).sum()))
        w = np.exp(s - z[d])
        for t in range(n):
            assert np.isclose(bad[d, t], sum(x for x, p in zip(w, paths) if p[t]))
        assert np.isclose(moves[d].sum(), n - 1)


def test_quality_classifier_holds_out(spark, sf):
    got = {r.doc_id: r for r in queries.op8_crf_quality(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for k, r in got.items())
    out = [(got[k].score, y, got[k].predicted) for k, y in labels.items() if got[k].held_out]
    s, y, p = (np.array(x) for x in zip(*out))
    assert auc(s, y) > 0.9 and (p[y == 1] == 1).mean() > 0.95


def test_quality_scores_equal_enumeration(spark, sf):
    """Marginals over all labellings of short documents, their length-weighted mean, and the curve."""
    from itertools import product

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    field = crf_quality.fit_field(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    n = crf_quality.N_BINS
    own, before, after, bias = field.weights[:n], field.weights[n:2 * n], field.weights[2 * n:3 * n], field.weights[-1]
    text = {r.doc_id: r.text for r in docs.collect()}
    seen = 0
    for r in crf_quality.quality_scores(docs, field).collect():
        bins, sizes = crf_quality.line_measures(text[r.doc_id] or "")
        if not 1 < len(bins) < 9:
            continue
        seen += 1
        u = [bias + sum(own[b] for b in x) + (sum(before[b] for b in bins[i - 1]) if i else 0) + (sum(after[b] for b in bins[i + 1]) if i + 1 < len(bins) else 0) for i, x in enumerate(bins)]
        weight = {p: math.exp(sum(a for a, y in zip(u, p) if y) + sum(field.trans[a, b] for a, b in zip(p, p[1:]))) for p in product((0, 1), repeat=len(bins))}
        good = [sum(w for p, w in weight.items() if not p[i]) / sum(weight.values()) for i in range(len(bins))]
        q = min(max(sum(g * s for g, s in zip(good, sizes)) / sum(sizes), 1e-4), 1 - 1e-4)
        want = 1 / (1 + math.exp(-(field.curve[0] * math.log(q / (1 - q)) + field.curve[1] * q + field.curve[2])))
        assert abs(want - r.score) < 1e-6 and r.predicted == (r.score >= 0.3)
    assert seen > 50


def test_classifier_odd_rows(spark):
    docs = odd_rows(spark)
    labels = spark.createDataFrame([(1, 1), (3, None)], "doc_id long, quality int")
    field = crf_quality.fit_field(docs, labels)
    got = [r.score for r in crf_quality.quality_scores(docs, field).collect()]
    assert got == [0.5] * 4  # the only labelled text has no words
    two = crf_quality.fit_field(docs, spark.createDataFrame([(1, 1), (3, 0), (3, 1)], "doc_id long, quality int"))
    assert two.prior is not None or all(0 <= r.score <= 1 for r in crf_quality.quality_scores(docs, two).collect())
    assert crf_quality.quality_scores(docs.limit(0), field).count() == 0


def test_classifier_with_columns_of_its_own_names(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").limit(300), spark.read.parquet(f"{sf}/labels.parquet")
    clash = [F.lit(7).alias(k) for k in ("_id", "_y", "_t", "_order", "score", "held_out")]
    plain, odd = crf_quality.fit_field(docs, labels), crf_quality.fit_field(docs.select("*", *clash), labels.select("*", *clash))
    assert np.array_equal(plain.weights, odd.weights)
    score = lambda df, field: sorted(map(tuple, crf_quality.quality_scores(df, field).collect()))
    assert score(docs, plain) == score(docs.select("*", *clash), odd)


def plain_links(rows):
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([r[2] for r in rows])
    link = (x @ x.T >= 0.98) & (lab[:, None] == lab)
    np.fill_diagonal(link, False)
    comp = dict(zip(ids, ids))
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            m = min([comp[ids[i]], *(comp[ids[j]] for j in np.flatnonzero(link[i]))])
            if m < comp[ids[i]]:
                comp[ids[i]] = m
                changed = True
    return {i: (int(link[k].sum()), comp[i]) for k, i in enumerate(ids)}


def test_embedding_links_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 32))
    near = np.concatenate([base[:20] + rng.normal(size=(20, 32)) * s for s in (0.02, 0.1, 0.14, 0.2)])
    crowd = base[50] + rng.normal(size=(150, 32)) * 0.1
    x = np.concatenate([base, near, crowd, near[:5], base[:3] * 7]).astype(np.float32)
    rows = [(i, v.tolist(), 7 if i % 9 else 8) for i, v in enumerate(x)]
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    monkeypatch.setattr(embedding_dedup, "CROWDED", 60)
    monkeypatch.setattr(embedding_dedup, "THIN", 1)
    odd = [(1000, None, 7), (1001, [0.0] * 32, 7), (1002, [float("nan")] + [1.0] * 31, 7), (1003, rows[0][1], None), (1004, [], 7), (1005, [1.0, 0.0], 7)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    want = plain_links(rows)
    assert len(got) == len(rows) + len(odd)
    for k, (n, c) in want.items():
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (n, c, k == c)
    for r in odd:
        assert (got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (0, r[0], True)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_odd_ids(spark):
    """Null ids are smallest of nothing; repeated rows are copies of each other; other columns are not read."""
    v, w = [1.0, 0.0, 2.0], [0.0, 3.0, 0.0]
    df = spark.createDataFrame([(None, v, 1, 0), (None, v, 1, 0), (7, w, 1, 0), (7, w, 1, 0), (None, w, 2, 0)], "vec_id long, embedding array<float>, label int, node int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 1, None, True), (None, 1, None, True), (7, 1, 7, True), (7, 1, 7, True), (None, 0, None, True)], key=str)


@pytest.mark.parametrize("kind, labels", [("string", ["a", "b", "1"]), ("double", [1.2, 1.7, -0.0]), ("decimal(4,2)", [1, 2, 3]), ("date", None), ("array<int>", [[1], [1, 2], []]), ("boolean", [True, False, None])])
def test_embedding_labels_of_any_type(spark, kind, labels):
    """Equal labels link, others don't, of whatever type; zeros of both signs are equal."""
    from datetime import date
    from decimal import Decimal

    labels = labels or [date(2024, 1, k) for k in (1, 2, 3)]
    labels = [Decimal(x) for x in labels] if kind.startswith("decimal") else labels
    v = [1.0, 0.5, 2.0]
    rows = [(i, [x + i * 1e-3 for x in v], label) for i, label in enumerate(labels * 2)]
    if kind == "double":
        rows.append((6, v, 0.0))
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()}
    for i, (_, _, a) in enumerate(rows):
        same = [j for j, (_, _, b) in enumerate(rows) if a is not None and a == b]
        assert got[i] == (max(len(same) - 1, 0), min(same, default=i))


def test_colliding_label_numbers_take_another_seed(spark, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(embedding_dedup.F, "xxhash64", lambda c, seed=None: real(c) if seed is None else F.when(seed == 0, 5).otherwise(real(c, seed)))
    rows = embedding_dedup.numbered(spark.createDataFrame([("a",), ("b",), (None,)], "label string"))
    assert len({r.label for r in rows.collect()}) == 3


@pytest.mark.parametrize("dim", [64, 256])
def test_embedding_recall_at_the_threshold(spark, dim):
    """Planted groups whose pairs lie on both sides of the threshold, at the real widths of keys."""
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(2000, dim))
    near = np.concatenate([base[:400] + rng.normal(size=(400, dim)) * s for s in (0.1, 0.15, 0.19, 0.2, 0.21)] + [base[500] + rng.normal(size=(300, dim)) * 0.13])
    x = np.concatenate([base, near]).astype(np.float32)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    want = plain_links(rows)
    total, found = sum(n for n, _ in want.values()), sum(got[k].n_links for k in want)
    assert 0 <= total - found <= 0.001 * total and total > 1000
    assert sum(got[k].component_id != c for k, (_, c) in want.items()) <= 0.001 * len(want)


def test_units_name_few_rows():
    """A close group's unit gives a row for each vector, not for each pair, and connects it."""
    assert embedding_dedup.connected(6, np.array([1, 2, 4]), np.array([2, 3, 5])).tolist() == [0, 1, 1, 1, 4, 4]
    chain = np.arange(999)
    assert (embedding_dedup.connected(1000, chain, chain + 1) == 0).all()


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 64))
    x[200:] = x[:200] + rng.normal(size=(200, 64)) * rng.uniform(0.05, 2, size=(200, 1))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, f = embedding_dedup.encode(x)
    value, bound = embedding_dedup.estimates(q[:200], f[:200], q[200:], f[200:])
    error = value - x[:200] @ x[200:].T
    assert abs(error.mean()) < 0.01 and (np.abs(error) <= bound).all()


def test_language_model(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op10_log_bilinear(spark, sf).collect()}
    out = {k for k in texts if zlib.crc32(str(k).encode()) % 10 == 0}
    toks = {k: lbl_lm.tokens(t) for k, t in texts.items()}
    c = Counter(w for k in texts if k not in out for w in toks[k])
    n, v = sum(c.values()), len(c)
    for k, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (k in out, len(toks[k]), sum(c[w] > 0 for w in toks[k]), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks[k]), rel_tol=1e-9)
    base, model = (sum(getattr(got[k], x) for k in out) for x in ("base_score", "score"))
    assert model > base * 0.95  # both are negative


def test_model_is_normalised():
    rng = np.random.default_rng(0)
    m = lbl_lm.initial(rng.random(300) + 0.01)
    m.a[:], m.r[:] = rng.normal(size=m.a.shape), rng.normal(size=m.r.shape)
    m.log_z = np.stack([m.log_z_of(i) for i in range(lbl_lm.COARSE + 1)])
    every = [m.log_prob(np.array([5, t]), np.array([0]))[1] for t in range(300)]
    assert abs(np.exp(every).sum() - 1) < 1e-4


def test_scores_equal_a_direct_softmax(spark):
    """Every token's class by a softmax written out, and its share of the class."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(odd_rows(spark))
    counts = lbl_lm.durable(lbl_lm.word_counts(docs.where(lbl_lm.fold(F.col("doc_id")) != 0)), "test-counts")
    classes = lbl_lm.gather_classes(counts)
    sent = spark.sparkContext.broadcast(classes)
    encoded = lbl_lm.durable(lbl_lm.encode_corpus(docs, sent), "test-corpus")
    model = lbl_lm.train_model(encoded, classes, sent)
    n = {bytes(r.word): r.n for r in counts.collect()}
    codes = lbl_lm._Codes(classes)
    cls_of = lambda w: int(lbl_lm.classes_of(np.array([codes[w]]), classes)[0])
    mass = np.full(classes.k, 0.1)
    for w, c in n.items():
        mass[cls_of(w)] += c + 0.1
    mass[:len([w for w in classes.head if cls_of(w) < classes.k // 2])] -= 0.1
    assert np.allclose(mass[cls_of(b"the")], classes.mass[cls_of(b"the")])
    text = {r.doc_id: r.text for r in docs.where("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("text")).collect()}
    got = lbl_lm.score_texts(encoded, counts, classes, model).where("doc_id > 3").orderBy("doc_id").limit(25).collect()
    for r in got:
        c1, c2, total = classes.k, lbl_lm.COARSE, 0.0
        for w in lbl_lm.tokens(text[r.doc_id]):
            c = cls_of(w)
            s = (model.a[c1] + model.b[c2]).astype(float) @ model.r.T + model.bias
            total += (s[c] - np.log(np.exp(s).sum())) / math.log(10) + math.log10((n.get(w, 0) + 0.1) / classes.mass[c])
            c1, c2 = c, (min(c1, lbl_lm.COARSE - 1) if c1 < classes.k else lbl_lm.COARSE)
        assert math.isclose(total, r.score, rel_tol=1e-4), r.doc_id


def test_contexts_stop_at_texts():
    one, two = lbl_lm.contexts(np.array([1, 2, 3, 4, 5, 600]), np.array([0, 3, 4]), 700)
    s, c = 700, lbl_lm.COARSE
    assert one.tolist() == [s, 1, 2, s, s, 5] and two.tolist() == [c, c, 1, c, c, c]
    assert lbl_lm.contexts(np.array([600, 1, 2]), np.array([0]), 700)[1].tolist() == [c, c, c - 1]


def test_classes_grow_with_the_corpus(spark):
    few, many = (spark.createDataFrame([(bytearray(b"%d" % i), 9) for i in range(n)], "word binary, n long") for n in (100, 2500))
    assert (lbl_lm.gather_classes(few).k, lbl_lm.gather_classes(many).k) == (188, 428)


def test_language_model_odd_rows(spark):
    got = lbl_lm.language_scores(odd_rows(spark)).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 4, 8001] and all(np.isfinite([r.base_score, r.score]).all() for r in got)
    assert lbl_lm.language_scores(odd_rows(spark).limit(0)).count() == 0


def test_frequent_words_are_bounded_and_complete(spark):
    rows = [(bytearray(b"w%d" % i), n) for i, n in enumerate([5_000_000, 3000, 2999, 7, 7, 7, 2, 1, 1])] + [(bytearray(lbl_lm.END), 2)]
    counts = spark.createDataFrame(rows, "word binary, n long").repartition(3)
    assert lbl_lm.frequent(counts, 6) == [(b"w0", 5_000_000), (b"w1", 3000), (b"w2", 2999), (b"w3", 7), (b"w4", 7), (b"w5", 7), (b"\n", 2)]
    assert lbl_lm.frequent(counts, 5) == [(b"w0", 5_000_000), (b"w1", 3000), (b"w2", 2999), (b"\n", 2)]
    assert len(lbl_lm.frequent(counts, 100)) == 10
    assert lbl_lm.frequent(counts.limit(0), 5) == []
