"""Mixing, archives and the pipeline against plain versions."""

import base64
import hashlib
import re
from collections import Counter, defaultdict

import duckdb

import corpus_pipeline
from cuesheet.llm import common, mixing, quality_rules, queries, warc

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(common.WORD)


def plain_targets(sizes):
    """Share by weight; cap at three times the size; reshare the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, left, free = {}, float(sum(sizes.values())), set(order)
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] >= 3 * sizes[s]]
        if not over:
            target |= {s: unit * weight[s] for s in free}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def plain_mix(rows):
    """(doc_id, source, text): key, size and words taken of each."""
    size = Counter()
    for _, s, t in rows:
        size[s] += len(WORD.findall(t or ""))
    target = plain_targets(size)
    out = []
    for s in size:
        own = sorted((hashlib.md5(f"mix-1|{'' if d is None else d}".encode()).hexdigest(), d, len(WORD.findall(t or ""))) for d, x, t in rows if x == s)
        goal = int(target[s])
        epochs, before = (goal // size[s], 0) if size[s] else (0, 0)
        rest = goal - epochs * size[s]
        for _, d, n in own:
            out.append((d, n, size[s], round(target[s], 6), epochs * n + max(0, min(n, rest - before)), epochs + (n > 0 and before < rest or n == 0 and before < rest)))
            before += n
    return out


def test_mixing_equals_plain_version(spark):
    got = [tuple(r)[:3] + (round(r.target, 6), r.taken) for r in queries.op1_source_mixing(spark, SMALL).collect()]
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "text").collect()]
    assert sorted(got) == sorted(r[:5] for r in plain_mix(rows))


def test_mixing_odd_rows(spark):
    rows = [(1, "a b c", "en", None, 0), (2, None, "en", "z", 0), (None, "a b", "en", "a", 0), (None, "c d e f", "en", "a", 0), (3, "x " * 50, "en", "b", 0), (3, "x " * 50, "en", "b", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix_plan(df).collect()
    assert len(got) == 6 and all(0 <= r.taken <= 3 * r.size for r in got)
    per = defaultdict(lambda: [0, 0.0])
    for r in got:
        per[r.source][0] += r.taken
        per[r.source][1] = r.target
    assert all(t - 3 <= n <= t for n, t in per.values()) and per["z"] == [0, 0.0]
    assert mixing.mix_plan(df.limit(0)).count() == 0 and mixing.mixed(df.limit(0)).count() == 0
    assert mixing.mixed(df).columns == df.columns


def test_mix_fills_capped_sources(spark):
    sizes = {"a": 1000, "b": 1, "c": 2, "d": 500, "e": 0, None: 30}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(5, "http://a/ b", "<p>é"), (3, None, "<p>é"), (9, "u", None), (1, "u", ""), (None, "u", "z"), (7, "u", "z\r\n\r\nWARC/1.1\r\n")], "page_id long, url string, html string")
    folder = common.qualified(spark, common.shared_path(spark, "test-warc"))
    index = warc.write_archives(pages, folder, frame_bytes=600)
    got = {r.page_id: r for r in warc.read_archives(index, folder).collect()}
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert {k: (r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload) for k, r in got.items()} == {
        3: ("response", None, 5, sha("<p>é"), "<p>é"), 5: ("revisit", 3, 5, sha("<p>é"), None), 1: ("response", None, 0, sha(""), ""), 9: ("revisit", 1, 0, sha(""), None),
        None: ("response", None, 1, sha("z"), "z"), 7: ("response", None, len("z\r\n\r\nWARC/1.1\r\n"), sha("z\r\n\r\nWARC/1.1\r\n"), "z\r\n\r\nWARC/1.1\r\n")}
    for r in index.where("kind = 'record'").collect():
        head, _ = warc.read_record(r.asDict(), folder)
        assert head["warc-record-id"] == warc.record_uri(r.page_id)
    frames = [r for r in index.where("kind = 'frame'").collect()]
    system, inner = warc._open(folder)
    for bundle in {r.bundle for r in frames}:
        data = system.open_input_file(f"{inner}/{bundle}").read()
        own = sorted((r.frame, r.frame_bytes, r.record_bytes) for r in frames if r.bundle == bundle)
        assert warc.read_seek_table(data) == [(c, d) for _, c, d in own]
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_archives_odd_rows(spark):
    """The smallest id repeated, a payload larger than many frames, columns of other names."""
    rows = [(3, "u", "A", 1, 1), (3, "u", "A", 1, 1), (5, "u", "A", 1, 1), (6, "u", "é" * 1_500_000, 1, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha int, revisit int")
    folder = common.shared_path(spark, "test-warc")
    got = sorted((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(warc.write_archives(pages, folder, frame_bytes=600), folder).collect())
    assert got == [(3, "response", None, 1), (3, "response", None, 1), (5, "revisit", 3, 1), (6, "response", None, 3_000_000)]


def test_stages_with_odd_rows(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns with the stages' own names, an empty table."""
    good = [" ".join(f"word{k}x{i}" for i in range(60)) + "." for k in range(4)]
    rows = [(1, None, "en", "a"), (2, "", None, None), (None, good[0], "en", None), (None, None, None, None), (3, " ".join(f"long{i}" for i in range(40_000)), "en", "a"),
            (4, good[1], "en", "a"), (4, good[1], "en", "a"), (4, good[2], "de", "b"), (5, good[3] + " call 499-555-6503", "de", "b")]
    clash = "own string, at long, pii int, plan string, of string, limits int, gone long, words array<int>"
    df = spark.createDataFrame([(*r, None, "o", n, n, "p", "q", n, n, [n]) for n, r in enumerate(rows)], f"doc_id long, text string, lang string, source string, n_chars long, {clash}")
    for docs in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == df.columns and (out.count() > 0) == (docs.count() > 0)
        assert (corpus_pipeline.packing_stage(spark, docs, SMALL).count() > 0) == (docs.count() > 0)
    once = sorted((r.doc_id or 0, (r.text or "")[:8]) for r in corpus_pipeline.near_duplicate_stage(spark, df, SMALL).collect())
    assert once == [(0, "word0x0 "), (1, ""), (3, "long0 lo"), (4, "word1x0 "), (4, "word2x0 "), (5, "word3x0 ")]
    private = {r.at: r.text for r in corpus_pipeline.privacy_stage(spark, df, SMALL).collect()}
    assert private[0] is None and private[5] == good[1] and "499-555-6503" not in private[8]


def test_pipeline_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in quality_rules.quality(docs).where("kept").collect()}
    got, tables = docs, []
    for _, stage in corpus_pipeline.STAGES:
        got = common.durable(stage(spark, got, SMALL), "test-stage")
        tables.append(got)
    assert all(t.columns == docs.columns for t in tables[:-1])
    assert {r.doc_id for r in tables[0].collect()} == kept
    ids = sorted(kept)
    words = [(text[i] or "").encode().lower().split() for i in ids]
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} or {tuple(w)} for w in words]
    root = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    single = {ids[r] for r in set(root)}
    assert {r.doc_id for r in tables[1].collect()} == single
    private = {r.doc_id: r for r in tables[2].collect()}
    assert private.keys() == single and all(private[k].text == text[k] or re.search("[0-9@]", text[k]) for k in single)
    times = Counter(r.doc_id for r in tables[3].collect())
    want = {d: n for d, *_, n in plain_mix([(k, r.source, r.text) for k, r in private.items()]) if n}
    assert times == want
    pieces = tables[4].collect()
    assert {r.doc_id for r in pieces} == set(times)
    for k, n in times.items():
        own = [r for r in pieces if r.doc_id == k]
        assert sum(r.length for r in own) == n * own[0].doc_tokens
    again = corpus_pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in again.collect()) == sorted((r.doc_id, r.start, r.ids_crc32) for r in pieces)
    assert common.release(spark) > 0


def test_sql_of_the_operators(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        got, want = queries.QUERIES[name](spark, SMALL), con.sql(sql)
        key = lambda rows, cols: sorted(tuple(str(r[cols.index(c)]) for c in sorted(cols)) for r in rows)
        assert key(got.collect(), got.columns) == key(want.fetchall(), want.columns), name
