"""Alignment, frame helpers, sources and streams against plain versions."""

import time
from datetime import datetime, timedelta
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import functions as F

from cuesheet.functions import colour, vision
from cuesheet.operators import asof, lyrics, qa, timeline
from cuesheet.sources import io
from cuesheet.streaming import live

START = datetime(2024, 1, 1)
USER = "track_id long, line_index int, u_idx int, word string"
HEARD = "track_id long, w_idx int, word string, start_s double, end_s double, probability double"


def song(spark, lines, heard):
    words = [(i, w) for i, line in enumerate(lines) for w in line.split()]
    u = spark.createDataFrame([(1, i, k, w) for k, (i, w) in enumerate(words)], USER)
    h = spark.createDataFrame([(1, k, w, k * 1.0, k + 0.5, 0.9) for k, w in enumerate(heard.split())], HEARD)
    return u, h


def test_alignment_keeps_missed_words(spark):
    u, h = song(spark, ["Hello, big world", "again we sing", "the end now"], "hello world uh again they sing end")
    got = {r.u_idx: r for r in lyrics.align(u, h).collect()}
    assert [got[i].match_type for i in range(9)] == ["exact", "inserted", "exact", "exact", "fuzzy", "exact", "inserted", "exact", "inserted"]
    assert [got[i].line_index for i in range(9)] == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert (got[1].start_s, got[1].end_s, got[8].start_s, got[8].end_s) == (0.5, 1.0, 6.5, 7.0)
    literal = {r.u_idx: r for r in lyrics.align(u, h, compat=True).collect()}
    assert 1 not in literal and literal[3].line_index == 0 and all(r.match_type != "inserted" for r in literal.values())


def test_interpolation_and_empty_transcript(spark):
    u, h = song(spark, ["a b c d"], "a x d")
    got = sorted(lyrics.align(u, h).collect(), key=lambda r: r.u_idx)
    assert [(r.start_s, r.end_s, r.match_type) for r in got[1:3]] == [(1.0, 1.25, "interpolated"), (1.25, 1.5, "interpolated")]
    got = sorted(lyrics.align(u, h.limit(0)).collect(), key=lambda r: r.u_idx)
    assert [r.match_type for r in got] == ["inserted"] * 4 and got[-1].end_s == 0.5


def test_opcodes_equal_difflib(spark):
    rng = np.random.default_rng(0)
    pairs = [([f"w{i}" for i in rng.integers(0, k, n)], [f"w{i}" for i in rng.integers(0, k, m)]) for k, n, m in ((5, 300, 280), (90, 40, 60), (3, 0, 4), (3, 4, 0))]
    df = spark.createDataFrame(list(enumerate(pairs)), "i int, p struct<u:array<string>,w:array<string>>")
    got = {r.i: [tuple(o) for o in r.o] for r in df.select("i", lyrics.opcodes("p.u", "p.w").alias("o")).collect()}
    assert got == {i: SequenceMatcher(None, u, w).get_opcodes() for i, (u, w) in enumerate(pairs)}


def slow_ward(x, most):
    """All merges by searching the whole matrix each time, cut like ours."""
    n = len(x)
    d = vision.cosine_distances(x) ** 2
    members, steps = {i: [i] for i in range(n)}, []
    d = {(i, j): d[i, j] for i in range(n) for j in range(i)}
    at = lambda i, j: d[max(i, j), min(i, j)]
    while len(members) > 1:
        i, j = min(((a, b) for a in members for b in members if a < b), key=lambda p: (at(*p), p))
        a, b, h = len(members[i]), len(members[j]), at(i, j)
        for k in members.keys() - {i, j}:
            c = len(members[k])
            d[max(i, k), min(i, k)] = max(0.0, ((a + c) * at(i, k) + (b + c) * at(j, k) - c * h) / (a + b + c))
        steps.append((h ** 0.5, members[i] + members[j]))
        members[i] += members.pop(j)
    label = list(range(n))
    if n > most:
        top = steps[n - most - 1][0] + 1e-9
        for h, own in steps:
            if h <= top:
                for k in own:
                    label[k] = min(own)
    seen = {}
    return [seen.setdefault(v, len(seen)) for v in label]


def test_ward_clusters():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.05, (6, 12)) for c in (np.eye(12)[0] * 5, np.eye(12)[5] * 5, np.eye(12)[9] * 5)])[np.r_[0:3, 6:9, 12:18, 3:6, 9:12]]
    got = vision.ward_clusters(x, 3)
    assert got.tolist() == [0] * 3 + [1] * 3 + [2] * 6 + [0] * 3 + [1] * 3
    assert vision.ward_clusters(x[:2], 3).tolist() == [0, 1] and vision.ward_clusters(x[:0], 3).tolist() == []
    for n, most in ((1, 3), (2, 1), (7, 3), (25, 13), (60, 5), (60, 59)):
        x = rng.normal(size=(n, 12))
        assert vision.ward_clusters(x, most).tolist() == slow_ward(x, most)
    # ties: every row twice or more, and rows of nothing
    x = np.repeat(rng.normal(size=(12, 12)), [1, 2, 3, 4] * 3, axis=0)[rng.permutation(30)]
    for most in (3, 8, 12, 20):
        assert vision.ward_clusters(x, most).tolist() == slow_ward(x, most)
    assert vision.ward_clusters(np.ones((10, 12)), 3).tolist() == [0] * 10  # equal distances leave fewer than asked
    took = []
    for n in (450, 900):
        x = rng.normal(size=(n, 12))
        start = time.perf_counter()
        vision.ward_clusters(x, 60)
        took.append(time.perf_counter() - start)
    assert took[1] < 8 * took[0] + 0.5  # a cube would take eight times as long


def test_resized_pictures():
    """Linear interpolation between pixel centres, against a loop; halves and doubles of a gradient."""
    rng = np.random.default_rng(4)
    a = rng.integers(0, 256, (9, 14))
    for h, w in ((9, 14), (4, 14), (9, 7), (5, 5), (1, 1)):
        got = vision.resized(a, h, w)
        for i in range(h):
            for j in range(w):
                y, x = min(max((i + 0.5) * 9 / h - 0.5, 0), 8), min(max((j + 0.5) * 14 / w - 0.5, 0), 13)
                y0, x0 = int(y), int(x)
                y1, x1 = min(y0 + 1, 8), min(x0 + 1, 13)
                want = sum(a[p, q] * fy * fx for p, fy in ((y0, 1 - y + y0), (y1, y - y0)) for q, fx in ((x0, 1 - x + x0), (x1, x - x0)))
                assert abs(got[i, j] - np.floor(want + 0.5)) <= (abs(want % 1 - 0.5) < 1e-9)
    assert vision.resized(np.array([[0, 10, 20, 30]]), 1, 2).tolist() == [[5, 25]]
    b = np.repeat(np.repeat(a, 2, axis=0), 2, axis=1)
    assert vision.ssim(a, b) > 0.999 and vision.ssim(b, a) > 0.999


def test_similarity_and_colour():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 256, (24, 30))
    assert abs(vision.ssim(a, a) - 1) < 1e-9 and vision.ssim(a, 255 - a) < 0.1
    g = np.exp(-((np.arange(11) - 5) ** 2) / 4.5)
    k = np.outer(g, g) / np.outer(g, g).sum()
    b = a + rng.normal(0, 20, a.shape)
    pa, pb = (np.pad(v.astype(float), 5, mode="reflect") for v in (a, b))
    total = 0.0
    for i in range(24):
        for j in range(30):
            x, y = pa[i:i + 11, j:j + 11], pb[i:i + 11, j:j + 11]
            mx, my = (k * x).sum(), (k * y).sum()
            vx, vy, c = (k * x * x).sum() - mx * mx, (k * y * y).sum() - my * my, (k * x * y).sum() - mx * my
            total += (2 * mx * my + 6.5025) * (2 * c + 58.5225) / ((mx * mx + my * my + 6.5025) * (vx + vy + 58.5225))
    assert abs(vision.ssim(a, b) - total / 720) < 1e-9


def test_frame_helpers_in_spark(spark):
    df = spark.createDataFrame([(1, [0] * 64, [255] * 64, 8), (2, [9] * 64, None, 8)], "i int, a array<int>, b array<int>, h int")
    got = {r.i: r.s for r in df.select("i", vision.ssim_pairs("a", "b", "h").alias("s")).collect()}
    assert got[1] < 0.01 and got[2] is None
    pixels = spark.createDataFrame([(1, [0, 0, 0, 255, 255, 255, 0, 0, 255]), (2, []), (3, None), (4, [0, 0, 255] * 10 + [7])], "i int, p array<int>")
    assert sorted(map(tuple, colour.lab_pixels(pixels.where("i = 1"), "p").collect())) == [(1, 0, 128, 128), (1, 136, 208, 195), (1, 255, 128, 128)]
    hist = [tuple(r)[:3] + (round(r.p, 6),) for r in colour.sparse_histograms(pixels.where("i > 1"), ["i"], "p").collect()]
    assert sorted(hist) == [(4, 0, 136, 1.0), (4, 1, 208, 1.0), (4, 2, 195, 1.0)]
    blocks = spark.createDataFrame([([[1.0] * 12, [1.0] * 12, [1.0, 0.0] * 6],)], "c array<array<double>>")
    assert blocks.select(vision.cluster_blocks("c", F.lit(40.0)).alias("x")).first().x == [0, 1, 2]


def test_nearest_is_exact_over_chunks(spark):
    rng = np.random.default_rng(3)
    beats = sorted(np.round(rng.uniform(0, 2000, 40), 3).tolist() + [100.0, 101.0])
    at = np.round(rng.uniform(-50, 2100, 200), 3).tolist() + [100.5]
    p = spark.createDataFrame([(1, t) for t in at] + [(2, 5.0)], "track_id int, at double")
    b = spark.createDataFrame([(1, t) for t in beats], "track_id int, t double")
    got = {(r.track_id, r["at"]): r.beat for r in asof.nearest(p, b, "track_id", "at", "beat").collect()}
    assert got[2, 5.0] == 5.0 and got[1, 100.5] == min(beats, key=lambda x: abs(x - 100.5))
    assert all(got[1, t] == min(beats, key=lambda x: abs(x - t)) for t in at)


def test_closed_and_open_lines(spark):
    lines = spark.createDataFrame([(1, 0, 0.0, 1.0), (1, 1, 1.0, 2.0)], "track_id int, line_index int, start_s double, end_s double")
    at = lambda closed: {r.frame_idx: r.line_index for r in timeline.active_line(lines, 2.0, closed).collect()}
    assert at(False) == {0: 0, 1: 0, 2: 1, 3: 1} and at(True) == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1}


def test_clip_files_and_documents(spark, tmp_path):
    for n in ("b.MP4", "a.mov", "notes.txt", "c.webm"):
        (tmp_path / n).write_bytes(b"x" * 3)
    assert [r.file for r in io.list_clips(spark, str(tmp_path)).orderBy("clip_no").collect()] == ["a.mov", "b.MP4", "c.webm"]
    docs = spark.createDataFrame([(i, "{}") for i in range(20)], "track_id int, document string")
    io.write_documents(docs, str(tmp_path / "out"), "track_id", 4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def stream(spark, tmp_path, df):
    df.write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))


def run(out, mode, name):
    q = out.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


def test_chunk_counts_stream_equals_batch(spark, tmp_path):
    rows = [(k % 3, START + timedelta(seconds=7 * k), "beat" if k % 4 else "onset") for k in range(200)]
    df = spark.createDataFrame(rows, "track_id int, ts timestamp, kind string")
    run(live.chunk_counts(stream(spark, tmp_path, df)), "append", "st1")
    got = {tuple(r) for r in spark.table("st1").collect()}
    want = {tuple(r) for r in live.chunk_counts(df).collect()}
    last = max(r[0] for r in want) - timedelta(seconds=90)
    assert got <= want and {r for r in want if r[0] < last} <= got


def test_playing_section_stream(spark, tmp_path):
    s = spark.createDataFrame([(1, 0.0, 5.0, "Intro"), (1, 5.0, 9.0, "Verse")], "track_id int, start_s double, end_s double, label string")
    df = spark.createDataFrame([(1, 0.0), (1, 5.0), (1, 9.0), (2, 1.0)], "track_id int, t double")
    run(live.playing_section(stream(spark, tmp_path, df), s), "append", "st3")
    assert {(r.track_id, r.t, r.section) for r in spark.table("st3").collect()} == {(1, 0.0, "intro"), (1, 5.0, "verse"), (1, 9.0, None), (2, 1.0, None)}


def test_black_frames(spark):
    df = spark.createDataFrame([(1, [16.0] * 4), (2, [17.0] * 4)], "i int, pixels array<double>")
    assert [r.i for r in qa.black_frames(df).collect()] == [1]
