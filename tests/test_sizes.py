"""Plans and steps that keep their figures in proportion to the input; results by plain loops."""

import os
import random
import re

import pytest

from pyspark.sql import functions as F

from cuesheet.functions.text import letters_of_words
from cuesheet.jobs.catalog import QUERIES
from cuesheet.operators import effects, lyrics, timeline
from cuesheet.sources import io, song_files

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["io2_lyric_words", "f1_normalise", "x6_reveal", "io1_transcript_words"])
def test_words_are_numbered_where_they_are_read(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SMALL))


def test_key_words_are_picked_where_their_line_is_read(spark):
    """No word moves to be ranked in its line, and the letters of a line's words are found once."""
    p = plan(QUERIES["t5_key_words"](spark, SMALL))
    assert "Exchange" not in p and "Window" not in p and p.count("[^a-z") == 1
    assert plan(QUERIES["x5_word_class"](spark, SMALL)).count("[^a-z") == 1


def test_key_words_of_lines(spark):
    rng = random.Random(5)
    some = ["the", "of", "love", "Fire!", "--", "stone", "sto ne".replace(" ", "\u00a0"), "\u0130stanbul", "\u212aelvin", "\u03a3\u03a3\u03a3\u03a3", "\U0001f600" * 7, "a", "b", "it", "stones", "THAT", "\u00e9t\u00e9s"]
    lines = [(k, j, [rng.choice(some) for _ in range(n)]) for k in range(4) for j, n in enumerate([1, 2, 3, 4, 9, 30, 300])]
    lines += [(9, 0, ["of"]), (9, 1, ["is", "of", "the", "xyz", "abc"]), (9, 2, ["the"] * 500), (9, 3, ["silver"] * 5), (9, 4, ["love", "golden", "silver", "ox", "copper"]), (9, 5, ["a" * 5000, "the"])]
    df = spark.createDataFrame(lines, "track_id long, line_index int, words array<string>")
    letters = df.select("words", letters_of_words(F.col("words")).alias("low")).collect()
    assert all(r.low == [re.sub("[^a-z]", "", w.lower()) for w in r.words] for r in letters)
    none, weight = F.lit(None).cast("string"), lambda j: F.when(j % 3 == 0, (j % 10) / F.lit(10.0))
    words = df.select("track_id", "line_index", F.posexplode("words").alias("word_idx", "word")).withColumn("role", none).withColumn("importance", weight(F.col("word_idx")))
    classes = F.transform(letters_of_words(F.col("words")), lambda low, j: timeline.class_of(low, none, weight(j), ["the", "of"]))
    for most in (1, 3, 7):
        want = timeline.key_words(timeline.word_class(words, ["the", "of"]), most)
        got = timeline.key_words_of_lines(df.withColumn("classes", classes), most)
        assert got.dtypes == want.dtypes and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        picked = {(r.line_index, r.stack_pos): (r.word_idx, r.word) for r in got.where("track_id = 9").collect()}
        assert picked[0, 1] == (0, "of") and picked[2, 1] == (499, "the") and picked[3, 1] == (1, "silver")
        assert [picked.get((4, n)) for n in range(1, most + 1)] == [(1, "golden"), (2, "silver"), (4, "copper"), (0, "love"), None, None, None][:most]


def test_roles_of_lines(spark):
    assert "Exchange" not in plan(QUERIES["x4_roles"](spark, SMALL))
    rng = random.Random(6)
    some, roles = ["the", "THE", "no", "ox", "fox", "stone", "--", "\u0130stanbul", "\U0001f600" * 4], [None, None, None, "hero", "accent", "own"]
    lines = [(k, j, [rng.choice(some) for _ in range(n)], [rng.choice(roles) if j % 2 else None for _ in range(n)]) for k in range(4) for j, n in enumerate([1, 1, 2, 2, 3, 5, 9, 9, 300])]
    lines += [(9, 0, ["the", "no"], [None] * 2), (9, 1, ["fox", "two"], [None] * 2), (9, 2, ["no", "stone"], [None, "own"])]
    df = spark.createDataFrame(lines, "track_id long, line_index int, words array<string>, roles array<string>")
    words = df.select("track_id", "line_index", F.posexplode(F.arrays_zip("words", "roles")).alias("word_idx", "x")).select("track_id", "line_index", "word_idx", F.col("x.words").alias("word"), F.col("x.roles").alias("role"))
    rows = lambda d: sorted((r.track_id, r.line_index, r.word_idx, r.word, r.role or "", r.shown_role) for r in d.collect())
    got = rows(timeline.roles_of_lines(df))
    assert got == rows(timeline.roles(words))
    assert [r[-1] for r in got if r[0] == 9] == ["hero", "connector", "hero", "accent", "accent", "own"]


def test_words_straight_from_texts(spark):
    texts = [(1, " a  b\t\n\n c\r\nd"), (2, None), (3, " \n"), (4, "x\ny\nz z"), (5, "")]
    df = spark.createDataFrame(texts, "track_id long, text string")
    rows = lambda d: sorted(map(tuple, d.select("track_id", "line_index", "word_idx", "word", "u_idx").collect()))
    assert rows(io.lyric_words(df)) == rows(io.flat_words(io.lyric_lines(df)))
    sizes = {(r.track_id, r.u_idx): r.in_line for r in io.lyric_words(df, with_size=True).collect()}
    assert sizes == {(1, 0): 2, (1, 1): 2, (1, 2): 1, (1, 3): 1, (4, 0): 1, (4, 1): 1, (4, 2): 2, (4, 3): 2}


@pytest.mark.parametrize("closed", [False, True])
def test_active_line_of_lines_that_cross_or_not(spark, closed):
    rng = random.Random(1)
    lines = [(k, i, s, s + rng.choice((0.0, 0.05, 0.3, 0.7, 4.0))) for k in range(6) for i in range(60) for s in [round(i * (0.4, 0.8, 5.0, 0.1, 1.0, 30.0)[k] + rng.choice((0, 0, 0.25)), 2)]]
    want = {}
    for k, i, s, e in lines:
        for f in range(20_000):
            if s <= f / 10.0 and (f / 10.0 <= e if closed else f / 10.0 < e):
                want[k, f] = min(i, want.get((k, f), i))
    df = timeline.active_line(spark.createDataFrame(lines, "track_id long, line_index int, start_s double, end_s double"), 10.0, closed)
    got = [tuple(r) for r in df.select("track_id", "frame_idx", "line_index").collect()]
    assert len(got) == len(want) and {(k, f): i for k, f, i in got} == want
    # frames of lines by themselves are not grouped
    assert "Union" in plan(df)


def test_curves_deal_frames_before_they_are_summed(spark):
    """Few songs of few bytes have many frames: those are dealt, not held by the task that made them."""
    beats = spark.createDataFrame([(1, 0, 1.0)], "track_id long, beat_idx int, t double")
    chorus = spark.createDataFrame([(1, 0.0, 30.0), (1, 20.0, 40.0)], "track_id long, start_s double, end_s double")
    c = effects.curves(beats, beats.withColumnRenamed("beat_idx", "onset_idx"), chorus, 10.0)
    p = plan(c)
    assert re.search(r"hashpartitioning\(track_id#\d+L, frame_idx#\d+L.*REPARTITION_BY_COL", p)
    assert "HashAggregate" not in p[p.index("REPARTITION_BY_COL"):]
    got = {r.frame_idx: (round(r.zoom, 6), round(r.flash, 6), round(r.saturation, 6)) for r in c.collect()}
    assert len(got) == 401 and got[10] == (1.03, 0.2, 1.4) and got[250] == (1.0, 0.0, 1.8) and got[295][2] == round(1 + 0.4 * 0.5 + 0.4, 6)


def test_uncaptioned_lines_move_no_words(spark):
    assert "u_idx" not in plan(QUERIES["j9_uncaptioned"](spark, SMALL))


def test_each_pair_of_scene_and_line_once(spark):
    scenes = spark.createDataFrame([(1, 0, 0.0, 40.0), (1, 1, 40.0, 41.0), (2, 0, 0.0, 5.0)], "track_id long, scene_no int, start_s double, end_s double")
    lines = spark.createDataFrame([(1, 0, "a", 0.0, 50.0), (1, 1, "b", 15.0, 17.0), (1, 2, "b", 15.0, 17.0), (1, 3, "c", 60.0, 61.0)], "track_id long, line_index int, text string, start_s double, end_s double")
    df = timeline.scene_lyrics(scenes, lines)
    assert sorted(map(tuple, df.collect())) == [(1, 0, "a / b / b"), (1, 1, "a"), (2, 0, "")]
    # texts join the pairs that were found: they are not dealt to the buckets
    assert not re.search(r"hashpartitioning\(track_id#\d+L, b#\d+L[^\n]*\n[^\n]*text", plan(df))


def test_files_are_listed_by_tasks(spark, tmp_path):
    """The driver sees a folder for each task, not the songs."""
    path = str(tmp_path / "out")
    song_files.write_song_files(spark.createDataFrame([(k, f"text {k}") for k in range(300)], "track_id long, document string"), path)
    with open(f"{path}/beside.json", "w") as f:
        f.write("b")
    df = song_files.read_song_files(spark, path)
    parts = song_files.SongFilesReader(path, ".json").partitions()
    assert len(parts) == 1 + sum(os.path.isdir(f"{path}/{x}") for x in os.listdir(path) if x.startswith("part")) < 20
    assert df.rdd.getNumPartitions() == len(parts)
    assert {tuple(r) for r in df.collect()} == {(str(k), f"text {k}") for k in range(300)} | {("beside", "b")}


def test_lists_of_a_song_are_made_once(spark):
    """No filter by a list lies below the words of a song, with the heard words made anew in it for each opcode."""
    p = QUERIES["j10_w12_s3_given_opcodes"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in p.split("\n") if "Filter" in x and "transform" in x]


def test_times_of_opcodes_without_heard_words_or_times(spark):
    u = "array<struct<u_idx:int,line_index:int,word:string>>"
    word = lambda n: [(k, 0, f"w{k}") for k in range(n)]
    rows = [(1, word(3), [], [("delete", 0, 3, 0, 0)]), (2, word(2), [(1.0, None, 0.5), (2.0, 2.1005, None)], [("equal", 0, 1, 0, 1), ("insert", 1, 1, 1, 2), ("delete", 1, 2, 2, 2)]),
            (3, word(4), [(1.0, 1.5, 0.9), (2.0, 2.5, 0.8), (3.0, 3.2, 0.7)], [("replace", 0, 3, 0, 2), ("replace", 3, 4, 2, 3)]), (4, [], [(1.0, 1.5, 0.9)], [])]
    df = spark.createDataFrame(rows, f"track_id long, u {u}, w array<struct<start_s:double,end_s:double,probability:double>>, ops array<struct<tag:string,u0:int,u1:int,w0:int,w1:int>>")
    got = {(r.track_id, r.u_idx): (r.start_s, r.end_s, r.confidence, r.match_type) for r in lyrics.timed_by(df.repartition(1)).collect()}
    assert got == {
        (1, 0): (0.0, 0.167, 0.3, "inserted"), (1, 1): (0.167, 0.333, 0.3, "inserted"), (1, 2): (0.333, 0.5, 0.3, "inserted"), (2, 0): (1.0, None, 0.5, "exact"), (2, 1): (2.1, 2.6, 0.3, "inserted"),
        (3, 0): (1.0, 1.5, 0.5, "interpolated"), (3, 1): (1.5, 2.0, 0.5, "interpolated"), (3, 2): (2.0, 2.5, 0.5, "interpolated"), (3, 3): (3.0, 3.2, 0.7, "fuzzy")}
