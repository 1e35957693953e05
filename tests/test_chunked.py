"""Windows in two levels against one window over the whole group."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuesheet.operators import assembly, chunked, clips, sections



def groups(spark, n=400):
    """Groups of many shapes: dense, with holes of several chunks, single rows; values with long gaps; runs longer than a chunk."""
    r = spark.range(7 * n).select((F.col("id") % 7).alias("k"), F.floor(F.col("id") / 7).alias("i"))
    r = r.where((F.col("k") != 3) | (F.col("i") < 1)).where((F.col("k") != 4) | (F.col("i") % 97 > 60)).where((F.col("k") != 5) | (F.col("i") > 200))
    h = F.pmod(F.xxhash64("k", "i"), F.lit(1000))
    value = F.when((F.col("k") != 6) & (h < 60) & ((F.col("k") != 2) | (F.col("i") > 150)), h.cast("int"))
    kind = F.when(F.col("k") == 1, 0).otherwise(F.floor(F.col("i") / F.when(F.col("k") == 2, 1).when(F.col("k") == 0, 37).otherwise(3)) % 2)
    return r.select("k", "i", value.alias("v"), kind.cast("int").alias("kind"), (h / 8).alias("x"))


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("size", [1, 5, 16, 4096])
def test_equal_to_one_window(spark, size):
    g, one = groups(spark).cache(), Window.partitionBy("k").orderBy("i")
    every = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = one.rowsBetween(Window.unboundedPreceding, 0)
    assert rows(chunked.running_sum(g, ["k"], "i", {"s": F.col("x"), "n": F.col("v")}, size), "k", "i", "s", "n") == rows(g.select("k", "i", F.sum("x").over(upto).alias("s"), F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("n")), "k", "i", "s", "n")
    assert rows(chunked.following(g, ["k"], "i", "x", "o", size), "k", "i", "o") == rows(g.select("k", "i", F.lead("x").over(one).alias("o")), "k", "i", "o")
    assert rows(chunked.preceding(g, ["k"], "i", "x", "o", size), "k", "i", "o") == rows(g.select("k", "i", F.lag("x").over(one).alias("o")), "k", "i", "o")
    fill = F.coalesce(F.last("v", True).over(upto), F.first("v", True).over(every))
    assert rows(chunked.known(g, ["k"], "i", "v", "o", size), "k", "i", "o") == rows(g.select("k", "i", fill.alias("o")), "k", "i", "o")
    new = F.coalesce((F.col("kind") != F.lag("kind").over(one)).cast("int"), F.lit(1))
    want = g.withColumn("new", new).withColumn("run", F.sum("new").over(upto) - 1).groupBy("k", "run").agg(F.first("kind").alias("kind"), F.min("i").alias("lo"), F.count("*").alias("n"))
    assert rows(chunked.runs(g, ["k"], "i", "kind", {"lo": (F.min("i"), F.min("lo")), "n": (F.count("*"), F.sum("n"))}, "run", size), "k", "run", "kind", "lo", "n") == rows(want, "k", "run", "kind", "lo", "n")
    g.unpersist()


@pytest.mark.parametrize("size", [16, 4096])
def test_crops_equal_one_window(spark, size):
    c = groups(spark).where("k IN (0, 1, 2, 3, 6)").select(F.col("k").alias("clip_id"), F.col("i").alias("frame_idx"), F.col("v").alias("center_x"))
    w = Window.partitionBy("clip_id").orderBy("frame_idx")
    filled = F.coalesce(F.last("center_x", True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.first("center_x", True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(320))
    mean = c.withColumn("f", filled).select("clip_id", "frame_idx", F.avg("f").over(w.rowsBetween(-7, 7)).cast("int").alias("m"))
    want = mean.select("clip_id", "frame_idx", F.greatest(F.lit(0), F.least(F.col("m") - 20, F.lit(600))).alias("crop_x"))
    got = clips.crop_positions(c, 640, 40, size=size)
    assert rows(got, "clip_id", "frame_idx", "crop_x") == rows(want, "clip_id", "frame_idx", "crop_x")
    moved = want.withColumn("prev", F.lag("crop_x").over(w)).where("prev IS NULL OR prev <> crop_x")
    assert rows(clips.crop_commands(got, 40, 360, 30, size), "clip_id", "frame_idx") == rows(moved, "clip_id", "frame_idx")


def test_a_song_of_a_million_blocks_is_many_tasks(spark):
    """Sections of one very long song: equal to one window, dealt to many tasks, none with over a tenth of its rows."""
    b = spark.range(1_000_000).select(F.lit(1).alias("track_id"), F.col("id").alias("block_idx"), (F.col("id") * 0.5).alias("t"), (F.floor(F.sqrt("id")) % 3).cast("int").alias("cluster"), F.lit(0.25).alias("energy"))
    songs = spark.createDataFrame([(1, 500_000.0)], "track_id int, duration double")
    got = sections.merge_blocks(b, songs).orderBy("section_idx").collect()
    assert len(got) == 1000 and [r.start_s for r in got] == [0.5 * k * k for k in range(1000)] and [r.end_s for r in got[:-1]] == [r.start_s for r in got[1:]]
    assert got[-1].end_s == 500_000.0 and all(r.cluster == k % 3 and r.energy_avg == 0.25 for k, r in enumerate(got))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        inside = chunked.in_chunks(b, "block_idx").select(F.lag("t").over(chunked.inside(["track_id"], "block_idx")).alias("prev")).withColumn("at", F.spark_partition_id())
        share = [r.n for r in inside.groupBy("at").agg(F.count("prev").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(share) > 16 and max(share) < 100_000


def test_a_project_of_many_clips(spark):
    """Offsets of a long project, with hard cuts and fades, against a running loop."""
    n = 50_000
    c = spark.range(n).select(F.lit(1).alias("project_id"), F.col("id").alias("clip_id"), F.lit(0.5).alias("duration"))
    cuts = spark.range(n - 1).select(F.lit(1).alias("project_id"), F.col("id").alias("clip_id"), F.when(F.col("id") % 5 == 0, "none").otherwise("fade").alias("xfade"), F.lit(0.25).alias("td"))
    got = {r.clip_id: r.offset for r in assembly.offsets(c, cuts, 1000).collect()}
    lasted = taken = 0.0
    for k in range(n - 1):
        lasted += 0.5
        own = 0.0 if k % 5 == 0 else 0.25
        assert abs(got[k] - max(0.0, lasted - taken - own)) < 1e-6
        taken += 0.033 if k % 5 == 0 else 0.25
    assert len(got) == n - 1
