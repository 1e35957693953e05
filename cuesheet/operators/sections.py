"""Song structure: blocks, sections, labels, chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import rounded
from .asof import nearest
from .chunked import SIZE, following, runs

HOP = 512 / 22050


def block_chroma(frames: DataFrame, per_block: int) -> DataFrame:
    """A4 [R]: mean of each of the chroma values over blocks of frames; a ragged tail is dropped, a song has one block at least."""
    n = frames.groupBy("track_id").agg(F.greatest(F.lit(1), F.floor(F.count("*") / per_block)).alias("n_blocks"))
    x = frames.select("track_id", F.floor(F.col("frame_idx") / per_block).alias("block_idx"), F.posexplode("chroma").alias("pitch", "v"))
    means = x.groupBy("track_id", "block_idx", "pitch").agg(F.avg("v").alias("mean"))
    return means.join(n, "track_id").where("block_idx < n_blocks").drop("n_blocks")


def normalised_energy(frames: DataFrame) -> DataFrame:
    """W4 [R]: energy over the song's largest (0 stays 0), 4 digits; time of the frame, 3 digits.
    The largest comes from an aggregate that is joined back, not from a window over raw frames."""
    top = frames.groupBy("track_id").agg(F.max("rms").alias("top"))
    return frames.join(top, "track_id").select("track_id", "frame_idx", rounded(F.col("frame_idx") * F.lit(HOP), 3).alias("time"),
                                               rounded(F.when(F.col("top") > 0, F.col("rms") / F.col("top")).otherwise(F.col("rms")), 4).alias("value"))


def block_energy(blocks: DataFrame, samples: DataFrame, step: float, span: float = 4.0) -> DataFrame:
    """J4 [R]: mean of the samples in [start, start + span) of each block; 0 without samples. Block k
    starts at k * step; a sample is sent to the blocks it can lie in, so there is no range join.
    ``blocks``: track_id, block_idx; ``samples``: track_id, t, value."""
    k = F.floor(F.col("t") / step)
    reach = int(span / step) + 1
    s = samples.select("track_id", "t", "value", F.explode(F.array(*[k + d for d in range(-reach, 2)])).alias("block_idx"))
    s = s.where((F.col("t") >= F.col("block_idx") * step) & (F.col("t") < F.col("block_idx") * step + span))
    means = s.groupBy("track_id", "block_idx").agg(F.avg("value").alias("energy"))
    return blocks.join(means, ["track_id", "block_idx"], "left").withColumn("energy", F.coalesce("energy", F.lit(0.0)))


def merge_blocks(blocks: DataFrame, songs: DataFrame, size: int = SIZE) -> DataFrame:
    """W1 [R]: runs of blocks of one cluster as sections, up to the next run's start, the last to the end.
    ``blocks``: track_id, block_idx, t, cluster, energy; ``songs``: track_id, duration. Runs are made inside chunks of
    ``size`` blocks and joined at their borders, so a song of any length is many tasks."""
    parts = {"start_s": (F.min("t"), F.min("start_s")), "_sum": (F.sum("energy"), F.sum("_sum")), "_n": (F.count("energy"), F.sum("_n"))}
    merged = runs(blocks, ["track_id"], "block_idx", "cluster", parts, "section_idx", size)
    merged = following(merged, ["track_id"], "section_idx", "start_s", "next_s", size)
    return merged.join(songs.select("track_id", "duration"), "track_id").select(
        "track_id", "section_idx", rounded(F.col("start_s"), 3).alias("start_s"), rounded(F.coalesce("next_s", "duration"), 3).alias("end_s"), "cluster",
        rounded(F.col("_sum") / F.col("_n"), 3).alias("energy_avg"))


def label_sections(sections: DataFrame) -> DataFrame:
    """W2 [R]: intro, outro, chorus, bridge or verse by energy, place and repetition."""
    song = Window.partitionBy("track_id")
    stats = sections.groupBy("track_id").agg(F.percentile("energy_avg", F.lit(0.5)).alias("mid"), F.percentile("energy_avg", F.lit(0.75)).alias("high"),
                                             F.min("section_idx").alias("lo"), F.max("section_idx").alias("hi"))
    s = sections.withColumn("seen", F.count("*").over(Window.partitionBy("track_id", "cluster"))).join(stats, "track_id")
    e, first, last = F.col("energy_avg"), F.col("section_idx") == F.col("lo"), F.col("section_idx") == F.col("hi")
    label = (F.when(first & (e < F.col("mid")) & (F.col("end_s") - F.col("start_s") < 20), "intro").when(last & (e < F.col("mid")), "outro")
             .when((e >= F.col("high")) & (F.col("seen") >= 2), "chorus").when((F.col("seen") == 1) & ~first & ~last, "bridge").otherwise("verse"))
    return s.select("track_id", "section_idx", "start_s", "end_s", label.alias("label"), "energy_avg")


def snap_sections(sections: DataFrame, beats: DataFrame, songs: DataFrame) -> DataFrame:
    """W3 [R]: section ends on the nearest beat, the first start 0, the last end the song's; a start is
    the end before it; empty sections go after that. Songs without beats stay as they are."""
    w = Window.partitionBy("track_id").orderBy("section_idx")
    s = nearest(sections, beats, "track_id", "end_s", "beat_end")
    has = beats.select("track_id").distinct().withColumn("has_beats", F.lit(True))
    s = s.join(has, "track_id", "left").join(songs.select("track_id", "duration"), "track_id")
    end = F.when(F.lead("section_idx").over(w).isNull(), rounded(F.col("duration"), 3)).otherwise(rounded(F.col("beat_end"), 3))
    s = s.withColumn("new_end", end)
    s = s.withColumn("new_start", F.coalesce(F.lag("new_end").over(w), F.lit(0.0)))
    keep = F.col("has_beats").isNull() | (F.col("new_end") > F.col("new_start"))
    pick = lambda new, old: F.when(F.col("has_beats"), F.col(new)).otherwise(F.col(old)).alias(old)
    return s.where(keep).select("track_id", "section_idx", pick("new_start", "start_s"), pick("new_end", "end_s"), "label")


def chapters(sections: DataFrame) -> DataFrame:
    """W10 [D]: ``MM:SS Label``; verses are numbered if there are several, the last of several choruses is final."""
    low = F.lower("label")
    kind = Window.partitionBy("track_id", low)
    nth, n = F.row_number().over(kind.orderBy("section_idx")), F.count("*").over(kind)
    name = (F.when((low == "verse") & (n > 1), F.concat(F.lit("Verse "), nth.cast("string"))).when((low == "chorus") & (n > 1) & (nth == n), "Final Chorus").otherwise(F.initcap(low)))
    first = F.row_number().over(Window.partitionBy("track_id").orderBy("section_idx")) == 1
    sec = F.when(first, 0).otherwise(F.floor("start_s"))
    return sections.select("track_id", "section_idx", name.alias("name"), sec.alias("sec")).select(
        "track_id", "section_idx", F.format_string("%02d:%02d %s", F.floor(F.col("sec") / 60), F.col("sec") % 60, "name").alias("chapter"))


def bpm_of(beats: DataFrame) -> DataFrame:
    """W13 [A]: 60 over the median gap of a song's beats, 1 digit; null without a gap above 0."""
    gaps = beats.select("track_id", (F.col("t") - F.lag("t").over(Window.partitionBy("track_id").orderBy("t", "beat_idx"))).alias("gap"))
    return gaps.groupBy("track_id").agg(F.percentile("gap", F.lit(0.5)).alias("gap")).select("track_id", rounded(F.when(F.col("gap") > 0, 60 / F.col("gap")), 1).alias("bpm"))


def peaks(frames: DataFrame, reach: int = 3, delta: float = 1.0, size: int = 4096) -> DataFrame:
    """W14 [A]: frames that are the largest of their surroundings and exceed their mean by ``delta``. A song
    goes in chunks of ``size`` frames, with those within ``reach`` of a border in both."""
    i = F.col("frame_idx")
    chunks = F.array_distinct(F.transform(F.array(i - reach, i, i + reach), lambda x: F.floor(x / size)))
    f = frames.withColumn("chunk", F.explode(chunks))
    w = Window.partitionBy("track_id", "chunk").orderBy("frame_idx").rowsBetween(-reach, reach)
    f = f.withColumn("top", F.max("rms").over(w)).withColumn("mean", F.avg("rms").over(w)).where(F.col("chunk") == F.floor(i / size))
    return f.where((F.col("rms") == F.col("top")) & (F.col("rms") >= F.col("mean") + delta)).select("track_id", "frame_idx", "t")


def frame_energy(samples: DataFrame, length: int = 2048, hop: int = 512) -> DataFrame:
    """W4 [A]: root mean square of overlapping frames of samples, frame k centred on sample k * hop with silence
    around the song. A sample is sent to the frames that hold it. ``samples``: track_id, sample_idx, value."""
    i, half = F.col("sample_idx"), length // 2
    k = F.explode(F.sequence(F.greatest(F.ceil((i - half + 1) / hop), F.lit(0)), F.floor((i + half) / hop)))
    sums = samples.select("track_id", i, "value", k.alias("frame_idx"))
    last = samples.groupBy("track_id").agg(F.floor(F.max("sample_idx") / hop).alias("last"))
    e = sums.groupBy("track_id", "frame_idx").agg(F.sqrt(F.sum(F.col("value") * F.col("value")) / length).alias("rms"))
    return e.join(last, "track_id").where("frame_idx <= last").drop("last")
