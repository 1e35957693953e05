"""Clip quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import rounded
from .chunked import SIZE, following, running_sum

FACE, JUMP, COLOUR = 0.5, 0.65, 0.7


def sampled(frames: DataFrame, fps) -> DataFrame:
    """F5 [D]: about two frames a second."""
    return frames.where(F.pmod(F.col("frame_idx"), F.greatest(F.lit(1), F.floor(fps / 2))) == 0)


def cosine(a, b):
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def face_tier(frames: DataFrame, references: DataFrame) -> DataFrame:
    """A5 [R]: frames, frames with a face, least and mean similarity to the project's reference, verdict.
    ``frames``: project_id, clip_id, frame_idx, embedding, has_face; ``references``: project_id, reference."""
    s = frames.join(references, "project_id").withColumn("sim", F.when(F.col("has_face"), cosine(F.col("embedding"), F.col("reference"))))
    g = s.groupBy("project_id", "clip_id").agg(F.count("*").alias("frames_checked"), F.count("sim").alias("frames_with_face"), F.min("sim").alias("lo"), F.avg("sim").alias("mean"))
    return g.select("project_id", "clip_id", "frames_checked", "frames_with_face", F.coalesce(rounded(F.col("lo"), 4), F.lit(0.0)).alias("min_similarity"),
                    F.coalesce(rounded(F.col("mean"), 4), F.lit(0.0)).alias("mean_similarity"), F.coalesce(F.col("lo") >= FACE, F.lit(True)).alias("passed"))


def frame_pairs(frames: DataFrame, by: list[str], order: str, pixels: str, size: int = SIZE) -> DataFrame:
    """Each frame of a clip with the next one: ``by, order, pair_idx, pixels`` and ``next_`` pixels. Neighbours are found on the frames'
    numbers alone; pixels are joined to them by frame, so no clip's or project's pictures meet in one task."""
    n = frames.select(*by, order)
    n = following(running_sum(n, by, order, {"_nth": F.lit(1)}, size), by, order, order, "_next", size).where("_next IS NOT NULL")
    own = frames.select(*by, order, F.col(pixels).alias(pixels))
    nxt = frames.select(*by, F.col(order).alias("_next"), F.col(pixels).alias(f"next_{pixels}"))
    return n.join(own, [*by, order]).join(nxt, [*by, "_next"]).select(*by, order, (F.col("_nth") - 1).cast("long").alias("pair_idx"), pixels, f"next_{pixels}")


def ssim_tier(pairs: DataFrame) -> DataFrame:
    """A6 [R]: mean and least similarity of consecutive frames of a clip, the first worst pair, whether it jumps.
    ``pairs``: project_id, clip_id, pair_idx, ssim."""
    worst = F.min(F.struct("ssim", "pair_idx"))["pair_idx"]
    g = pairs.where("ssim is not null").groupBy("project_id", "clip_id").agg(rounded(F.avg("ssim"), 4).alias("mean_ssim"), rounded(F.min("ssim"), 4).alias("min_ssim"), worst.alias("i"))
    return g.select("project_id", "clip_id", "mean_ssim", "min_ssim", F.format_string("frame_%05d-frame_%05d", "i", F.col("i") + 1).alias("min_pair"), (F.col("min_ssim") < JUMP).alias("jump"))


def colour_tier(hist: DataFrame) -> DataFrame:
    """A7 [R]: correlation of each clip's histograms with their project's mean; projects of two clips or more.
    ``hist``: project_id, clip_id, channel, bin, p with all bins. A constant histogram correlates fully."""
    mean = hist.groupBy("project_id", "channel", "bin").agg(F.avg("p").alias("m"), F.count("*").alias("n")).where("n >= 2")
    j = hist.join(mean, ["project_id", "channel", "bin"])
    c = j.groupBy("project_id", "clip_id", "channel").agg(F.covar_pop("p", "m").alias("c"), F.var_pop("p").alias("vp"), F.var_pop("m").alias("vm"))
    r = F.when((F.col("vp") < 1e-14) | (F.col("vm") < 1e-14), 1.0).otherwise(F.col("c") / F.sqrt(F.col("vp") * F.col("vm")))
    return c.withColumn("r", r).groupBy("project_id", "clip_id").agg(
        *(rounded(F.max(F.when(F.col("channel") == k, F.col("r"))), 4).alias(f"{n}_correlation") for k, n in enumerate("lab")),
        (F.min(F.when(F.col("channel") > 0, F.col("r"))) >= COLOUR).alias("passed"))


def technical_checks(clips: DataFrame) -> DataFrame:
    """X12 [R]: issues of a probed clip; without a stream that is the only one. ``expected`` may be null."""
    size = F.format_string("%dx%d", "width", "height")
    # Texts of the issues.
    checks = F.array(
        F.when(F.least("width", "height") < 720, F.concat(F.lit("Resolution below 720p ("), size, F.lit(")"))),
        F.when(F.col("fps") < 24, F.concat(F.lit("Frame rate below 24fps ("), F.format_string("%.2f", "fps"), F.lit(")"))),
        F.when((F.col("duration") > 0) & (F.abs(F.col("duration") - F.col("expected")) > 1), F.format_string("Duration %.2fs outside expected %.2fs", "duration", "expected")))
    issues = F.when(~F.col("has_video"), F.array(F.lit("No video stream found"))).otherwise(F.filter(checks, lambda x: x.isNotNull()))
    return clips.withColumn("issues", issues)


def overall(clips: DataFrame) -> DataFrame:
    """X13 [R]: weighted score of the tiers that were run. Columns: frames_with_face and mean_similarity
    (null if skipped), n_issues, video_passed, mean_ssim (0 without), colour (mean correlation, null without)."""
    face = F.when(F.col("frames_with_face").isNotNull(), F.when(F.col("frames_with_face") > 0, F.col("mean_similarity")).otherwise(1.0))
    v = F.when(F.col("video_passed"), 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - F.col("n_issues") * F.lit(0.25)))
    v = F.when(F.col("mean_ssim") > 0, v * 0.6 + F.col("mean_ssim") * 0.4).otherwise(v)
    parts = ((face, 0.3), (v, 0.5), (F.col("colour"), 0.2))
    total = sum((F.coalesce(s * w, F.lit(0.0)) for s, w in parts), F.lit(0.0))
    weight = sum((F.when(s.isNotNull(), w).otherwise(0.0) for s, w in parts), F.lit(0.0))
    return clips.withColumn("overall_score", rounded(F.least(F.greatest(F.try_divide(total, weight), F.lit(0.0)), F.lit(1.0)), 2))


def summary(results: DataFrame) -> DataFrame:
    """A9 [R]: totals and failed files of each project, and the totals of the catalogue (null project, no files).
    The catalogue's row is the sum of the projects' rows; no list is gathered for it."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("clip_id"))))
    each = results.groupBy("project_id").agg(
        F.count("*").alias("total"), F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("failed"),
        F.array_join(F.transform(failed, lambda x: x.cast("string")), ",").alias("failed_clips")).withColumnRenamed("n_passed", "passed")
    whole = results.groupBy("project_id").agg(F.count("*").alias("total"), F.count_if("passed").alias("n"))
    whole = whole.agg(F.lit(None).cast(each.schema["project_id"].dataType).alias("project_id"), F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("n"), F.lit(0)).alias("passed"))
    return each.unionByName(whole.withColumn("failed", F.col("total") - F.col("passed")).withColumn("failed_clips", F.lit(None).cast("string")))


def frozen_runs(pairs: DataFrame, limit: float = 0.999) -> DataFrame:
    """Q11 [D]: runs of consecutive pairs whose similarity reaches ``limit``."""
    w = Window.partitionBy("project_id", "clip_id").orderBy("pair_idx")
    f = pairs.withColumn("run", F.col("pair_idx") - F.row_number().over(Window.partitionBy("project_id", "clip_id", F.col("ssim") >= limit).orderBy("pair_idx"))).where(F.col("ssim") >= limit)
    return f.groupBy("project_id", "clip_id", "run").agg(F.min("pair_idx").alias("first_pair"), F.count("*").alias("pairs")).drop("run")


def black_frames(frames: DataFrame, limit: float = 16.0) -> DataFrame:
    """Q11 [D]: frames whose mean brightness is at most ``limit``. ``frames``: …, pixels."""
    mean = F.aggregate("pixels", F.lit(0.0), lambda a, x: a + x) / F.size("pixels")
    return frames.withColumn("luma", mean).where(F.col("luma") <= limit).drop("pixels")


def retry_plan(attempts: DataFrame) -> DataFrame:
    """W11 [D]: next step of each failed clip: a new seed twice, then a simpler prompt, then review with
    the best attempt. ``attempts``: project_id, clip_id, attempt, score, passed."""
    g = attempts.groupBy("project_id", "clip_id").agg(F.count("*").alias("n"), F.max("passed").alias("ok"), F.max_by("attempt", F.struct("score", -F.col("attempt"))).alias("best_attempt"))
    return g.where("not ok").select("project_id", "clip_id", "n", F.when(F.col("n") <= 2, "new_seed").when(F.col("n") == 3, "simplify").otherwise("review").alias("action"), "best_attempt")
