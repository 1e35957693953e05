"""Short vertical clips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import rounded
from .asof import first_from, last_upto, overlapping, with_events_around
from .chunked import SIZE, around, known, preceding

# Score of a section by a word in its label, first match first.
TYPE_SCORES = (("chorus", 0.9), ("drop", 0.95), ("climax", 0.95), ("bridge", 0.7), ("prechorus", 0.65), ("pre-chorus", 0.65), ("verse", 0.5), ("intro", 0.4), ("outro", 0.3))


def section_scores(sections: DataFrame, beats: DataFrame) -> DataFrame:
    """A10 [R]: score by label, averaged with an explicit energy, plus a bonus for beats in [start, end]."""
    base = F.lit(0.5)
    for word, score in reversed(TYPE_SCORES):
        base = F.when(F.lower("label").contains(word), score).otherwise(base)
    base = F.when(F.col("energy").isNotNull(), (base + F.col("energy")) / 2).otherwise(base)
    s = sections.select("track_id", "section_idx", "start_s", "end_s")
    n = overlapping(beats.select("track_id", "t"), s, "track_id", F.col("t"), F.col("start_s"), F.col("end_s"), F.col("t").between(F.col("start_s"), F.col("end_s")), bucket=32.0)
    n = n.groupBy("track_id", "section_idx").agg(F.count("*").alias("n_beats"))
    j = sections.join(n, ["track_id", "section_idx"], "left").fillna(0, ["n_beats"])
    density = F.col("n_beats") / F.greatest(F.col("end_s") - F.col("start_s"), F.lit(0.1)) / 4.0
    return j.withColumn("score", F.least(base + F.least(density, F.lit(0.3)), F.lit(1.0)))


def with_bonuses(scored: DataFrame) -> DataFrame:
    """W9 [R]: the first chorus gets 0.15, then an opener before 5 s with at least 0.4 gets 0.1; 1 at most."""
    is_chorus = F.lower("label").contains("chorus")
    first = F.min(F.when(is_chorus, F.col("section_idx"))).over(Window.partitionBy("track_id"))
    s = scored.withColumn("score", F.when(is_chorus & (F.col("section_idx") == first), F.least(F.col("score") + 0.15, F.lit(1.0))).otherwise(F.col("score")))
    return s.withColumn("score", F.when((F.col("start_s") < 5) & (F.col("score") >= 0.4), F.least(F.col("score") + 0.1, F.lit(1.0))).otherwise(F.col("score")))


def candidates(scored: DataFrame, beats: DataFrame, least: float = 15.0, most: float = 30.0) -> DataFrame:
    """T1 [R]: window of each section: 15 to 30 s, on beats, snapped again where that moved it too far. The first
    look-ups read an array of the beats around the section's start; the second ones go from the beat found there, which may be
    far off, and read the array around that."""
    n = F.col("end_s") - F.col("start_s")
    raw = F.when(n < least, F.col("start_s") + least).when(n > most, F.col("start_s") + most).otherwise(F.col("end_s"))
    s = with_events_around(scored, beats, "track_id", F.col("start_s"), "near")
    near, a, b = F.col("near"), F.col("a"), F.col("b")
    s = s.withColumn("a", last_upto(near, F.col("start_s"))).withColumn("b", first_from(near, raw)).drop("near")
    s = with_events_around(s, beats, "track_id", a, "near")
    s = s.withColumn("b", F.when(b - a > most + 1, last_upto(near, a + most)).otherwise(b))
    s = s.withColumn("b", F.when(b - a < least - 1, first_from(near, a + least)).otherwise(b))
    return s.select("track_id", "section_idx", "label", "score", F.greatest(a, F.lit(0.0)).alias("clip_start"), b.alias("clip_end"))


def pick(cands: DataFrame, k: int, margin: float = 2.0) -> DataFrame:
    """T2 [R]: greedily the best ``k`` windows that keep ``margin`` seconds apart, then in order of time.
    A song's windows (one per section) are folded in an array."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("neg"), "section_idx", "clip_start", "clip_end", "label", "score")))
    far = lambda c, s: (c["clip_start"] >= s["clip_end"] + margin) | (s["clip_start"] >= c["clip_end"] + margin)
    best = F.aggregate("all", F.filter("all", lambda x: F.lit(False)), lambda acc, c: F.when(
        (F.size(acc) < k) & F.forall(acc, lambda s: far(c, s)), F.concat(acc, F.array(c))).otherwise(acc))
    by_time = F.array_sort(F.transform(best, lambda c: F.struct(c["clip_start"].alias("clip_start"), c["section_idx"].alias("section_idx"), c["clip_end"].alias("clip_end"), c["label"].alias("label"), c["score"].alias("score"))))
    return cands.groupBy("track_id").agg(ordered.alias("all")).select("track_id", F.posexplode(by_time).alias("rank", "c")).select(
        "track_id", "rank", "c.section_idx", "c.clip_start", "c.clip_end", "c.label", "c.score")


def manifest(picks: DataFrame, height: int = 1080, width: int = 1920) -> DataFrame:
    """T3 [R]: rows of the clip manifest; a video narrower than the crop is centred."""
    crop = int(height * 9 / 16)
    return picks.select("track_id", F.format_string("tiktok-clip-%02d", F.col("rank") + 1).alias("file"), rounded(F.col("clip_start"), 3).alias("start_time"), rounded(F.col("clip_end"), 3).alias("end_time"),
                        rounded(F.col("clip_end") - F.col("clip_start"), 3).alias("duration"), F.col("label").alias("section_label"), rounded(F.col("score"), 3).alias("energy"),
                        F.lit(crop).alias("crop_width"), F.lit("center" if width < crop else "smart").alias("crop_mode"))


def crop_positions(centers: DataFrame, width: int, crop: int, reach: int = 7, size: int = SIZE) -> DataFrame:
    """W7 [R]: crop position of each frame: gaps filled from before, then from the first known, then the
    middle; mean over 15 frames; left edge inside the picture. A clip goes in chunks of ``size`` frames, which carry the
    last and first known values and share the frames at their borders; frames are numbered without gaps."""
    filled = known(centers.select("clip_id", "frame_idx", "center_x"), ["clip_id"], "frame_idx", "center_x", "filled", size)
    filled = filled.withColumn("filled", F.coalesce("filled", F.lit(width // 2)))
    c = around(filled, ["clip_id"], "frame_idx", reach, {"mean": F.avg("filled")}, size)
    return c.select("clip_id", "frame_idx", F.greatest(F.lit(0), F.least(F.col("mean").cast("int") - crop // 2, F.lit(width - crop))).alias("crop_x"))


def crop_commands(crops: DataFrame, crop: int, height: int, fps: float, size: int = SIZE) -> DataFrame:
    """W8 [R]: a command for each frame at which the position changes."""
    c = preceding(crops, ["clip_id"], "frame_idx", "crop_x", "prev", size).where("prev IS NULL OR prev <> crop_x")
    return c.select("clip_id", "frame_idx", F.format_string(f"%.4f [enter] crop w {crop} h {height} x %d y 0;", F.col("frame_idx") / F.lit(float(fps)), "crop_x").alias("command"))


def subject_centers(boxes: DataFrame) -> DataFrame:
    """A15 [R]: centre of the largest face of each frame, the first on ties (then the leftmost). ``boxes``: clip_id, frame_idx, box_idx, x, w, h (null without a face)."""
    best = F.min_by(F.col("x") + F.floor(F.col("w") / 2), F.when(F.col("w").isNotNull(), F.struct(-(F.col("w") * F.col("h")), "box_idx", "x")))
    return boxes.groupBy("clip_id", "frame_idx").agg(best.cast("int").alias("center_x"))


#: Landmarks of both shoulders and both hips.
TORSO = (11, 12, 23, 24)


def torso_centers(landmarks: DataFrame, width: int) -> DataFrame:
    """A15 [R]: centre of a frame's torso, the mean place of four landmarks in pixels, cut off; null without all four.
    ``landmarks``: clip_id, frame_idx, landmark, x (share of the width)."""
    of = [F.max(F.when(F.col("landmark") == k, F.col("x"))) for k in TORSO]
    return landmarks.groupBy("clip_id", "frame_idx").agg((sum(of[1:], of[0]) / 4 * width).cast("int").alias("center_x"))
