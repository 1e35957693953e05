"""Cut lists and delivery checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import transition
from .asof import nearest, sections_at
from .chunked import SIZE, following, running_sum


def cut_list(clips: DataFrame, beats: DataFrame, sections: DataFrame, default_td: float | None = None, size: int = SIZE) -> DataFrame:
    """W5 [R]: cut after each clip of a project but the last: raw time, nearest beat, and the transition by
    the sections 0.1 s around that beat. ``clips``: project_id, clip_id, track_id, duration. Sums run in chunks of
    ``size`` clip numbers, so a long project is many tasks."""
    c = clips.select("project_id", "clip_id", "track_id", "duration")
    c = following(running_sum(c, ["project_id"], "clip_id", {"raw_cut": F.col("duration")}, size), ["project_id"], "clip_id", "clip_id", "next_clip", size)
    c = nearest(c.where("next_clip is not null").drop("next_clip", "duration"), beats, "track_id", "raw_cut", "snapped_cut")
    at = {"section_before": F.col("snapped_cut") - 0.1, "section_after": F.col("snapped_cut") + 0.1}
    c = sections_at(c, sections, "track_id", at, ["project_id", "clip_id"])
    kind, td = transition(F.col("section_before"), F.col("section_after"))
    return c.select("project_id", "clip_id", "raw_cut", "snapped_cut", "section_before", "section_after", kind.alias("xfade"), (F.lit(default_td) if default_td else td).alias("td"))


def offsets(clips: DataFrame, cuts: DataFrame, size: int = SIZE) -> DataFrame:
    """W6 [R]: where each transition begins. A hard cut takes no time from its own offset but 0.033 s from
    all later ones; an offset below 0 is 0, which later ones don't feel."""
    hard = (F.col("xfade") == "none") | (F.col("td") <= 0)
    j = clips.select("project_id", "clip_id", "duration").join(cuts.select("project_id", "clip_id", "xfade", "td"), ["project_id", "clip_id"])
    j = j.withColumn("own", F.when(hard, 0.0).otherwise(F.col("td"))).withColumn("used", F.when(hard, 0.033).otherwise(F.col("td")))
    j = running_sum(j, ["project_id"], "clip_id", {"lasted": F.col("duration"), "taken": F.col("used")}, size)
    upto = F.col("lasted") - (F.col("taken") - F.col("used"))
    return j.select("project_id", "clip_id", F.when(hard, "fade").otherwise(F.col("xfade")).alias("transition"), F.col("used").alias("duration"), F.greatest(F.lit(0.0), upto - F.col("own")).alias("offset"))


def audit(cuts: DataFrame, clips: DataFrame, songs: DataFrame, uncovered: DataFrame) -> DataFrame:
    """Q10 [D]: per project: cuts over 0.1 s off a beat, difference of clip and song length, clips without
    a stream or not 16:9, lyric lines of its song without a caption (``uncovered``: track_id, line_index)."""
    gaps = uncovered.groupBy("track_id").agg(F.count("*").alias("uncovered_lines"))
    own = clips.groupBy("project_id").agg(F.min("track_id").alias("track_id")).join(gaps, "track_id", "left").select("project_id", "uncovered_lines")
    off = cuts.groupBy("project_id").agg(F.count_if(F.round(F.abs(F.col("raw_cut") - F.col("snapped_cut")), 6) > 0.1).alias("off_beat"))
    p = clips.join(songs.select("track_id", F.col("duration").alias("song_s")), "track_id", "left")
    p = p.groupBy("project_id").agg((F.abs(F.sum("duration") - F.max("song_s")) <= 1).alias("length_ok"), F.count_if(~F.col("has_video")).alias("no_stream"),
                                    F.count_if(F.col("has_video") & (F.col("width") * 9 != F.col("height") * 16)).alias("not_16_9"))
    return p.join(off, "project_id", "left").join(own, "project_id", "left").fillna(0, ["off_beat", "uncovered_lines"])
