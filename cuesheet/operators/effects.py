"""Beat-driven effects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import amplitude
from .timeline import _frames_of

VALID = ("zoom", "flash", "saturation")
MOST_EVENTS, MOST_CHARS = 150, 8000


def choruses(sections: DataFrame) -> DataFrame:
    """F2 [R]: sections whose label is chorus, in any case."""
    return sections.where(F.lower("label") == "chorus")


def unknown_effects(names: Column) -> Column:
    """F6, S1 [R]: requested effects (comma-separated) that do not exist."""
    asked = F.transform(F.split(names, ","), lambda x: F.lower(F.trim(x)))
    return F.array_except(asked, F.array(*map(F.lit, VALID)))


def heights_by_tempo(songs: DataFrame) -> DataFrame:
    """X16 [D]: ``track_id, zoom, flash``: heights of the effects of each song (track_id, bpm), for ``heights`` below."""
    zoom, flash = amplitude(F.col("bpm"))
    return songs.select("track_id", zoom.alias("zoom"), flash.alias("flash"))


def _with_height(events: DataFrame, heights: DataFrame | None, name: str, usual: float) -> DataFrame:
    """``events`` with the height of their song's effect; songs that ``heights`` does not name have the usual one."""
    if heights is None:
        return events.withColumn("height", F.lit(usual))
    return events.join(heights.select("track_id", F.col(name).alias("height")), "track_id", "left").withColumn("height", F.coalesce("height", F.lit(usual)))


def _decay(events: DataFrame, fps: float, height: float, seconds: float, name: str, heights: DataFrame | None) -> DataFrame:
    own = _with_height(events.withColumnRenamed("t", "e"), heights, name, height)
    f = _frames_of(own, F.col("e"), F.col("e") + seconds, fps)
    f = f.where((F.col("t") >= F.col("e")) & (F.col("t") <= F.round(F.col("e") + seconds, 4)))
    return f.select("track_id", "frame_idx", (F.col("height") * F.greatest(F.lit(0.0), 1 - (F.col("t") - F.col("e")) / seconds)).alias(name))


def curves(beats: DataFrame, onsets: DataFrame, chorus: DataFrame, fps: float, ramp_out: bool = True, heights: DataFrame | None = None) -> DataFrame:
    """A12 [R]: zoom, flash and saturation at each frame that any event touches, each a sum of its own
    events' terms. Events are sent to the few frames they touch and summed there, all kinds at once. ``heights``: track_id,
    zoom, flash (:func:`heights_by_tempo`), else 0.03 and 0.2 for all songs."""
    zoom, flash = _decay(beats, fps, 0.03, 0.15, "zoom", heights), _decay(onsets, fps, 0.2, 0.1, "flash", heights)
    clip = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    s = _frames_of(chorus.select("track_id", "start_s", "end_s"), F.col("start_s"), F.col("end_s"), fps).where((F.col("t") >= F.col("start_s")) & (F.col("t") <= F.col("end_s")))
    out = clip(F.col("end_s") - F.col("t")) if ramp_out else F.lit(1.0)
    sat = s.select("track_id", "frame_idx", (0.4 * clip(F.col("t") - F.col("start_s")) * out).alias("saturation"))
    parts = [zoom, flash, sat]
    every = None
    for p in parts:
        filled = p.select("track_id", "frame_idx", *(F.coalesce(F.col(c), F.lit(0.0)).alias(c) if c in p.columns else F.lit(0.0).alias(c) for c in ("zoom", "flash", "saturation")))
        every = filled if every is None else every.unionByName(filled)
    # dealt by frames before they are summed: a task holds the frames it has read, however few bytes the songs behind them were
    sums = every.repartition("track_id", "frame_idx").groupBy("track_id", "frame_idx").agg(F.sum("zoom").alias("zoom"), F.sum("flash").alias("flash"), F.sum("saturation").alias("saturation"))
    return sums.select("track_id", "frame_idx", (1 + F.col("zoom")).alias("zoom"), "flash", (1 + F.col("saturation")).alias("saturation"))


def chunking(songs: DataFrame, beats: DataFrame, onsets: DataFrame, chorus: DataFrame, enabled: tuple[str, ...] = VALID) -> DataFrame:
    """X14 [R]: events, estimated length of the expressions, and whether a song must go in chunks; only the
    enabled effects count."""
    n = lambda df, c: df.groupBy("track_id").agg(F.count("*").alias(c))
    j = songs.select("track_id").join(n(beats, "b"), "track_id", "left").join(n(onsets, "o"), "track_id", "left").join(n(chorus, "c"), "track_id", "left").fillna(0, ["b", "o", "c"])
    # Characters of a term and of its frame.
    used = [F.col(c) * per + 50 for name, c, per in (("zoom", "b", 60), ("flash", "o", 55), ("saturation", "c", 60)) if name in enabled]
    chars = sum(used, F.lit(0).cast("long"))
    events = sum((F.col(c) for name, c in (("zoom", "b"), ("flash", "o")) if name in enabled), F.lit(0).cast("long"))
    return j.select("track_id", events.alias("n_events"), chars.alias("est_chars"), ((events > MOST_EVENTS) | (chars > MOST_CHARS)).alias("chunked"))


def expressions(songs: DataFrame, beats: DataFrame, onsets: DataFrame, chorus: DataFrame, size: float | None = 30.0, relative: bool = False,
                heights: DataFrame | None = None) -> DataFrame:
    """X15 [R]: zoom, brightness and saturation expressions of each 30-second chunk of a song, or of whole songs
    (``size`` None); choruses are clipped to their chunks. ``relative`` counts times from a chunk's start; ``heights`` as for :func:`curves`."""
    if size is None:
        grid = songs.select("track_id", F.lit(0).cast("long").alias("chunk"), F.lit(0.0).alias("chunk_start"), F.col("duration").alias("chunk_end"))
    else:
        n = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("duration") / size) - 1)).alias("chunk")
        grid = songs.select("track_id", "duration", n).select(
            "track_id", "chunk", (F.col("chunk") * size).alias("chunk_start"), F.least((F.col("chunk") + 1) * size, F.col("duration")).alias("chunk_end"))
    shift = F.col("chunk_start") if relative else F.lit(0.0)
    chunk = lambda t: F.lit(0).cast("long") if size is None else F.floor(t / size)

    def joined(rows: DataFrame, order: list[str], name: str) -> DataFrame:
        terms = F.array_sort(F.collect_list(F.struct(*order, "term")))
        return rows.groupBy("track_id", "chunk").agg(F.array_join(F.transform(terms, lambda r: r["term"]), "+").alias(name))

    def pulses(events: DataFrame, index: str, effect: str, height: float, seconds: str, name: str) -> DataFrame:
        e = _with_height(events.select("track_id", "t", index), heights, effect, height).select("track_id", "t", index, "height", chunk(F.col("t")).alias("chunk")).withColumn("chunk_start", F.col("chunk") * (size or 0.0))
        t = F.col("t") - shift
        term = F.format_string(f"if(between(t,%.3f,%.3f),%s*(1-(t-%.3f)/{seconds}),0)", t, t + float(seconds), F.col("height").cast("string"), t)
        return joined(e.withColumn("term", term), ["t", index], name)

    lo, hi = F.greatest("start_s", "chunk_start"), F.least("end_s", "chunk_end")
    c = chorus.select("track_id", "section_idx", "start_s", "end_s").join(grid, "track_id").where((F.col("start_s") < F.col("chunk_end")) & (F.col("end_s") > F.col("chunk_start")))
    a, z = lo - shift, hi - shift
    ramp = F.format_string("if(between(t,%.3f,%.3f),0.4*((t-%.3f)/1.0),if(between(t,%.3f,%.3f),0.4,0))", a, a + 1.0, a, a + 1.0, z)
    g = grid.drop("chunk_end")
    for part in (pulses(beats, "beat_idx", "zoom", 0.03, "0.15", "zoom_expr"), pulses(onsets, "onset_idx", "flash", 0.2, "0.1", "brightness_expr"),
                 joined(c.withColumn("term", ramp), ["section_idx"], "saturation_expr")):
        g = g.join(part, ["track_id", "chunk"], "left")
    return g.select("track_id", "chunk", "chunk_start", F.coalesce("zoom_expr", F.lit("0")).alias("zoom_expr"), F.coalesce("brightness_expr", F.lit("0")).alias("brightness_expr"),
                    F.concat_ws("+", F.lit("1"), "saturation_expr").alias("saturation_expr"))
