"""As-of and range joins.

Both sides of an as-of join are dealt by song and by a chunk of time, so that one very long or
very common song is no single task; the nearest events of earlier and later chunks come from a
table with one row per song and chunk. Range joins put intervals into time buckets first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Seconds of a chunk of time.
CHUNK = 64.0


def neighbours(probes: DataFrame, events: DataFrame, by: str, at: Column, chunk: float = CHUNK) -> DataFrame:
    """``probes`` with ``prev_t`` and ``next_t``: the last event at or before ``at`` and the first at
    or after it (null where there is none). ``events``: by, t."""
    part = lambda t: F.floor(t / F.lit(chunk)).alias("_chunk")
    p = probes.select(F.struct(*probes.columns).alias("_row"), F.col(by).alias("_by"), at.alias("_at")).withColumn("_chunk", part(F.col("_at"))).withColumn("_e", F.lit(None).cast("double"))
    e = events.select(F.lit(None).cast(p.schema["_row"].dataType).alias("_row"), F.col(by).alias("_by"), F.col("t").alias("_at"), part(F.col("t")), F.col("t").cast("double").alias("_e"))
    w = Window.partitionBy("_by", "_chunk")
    near = p.unionByName(e).select("*", F.last("_e", True).over(w.orderBy("_at")).alias("_prev"), F.first("_e", True).over(
        w.orderBy("_at").rangeBetween(Window.currentRow, Window.unboundedFollowing)).alias("_next")).where("_row is not null")
    has = e.groupBy("_by", "_chunk").agg(F.min("_e").alias("_lo"), F.max("_e").alias("_hi"))
    spots = has.unionByName(p.select("_by", "_chunk").distinct(), allowMissingColumns=True).groupBy("_by", "_chunk").agg(F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    order = Window.partitionBy("_by").orderBy("_chunk")
    carried = spots.select("_by", "_chunk", F.last("_hi", True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                           F.first("_lo", True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    return near.join(carried, ["_by", "_chunk"], "left").select("_row.*", F.coalesce("_prev", "_before").alias("prev_t"), F.coalesce("_next", "_after").alias("next_t"))


def nearest(probes: DataFrame, events: DataFrame, by: str, at: str, out: str) -> DataFrame:
    """J1 [R]: the nearest event; of two equally near the earlier; without events the time itself."""
    n = neighbours(probes, events, by, F.col(at))
    t, p, q = F.col(at), F.col("prev_t"), F.col("next_t")
    return n.withColumn(out, F.when(p.isNull() & q.isNull(), t).when(q.isNull() | (F.abs(p - t) <= F.abs(q - t)), p).otherwise(q)).drop("prev_t", "next_t")


def snap(probes: DataFrame, events: DataFrame, by: str, at: Column, direction: str, out: str) -> DataFrame:
    """J2 [R]: the last event up to 0.01 after (``before``) or the first from 0.01 before on (``after``),
    else the first or last event of all; without events the time itself."""
    shifted = at + F.lit(0.01) if direction == "before" else at - F.lit(0.01)
    n = neighbours(probes.withColumn("_t", at), events, by, shifted)
    p, q = F.col("prev_t"), F.col("next_t")
    # nothing on the one side: the nearest of all on the other is the first, or last, event
    value = F.coalesce(p, q) if direction == "before" else F.coalesce(q, p)
    return n.withColumn(out, F.coalesce(value, F.col("_t"))).drop("prev_t", "next_t", "_t")


def with_events_around(probes: DataFrame, events: DataFrame, by: str, at: Column, out: str, chunk: float = CHUNK) -> DataFrame:
    """``probes`` with a sorted array ``out`` of the events in the chunk of time of ``at`` and the two beside it, and the
    last one before and the first one after these. For several look-ups of a probe that lie within a chunk of ``at``."""
    part = F.floor(F.col("t") / F.lit(chunk))
    e = events.select(F.col(by).alias("_by"), F.explode(F.array(part - 1, part, part + 1)).alias("_chunk"), F.col("t").cast("double").alias("_e"))
    near = e.groupBy("_by", "_chunk").agg(F.array_sort(F.collect_list("_e")).alias("_near"))
    p = probes.select(F.struct(*probes.columns).alias("_row"), F.col(by).alias("_by"), F.floor(at / F.lit(chunk)).alias("_chunk"))
    spots = near.unionByName(p.select("_by", "_chunk").distinct(), allowMissingColumns=True).groupBy("_by", "_chunk").agg(F.first("_near", True).alias("_near"))
    order = Window.partitionBy("_by").orderBy("_chunk")
    before = F.last(F.array_max("_near"), True).over(order.rangeBetween(Window.unboundedPreceding, -3))
    first = F.first(F.get("_near", F.lit(0)), True).over(order.rangeBetween(3, Window.unboundedFollowing))
    full = F.array_compact(F.concat(F.array(before), F.coalesce("_near", F.array().cast("array<double>")), F.array(first)))
    spots = spots.select("_by", "_chunk", full.alias(out))
    return p.join(spots, ["_by", "_chunk"], "left").select("_row.*", out)


def last_upto(events: Column, t: Column) -> Column:
    """J2 [R] in an array of :func:`with_events_around`: the last event up to 0.01 after ``t``, else the first of all, else ``t``."""
    return F.coalesce(F.array_max(F.filter(events, lambda x: x <= t + F.lit(0.01))), F.array_min(events), t)


def first_from(events: Column, t: Column) -> Column:
    """J2 [R] in such an array: the first event from 0.01 before ``t`` on, else the last of all, else ``t``."""
    return F.coalesce(F.array_min(F.filter(events, lambda x: x >= t - F.lit(0.01))), F.array_max(events), t)


def overlapping(points: DataFrame, spans: DataFrame, by: str, at: Column, lo: Column, hi: Column, test: Column, how: str = "inner", bucket: float = 8.0) -> DataFrame:
    """Range join: rows of ``points`` with the spans of their song that may hold ``at`` and pass
    ``test``. Spans are copied to each bucket of ``bucket`` seconds that [lo, hi] touches."""
    b = F.lit(bucket)
    p = points.withColumn("_b", F.floor(at / b))
    s = spans.withColumn("_b", F.explode(F.sequence(F.floor(lo / b), F.floor(hi / b)))).withColumnRenamed(by, f"_{by}")
    return p.join(s, (p[by] == s[f"_{by}"]) & (p["_b"] == s["_b"]) & test, how).drop(p["_b"]).drop(s["_b"]).drop(f"_{by}")


def section_at(probes: DataFrame, sections: DataFrame, by: str, at: str, key: list[str], out: str = "section") -> DataFrame:
    """J3 [R]: lower-cased label of the first section with start <= t < end, else ``unknown``. ``key`` names a probe."""
    return sections_at(probes, sections, by, {out: F.col(at)}, key)


def sections_at(probes: DataFrame, sections: DataFrame, by: str, at: dict[str, Column], key: list[str]) -> DataFrame:
    """J3 [R] at several times of a probe (new column: time), in one join."""
    s = sections.select(by, "section_idx", "start_s", "end_s", F.lower("label").alias("_label"))
    times = F.array(*(F.struct(F.lit(out).alias("out"), t.alias("t")) for out, t in at.items()))
    p = probes.withColumn("_at", F.explode(times))
    t = F.col("_at.t")
    j = overlapping(p, s, by, t, F.col("start_s"), F.col("end_s"), (F.col("start_s") <= t) & (t < F.col("end_s")), "left", 32.0)
    rest = [F.first(c).alias(c) for c in probes.columns if c not in key]
    first = lambda out: F.coalesce(F.min_by(F.when(F.col("_at.out") == out, F.col("_label")), F.when(F.col("_at.out") == out, F.col("section_idx"))), F.lit("unknown")).alias(out)
    return j.groupBy(*key).agg(*rest, *map(first, at))


def in_window(events: DataFrame, start: float, end: float) -> DataFrame:
    """F3 [R]: events in [start, end)."""
    return events.where((F.col("t") >= start) & (F.col("t") < end))


def clipped(spans: DataFrame, windows: DataFrame, by: str) -> DataFrame:
    """F4 [R]: spans that overlap windows of their song (lo, hi), clipped to them."""
    j = spans.join(windows, by).where((F.col("start_s") < F.col("hi")) & (F.col("end_s") > F.col("lo")))
    return j.withColumn("start_s", F.greatest("start_s", "lo")).withColumn("end_s", F.least("end_s", "hi"))
