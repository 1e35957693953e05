"""Mixing sources to target weights (operator 1).

Every document gets a hash-random key. Within a source the documents are taken in key order;
the words before each are found by distributed prefix sums: over 256 wide key ranges, over the 256
ranges of the wide one that holds the cut, then inside the one range that holds it, so that no window
has more than 256 rows of a source, or a 65,536th of its documents. What results is one
row per source (whole epochs, the key at which the last epoch stops, and what that key still
gets), so texts are never shuffled and a hot source is spread over its key ranges.

Defined cases: a null text has size 0; a null source is a source of its own, last in order;
documents with equal keys (repeated ids, null ids) at the cut share what is left there in
proportion to their sizes, rounded down; whole texts are counted, however long; other columns stay as
they are, whatever their names; an empty table gives an empty plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, n_words, small_or_not, text_or_empty

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
#: Hex digits of the key that name its range, and the wide range of that.
RANGE_DIGITS, COARSE_DIGITS = 4, 2
#: Sources up to which their plan is broadcast.
BROADCAST_SOURCES = 100_000
SEED = "mix-1"


def mix_key(doc_id: Column, seed: str = SEED) -> Column:
    """Hash-random key of a document: the same in each run and each engine."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """``doc_id, source, mix_key, size`` per document; size is its number of words."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        mix_key(F.col(id_col), seed).alias("mix_key"), n_words(text_or_empty(text_col)).alias("size"),
    )


def weighted_sources(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, weight`` (written): weights in turn by the sources' order, null last. Sources are
    numbered inside ranges of that order, and the ranges' sizes summed, so no task holds all of them."""
    order = F.col("source").asc_nulls_last()
    sorted_ = sizes.repartitionByRange(order).sortWithinPartitions(order)
    numbered = durable(sorted_.select("source", "source_size", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id")), "mix-sources")
    ranges = numbered.groupBy("part").agg(F.count("*").alias("n"))  # as many rows as ranges
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    ranges = F.broadcast(ranges.select(F.col("part").alias("p"), before.alias("before")))
    rank = F.col("before") + F.col("id") - F.shiftleft(F.col("part").cast("long"), 33)
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("long")
    return durable(numbered.join(ranges, F.col("part") == F.col("p")).select("source", "source_size", weight.alias("weight")), "mix-weights")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: all sizes together are shared by
    weight, none gets over ``max_epochs`` times its size, and the excess is reshared until none is above.

    A round is one aggregation; sources once capped stay so, as the level of the others only rises."""
    w = weighted_sources(sizes, weights).withColumn("cap", F.col("source_size") * max_epochs)
    total, share = w.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    room, rest, n = total, share, 0
    while True:
        capped = F.col("cap").cast("double") * F.lit(rest) <= F.lit(float(room)) * F.col("weight")
        found, cap, weight = w.where(capped).agg(F.count("*"), F.coalesce(F.sum("cap"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if found == n or not rest:
            break
        room, rest, n = total - cap, share - weight, found
    level = F.lit(float(room) / rest if rest else 0.0)
    return w.select("source", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(level * F.col("weight")).alias("target"))


def cut_points(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source, source_size, target, epochs, cut_key, left, at_cut``."""
    part = F.substring("mix_key", 1, RANGE_DIGITS)
    ranges = durable(rows.groupBy("source", part.alias("part")).agg(F.sum("size").alias("words")), "mix-ranges")
    targets = source_targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    goal = F.floor("target")
    targets = durable(
        targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", (goal - F.col("epochs") * F.col("source_size")).cast("long")), "mix-targets")
    few = small_or_not(targets.select(F.col("source").alias("s"), "rest"), BROADCAST_SOURCES)

    def cut(sums: DataFrame, by: str, start: str | None) -> DataFrame:
        w = Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = F.sum("words").over(w) + (F.col(start) if start else F.lit(0))
        return sums.withColumn("upto", upto).where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")))

    coarse = F.substring("part", 1, COARSE_DIGITS)
    wide = ranges.groupBy("source", coarse.alias("wide")).agg(F.sum("words").alias("words"))
    in_wide = cut(wide.join(few, F.col("source").eqNullSafe(F.col("s"))).drop("s"), "wide", None)
    in_wide = durable(in_wide.select(F.col("source").alias("s"), F.col("wide").alias("w"), (F.col("upto") - F.col("words")).alias("before"), "rest"), "mix-wide")
    of_wide = ranges.join(small_or_not(in_wide, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("s")) & (coarse == F.col("w")))
    in_part = cut(of_wide.drop("s", "w"), "part", "before")
    in_part = durable(in_part.select(F.col("source").alias("s"), F.col("part").alias("p"), (F.col("upto") - F.col("words")).alias("before"), "rest"), "mix-parts")
    keys = (
        rows.join(small_or_not(in_part, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("s")) & (part == F.col("p")))
        .groupBy("source", "mix_key").agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    )
    cuts = cut(keys, "mix_key", "before").select(
        F.col("source").alias("s"), F.col("mix_key").alias("cut_key"), (F.col("rest") - F.col("upto") + F.col("words")).alias("left"), F.col("words").alias("at_cut"))
    return durable(targets.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "rest"), "mix-cuts")


def taken_words(size: Column, key: Column) -> Column:
    """Words the mix takes of a row that was joined with :func:`cut_points`."""
    extra = (
        F.when(F.col("cut_key").isNull(), 0).when(key < F.col("cut_key"), size)
        .when(key == F.col("cut_key"), F.floor(size.cast("double") * F.col("left") / F.col("at_cut"))).otherwise(0)
    )
    return (F.col("epochs") * size + extra).cast("long")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every document."""
    rows = durable(sized(docs, id_col, text_col, source_col, seed), "mix-sizes")
    cuts = small_or_not(cut_points(rows, weights, max_epochs).withColumnRenamed("source", "s"), BROADCAST_SOURCES)
    return rows.join(cuts, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", taken_words(F.col("size"), F.col("mix_key")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed documents themselves, with the columns of ``docs``: a row for every epoch in
    which the mix takes words of the document, the one at the cut as a whole."""
    cuts = cut_points(durable(sized(docs, id_col, text_col, source_col, seed), "mix-sizes"), weights, max_epochs)
    plan = small_or_not(cuts.select(F.struct("source", "epochs", "cut_key").alias("plan")), BROADCAST_SOURCES)
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own"))
    key = mix_key(F.col("own")[id_col], seed)
    times = F.col("plan.epochs") + F.when(key <= F.col("plan.cut_key"), 1).otherwise(0)
    return (
        own.join(plan, F.col("own")[source_col].eqNullSafe(F.col("plan.source")))
        .select("own", F.explode(F.array_repeat(F.lit(1), times.cast("int"))))
        .select("own.*")
    )
