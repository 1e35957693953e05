"""Stored events through a streaming job, in order of event time and in many micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import shared_folder

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class Report:
    """What the micro-batches of a replay did: rows read (an observed metric), rows that state operators dropped because they
    came after the watermark (as Spark counts them, after partial aggregation), rows of state at the end."""

    batches: int = 0
    rows_in: int = 0
    dropped_after_partial: int = 0
    state_rows: int = 0
    watermarks: list[str] = field(default_factory=list)

    def add(self, progress) -> None:
        p = progress if isinstance(progress, dict) else progress.jsonValue if hasattr(progress, "jsonValue") else dict(progress)
        self.batches += 1
        seen = (p.get("observedMetrics") or {}).get("replay")
        if seen is not None:
            self.rows_in += (seen["rows"] if isinstance(seen, dict) else seen.rows) or 0
        states = p.get("stateOperators") or []
        self.dropped_after_partial += sum(s["numRowsDroppedByWatermark"] for s in states)
        self.state_rows = sum(s["numRowsTotal"] for s in states)
        if mark := (p.get("eventTime") or {}).get("watermark"):
            self.watermarks.append(mark)


@contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB, which arbitrary state with timers needs, for the queries started within."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def sliced(rows: DataFrame, at: Column, slices: int) -> DataFrame:
    """``rows`` with ``slice``: which of so many equal stretches of event time they lie in."""
    micros = F.unix_micros(at)
    span = rows.agg(F.min(micros).alias("lo"), F.max(micros).alias("hi")).select("lo", F.greatest(F.col("hi") - F.col("lo"), F.lit(1)).alias("wide"))
    j = rows.crossJoin(F.broadcast(span))  # one row
    return j.withColumn("slice", F.least(F.lit(slices - 1), F.floor((micros - F.col("lo")) * slices / F.col("wide")).cast("int"))).drop("lo", "wide")


def replay(rows: DataFrame, job: Callable[[DataFrame], DataFrame], slice_col: str = "slice", closing: DataFrame | None = None) -> tuple[DataFrame, Report]:
    """What ``job`` appends when it reads ``rows`` slice by slice, a slice a micro-batch (more, where state is to be
    cleared between them), and a report.

    The slices are written once, in folders of their own, and handed to the stream by renaming; the job runs as one query
    with one checkpoint, so it can be lost and resumed at any batch. ``closing``: rows of a last slice, such as one
    far ahead in time that moves the watermark past all others. The result is a written table."""
    spark = rows.sparkSession
    folder = shared_folder(spark, "replay")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    columns = [c for c in rows.columns if c != slice_col]
    rows.hint("rebalance", slice_col).write.partitionBy(slice_col).parquet(f"{folder}/slices")
    names = sorted((s.getPath().getName() for s in system.listStatus(path(f"{folder}/slices")) if s.isDirectory()), key=lambda n: int(n.partition("=")[2]))
    if closing is not None:
        closing.select(*columns).write.parquet(f"{folder}/slices/closing")
        names.append("closing")
    system.mkdirs(path(f"{folder}/in"))
    report = Report()
    with _rocks(spark):
        source = spark.readStream.schema(rows.select(*columns).schema).option("recursiveFileLookup", True).parquet(f"{folder}/in")
        out = job(source.observe("replay", F.count("*").alias("rows")))
        query = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out").start()
        try:
            seen = -1
            for name in names:
                system.rename(path(f"{folder}/slices/{name}"), path(f"{folder}/in/{name}"))
                query.processAllAvailable()
                for p in query.recentProgress:
                    if p["batchId"] > seen and p["numInputRows"] + len(p["stateOperators"]):
                        seen = p["batchId"]
                        report.add(p)
        finally:
            query.stop()
    return spark.read.schema(out.schema).parquet(f"{folder}/out"), report
