"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of code points other than the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The six characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"

_TABLES: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only a session that runs in one process (tests) may leave it unset and gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cuesheet-"))
    return sc.getCheckpointDir().rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark itself would read it by."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def shared_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/cuesheet-{name}-{uuid.uuid4().hex}"
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there and
    a lost executor costs no recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete what :func:`durable` and :func:`shared_path` made in this application. Results read
    these tables, so only the caller knows when: call it once they are written."""
    paths = _TABLES.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def small_or_not(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only once its rows have been counted and are few; otherwise leave the
    join to shuffle. ``df`` should be a written table, as it is read twice."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


#: Keys with at least one in so many of all rows are heavy: by their sum there are no more of them than that.
HEAVY = 10_000
#: Rows of a look-up table that may be broadcast whole.
FEW_ROWS = 300_000


def looked_up(rows: DataFrame, table: DataFrame, by: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``table``, a written one with one row for each key ``by`` and in ``weight`` the key's
    rows on the left. No key is hot: a small table is broadcast; of a large one the heavy keys are, at most
    ``HEAVY`` of ``total`` rows, and what is left is joined by shuffle. ``rows`` is then read twice."""
    if table.limit(FEW_ROWS + 1).count() <= FEW_ROWS:
        return rows.join(F.broadcast(table), by, how)
    is_heavy = F.col(weight) * HEAVY >= total
    heavy = F.broadcast(table.where(is_heavy))
    rest = rows.join(F.broadcast(table.where(is_heavy).select(*by)), by, "left_anti").join(table.where(~is_heavy), by, how)
    return rows.join(heavy, by).unionByName(rest)
