"""Readers and writers of song documents (IO1 to IO8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORD_T = "struct<word:string,start:double,end:double,probability:double>"
TRANSCRIPT = f"text string, language string, model_used string, segments array<struct<id:int,start:double,end:double,text:string,words:array<{WORD_T}>>>"
BEAT_OBJECT = "struct<beats:array<double>,timestamps:array<double>,beat_times:array<double>,onsets:array<double>,onset_times:array<double>,bpm:double>"
SECTION = "struct<start:double,end:double,label:string,name:string,type:string,energy:double,intensity:double>"
STREAMS = "struct<streams:array<struct<codec_type:string,width:string,height:string,r_frame_rate:string,duration:string>>,format:struct<duration:string>>"
CLIP_KINDS = r"(?i)\.(mp4|mov|mkv|webm|avi)$"


def read_transcripts(spark: SparkSession, path: str, track: Column) -> DataFrame:
    """IO1 [R], from files: one JSON document per song; ``track`` names the song, e.g. by its path."""
    return spark.read.schema(TRANSCRIPT).option("multiLine", True).json(path).withColumn("track_id", track)


def transcript_words(transcripts: DataFrame) -> DataFrame:
    """IO1 [R]: words of all segments in order, trimmed; a missing probability is 0."""
    words = F.flatten(F.transform(F.filter("segments", lambda s: s["words"].isNotNull()), lambda s: s["words"]))
    # an inner explode would filter transcripts by their words, which are made twice for it
    w = transcripts.select("track_id", F.posexplode_outer(words).alias("w_idx", "w")).where("w_idx IS NOT NULL")
    return w.select("track_id", "w_idx", F.trim("w.word").alias("word"), F.col("w.start").alias("start_s"), F.col("w.end").alias("end_s"),
                    F.coalesce("w.probability", F.lit(0.0)).alias("probability"))


def lyric_lines(lyrics: DataFrame) -> DataFrame:
    """IO2 [R]: non-blank lines of each text, trimmed and numbered. ``lyrics``: track_id, text."""
    trimmed = F.transform(F.split("text", "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    lines = F.filter(trimmed, lambda x: x != "")
    return lyrics.select("track_id", F.posexplode(lines).alias("line_index", "line"))


def flat_words(lines: DataFrame) -> DataFrame:
    """IO2 [R]: words of the lines, numbered in the line and in the song."""
    words = lines.select("track_id", "line_index", F.posexplode(F.split("line", r"\s+")).alias("word_idx", "word"))
    order = Window.partitionBy("track_id").orderBy("line_index", "word_idx")
    return words.withColumn("u_idx", (F.row_number().over(order) - 1).cast("int"))


def parted_lines(text: Column) -> Column:
    """IO2 [R]: the words of each non-blank line of a text."""
    trimmed = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.transform(F.filter(trimmed, lambda x: x != ""), lambda x: F.split(x, r"\s+"))


def lyric_line_words(lyrics: DataFrame) -> DataFrame:
    """IO2 [R]: ``track_id, line_index, words, first``: each line's words and the number of its first one in the song. They are
    counted inside the text, which is one row, so nothing is shuffled. ``lyrics``: track_id, text."""
    parted = lyrics.select("track_id", parted_lines(F.col("text")).alias("_lines"))
    inside = F.flatten(F.transform("_lines", lambda ws: F.sequence(F.lit(0), F.size(ws) - 1)))
    first = F.filter(F.transform(inside, lambda at, u: F.when(at == 0, u)), lambda u: u.isNotNull())
    lines = parted.select("track_id", F.posexplode(F.arrays_zip(F.col("_lines").alias("words"), first.alias("first"))).alias("line_index", "l"))
    return lines.select("track_id", "line_index", F.col("l.words").alias("words"), F.col("l.first").alias("first"))


def lyric_words(lyrics: DataFrame, with_size: bool = False) -> DataFrame:
    """IO2 [R]: the rows of :func:`flat_words` straight from whole texts, without a shuffle; ``with_size`` adds ``in_line``, the words of a word's line."""
    size = [F.size("words").alias("in_line")] if with_size else []
    w = lyric_line_words(lyrics).select("track_id", "line_index", "first", *size, F.posexplode("words").alias("word_idx", "word"))
    return w.select("track_id", "line_index", "word_idx", "word", (F.col("first") + F.col("word_idx")).alias("u_idx"), *(["in_line"] if with_size else []))


def parse_beats(docs: DataFrame) -> DataFrame:
    """IO3 [R]: beat maps in any accepted form; ``docs``: track_id, json. Onsets default to the beats.

    A flat list of numbers, a list of objects with time or timestamp, or an object."""
    obj = F.from_json("json", BEAT_OBJECT)
    flat = F.from_json("json", "array<double>")
    objects = F.from_json("json", "array<struct<time:double,timestamp:double>>")
    is_list = F.trim("json").startswith("[")
    is_flat = F.trim("json").rlike(r"^\[\s*(-?[0-9.]|\])")
    beats = F.when(is_list & is_flat, flat).when(is_list, F.transform(objects, lambda o: F.coalesce(o["time"], o["timestamp"], F.lit(0.0)))).otherwise(
        F.coalesce(obj["beats"], obj["timestamps"], obj["beat_times"], F.array().cast("array<double>")))
    onsets = F.coalesce(obj["onsets"], obj["onset_times"], beats)
    return docs.select("track_id", beats.alias("beats"), F.when(is_list, beats).otherwise(onsets).alias("onsets"))


def parse_sections(docs: DataFrame) -> DataFrame:
    """IO4 [R]: sections from a flat list or under one of three names; end defaults to start + 30, a label to ``section-`` and its number."""
    arr = f"array<{SECTION}>"
    obj = F.from_json("json", f"struct<sections:{arr},segments:{arr},structure:{arr}>")
    rows = F.when(F.trim("json").startswith("["), F.from_json("json", arr)).otherwise(F.coalesce(obj["sections"], obj["segments"], obj["structure"]))
    s = docs.select("track_id", F.posexplode(rows).alias("section_idx", "s"))
    start = F.coalesce("s.start", F.lit(0.0))
    return s.select("track_id", "section_idx", start.alias("start_s"), F.coalesce("s.end", start + 30).alias("end_s"),
                    F.coalesce("s.label", "s.name", "s.type", F.concat(F.lit("section-"), "section_idx")).alias("label"), F.coalesce("s.energy", "s.intensity").alias("energy"))


def list_clips(spark: SparkSession, path: str) -> DataFrame:
    """IO5 [R]: clip files of the five kinds below ``path``, by name; contents are not read."""
    return clip_files(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length"))


def clip_files(files: DataFrame) -> DataFrame:
    """IO5 [R]: of ``path, length`` the clips, numbered in each folder by name."""
    files = files.where(F.col("path").rlike(CLIP_KINDS))
    name = F.element_at(F.split("path", "/"), -1)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    order = Window.partitionBy(folder).orderBy(name)
    return files.select(folder.alias("folder"), name.alias("file"), "length", (F.row_number().over(order) - 1).cast("int").alias("clip_no"))


def parse_probe(docs: DataFrame) -> DataFrame:
    """IO6 [R]: first video stream of a probe document (column json); other columns are kept."""
    p = docs.withColumn("_p", F.from_json("json", STREAMS)).withColumn("_v", F.get(F.filter("_p.streams", lambda s: s["codec_type"] == "video"), F.lit(0)))
    rate = F.col("_v.r_frame_rate")
    num, den = (F.split_part(rate, F.lit("/"), F.lit(i)).try_cast("double") for i in (1, 2))
    fps = F.when(rate.contains("/"), F.coalesce(F.try_divide(num, den), F.lit(0.0))).otherwise(rate.try_cast("double"))
    return p.select(*(c for c in docs.columns if c != "json"), F.col("_v").isNotNull().alias("has_video"), F.coalesce(F.col("_v.width").cast("int"), F.lit(0)).alias("width"),
                    F.coalesce(F.col("_v.height").cast("int"), F.lit(0)).alias("height"), F.coalesce(fps, F.lit(0.0)).alias("fps"),
                    F.when(F.col("_v").isNotNull(), F.coalesce(F.col("_p.format.duration").try_cast("double"), F.lit(0.0))).otherwise(0.0).alias("duration"))


def song_documents(rows: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """IO7 [R]: one JSON document per song with its rows, in order, under ``name``."""
    cols = [c for c in rows.columns if c not in (key, order)]
    got = F.array_sort(F.collect_list(F.struct(order, *cols)))
    return rows.groupBy(key).agg(got.alias("_r")).select(key, F.to_json(F.struct(F.transform("_r", lambda r: F.struct(*(r[c].alias(c) for c in cols))).alias(name))).alias("document"))


def write_documents(documents: DataFrame, path: str, key: str, parts: int) -> None:
    """IO7 [R]: documents as Parquet, in ``parts`` folders by a hash of the key."""
    documents.withColumn("part", F.pmod(F.hash(key), F.lit(parts))).repartition(parts, "part").write.partitionBy("part").parquet(path)


def report_json(rows: DataFrame, keys: list[str], measures: list[str], skipped: str | None = None) -> DataFrame:
    """IO8 [R]: a JSON report per row without nulls; NaN and infinite values become 0; ``skipped`` shows only if true."""
    clean = [F.when(F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(F.col(c)).alias(c) for c in measures]
    flag = [F.when(F.col(skipped), True).alias(skipped)] if skipped else []
    return rows.select(*keys, F.to_json(F.struct(*clean, *flag)).alias("report"))
