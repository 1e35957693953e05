"""Folders with one document a song: written by a data source with a commit of its own, read by its reader, a task for each task's folder."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

PENDING = "_pending"
#: Of gzip: transcripts take 1.1 times the bytes that the highest level leaves, in a quarter of its time.
LEVEL = 3


def _opened(path: str):
    """The file system of a path and the path inside it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def file_name(track_id) -> str:
    """A name that any file system takes and that no reader takes for a hidden file."""
    name = quote(str(track_id), safe="")
    return f"%{ord(name[0]):02X}{name[1:]}" if name[:1] in (".", "_") else name


@dataclass
class Written(WriterCommitMessage):
    """A task's own folder and the number of its files."""

    folder: str
    files: int


class SongFilesWriter(DataSourceWriter):
    """Each attempt of a task writes to a folder of its own below ``_pending``; the commit moves the folders of the attempts that
    count, one rename a task, and deletes what other attempts left. A reader sees all files of a write or none."""

    def __init__(self, path: str, suffix: str):
        self.path, self.suffix, self.run = path.rstrip("/"), suffix, uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Written:
        system, root = _opened(self.path)
        folder, seen = f"{PENDING}/{self.run}/{uuid.uuid4().hex}", set()
        system.create_dir(f"{root}/{folder}", recursive=True)
        for name, document in iterator:
            if name is None or name in seen:
                raise ValueError(f"one document for each song, and a name for it: {name!r}")
            seen.add(name)
            text, packed = (document or "").encode(), self.suffix.endswith(".gz")
            with system.open_output_stream(f"{root}/{folder}/{file_name(name)}{self.suffix}", compression=None) as f:
                f.write(gzip.compress(text, LEVEL, mtime=0) if packed else text)
        return Written(folder, len(seen))

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _opened(self.path)
        for n, m in enumerate(m for m in messages if m and m.files):
            system.move(f"{root}/{m.folder}", f"{root}/part-{n:05d}-{self.run[:12]}")
        self._clear(system, root)
        with system.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_opened(self.path))

    def _clear(self, system, root: str) -> None:
        from pyarrow import fs

        if system.get_file_info(f"{root}/{PENDING}/{self.run}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{PENDING}/{self.run}")


class SongFilesReader(DataSourceReader):
    """The driver sees only the folders directly below the path; a task lists one of them, or the files beside them, and reads what it
    finds. So the number of songs never reaches the driver."""

    def __init__(self, path: str, suffix: str):
        self.path, self.suffix = path.rstrip("/"), suffix

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = _opened(self.path)
        below = system.get_file_info(fs.FileSelector(root))
        folders = sorted(x.base_name for x in below if x.type == fs.FileType.Directory and x.base_name[:1] not in ("_", "."))
        beside = any(x.type == fs.FileType.File and x.base_name.endswith(self.suffix) for x in below)
        return [InputPartition(x) for x in folders + [""] * beside] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        from pyarrow import fs

        if partition.value is None:
            return
        system, root = _opened(self.path)
        top = f"{root}/{partition.value}".rstrip("/")
        for f in system.get_file_info(fs.FileSelector(top, recursive=bool(partition.value))):
            hidden = any(x[:1] in ("_", ".") for x in f.path[len(top):].split("/"))
            if f.type == fs.FileType.File and not hidden and f.base_name.endswith(self.suffix) and f.size:
                with system.open_input_stream(f.path) as file:
                    yield unquote(f.base_name[:len(f.base_name) - len(self.suffix)]), file.read().decode()


class SongFiles(DataSource):
    """``format("song_files")``: rows of a name and a text; options ``path`` and ``suffix``."""

    @classmethod
    def name(cls) -> str:
        return "song_files"

    def schema(self) -> str:
        return "track_id string, document string"

    def reader(self, schema: StructType) -> SongFilesReader:
        return SongFilesReader(self.options["path"], self.options.get("suffix", ".json"))

    def writer(self, schema: StructType, overwrite: bool) -> SongFilesWriter:
        if overwrite:
            raise ValueError("song files are added to a folder; give a new one to replace them")
        return SongFilesWriter(self.options["path"], self.options.get("suffix", ".json"))


def write_song_files(documents: DataFrame, path: str, suffix: str = ".json", dealt: bool = False) -> None:
    """IO7, X3 [R] as files: ``track_id, document``, a file for each song, packed if ``suffix`` ends with ``.gz``. Rows of a song meet in one
    task, which refuses a second one; ``dealt``: they do so already, as where documents are made of texts that were dealt by song."""
    documents.sparkSession.dataSource.register(SongFiles)
    rows = documents.select(F.col("track_id").cast("string").alias("track_id"), F.col("document"))
    rows = rows if dealt else rows.repartition("track_id")
    rows.write.format("song_files").option("suffix", suffix).mode("append").save(path)


def read_song_files(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """IO1 to IO4 [R] from files: ``track_id`` (from the file's name) and its whole ``text``; files below ``_pending`` are not seen, nor are
    files without a byte, which Spark's own readers pass over too."""
    spark.dataSource.register(SongFiles)
    return spark.read.format("song_files").schema("track_id string, text string").option("suffix", suffix).load(path)
