"""One document a song: what is written is read back, whatever the names; attempts that do not count leave nothing."""

import os

import pytest
from pyspark.sql import Row

from cuesheet.sources import song_files


def test_round_trip_of_any_name_and_text(spark, tmp_path):
    names = ["1", "02", "a b", "a/b", "ü%2F+", "..", "x.json", "漢字", "a?b#c&d=e"]
    rows = [(n, text) for n, text in zip(names, ["{}", "", "line\n\nline\r\n", "é" * 5000, '{"a": "\\u00e9"}', "x", "y", "z", "w"])]
    path = str(tmp_path / "out")
    song_files.write_song_files(spark.createDataFrame(rows, "track_id string, document string").repartition(4), path)
    assert sorted(map(tuple, song_files.read_song_files(spark, path).collect())) == sorted(r for r in rows if r[1])
    assert any(f == "02.json" for _, _, fs in os.walk(path) for f in fs)
    song_files.write_song_files(spark.createDataFrame([(7, "seven")], "track_id long, document string"), path)
    got = dict(map(tuple, song_files.read_song_files(spark, path).collect()))
    assert len(got) == 9 and got["7"] == "seven"


def test_a_task_that_runs_twice(tmp_path):
    """Two attempts write; the one that counts is moved, the other one and a task that never ended leave no file."""
    w = song_files.SongFilesWriter(str(tmp_path), ".ass")
    rows = [Row("1", "one"), Row("2", "two")]
    lost, counts, other = w.write(iter(rows)), w.write(iter(rows)), w.write(iter([Row("3", "three")]))
    never = song_files.SongFilesWriter(str(tmp_path), ".ass")
    never.write(iter([Row("9", "nine")]))
    assert lost.folder != counts.folder and not [f for f in os.listdir(tmp_path) if f.startswith("part")]
    w.commit([counts, None, other])
    files = sorted((os.path.basename(f), open(os.path.join(d, f)).read()) for d, _, fs in os.walk(tmp_path) for f in fs if "_pending" not in d)
    assert files == [("1.ass", "one"), ("2.ass", "two"), ("3.ass", "three"), ("_SUCCESS", "")]
    never.abort([])
    assert os.listdir(tmp_path / "_pending") == []


def test_files_of_a_run_that_was_lost_are_not_read(spark, tmp_path):
    w = song_files.SongFilesWriter(str(tmp_path), ".json")
    w.write(iter([Row("1", "pending")]))
    song_files.write_song_files(spark.createDataFrame([("2", "done")], "track_id string, document string"), str(tmp_path))
    assert [tuple(r) for r in song_files.read_song_files(spark, str(tmp_path)).collect()] == [("2", "done")]


@pytest.mark.parametrize("rows", [[("1", "a"), ("1", "b")], [(None, "a")]])
def test_a_song_has_one_document(spark, tmp_path, rows):
    with pytest.raises(Exception, match="one document for each song"):
        song_files.write_song_files(spark.createDataFrame(rows, "track_id string, document string"), str(tmp_path / "out"))
    assert not [d for d, _, fs in os.walk(tmp_path) for f in fs if f.endswith(".json") and "part-" in d]


def test_packed_files(spark, tmp_path):
    """A suffix of .gz packs each file as any reader of gzip takes it; documents that are dealt already are not dealt again."""
    import gzip

    rows = [(k, '{"word": "la"}' * 500 + f" é{k}") for k in range(20)]
    documents = spark.createDataFrame(rows, "track_id long, document string").repartition(4, "track_id")
    for name, dealt in (("a", False), ("b", True)):
        path = str(tmp_path / name)
        song_files.write_song_files(documents, path, ".json.gz", dealt)
        assert {tuple(r) for r in song_files.read_song_files(spark, path, ".json.gz").collect()} == {(str(k), d) for k, d in rows}
        files = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".json.gz")]
        assert len(files) == 20 and sum(map(os.path.getsize, files)) < sum(len(d) for _, d in rows) / 20
        assert {gzip.open(f, "rt", encoding="utf-8").read() for f in files} == {d for _, d in rows}


def test_transcripts_move_as_texts(spark, tmp_path, monkeypatch):
    """The files of transcripts take fewer bytes than their texts do twice."""
    from cuesheet.jobs import catalog

    monkeypatch.setattr(catalog, "shared_folder", lambda _, name: str(tmp_path / name))
    n = catalog.QUERIES["io1_transcript_files"](spark, "/root/testdata/sf0.001").count()
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("sum(octet_length(text))").first()[0]
    files = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path) for f in fs if ".json" in f and not f.startswith(".")]
    assert n > 0 and files and sum(map(os.path.getsize, files)) < 2 * texts
