"""Queries whose words do not occur in the given tables, with the same SQL on tables that hold them."""

import random

import duckdb
from test_oracle import canonical

from cuesheet.functions import text
from cuesheet.jobs.catalog import ORACLE_SQL, QUERIES
from cuesheet.operators import planning


def test_theme_tags_on_real_words(spark, tmp_path):
    """Every theme and emotional word, in any case and with signs around it, some in both lexicons; words of two parts tag nothing."""
    rng = random.Random(1)
    lexicon = sorted({r[0] for r in planning.theme_lexicon(spark, text.EMOTIONAL).collect()})
    lines = []
    for k in range(200):
        words = [rng.choice(lexicon) if rng.random() < 0.4 else f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 60))]
        words = [rng.choice((str.upper, str.title, str, lambda x: f"({x})", lambda x: f"{x},", lambda x: f"{x}s!")) (w) for w in words]
        lines.append((k, "\n".join(" ".join(words[i:i + 7]) for i in range(0, len(words), 7)), "en", "a", 0))
    df = spark.createDataFrame(lines, "doc_id long, text string, lang string, source string, n_chars long")
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got, want = QUERIES["a16_theme_tags"](spark, str(tmp_path)), con.sql(ORACLE_SQL["a16_theme_tags"])
    rows = canonical(got.collect(), got.columns)
    assert rows == canonical(want.fetchall(), want.columns) and len(rows) > 500
    assert len({r.theme for r in got.collect()}) > 10
