"""SQL of operators on made tables that hold what the given ones lack: revisits, links, copies."""

import random

import duckdb
import numpy as np

from cuesheet.llm import queries


def equal(spark, folder, name, table, df):
    df.coalesce(2).write.parquet(f"{folder}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    got, want = queries.QUERIES[name](spark, str(folder)), con.sql(queries.ORACLE_SQL[name])
    show = lambda rows, cols: sorted(tuple(str(r[cols.index(c)]) for c in sorted(cols)) for r in rows)
    rows = got.collect()
    assert sorted(got.columns) == sorted(want.columns) and show(rows, got.columns) == show(want.fetchall(), want.columns)
    return rows


def test_revisits(spark, tmp_path):
    rng = random.Random(1)
    pages = [(k, f"http://a/{k}", rng.choice((None, "", "<p>é</p>", "x" * 5000, f"<p>{k}</p>", f"page {rng.randrange(20)}"))) for k in rng.sample(range(10_000), 400)]
    rows = equal(spark, tmp_path, "op4_warc_bundles", "pages", spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert sum(r.record_type == "revisit" for r in rows) > 200 and {r.record_type for r in rows} == {"response", "revisit"}


def test_links(spark, tmp_path):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 24))
    x = np.concatenate([base, base + rng.normal(size=base.shape) * 0.1, base + rng.normal(size=base.shape) * 0.2, base[:9]])
    rows = [(int(k), v.astype(np.float32).tolist(), int(k) % 30 % 4) for k, v in enumerate(x)] + [(500, None, 1), (501, [0.0] * 24, 1), (502, rng.normal(size=24).tolist(), None)]
    got = equal(spark, tmp_path, "op9_rotation_codes", "embeddings", spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert sum(r.n_links > 0 for r in got) > 60 and sum(not r.kept for r in got) > 30


def test_copies(spark, tmp_path):
    rng = random.Random(3)
    rows = [(k, rng.choice((None, "", "A copy", "a COPY", "É", "é", f"text {rng.randrange(60)}", f"TEXT {k}")), "en", "a", 0) for k in range(500)]
    got = equal(spark, tmp_path, "op13_exact_dedup", "documents", spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert sum(not r.kept for r in got) > 300
