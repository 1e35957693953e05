"""Stored tables through the streaming jobs: many micro-batches, late rows, timers, a job that is lost and goes on."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cuesheet.streaming import live, replay

START = datetime(2024, 1, 1)
EVENTS = "track_id long, ts timestamp, kind string, slice int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_late_rows_are_dropped_and_counted(spark):
    """Rows that come after the watermark passed their chunk are dropped and counted; all others equal the batch."""
    rng = random.Random(1)
    fresh = [(k % 5, START + timedelta(seconds=3 * k), rng.choice(("beat", "onset", "other")), k // 100) for k in range(1000)]
    # the watermark is a minute behind the latest row of the slices before
    late = [(rng.randrange(5), START + timedelta(seconds=rng.uniform(0, 200)), "beat", 6) for _ in range(37)]
    # behind the latest row but not behind the watermark: counted
    behind = [(1, START + timedelta(seconds=3 * 600 - 40), "onset", 6) for _ in range(11)]
    df = spark.createDataFrame(fresh + late + behind, EVENTS)
    end = spark.createDataFrame([(None, START + timedelta(days=1), None, 0)], EVENTS)
    out, report = replay.replay(df, lambda e: live.chunk_counts(e, with_rows=True), closing=end)
    want = live.chunk_counts(spark.createDataFrame(fresh + behind, EVENTS), with_rows=True)
    assert rows_of(out) == rows_of(want)
    counted = out.agg(F.sum("rows")).first()[0]
    assert report.rows_in == 1000 + 37 + 11 + 1 and report.rows_in - counted - 1 == 37
    assert report.dropped_after_partial > 0 and report.batches > 10 and report.watermarks == sorted(report.watermarks)
    assert report.state_rows == 1  # the closing row's own chunk; all others were evicted


def plain_runs(rows, idle):
    out, last = {}, {}
    end = max(r[2] for r in rows)
    for p, c, ts, n, score, passed in sorted(rows, key=lambda r: (r[2], r[3])):
        run = last.get((p, c))
        if run and (ts - run["last"]).total_seconds() > idle:
            run["closed"], run = True, None
        if not run:
            run = last[p, c] = {"n": 0, "best": float("-inf"), "closed": False, "action": None}
            out[p, c, n] = run
        run["n"], run["best"], run["last"] = run["n"] + 1, max(run["best"], score), ts
        if passed:
            run["action"], run["closed"] = "done", True
            del last[p, c]
    for r in out.values():
        if not r["action"] and (r["closed"] or r["last"] + timedelta(seconds=idle) < end - timedelta(minutes=10)):
            r["action"], r["closed"] = "review", True
        r["action"] = r["action"] or ("new_seed" if r["n"] <= 2 else "simplify" if r["n"] == 3 else "review")
    return {k: (r["n"], r["action"], r["best"], r["closed"]) for k, r in out.items()}


def test_retry_states_in_any_slicing(spark):
    """The same final states from 1 and 7 micro-batches, equal to a plain loop; idle runs are closed by timers."""
    rng = random.Random(2)
    rows = [(rng.randrange(3), rng.randrange(6), START + timedelta(seconds=rng.uniform(0, 30_000)), n, round(rng.random(), 3), rng.random() < 0.15) for n in range(400)]
    rows += [(9, 9, START + timedelta(seconds=10), 1000 + k, 0.1 * k, k == 2) for k in range(4)]  # equal times: by number
    df = spark.createDataFrame(rows, "project_id long, clip_id long, ts timestamp, attempt long, score double, passed boolean")
    want = plain_runs(rows, 1200.0)
    for slices in (1, 7):
        out, report = replay.replay(replay.sliced(df, F.col("ts"), slices), lambda a: live.retry_states(a, idle_seconds=1200.0))
        got = {(r.project_id, r.clip_id, r.first_attempt): (r.attempts, r.action, r.best_score, r.closed) for r in live.final_states(out).collect()}
        assert got == want and report.rows_in == len(rows)
    assert {"done", "review", "new_seed"} <= {v[1] for v in want.values()} and any(v[1] == "review" and v[0] < 4 for v in want.values())
    assert report.batches >= 7


def test_a_lost_query_goes_on(spark, tmp_path):
    """A query that is stopped between micro-batches goes on from its checkpoint: no row twice, none lost."""
    rows = [(k % 3, START + timedelta(seconds=7 * k), "beat", 0) for k in range(200)]
    df = spark.createDataFrame(rows, EVENTS).drop("slice")
    with replay._rocks(spark):
        for part in (df.where(F.unix_timestamp("ts") % 2 == 0), df.where(F.unix_timestamp("ts") % 2 == 1), spark.createDataFrame([(None, START + timedelta(days=1), None, 0)], EVENTS).drop("slice")):
            part.write.mode("append").parquet(str(tmp_path / "in"))
            job = live.chunk_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), late="2 hours")
            q = job.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
            q.awaitTermination()
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == rows_of(live.chunk_counts(df))
