"""Streaming jobs (ST1 to ST3). Each takes a streaming DataFrame; :mod:`.replay` feeds them stored tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def chunk_counts(events: DataFrame, late: str = "1 minute", size: str = "30 seconds", with_rows: bool = False) -> DataFrame:
    """ST1 [A]: beats and onsets of each song in 30-second chunks. ``events``: track_id, ts (timestamp), kind.

    A chunk is appended once the watermark, ``late`` behind the latest event, has passed its end; events of chunks that are
    gone by then are dropped. ``with_rows`` adds the number of all events counted, so that those read less those
    counted are those dropped."""
    counts = events.withWatermark("ts", late).groupBy(F.window("ts", size), "track_id").agg(
        F.count_if(F.col("kind") == "beat").alias("beats"), F.count_if(F.col("kind") == "onset").alias("onsets"), F.count("*").alias("rows"))
    return counts.select(F.col("window.start").alias("chunk_start"), "track_id", "beats", "onsets", *(["rows"] if with_rows else []))


class _Retries(StatefulProcessor):
    """The run of attempts at one clip: their number, the best score, the first one and when the last one came."""

    def __init__(self, idle_us: int):
        self.idle = idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "attempts int, best double, first_attempt long, last_us long")

    def close(self) -> None:
        pass

    def _timer(self, run) -> int:
        """When a run ends for want of attempts; an open run has this one timer."""
        return (run[3] + self.idle) // 1000 + 1

    def _row(self, key, run, action: str, closed: bool) -> tuple:
        return (*key, run[2], run[0], action, run[1], closed)

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["project_id", "clip_id", "first_attempt", "attempts", "action", "best_score", "closed"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [x for part in rows for x in zip(*(part[c].tolist() for c in ("us", "attempt", "score", "passed")), strict=True)]
        before = run = self.run.get()
        out = []
        for us, n, score, passed in sorted(new, key=lambda x: x[:2]):
            if run and us - run[3] > self.idle:
                out.append(self._row(key, run, "review", True))
                run = None
            run = (run[0] + 1, max(run[1], score), run[2], us) if run else (1, score, n, us)
            if passed:
                out.append(self._row(key, run, "done", True))
                run = None
        if before:
            self.handle.deleteTimer(self._timer(before))
        if run:
            out.append(self._row(key, run, "new_seed" if run[0] <= 2 else "simplify" if run[0] == 3 else "review", False))
            self.run.update(run)
            self.handle.registerTimer(self._timer(run))
        elif before:
            self.run.clear()
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        run = self.run.get()
        self.run.clear()
        yield self._frame([self._row(key, run, "review", True)])


def retry_states(attempts: DataFrame, late: str = "10 minutes", idle_seconds: float = 600.0) -> DataFrame:
    """ST2 [A]: the next step of every clip with new attempts, after each batch: done, new_seed, simplify or review.

    A run of attempts ends when one passes (``done``) or when none has come for ``idle_seconds`` of event time
    (``review``, from the next attempt or from a timer that the watermark sets off); what comes later begins a new run. State is four
    numbers a clip with an open run. Attempts go by time, then by number. ``attempts``: project_id, clip_id, ts, attempt,
    score, passed; gives ``project_id, clip_id, first_attempt, attempts, action, best_score, closed``, a run's latest row being its state."""
    own = attempts.withWatermark("ts", late).select("project_id", "clip_id", "ts", F.unix_micros("ts").alias("us"), "attempt", "score", "passed")
    return own.groupBy("project_id", "clip_id").transformWithStateInPandas(
        _Retries(int(idle_seconds * 1_000_000)), "project_id long, clip_id long, first_attempt long, attempts int, action string, best_score double, closed boolean", "append", "EventTime")


def final_states(states: DataFrame) -> DataFrame:
    """ST2 [A]: of the rows of :func:`retry_states` the last one of each run."""
    last = F.max_by(F.struct("attempts", "action", "best_score", "closed"), F.struct("attempts", "closed"))
    return states.groupBy("project_id", "clip_id", "first_attempt").agg(last.alias("s")).select("project_id", "clip_id", "first_attempt", "s.*")


def playing_section(positions: DataFrame, sections: DataFrame) -> DataFrame:
    """ST3 [A]: live positions (track_id, t, …) with the section that plays; null if none does."""
    s = sections.select(F.col("track_id").alias("s_track"), "start_s", "end_s", F.lower("label").alias("section"))
    return positions.join(s, (F.col("track_id") == F.col("s_track")) & (F.col("t") >= F.col("start_s")) & (F.col("t") < F.col("end_s")), "left").drop("s_track", "start_s", "end_s")
