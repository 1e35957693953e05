"""Clip windows against a plain loop over all beats, with beats near and far."""

import random

import pytest

from cuesheet.operators import clips


def snap(t, beats, direction):
    if not beats:
        return t
    near = [b for b in beats if (b <= t + 0.01 if direction == "before" else b >= t - 0.01)]
    return (max(near) if direction == "before" else min(near)) if near else (beats[0] if direction == "before" else beats[-1])


def window(start, end, beats):
    end = start + 15 if end - start < 15 else start + 30 if end - start > 30 else end
    a, b = snap(start, beats, "before"), snap(end, beats, "after")
    if b - a > 31:
        b = snap(a + 30, beats, "before")
    if b - a < 14:
        b = snap(a + 15, beats, "after")
    return max(a, 0.0), b


def songs(seed):
    """Beats that begin, pause and stop up to 20 chunks of time away from the sections."""
    rng = random.Random(seed)
    beats, sections = {}, {}
    for song in range(60):
        gap = 64.0 * rng.choice((0, 0.2, 1, 2, 3, 7, 20))
        t, own = rng.choice((0.0, gap)), []
        for _ in range(rng.choice((0, 1, 2, 30, 120))):
            own.append(round(t, 3))
            t += gap if rng.random() < 0.05 else rng.choice((0.4, 0.5, 3.0, 16.0))
        beats[song] = own
        at, rows = rng.choice((0.0, 3.0, gap)), []
        for i in range(12):
            end = at + rng.choice((4.0, 14.99, 15.0, 22.5, 30.0, 31.0, 80.0))
            rows.append((i, at, end))
            at = end + rng.choice((0.0, 0.0, gap))
        sections[song] = rows
    return beats, sections


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_a_plain_loop(spark, seed):
    beats, sections = songs(seed)
    beats[1000], sections[1000] = [200.0 + i for i in range(60)], [(0, 0.0, 20.0)]
    s = spark.createDataFrame([(k, i, a, b, "verse", 0.5) for k, rows in sections.items() for i, a, b in rows], "track_id int, section_idx int, start_s double, end_s double, label string, score double")
    e = spark.createDataFrame([(k, t) for k, own in beats.items() for t in own], "track_id int, t double")
    got = {(r.track_id, r.section_idx): (r.clip_start, r.clip_end) for r in clips.candidates(s, e).collect()}
    assert got == {(k, i): window(a, b, beats[k]) for k, rows in sections.items() for i, a, b in rows}
    assert got[1000, 0] == (200.0, 215.0)
