"""Rows that meet under a key: helpers of the near-duplicate operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Rows of a key beyond which all are looked at closely.
MANY = 512


def runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Whole runs of sorted rows that agree in the first ``width`` columns, many runs at a time:
    where each run starts, and all columns. Bytes come as objects."""
    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
        new = np.any([c[1:] != c[:-1] for c in cols[:width]], axis=0)
        start = np.r_[0, np.flatnonzero(new) + 1]
        if len(start) > 1:
            yield start[:-1], [c[:start[-1]] for c in cols]
        rest = [c[start[-1]:] for c in cols]
    if rest is not None:
        yield np.zeros(1, np.int64), rest


def glanced(width: int, most: int):
    """Of rows sorted by the first ``width`` columns, which node and a word of 64 bits follow, those
    with a partner in their run within ``most`` bits of the word; all rows of runs over ``MANY``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, cols in runs(batches, width):
            size = np.diff(np.r_[start, len(cols[0])])
            nth = np.repeat(np.arange(len(start)), size)
            stays = np.repeat(size > MANY, size)
            word = cols[-1].view(np.uint64)
            for d in range(1, min(int(size.max()), MANY)):
                at = np.flatnonzero(nth[d:] == nth[:-d])
                at = at[np.bitwise_count(word[at] ^ word[at + d]) <= most]
                stays[at] = stays[at + d] = True
            names = [f"k{i}" for i in range(width)] + ["node"]
            yield pa.RecordBatch.from_arrays([pa.array(c[stays]) for c in cols[:-1]], names)

    return run
