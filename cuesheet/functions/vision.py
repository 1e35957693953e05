"""Vectorised helpers on frames (H2, H3): clustering and similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType


def cosine_distances(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1)
    unit = x / np.where(norm > 0, norm, 1)[:, None]
    return 1 - unit @ unit.T


def ward_merges(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merges of Ward linkage by nearest-neighbour chains: pairs of rows that stand for their clusters, and heights, from the lowest up.

    A chain goes from a cluster to its nearest one until two are each other's nearest (of equally near ones the chain's last
    one, else the lowest); they merge at once, as no other merge can come between. n - 1 merges of one row each: O(n^2)."""
    n = len(d)
    d, size, alive = d.astype(float) ** 2, np.ones(n), np.ones(n, bool)
    np.fill_diagonal(d, np.inf)
    chain, pairs, heights = [], [], []
    while len(pairs) < n - 1:
        if not chain:
            chain.append(int(np.argmax(alive)))
        while True:
            x = chain[-1]
            y = int(np.argmin(d[x]))
            if len(chain) > 1 and d[x, chain[-2]] <= d[x, y]:
                y = chain[-2]
                break
            chain.append(y)
        chain = chain[:-2]
        i, j = min(x, y), max(x, y)
        a, b, h = size[i], size[j], d[i, j]
        with np.errstate(invalid="ignore"):
            d[i] = np.where(alive, np.maximum(0, ((a + size) * d[i] + (b + size) * d[j] - size * h) / (a + b + size)), np.inf)
        alive[j] = False
        d[i, [i, j]] = np.inf
        d[:, i] = d[i]
        d[j], d[:, j] = np.inf, np.inf
        size[i] = a + b
        pairs.append((i, j))
        heights.append(np.sqrt(h))
    order = np.argsort(heights, kind="stable")
    return np.array(pairs, int).reshape(-1, 2)[order], np.array(heights)[order]


def ward_clusters(x: np.ndarray, most: int, tie: float = 1e-9) -> np.ndarray:
    """Labels by Ward linkage over cosine distances, numbered by first appearance: the fewest merges that leave at most ``most``
    clusters, and all merges as high as the last of these (within ``tie``), so equal distances may leave fewer."""
    n = len(x)
    label = np.arange(n)
    if n > most:
        pairs, heights = ward_merges(cosine_distances(x))
        for i, j in pairs[heights <= heights[n - most - 1] + tie]:
            label[label == label[j]] = label[i]
    _, first, back = np.unique(label, return_index=True, return_inverse=True)
    return np.argsort(np.argsort(first))[back]


@F.pandas_udf(ArrayType(IntegerType()))
def cluster_blocks(chroma: pd.Series, duration: pd.Series) -> pd.Series:
    """H2 [R]: cluster of each block of a song; max(3, duration / 20) clusters at most."""
    out = []
    for blocks, seconds in zip(chroma, duration):
        x = np.array([list(b) for b in blocks], float)
        out.append(ward_clusters(x, min(len(x), max(3, int(seconds / 20)))).tolist() if len(x) else [])
    return pd.Series(out)


def _gauss(img: np.ndarray) -> np.ndarray:
    g = np.exp(-((np.arange(11) - 5) ** 2) / (2 * 1.5 ** 2))
    g /= g.sum()
    p = np.pad(img, 5, mode="reflect") if min(img.shape) > 5 else np.pad(img, 5, mode="symmetric")
    p = sum(w * p[i:i + img.shape[0]] for i, w in enumerate(g))
    return sum(w * p[:, i:i + img.shape[1]] for i, w in enumerate(g))


def resized(img: np.ndarray, height: int, width: int) -> np.ndarray:
    """A grey picture of bytes in another size, by linear interpolation between the centres of its pixels; whole numbers again."""
    def places(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, n - 1), at - low

    if img.shape == (height, width):
        return img
    (r, r2, fr), (c, c2, fc) = places(img.shape[0], height), places(img.shape[1], width)
    x = img.astype(float)
    rows = x[r] * (1 - fr)[:, None] + x[r2] * fr[:, None]
    return np.floor(rows[:, c] * (1 - fc) + rows[:, c2] * fc + 0.5)


def ssim(a: np.ndarray, b: np.ndarray) -> float:
    """Mean structural similarity of two grey pictures; of unequal ones each is resized to the smaller height and width."""
    if a.shape != b.shape:
        h, w = min(a.shape[0], b.shape[0]), min(a.shape[1], b.shape[1])
        a, b = resized(a, h, w), resized(b, h, w)
    a, b = a.astype(float), b.astype(float)
    ma, mb = _gauss(a), _gauss(b)
    va, vb, ab = _gauss(a * a) - ma * ma, _gauss(b * b) - mb * mb, _gauss(a * b) - ma * mb
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    return float((((2 * ma * mb + c1) * (2 * ab + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2))).mean())


@F.pandas_udf(DoubleType())
def ssim_pairs(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """H3 [R]: similarity of grey frames given as pixel lists and height; null for a missing one."""
    for a, b, h in parts:
        yield pd.Series([None if x is None or y is None else ssim(np.reshape(x, (k, -1)), np.reshape(y, (k, -1))) for x, y, k in zip(a, b, h)], dtype=float)
