"""Document quality from a linear-chain conditional random field over lines (operator 8).

Every line with a word is good or bad. Its features are binned measures of the line itself and of
the lines before and after; a 2 x 2 transition matrix ties neighbours. Only documents are labelled,
so the field is fitted to them: a good document has good lines only, a bad one has at least one bad
line, and both likelihoods come from the probability that all lines are good. Forward-backward
marginals, averaged with the lines' lengths as weights, give the document's quality, which a
logistic curve turns into the probability of label 1.

The field is fitted on the driver with numpy, on at most ``SAMPLE`` documents of each label (those
with the smallest hash of their id, from the training folds only) of at most ``SAMPLE_BYTES`` each.
Scoring reads whole texts of any length, row by row, where they are.

Defined cases: a document without words scores 0; a null id counts as held out; a null quality is
no label; repeated label rows of a document count once, the lower one; repeated rows are scored each;
with labels of one kind only, or none, there is no field and every score, also of documents without words, is
the share of label 1 (0.5 without labels); columns of any other name are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most documents of either label that the field is fitted on.
SAMPLE = 2500
#: Longest document of the sample.
SAMPLE_BYTES = 65_536
FOLDS = 5
CUTOFF = 0.3
#: Upper edges of the bins of each line measure; values at or over the last form one more bin.
EDGES = {
    "symbols": (0.001, 0.05, 0.3), "bangs": (0.001, 0.2, 0.8), "upper": (0.05, 0.3, 0.8), "distinct": (0.35, 0.6, 0.8),
    "stutter": (0.001, 0.1, 0.4), "length": (3.5, 5.0, 8.0, 12.0), "words": (2, 5, 12, 40), "again": (0.5,), "digits": (0.001, 0.2),
}
N_BINS = sum(len(e) + 1 for e in EDGES.values())
STEPS, RATE, DECAY = 160, 0.1, 1e-4


def line_measures(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bin numbers (n, measures) and lengths of the lines of a text that have words."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        w = line.split()
        n = len(w)
        if not n:
            continue
        count = line.count
        chars = sum(map(len, w))
        rows.append((
            (count("#") + count("*") + count("$") + count("%") + count("&") + count("|") + count("<") + count(">")) / n,
            count("!") / n, sum(map(str.isupper, w)) / n, len(set(w)) / n ** 0.9 if n > 1 else 1.0,
            sum(map(str.__eq__, w, w[1:])) / n, chars / n, n, line in seen, sum(map(str.isdigit, w)) / n,
        ))
        sizes.append(chars)
        seen.add(line)
    values = np.array(rows, float).reshape(len(rows), len(EDGES))
    bins, base = np.empty(values.shape, np.int64), 0
    for k, edges in enumerate(EDGES.values()):
        bins[:, k] = base + np.searchsorted(edges, values[:, k], side="right")
        base += len(edges) + 1
    return bins, np.array(sizes, float)


@dataclass
class Field:
    """weights: of a line's own bins, the previous line's and the next line's, for the bad state;
    edge: (1, N_BINS * 3 + 1) bias is last; trans: 2 x 2; curve: of the logistic; prior: without model."""

    weights: np.ndarray
    trans: np.ndarray
    curve: np.ndarray
    prior: float | None = None

    def line_scores(self, bins: np.ndarray) -> np.ndarray:
        own, before, after = self.weights[:N_BINS], self.weights[N_BINS:2 * N_BINS], self.weights[2 * N_BINS:3 * N_BINS]
        s = own[bins].sum(axis=1) + self.weights[-1]
        if len(bins) > 1:
            s[1:] += before[bins[:-1]].sum(axis=1)
            s[:-1] += after[bins[1:]].sum(axis=1)
        return s

    def quality(self, bins: np.ndarray, sizes: np.ndarray) -> float:
        """Length-weighted mean of the marginals of the good state."""
        u = np.zeros((1, len(bins), 2))
        u[0, :, 1] = self.line_scores(bins)
        bad, _, _ = marginals(u, np.array([len(bins)]), self.trans, with_moves=False)
        return float(((1 - bad[0]) * sizes).sum() / sizes.sum())

    def score(self, text: str) -> float:
        if self.prior is not None:
            return self.prior
        bins, sizes = line_measures(text)
        if not len(bins):
            return 0.0
        return float(_sigmoid(self.curve @ _curve_inputs(self.quality(bins, sizes))))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _curve_inputs(q) -> np.ndarray:
    q = np.clip(q, 1e-4, 1 - 1e-4)
    return np.array([np.log(q / (1 - q)), q, np.ones_like(q)])


def marginals(u: np.ndarray, lengths: np.ndarray, trans: np.ndarray, with_moves: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded chains (docs, lines, states): probabilities of the bad state,
    expected transitions of each chain, and log of the partition sum."""
    n, length, _ = u.shape
    add = lambda x: np.logaddexp(x[..., 0], x[..., 1])
    fwd, bwd = np.zeros_like(u), np.zeros_like(u)
    fwd[:, 0] = u[:, 0]
    for t in range(1, length):
        step = np.stack([add(fwd[:, t - 1] + trans[:, s]) for s in (0, 1)], axis=1) + u[:, t]
        fwd[:, t] = np.where((t < lengths)[:, None], step, fwd[:, t - 1])
    z = add(fwd[:, -1])
    for t in range(length - 2, -1, -1):
        step = np.stack([add(bwd[:, t + 1] + u[:, t + 1] + trans[s]) for s in (0, 1)], axis=1)
        bwd[:, t] = np.where((t + 1 < lengths)[:, None], step, 0)
    inside = np.arange(length) < lengths[:, None]
    bad = np.where(inside, np.exp(np.minimum(0, fwd[..., 1] + bwd[..., 1] - z[:, None])), 0)
    moves = np.zeros((n, 2, 2))
    if length > 1 and with_moves:
        pair = fwd[:, :-1, :, None] + trans + (u + bwd)[:, 1:, None, :] - z[:, None, None, None]
        moves = (np.exp(np.minimum(0, pair)) * inside[:, 1:, None, None]).sum(axis=1)
    return bad, moves, z


def fit(texts: list[str], labels: list[int]) -> Field:
    """Fit the field and the logistic curve to documents with labels."""
    docs = [(b, s, y) for t, y in zip(texts, labels, strict=True) for b, s in [line_measures(t)] if len(b)]
    y = np.array([d[2] for d in docs], float)
    empty = Field(np.zeros(3 * N_BINS + 1), np.zeros((2, 2)), np.zeros(3))
    if not len(y) or y.min() == y.max():
        empty.prior = float(y.mean()) if len(y) else 0.5
        return empty
    docs.sort(key=lambda d: len(d[0]))
    y = np.array([d[2] for d in docs], float)
    groups = [list(range(lo, min(lo + 256, len(docs)))) for lo in range(0, len(docs), 256)]
    rows = {g: [docs[i] for i in ids] for g, ids in enumerate(groups)}
    weights = np.zeros(3 * N_BINS + 1)
    weights[-1] = -1.0
    theta = np.concatenate([weights, np.zeros(4)])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    # positions of the features of every line, for gathers and scatters over all documents at once
    packed = []
    for g in rows:
        lengths = np.array([len(d[0]) for d in rows[g]])
        bins = np.concatenate([d[0] for d in rows[g]])
        doc = np.repeat(np.arange(len(lengths)), lengths)
        pos = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        packed.append((lengths, bins, doc, pos, y[groups[g]]))
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for step in range(1, STEPS + 1):
        grad = np.zeros_like(theta)
        field = Field(theta[:-4], theta[-4:].reshape(2, 2), np.zeros(3))
        for g, (lengths, bins, doc, pos, label) in enumerate(packed):
            s = field.weights[bins].sum(axis=1) + field.weights[-1]
            later, earlier = pos > 0, np.r_[pos[1:] > 0, False]
            s[later] += field.weights[N_BINS + bins[earlier]].sum(axis=1)
            s[earlier] += field.weights[2 * N_BINS + bins[later]].sum(axis=1)
            u = np.zeros((len(lengths), lengths.max(), 2))
            u[doc, pos, 1] = s
            bad, moves, z = marginals(u, lengths, field.trans)
            good = (lengths - 1) * field.trans[0, 0] - z  # log probability that all lines are good
            factor = np.where(label == 1, 1.0, -np.exp(good) / np.maximum(-np.expm1(np.minimum(good, -1e-9)), 1e-9))
            factor = np.clip(factor, -50, 1) * share[groups[g]]
            per_line = -(factor[doc] * bad[doc, pos])
            for at, rows_in, b in ((0, slice(None), bins), (N_BINS, later, bins[earlier]), (2 * N_BINS, earlier, bins[later])):
                grad[:-4] += np.bincount((at + b).ravel(), np.repeat(per_line[rows_in], bins.shape[1]), len(theta) - 4)
            grad[-5] += per_line.sum()
            moved = -moves
            moved[:, 0, 0] += lengths - 1
            grad[-4:] += (factor[:, None, None] * moved).sum(axis=0).ravel()
        grad -= DECAY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    field = Field(theta[:-4].copy(), theta[-4:].reshape(2, 2).copy(), np.zeros(3))
    x = np.stack([_curve_inputs(field.quality(b, s)) for b, s, _ in docs])
    w = np.zeros(3)
    for _ in range(50):  # Newton steps with a small ridge
        p = _sigmoid(x @ w)
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3), x.T @ (y - p) - 1e-2 * w)
    field.curve = w
    return field


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def fit_field(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Field:
    """Fit on at most ``sample`` labelled documents of each label outside the held-out fold."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y"))
    known = known.where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & (fold(F.col("_id")) != 0))
    known = known.groupBy("_id").agg(F.min("_y").alias("_y")).withColumn("_order", F.xxhash64("_id"))
    few = [known.where(F.col("_y") == y).orderBy("_order", "_id").limit(sample) for y in (0, 1)]
    chosen = F.broadcast(few[0].unionByName(few[1]))  # 2 * sample rows at most
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_t"))
    rows = texts.join(chosen, "_id").where(F.octet_length("_t") <= SAMPLE_BYTES)
    got = sorted(rows.groupBy("_id", "_y").agg(F.min("_t").alias("_t")).collect())
    return fit([r["_t"] for r in got], [r["_y"] for r in got])


def quality_scores(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2)
            score = pa.array((field.score(texts[i].as_py() or "") for i in range(b.num_rows)), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), score], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col), (fold(F.col(id_col)) == 0).alias("held_out"), F.col(text_col))
    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double").withColumn("predicted", (F.col("score") >= cutoff).cast("int"))
