"""Log-bilinear language model trained by noise-contrastive estimation (operator 10).

Tokens are lower-cased words and one end per text. Counts of all training tokens are gathered once
(``word, n``). The model predicts classes, whose number K grows with the corpus: six for each square
root of the words seen ``OWN`` times or more. Half of them are the most frequent tokens themselves, the
others the heaviest endings of three bytes of all other words (and one class for the rest). With
d-vectors A of the class one before, B of the token two before (one of ``COARSE`` frequent ones, or any
other) and R of the class itself,

    P(class | before) = softmax(R . (A[c1] + B[c2]) + b),   P(word | class) = (n + 0.1) / mass(class)

where mass sums n + 0.1 over the words of the class and one unseen word, so the token probabilities
are normalised. Every training token is an example in each of ``ROUNDS`` passes or more: a task counts the
triples of its texts, ``CHUNK`` tokens at a time, and runs minibatches of noise-contrastive estimation in
numpy over all of them, weighted by their counts; the tasks' parameters are averaged by a shuffle of
their blocks. The log normalisers of all contexts come from batched matrix products, a task for each c2;
scoring a token is a look-up.

Counts of at most ``HEAD`` frequent words travel to the tasks (a bounded table); rarer words are
joined with the full counts by a shuffle on the word, so any vocabulary works.

Defined cases: a null text is empty (its end token is scored); a null id counts as held out; repeated
rows are scored each; texts are read whole, however long; with no training tokens the counts are zero and
base and model agree; columns of any other name are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

FOLDS = 10
SMOOTH = 0.1
#: A word of so many occurrences counts towards the number of classes.
OWN = 8
COARSE = 128
HEAD = 200_000
DIM, NOISE, RATE = 24, 48, 0.3
#: Tokens whose triples a task holds, and examples of a minibatch (fewer in a corpus of under two million tokens).
CHUNK, BATCH = 1_000_000, 1000
#: Passes over all training tokens, and tokens of a corpus below which there are more (up to five times as many).
ROUNDS, ENOUGH = 2, 10_000_000
#: Parameters of a block that is averaged as one row.
BLOCK = 65_536
#: Tokens that a task reads for each parameter at least.
COPY_SHARE = 4
#: The end token; no word can hold a line feed.
END = b"\n"
#: Distinct words that a task holds before it passes their counts on.
HELD = 200_000


def tokens(text: str | None) -> list[bytes]:
    out = (text or "").encode().lower().split()
    out.append(END)
    return out


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def word_counts(train: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n`` over all tokens of ``train``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            words = list(held)
            for lo in range(0, len(words), 50_000):
                part = words[lo:lo + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([held[w] for w in part], pa.int64())], ["word", "n"])
            held.clear()

        for b in batches:
            for t in b.column(0):
                held.update(tokens(t.as_py()))
                if len(held) > HELD:
                    yield from out()
        yield from out()

    return train.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Classes:
    """Class of each token, and what a token adds within its class."""

    k: int
    total: int
    distinct: int
    suffix_class: dict[bytes, int]
    mass: np.ndarray
    head: dict[bytes, int]
    head_n: np.ndarray
    head_class: np.ndarray

    @property
    def base_mass(self) -> float:
        return self.total + SMOOTH * (self.distinct + 1)


def frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words above the lowest count that at most ``most`` words reach, and the end token; by
    falling count. No task sends more than it has of these, so the driver gets ``most`` rows in all."""
    # Counts up to 1,024 stand for themselves, larger ones for a sixteenth of a power of two.
    step = F.when(F.col("n") < 1024, F.col("n")).otherwise(1024 + F.floor(16 * F.log2(F.col("n") / 1024))).cast("long")
    lowest, reach = None, 0
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # under 1,900 rows
        reach += r["count"]
        if reach > most:
            break
        lowest = r.step
    chosen = F.col("word") == F.lit(bytearray(END))
    found = counts.where(chosen if lowest is None else chosen | (step >= lowest)).collect()
    return sorted(((bytes(r.word), r.n) for r in found), key=lambda x: (-x[1], x[0]))


def gather_classes(counts: DataFrame) -> Classes:
    """Classes and the bounded tables that tasks get, from the written counts of all words."""
    top = frequent(counts, HEAD)
    total, distinct, own = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count(F.when(F.col("n") >= OWN, 1))).first()
    k = 128 + 6 * math.isqrt(own)
    singles = [END] + [w for w, _ in top if w != END][:k // 2 - 1]
    word_class = {w: i for i, w in enumerate(singles)}
    alone = counts.sparkSession.createDataFrame([(bytearray(w),) for w in singles], "word binary")
    rest = counts.join(F.broadcast(alone), "word", "left_anti")  # k / 2 rows
    ending = F.when(F.length("word") > 3, F.expr("substring(word, -3)")).otherwise(F.col("word")).alias("ending")
    endings = durable(rest.groupBy(ending).agg(F.sum("n").alias("n"), F.count("*").alias("types")), "lm-endings")
    best = endings.orderBy(F.desc("n"), "ending").limit(k - len(singles) - 1).collect()
    suffix_class = {bytes(r.ending): len(singles) + i for i, r in enumerate(best)}
    known = dict(top)
    mass = np.full(k, SMOOTH)
    for w, c in word_class.items():
        mass[c] = known.get(w, 0) + SMOOTH  # the only word of its class
    for r in best:
        mass[suffix_class[bytes(r.ending)]] += r.n + SMOOTH * r.types
    n_rest, types_rest = endings.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    mass[k - 1] += n_rest - sum(r.n for r in best) + SMOOTH * (types_rest - sum(r.types for r in best))
    classes = np.array([c if (c := word_class.get(w)) is not None else suffix_class.get(w[-3:], k - 1) for w, _ in top] + [0], np.int64)
    return Classes(k, int(total), int(distinct), suffix_class, mass, {w: i for i, (w, _) in enumerate(top)}, np.array([n for _, n in top], float), classes)


class _Codes(dict):
    """Code of a token: its place among the frequent ones, or -1 less the class of a rare one."""

    def __init__(self, c: Classes):
        super().__init__(c.head)
        self.suffix_class, self.rest = c.suffix_class, c.k - 1
        if END not in self:  # nothing to learn from: the end has a class of its own all the same
            self[END] = -1

    def __missing__(self, word: bytes) -> int:
        return -1 - self.suffix_class.get(word[-3:], self.rest)


def encode_corpus(docs: DataFrame, classes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts as codes, ``doc_id, held_out, uid, codes, rare`` (rare words with their counts); written
    once, read for training and for scoring. ``classes`` is broadcast."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes(classes.value)
        uid = TaskContext.get().partitionId() << 33
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part, got, rare = b.slice(lo, 512), [], []
                for t in part.column(2):
                    w = tokens(t.as_py())
                    c = np.fromiter(map(codes.__getitem__, w), np.int32, len(w))
                    got.append(c)
                    rare.append(list(Counter([w[i] for i in np.flatnonzero(c < 0)]).items()))
                ends = np.cumsum([0, *map(len, got)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(got)))
                ids = pa.array(np.arange(uid, uid + part.num_rows))
                uid += part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids, lists, pa.array(rare, pa.map_(pa.binary(), pa.int64()))], ["doc_id", "held_out", "uid", "codes", "rare"])

    rows = docs.select(F.col(id_col), (fold(F.col(id_col)) == 0), F.col(text_col))
    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, uid long, codes array<int>, rare map<binary,bigint>")


def classes_of(codes: np.ndarray, c: Classes) -> np.ndarray:
    return np.where(codes >= 0, c.head_class[np.maximum(codes, -1)], -1 - codes)


def flat_codes(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All codes of a column, and where each text starts; no text is empty."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), (offsets[:-1] - offsets[0]).astype(np.int64)


def contexts(cls: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Class one token before each token, and the coarse one two before; k and ``COARSE`` before a text."""
    one, two = np.roll(cls, 1), np.minimum(np.roll(cls, 2), COARSE - 1)
    one[starts] = k
    two[starts] = COARSE
    two[starts[starts + 1 < len(cls)] + 1] = COARSE
    return one, two


@dataclass
class Model:
    """A: (k + 1, d); B: (COARSE + 1, d); R: (k, d); b: (k); log_z: (COARSE + 1, k + 1)."""

    a: np.ndarray
    b: np.ndarray
    r: np.ndarray
    bias: np.ndarray
    log_z: np.ndarray | None = None

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.a, self.b, self.r, self.bias)])

    def like(self, flat: np.ndarray) -> Model:
        parts = np.split(flat, np.cumsum([self.a.size, self.b.size, self.r.size]))
        return Model(*(x.reshape(y.shape) for x, y in zip(parts, (self.a, self.b, self.r, self.bias), strict=True)))

    def log_z_of(self, two: int) -> np.ndarray:
        """Log normalisers of all contexts with ``two``, by batched matrix products."""
        z = np.empty(len(self.a), np.float32)
        for lo in range(0, len(z), 1024):
            s = (self.a[lo:lo + 1024] + self.b[two]) @ self.r.T + self.bias
            m = s.max(axis=1)
            z[lo:lo + 1024] = m + np.log(np.exp(s - m[:, None]).sum(axis=1))
        return z

    def log_prob(self, cls: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural log of P(class | before) for each token of texts that begin at ``starts``."""
        one, two = contexts(cls, starts, len(self.r))
        return np.einsum("ij,ij->i", self.a[one] + self.b[two], self.r[cls]) + self.bias[cls] - self.log_z[two, one]


def initial(mass: np.ndarray, seed: int = 10) -> Model:
    rng = np.random.default_rng(seed)
    small = lambda n: rng.normal(0, 0.1, (n, DIM)).astype(np.float32)
    return Model(small(len(mass) + 1), small(COARSE + 1), small(len(mass)), np.log(mass / mass.sum()).astype(np.float32))


class Trainer:
    """Minibatch noise-contrastive estimation with AdaGrad, from a copy of a model."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int, batch: int = BATCH):
        self.batch = batch
        self.p = [model.a.copy(), model.b.copy(), model.r.copy(), model.bias.copy()]
        self.sums = [np.full_like(x, 1e-2) for x in self.p]
        self.k, self.noise_upto, self.log_kq = len(noise), np.cumsum(noise), np.log(NOISE * noise).astype(np.float32)
        self.rng = np.random.default_rng(seed)

    def move(self, which: int, rows: np.ndarray, grad: np.ndarray) -> None:
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        g, rows = np.add.reduceat(grad[order], first, axis=0), rows[first]
        self.sums[which][rows] += g * g
        self.p[which][rows] += RATE * g / np.sqrt(self.sums[which][rows])

    def step(self, one: np.ndarray, two: np.ndarray, t: np.ndarray, weight: np.ndarray) -> None:
        a, b, r, bias = self.p
        s = np.minimum(np.searchsorted(self.noise_upto, self.rng.random(NOISE) * self.noise_upto[-1], side="right"), self.k - 1)
        h, rt, rs = a[one] + b[two], r[t], r[s]
        true = np.einsum("ij,ij->i", h, rt) + bias[t] - self.log_kq[t]
        false = h @ rs.T + bias[s] - self.log_kq[s]
        gt = weight / (1 + np.exp(np.clip(true, -30, 30)))  # 1 - P(data | true word)
        gf = -weight[:, None] / (1 + np.exp(-np.clip(false, -30, 30)))
        gh = gt[:, None] * rt + gf @ rs
        self.move(0, one, gh)
        self.move(1, two, gh)
        self.move(2, np.r_[t, s], np.concatenate([gt[:, None] * h, gf.T @ h]))
        self.move(3, np.r_[t, s], np.r_[gt, gf.sum(axis=0)])

    def learn(self, one: np.ndarray, two: np.ndarray, cls: np.ndarray) -> None:
        """All given tokens, equal triples as one example of their weight, in random order. Weights are shares of what a
        minibatch weighs on average, so one that holds a frequent triple does not mute its others."""
        cells, n = np.unique((two.astype(np.int64) * (self.k + 1) + one) * self.k + cls, return_counts=True)
        order, whole = self.rng.permutation(len(cells)), n.mean() * self.batch
        for lo in range(0, len(cells), self.batch):
            at = order[lo:lo + self.batch]
            c, w = cells[at], (n[at] / whole).astype(np.float32)
            before = c // self.k
            self.step(before % (self.k + 1), before // (self.k + 1), c % self.k, w)


def train_model(encoded: DataFrame, classes: Classes, sent_classes) -> Model:
    """``ROUNDS`` passes or more over all training texts; tasks are those that read the table, but fewer
    where a task would have under twice ``CHUNK`` tokens or under ``COPY_SHARE`` for each parameter, of which it sends a copy in each
    round. Copies are averaged in two levels."""
    sc = encoded.sparkSession.sparkContext
    model, noise = initial(classes.mass), (classes.mass / classes.mass.sum())
    batch = max(64, min(BATCH, classes.total // 1500))
    share = max(2 * CHUNK, COPY_SHARE * len(model.flat()))
    texts = encoded.where("not held_out").select("codes").coalesce(max(1, math.ceil(classes.total / share)))
    group = math.ceil(math.sqrt(texts.rdd.getNumPartitions()))
    for nth in range(ROUNDS + min(4 * ROUNDS, ENOUGH // max(1, classes.total))):
        sent = sc.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, nth=nth) -> Iterator[pa.RecordBatch]:
            c, held, seen, total = sent_classes.value, [], 0, 0
            trainer = Trainer(sent.value, noise, 1000 * nth + TaskContext.get().partitionId(), batch)

            def learn() -> None:
                if held:
                    trainer.learn(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held.clear()

            for b in batches:
                for lo in range(0, b.num_rows, 256):
                    codes, starts = flat_codes(b.column(0).slice(lo, 256))
                    if not len(codes):
                        continue
                    cls = classes_of(codes, c)
                    held.append([x.astype(np.int32) for x in (*contexts(cls, starts, c.k), cls)])
                    seen, total = seen + len(cls), total + len(cls)
                    if seen >= CHUNK:
                        learn()
                        seen = 0
            learn()
            if total:
                flat = Model(*trainer.p).flat()
                parts = [flat[lo:lo + BLOCK].tobytes() for lo in range(0, len(flat), BLOCK)]
                salt = TaskContext.get().partitionId() // group
                yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([salt] * len(parts), pa.int32()), pa.array([total] * len(parts), pa.int64()), pa.array(parts, pa.binary())], names)

        def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], list] = {}
            for b in batches:
                for block, salt, n, part in zip(*(x.to_pylist() for x in b.columns), strict=True):
                    own = sums.setdefault((block, salt), [0, 0.0])
                    own[0] += n
                    own[1] = own[1] + n * np.frombuffer(part, np.float32).astype(np.float64)
            for (block, salt), (n, x) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([salt], pa.int32()), pa.array([n]), pa.array([(x / n).astype(np.float32).tobytes()], pa.binary())], names)

        # in two levels: a task meets the copies of a block from one group of tasks, then one mean of each group
        names, form = ["block", "salt", "n", "part"], "block int, salt int, n long, part binary"
        of_groups = texts.mapInArrow(run, form).repartition("block", "salt").mapInArrow(mean, form)
        whole = of_groups.select("block", F.lit(0).alias("salt"), "n", "part").repartition("block").mapInArrow(mean, form)
        got = sorted((r.block, r.part) for r in whole.collect())
        if got:
            model = model.like(np.concatenate([np.frombuffer(p, np.float32) for _, p in got]))
        sent.unpersist()

    sent = sc.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for two in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([two]), pa.array([sent.value.log_z_of(two).tobytes()], pa.binary())], ["two", "z"])

    z = sorted((r.two, r.z) for r in encoded.sparkSession.range(COARSE + 1).mapInArrow(rows, "two long, z binary").collect())
    model.log_z = np.stack([np.frombuffer(x, np.float32) for _, x in z])
    return model


def score_texts(encoded: DataFrame, counts: DataFrame, classes: Classes, model: Model) -> DataFrame:
    """One row for each text of :func:`encode_corpus`, as described in :func:`language_scores`."""
    sent = encoded.sparkSession.sparkContext.broadcast((classes, model))
    names = ["uid", "n_tokens", "n_head", "head_base", "head_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, m = sent.value
        log_base = np.r_[np.log10((c.head_n + SMOOTH) / c.base_mass), 0.0]
        shift = np.log10(c.base_mass / c.mass)  # from the base to within a class
        for b in batches:
            for lo in range(0, b.num_rows, 128):
                codes, starts = flat_codes(b.column(1).slice(lo, 128))
                known, cls = codes >= 0, classes_of(codes, c)
                base = np.where(known, log_base[np.maximum(codes, -1)], 0.0)
                score = base + m.log_prob(cls, starts) / math.log(10) + shift[cls]
                sums = [np.add.reduceat(x, starts) for x in (known.astype(np.int64), base, score)]
                sizes = np.diff(np.r_[starts, len(codes)])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, 128), *map(pa.array, (sizes, *sums))], names)

    done = encoded.select("uid", "codes").mapInArrow(run, "uid long, n_tokens long, n_head long, head_base double, head_score double")
    rare = encoded.where(F.size("rare") > 0).select("uid", F.explode("rare").alias("word", "times"))
    found = rare.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    log_p = F.log10((F.col("n") + SMOOTH) / F.lit(classes.base_mass))
    sums = found.groupBy("uid").agg(F.sum(F.col("times") * log_p).alias("rare_base"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    return encoded.select("uid", "doc_id", "held_out").join(done, "uid").join(sums, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(classes.total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("head_score") + F.coalesce("rare_base", F.lit(0.0))).alias("score"))


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every document:
    log10 probabilities by the smoothed unigrams and by the model, both learnt from the other folds."""
    train = docs.where(fold(F.col(id_col)) != 0)
    counts = durable(word_counts(train, text_col), "lm-counts")
    classes = gather_classes(counts)
    sent = docs.sparkSession.sparkContext.broadcast(classes)
    encoded = durable(encode_corpus(docs, sent, id_col, text_col), "lm-corpus")
    return score_texts(encoded, counts, classes, train_model(encoded, classes, sent))
