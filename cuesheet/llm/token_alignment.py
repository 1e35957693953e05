"""Alignment of two tokenizers by a dictionary of groups (operator 11).

The byte offsets at which tokens of both tokenizers end cut a text into groups of A-ids over B-ids. Distinct
groups are interned: most are one A-id over one B-id, whose key is the two ids; the others' key is a 64-bit hash of
their ids, which the dictionary proves free of collisions (else another seed is taken). Where the text is
read a document becomes its distinct groups with their frequencies, and a task counts the documents
of each group before anything moves. The links of a group, the A-B pairs whose bytes overlap, are
expanded once for each distinct group:

* the documents of an id pair are the documents of the groups that hold it, less those in which the pair had
  been met in another group already, which the task counts as well;
* a group's sums over its links are joined back by its key and multiplied by its frequency in each document.

Very common groups and pairs are broadcast, at most 10,000 of them by the sum of their weights; the others are
joined by shuffle. Highest counts are one number for each A-id, bounded by the vocabulary.

Texts are encoded without special tokens (their strings are plain text), whole by their segments: neither
tokenizer can have a token across a single blank between two other characters, as the first splits
its input before such a blank and the second has no piece with a blank after something else (checked on the
vocabularies; else a text is one segment). A worker remembers recent segments with their groups, and encodes the
new ones of many texts in one call. A test holds this against whole encodings.

Defined cases: a text that is null or empty, or whose joined bytes by A or B differ from the text with a
blank in front, has no tokens: zeros, and '' as checksum; repeated rows and ids count as documents of their
own; columns of any other name are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain, count
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, looked_up, text_or_empty

#: Characters after which a text is cut at the next place that allows it.
PART = 65_536
#: Distinct groups that a task counts, and groups and segments that a worker remembers, at once.
HELD = 300_000
#: Characters looked at in one call, and of a segment that is remembered.
BATCH, SHORT = 262_144, 64
#: Texts between two looks at what is held.
ROWS = 256

_CUT = re.compile(r"(?<=\S) (?=\S)")
_BITS = 16


def _byte_characters() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + n)] = b
    return out


class Aligner:
    """Both tokenizers, the bytes of their entries and the groups of a text; one for each worker process."""

    def __init__(self, path_a: str, path_b: str, seed: int = 0):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto
        from tokenizers import Tokenizer

        self.a, self.b, self.seed = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b), seed
        self.a.encode_special_tokens = True
        spelt = _byte_characters()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(spelt[c] for c in names[i]) if i in names and all(c in spelt for c in names[i]) else b"" for i in range(max(names) + 1)]
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.vocab_size())]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << _BITS:
            raise ValueError("vocabularies of at most 65,536 ids")
        self.size_a, self.size_b = (np.array(list(map(len, v))) for v in (self.bytes_a, self.bytes_b))
        self.text_a = np.array([f"{i}{s}" for s in ",|" for i in range(len(self.bytes_a))], object)
        self.text_b = np.array([f"{i}{s}" for s in ",;" for i in range(len(self.bytes_b))], object)
        self.in_parts = self._in_parts(path_a, path_b, proto)
        self.groups: dict[int, tuple] = {}
        self.keys: dict[tuple[bytes, bytes], int] = {}
        self.clashes: list[tuple[int, bytes, bytes]] = []
        self.segments: dict[str, tuple | None] = {}

    def _in_parts(self, path_a: str, path_b: str, proto) -> bool:
        """Whether both tokenizers surely have a boundary before a single blank, whatever stands around."""
        with open(path_a, encoding="utf-8") as f:
            d = json.load(f)
        m = proto.ModelProto()
        with open(path_b, "rb") as f:
            m.ParseFromString(f.read())
        n, pre = m.normalizer_spec, d["pre_tokenizer"]
        inside = any("▁" in p.piece.lstrip("▁") for p in m.pieces if p.type in (1, 4))
        return (pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not d["normalizer"] and m.trainer_spec.model_type == 2 and not inside
                and not n.precompiled_charsmap and n.add_dummy_prefix and n.escape_whitespaces and not n.remove_extra_whitespaces and not m.trainer_spec.treat_whitespace_as_suffix)

    def parts(self, text: str) -> list[str]:
        """The text cut at blanks, which the tokenizers' own prefix puts back."""
        out, lo = [], 0
        while self.in_parts and len(text) - lo > PART and (m := _CUT.search(text, lo + PART)):
            out.append(text[lo:m.start()])
            lo = m.end()
        return [*out, text[lo:]]

    def links(self, a: bytes, b: bytes) -> list[int]:
        """Codes of the pairs of a group's tokens that overlap."""
        a, b, out, i, j = np.frombuffer(a, "<u4").tolist(), np.frombuffer(b, "<u4").tolist(), [], 0, 0
        end_a, end_b = len(self.bytes_a[a[0]]), len(self.bytes_b[b[0]])
        while True:
            out.append(a[i] << _BITS | b[j])
            step_a, step_b = end_a <= end_b, end_b <= end_a
            if step_a:
                i += 1
            if step_b:
                j += 1
            if i == len(a) or j == len(b):
                return out
            end_a += len(self.bytes_a[a[i]]) * step_a
            end_b += len(self.bytes_b[b[j]]) * step_b

    def interned(self, a: bytes, b: bytes) -> int:
        """The key of a group of several tokens; its distinct pairs, the number of its links and its ids are in ``self.groups``."""
        code = self.keys.get((a, b))
        if code is None:
            links = self.links(a, b)
            code = self.keys[a, b] = -1 - (xxhash.xxh64_intdigest(len(a).to_bytes(8, "little") + a + b, self.seed) >> 1)
            if code in self.groups:
                self.clashes.append((code, a, b))
            self.groups[code] = tuple(dict.fromkeys(links)), len(links), a, b
        return code

    def forget(self) -> None:
        """Drop what is remembered, if it is much."""
        if len(self.segments) > HELD or len(self.groups) > HELD:
            self.segments.clear()
            self.groups.clear()
            self.keys.clear()

    def segmented(self, parts: Iterable[str]) -> Iterator[list[tuple | None]]:
        """The entries of each part's segments, in order."""
        waiting, size = [], 0
        for p in parts:
            waiting.append(_CUT.split(p) if self.in_parts else [p])
            size += len(p)
            if size >= BATCH:
                yield from self._entries(waiting)
                waiting, size = [], 0
        yield from self._entries(waiting)

    def _entries(self, lists: list[list[str]]) -> Iterator[list[tuple | None]]:
        missing = list({s for x in lists for s in x}.difference(self.segments))
        if missing:
            ids_a = [e.ids for e in self.a.encode_batch_fast([" " + s for s in missing], add_special_tokens=False)]
            ids_b = self.b.encode(missing, num_threads=1)
            good = [n for n, (s, a, b) in enumerate(zip(missing, ids_a, ids_b, strict=True)) if self._spelt(s, a, b)]
            self.segments.update(dict.fromkeys(missing))
            self.segments.update(zip((missing[n] for n in good), self.entries([ids_a[n] for n in good], [ids_b[n] for n in good])))
        for x in lists:
            yield list(map(self.segments.__getitem__, x))
        for s in missing:
            if len(s) > SHORT:
                del self.segments[s]

    def _spelt(self, text: str, ids_a: list[int], ids_b: list[int]) -> bool:
        """Whether the bytes of both are those of the text with a blank in front."""
        want = (" " + text).encode()
        return b"".join([self.bytes_a[i] for i in ids_a]) == want == b"".join([self.bytes_b[i] for i in ids_b])

    def entries(self, ids_a: list[list[int]], ids_b: list[list[int]]) -> list[tuple]:
        """Of each segment, many at a time: numbers of A-tokens, B-tokens and links, ``a1,a2|b1;a3|b2,b3;``, and the keys of its groups."""
        if not ids_a:
            return []
        len_a, len_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (ids_a, ids_b))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, n.sum()) for x, n in ((ids_a, len_a), (ids_b, len_b)))
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at = np.searchsorted(end_b, end_a)
        last = np.flatnonzero(end_b[at] == end_a)  # segments end with a group, so no group spans two
        to_a, to_b = last + 1, at[last] + 1
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        codes, links = a[last] << _BITS | b[to_b - 1], np.ones(len(last), np.int64)
        more = np.flatnonzero((n_a > 1) | (n_b > 1))
        raw_a, raw_b = a.astype("<u4").tobytes(), b.astype("<u4").tobytes()
        own = [self.interned(raw_a[i:k], raw_b[m:n]) for i, k, m, n in zip(*((4 * x[more]).tolist() for x in (to_a - n_a, to_a, to_b - n_b, to_b)), strict=True)]
        codes[more], links[more] = own, [self.groups[c][1] for c in own]
        # the ids in order, those of A before those of B in each group, each with the sign that follows it
        shown = np.empty(len(a) + len(b), object)
        sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        sign_a[to_a - 1], sign_b[to_b - 1] = len(self.size_a), len(self.size_b)
        shown[np.arange(len(a)) + np.repeat(to_b - n_b, n_a)] = self.text_a[a + sign_a]
        shown[np.arange(len(b)) + np.repeat(to_a, n_b)] = self.text_b[b + sign_b]
        shown, keys = shown.tolist(), codes.tolist()
        at_token, at_group = np.cumsum(len_a + len_b).tolist(), np.searchsorted(to_a, np.cumsum(len_a), "right").tolist()
        n_links = np.diff(np.cumsum(links)[np.array(at_group) - 1], prepend=0).tolist()
        return [(x, y, n, "".join(shown[t:u]), tuple(keys[g:h])) for x, y, n, t, u, g, h in zip(len_a.tolist(), len_b.tolist(), n_links, [0, *at_token], at_token, [0, *at_group], at_group)]


@cache
def aligner(path_a: str, path_b: str, seed: int) -> Aligner:
    return Aligner(path_a, path_b, seed)


_N_A, _N_B, _LINKS, _LISTED, _GROUPS = map(itemgetter, range(5))


class _Document:
    """Sums and distinct groups of a text, part by part."""

    def __init__(self):
        self.sha = hashlib.sha256()
        self.groups: Counter = Counter()
        self.n_a = self.n_b = self.n_links = 0
        self.good = True

    def add(self, entries: list[tuple | None]) -> None:
        if not self.good or None in entries:
            self.good = False
            return
        self.sha.update((";" * bool(self.groups) + "".join(map(_LISTED, entries))[:-1]).encode())
        self.groups.update(chain.from_iterable(map(_GROUPS, entries)))
        self.n_a, self.n_b, self.n_links = self.n_a + sum(map(_N_A, entries)), self.n_b + sum(map(_N_B, entries)), self.n_links + sum(map(_LINKS, entries))


_NAMES = ["nth", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "times", "kind", "code", "a", "b", "n"]


def coded(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, seed: int = 0) -> DataFrame:
    """Three kinds of rows, where the texts are read: ``doc``, each document with its distinct groups (``groups``) and their
    frequencies (``times``); ``group``, a group's ids and how many documents hold it (``n``); ``again``, a pair and in
    how many documents, counted once for each further group, it lies in more than one group."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first = aligner(path_a, path_b, seed), TaskContext.get().partitionId() << 33
        held, again, nth = Counter(), Counter(), 0

        def batch(rows: list[tuple], ids: pa.Array) -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [[]] * (len(_NAMES) - 1)
            arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
            return pa.RecordBatch.from_arrays([arrays[0], ids, *arrays[1:]], _NAMES)

        def counted(id_type: pa.DataType) -> pa.RecordBatch:
            none = (None,) * 8
            rows = [(*none, "group", c, *(own.groups[c][2:] if c < 0 else (None, None)), n) for c, n in held.items()] + [(*none, "group", *x, 0) for x in own.clashes] + [(*none, "again", c, None, None, n) for c, n in again.items()]
            held.clear()
            again.clear()
            own.forget()
            return batch(rows, pa.nulls(len(rows), id_type))

        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for lo in range(0, b.num_rows, ROWS):
                rows, parts = [], [own.parts(t) if t else [] for t in texts.slice(lo, ROWS).to_pylist()]
                entries = own.segmented(p for ps in parts for p in ps)
                for ps in parts:
                    d = _Document()
                    for _ in ps:
                        d.add(next(entries))
                    if not ps or not d.good:
                        rows.append((first + nth, 0, 0, 0, 0, "", [], [], "doc", None, None, None, None))
                    else:
                        g = d.groups
                        met = Counter(chain.from_iterable([own.groups[c][0] if c < 0 else (c,) for c in g]))
                        again.update({p: n - 1 for p, n in met.items() if n > 1})
                        held.update(g.keys())
                        rows.append((first + nth, d.n_a, d.n_b, g.total(), d.n_links, d.sha.hexdigest(), list(g), list(g.values()), "doc", None, None, None, None))
                    nth += 1
                next(entries, None)
                yield batch(rows, ids.slice(lo, ROWS))
                if len(held) + len(again) > HELD or len(own.segments) > HELD or len(own.groups) > HELD:
                    yield counted(ids.type)
        if held:
            yield counted(ids.type)

    long, types = pa.int64(), None
    types = [long] * 5 + [pa.string(), pa.list_(long), pa.list_(long), pa.string(), long, pa.binary(), pa.binary(), long]
    rows = docs.select(F.col(id_col), text_or_empty(text_col))
    return rows.mapInArrow(run, f"nth long, doc_id {id_type.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups array<long>, times array<long>, kind string, code long, a binary, b binary, n long")


def expanded(groups: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``code, pair, times, n_docs``: the distinct pairs of each group and how often it links them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b, 0)
        for x in batches:
            rows = [(code, p, times, n) for code, a, b, n in zip(*(c.to_pylist() for c in x.columns), strict=True) for p, times in Counter(own.links(a, b)).items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)], ["code", "pair", "times", "n_docs"])

    several = groups.where("code < 0").select("code", "a", "b", "n_docs").mapInArrow(run, "code long, pair long, times long, n_docs long")
    return groups.where("code >= 0").select("code", F.col("code").alias("pair"), F.lit(1).cast("long").alias("times"), "n_docs").unionByName(several)


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row."""
    for seed in count():
        rows = durable(coded(docs, path_a, path_b, id_col, text_col, seed), "coded")
        groups = durable(rows.where("kind = 'group'").groupBy("code", "a", "b").agg(F.sum("n").alias("n_docs")), "groups")
        if not groups.where("code < 0").groupBy("code").count().where("count > 1").limit(1).count():
            break
    links = durable(expanded(groups, path_a, path_b), "links")
    pairs = pair_counts(links, rows.where("kind = 'again'").groupBy(F.col("code").alias("pair")).agg(F.sum("n").alias("again")))
    priced = looked_up(links, pairs, ["pair"], "n_groups", links.count())
    sums = priced.groupBy("code").agg(F.max("n_docs").alias("n_docs"), F.sum(F.col("times") * F.col("n")).alias("counts"), F.sum(F.col("times") * F.col("is_best").cast("long")).alias("best"))
    sums = durable(sums, "group-sums")
    held = rows.where("kind = 'doc'").select("nth", F.explode(F.arrays_zip("groups", "times")).alias("g")).select("nth", F.col("g.groups").alias("code"), F.col("g.times").alias("times"))
    total = sums.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    of = looked_up(held, sums, ["code"], "n_docs", total).groupBy("nth").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("counts")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.where("kind = 'doc'").join(of, "nth", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


def pair_counts(links: DataFrame, again: DataFrame) -> DataFrame:
    """``pair, n, is_best, n_groups``: in how many documents each pair is linked, and whether that is its A-id's highest number."""
    n = links.groupBy("pair").agg(F.sum("n_docs").alias("n"), F.count("*").alias("n_groups")).join(again, "pair", "left")
    n = durable(n.select("pair", "n_groups", (F.col("n") - F.coalesce("again", F.lit(0))).alias("n")), "pairs")
    a = F.shiftright("pair", _BITS).alias("a")
    highest = F.broadcast(n.groupBy(a).agg(F.max("n").alias("highest")))  # one row for each A-id
    return durable(n.select("*", a).join(highest, "a").select("pair", "n", "n_groups", (F.col("n") == F.col("highest")).alias("is_best")), "pair-counts")
