"""Harmonic packing of token sequences (operator 5).

A length l belongs to class k = capacity div l: k pieces of the class always fit in one
sequence. Full sequences of a class hold exactly k pieces, so workers fill them without
knowing of each other. Documents may be cut freely, and the cut is what keeps the padding low:
a rest that would waste over ``TOLERANCE`` of its class's sequences gives off a piece of exactly
capacity div (k + 1) tokens, at most ``MAX_CUTS`` times. What does not fill a sequence of its
class (under k pieces for each class and salt) is packed first-fit decreasing over all classes.

Token ids are made, cut and checksummed where the text is read; only the piece table moves.

Defined cases: a null text is empty and still has its end token; repeated documents give their
pieces each; a null id is kept; texts are encoded whole, however long; columns of any other name are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

CAPACITY = 4096
END_ID = 2
TOLERANCE = 1 / 32
MAX_CUTS = 2
#: Pieces of a class for each salt; a class is filled by as many tasks as it has salts.
PIECES_PER_SALT = 32_768
#: Words, and parts of words, whose ids a worker remembers.
REMEMBERED = 500_000


def cut_lengths(n: int, capacity: int = CAPACITY, tolerance: float = TOLERANCE, max_cuts: int = MAX_CUTS) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens, in order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    for _ in range(max_cuts):
        if not rest or capacity - rest * (capacity // rest) <= tolerance * capacity:
            break
        out.append(capacity // (capacity // rest + 1))
        rest -= out[-1]
    return out + [rest] * bool(rest)


#: The tokenizer's own way to split lower-cased text, spelt out for Latin-1.
_LETTER, _NUMBER, _SPACE = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", " \t\n\x0b\x0c\r\xa0"
_PART = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
#: Texts with these go through the library whole: other scripts, controls, special tokens.
_ODD = re.compile("[^\t-\r\x20-\x7e\xa0-\xff]|<\\|")
_TRIAL = "It's 12 \xc9t\xe9s_x!!  don't\n\xbd ***the.,\t<a> \xb5\xb2 I'LL"


class _Parts(dict):
    """Ids of a part of a word, from the tokenizer's model."""

    def __init__(self, tok):
        super().__init__()
        self.tokenize = tok.model.tokenize
        spell = tok.pre_tokenizer.pre_tokenize_str
        #: The model reads bytes as characters of its own; blanks are in no part.
        self.spelling = {i: "".join(x for x, _ in spell(chr(i))) for i in range(128, 256) if i not in (0x85, 0xA0)}

    def __missing__(self, part: str) -> bytes:
        spelt = part if part.isascii() else part.translate(self.spelling)
        out = self[part] = np.array([t.id for t in self.tokenize(spelt)], "<u4").tobytes()
        return out


class _Words(dict):
    """Ids of a word: those of its parts in order."""

    def __init__(self, parts: _Parts):
        super().__init__()
        self.part = parts.__getitem__

    def __missing__(self, word: str) -> bytes:
        out = self[word] = b"".join(map(self.part, _PART.findall(word)))
        return out


class PartIds:
    """Ids of texts from a tokenizer that lower-cases and splits its input before merging, so that
    the ids of a part don't depend on its neighbours: a worker remembers those of recent parts.

    Only for tokenizers that mark the end of a part in its last token and pass a trial, and only for
    texts in which splitting is plain (Latin-1 without special tokens or controls); all
    others go whole through the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.by_part = any(t.endswith("</w>") for t in self.tok.get_vocab(with_added_tokens=True))
        if self.by_part:
            self.parts = _Parts(self.tok)
            self.words = _Words(self.parts)
            self.by_part = next(self([_TRIAL])) == self._whole(_TRIAL)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for t in texts:
            if not self.by_part or _ODD.search(t):
                yield self._whole(t)
                continue
            yield b"".join(map(self.words.__getitem__, t.lower().split()))
            for d in (self.parts, self.words):
                if len(d) > REMEMBERED:
                    d.clear()


@cache
def part_ids(path: str) -> PartIds:
    """One for each worker process, kept between its tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return PartIds(path)


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``) for each piece."""
    end = np.array([end_id], "<u4").tobytes()
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = part_ids(tokenizer_path)
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                texts = [t or "" for t in part.column(1).to_pylist()]
                row, start, length, crc, total, ids = [], [], [], [], [], []
                for r, raw in enumerate(encode(texts)):
                    raw += end
                    n, at = len(raw) // 4, 0
                    for k in cut_lengths(n, capacity):
                        chunk = raw[4 * at:4 * (at + k)]
                        row.append(r)
                        start.append(at)
                        length.append(k)
                        crc.append(zlib.crc32(chunk))
                        total.append(n)
                        if with_ids:
                            ids.append(np.frombuffer(chunk, "<u4").astype(np.int32))
                        at += k
                out = [part.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                yield pa.RecordBatch.from_arrays(out + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names)

    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _first_fit(capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Leftovers of one salt: at most k - 1 pieces of each class, so of bounded size."""
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        free = np.empty(len(rows), np.int64)
        used, low = 0, 0
        seq, off = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        for i, n in enumerate(rows["length"].to_numpy()):
            while low < used and free[low] == 0:
                low += 1
            fits = np.flatnonzero(free[low:used] >= n)
            if len(fits):
                j = low + fits[0]
            else:
                j, free[used] = used, capacity
                used += 1
            seq[i], off[i] = j, capacity - free[j]
            free[j] -= n
        return rows.drop(columns=["salt", "class"]).assign(sequence_id=(1 << 60) + (int(key[0]) << 24) + seq, offset=off)

    return run


def pack(piece_table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a piece table. Reads it twice: pass a written one."""
    cols = piece_table.columns
    by_class = piece_table.withColumn("class", F.floor(F.lit(capacity) / F.col("length")).cast("int"))
    sizes = by_class.groupBy("class").agg(F.count("*").alias("n")).select("class", F.ceil(F.col("n") / PIECES_PER_SALT).cast("int").alias("salts"))
    salted = by_class.join(F.broadcast(sizes), "class").withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("salts")).cast("int"))
    group = Window.partitionBy("class", "salt")
    salted = (
        salted.withColumn("nth", F.row_number().over(group.orderBy("doc_id", "start", "ids_crc32")) - 1)
        .withColumn("in_group", F.count("*").over(group))
        .withColumn("bin", F.floor(F.col("nth") / F.col("class")))
        .withColumn("full", F.col("bin") < F.floor(F.col("in_group") / F.col("class")))
    )
    within = Window.partitionBy("class", "salt", "bin").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = salted.where("full").select(
        *cols, (F.col("class").cast("long") * (1 << 44) + F.col("salt").cast("long") * (1 << 20) + F.col("bin")).alias("sequence_id"),
        (F.sum("length").over(within) - F.col("length")).alias("offset"))
    rest = salted.where("not full").select(*cols, "class", "salt")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in piece_table.schema) + ", sequence_id long, offset long"
    return full.unionByName(rest.groupBy("salt").applyInPandas(_first_fit(capacity), schema))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenize, cut and pack ``docs``: one row for each piece."""
    return pack(durable(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id), "pack-pieces"), capacity)
