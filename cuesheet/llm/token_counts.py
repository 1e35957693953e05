"""Exact token counts of whole texts, however long (operator 3).

Huge documents are encoded in overlapping chunks, with the character offsets of their tokens. Two
neighbours are spliced at a token boundary that both encodings have inside their overlap and that
is *proven stable*: no piece of the vocabulary holds those two characters side by side, so no merge
can ever cross it, whatever stands around. A chunk's tokens between its two splices are its share of
the count. Where an overlap has no such boundary it is doubled; where it reaches the splice before,
the chunk itself is.

Texts of at most a chunk and an overlap (33,024 characters) never enter that: they are counted by
their segments between stable boundaries (blank runs and line feeds), whose counts a worker
remembers, if the vocabulary allows it, or else as a whole. Tests hold both ways against each other.

Defined cases: a null text is empty (0 bytes, 0 tokens); every row gives a row, repeated ids and null
ids too; columns of any other name are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a chunk and of the first overlap tried.
CHUNK = 32_768
OVERLAP = 256
LIMIT = 4096
#: Segments whose counts a worker remembers, in each of two generations.
REMEMBERED = 400_000

SPACE = "▁"
_SEGMENT = re.compile(f"\n|[ {SPACE}]*[^\n {SPACE}]+|[ {SPACE}]+")


class PieceCounter:
    """Counts and boundaries by a sentencepiece model; one for each task."""

    def __init__(self, model_path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.chunk, self.overlap = chunk, overlap
        m = proto.ModelProto()
        m.ParseFromString(open(model_path, "rb").read())
        n = m.normalizer_spec
        # whole-text encoding can be cut only if normalizing never looks past a character and merges are all there is
        self.by_parts = m.trainer_spec.model_type == 2 and not n.precompiled_charsmap and n.add_dummy_prefix and n.escape_whitespaces and not n.remove_extra_whitespaces and not m.trainer_spec.treat_whitespace_as_suffix
        plain = [p.piece for p in m.pieces if p.type in (1, 4)]
        self.pairs = {p[i:i + 2] for p in plain for i in range(len(p) - 1)}
        self.stable_segments = self.by_parts and not any(x[1] == SPACE and x[0] != SPACE or "\n" in x for x in self.pairs)
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def stable(self, text: str, at: int) -> bool:
        """No piece holds the characters before and after ``at`` side by side."""
        return (text[at - 1] + text[at]).replace(" ", SPACE) not in self.pairs

    def boundaries(self, text: str, lo: int, hi: int) -> list[int]:
        """Token starts in ``text[lo:hi]`` as encoded on its own, as offsets into ``text``."""
        part = text[lo:hi]
        blank = lo > 0 and part[:1] in (" ", SPACE)
        begins = [x[0] for x in self.sp.encode(part[1:] if blank else part, return_type="offset_mapping")["offsets"]]
        if not blank:
            return [lo + b for b in begins]
        # the added prefix is the blank itself; offsets are of the text without it
        return [lo] + [lo + 1 + b for b in begins[1:]]

    def count_whole(self, text: str) -> int:
        return len(self.sp.encode(text, num_threads=1)) if text else 0

    def count_short(self, text: str) -> int:
        """Tokens of a text by its segments, whose counts are remembered."""
        if not text or not self.stable_segments:
            return self.count_whole(text)
        total, prefixed, get = 0, True, self.new.get
        for s in _SEGMENT.findall(text):
            if prefixed:
                total += self.count_whole(s)
                prefixed = False
                continue
            n = get(s)
            if n is None:
                n = self.old.get(s)
                if n is None:
                    n = self._unprefixed(s)
                self.new[s] = n
                if len(self.new) > REMEMBERED:
                    self.old, self.new = self.new, {}
                    get = self.new.get
            total += n
        return total

    def _unprefixed(self, text: str) -> int:
        """Tokens of ``text`` without the prefix: its first blank serves as prefix, or a line feed does that splits off."""
        if text[0] in (" ", SPACE):
            return self.count_whole(text[1:]) if len(text) > 1 else 1
        return self.count_whole("\n" + text) - self.count_whole("\n")

    def count(self, text: str) -> int:
        if not self.by_parts:
            return self.count_whole(text)
        if len(text) <= self.chunk + self.overlap:
            return self.count_short(text)
        return self.count_spliced(text)

    def count_spliced(self, text: str) -> int:
        """Tokens of a text by overlapping chunks: each is counted from its last splice to the next."""
        end, total, cut, lo, hi = len(text), 0, 0, 0, min(len(text), self.chunk + self.overlap)
        own, width = self.boundaries(text, lo, hi), self.overlap
        while hi < end:
            begin = max(cut, hi - 2 * width)
            until = min(end, hi + self.chunk)
            following, known = self.boundaries(text, begin, until), set(own)
            common = [b for b in following if begin < b < hi and b in known and self.stable(text, b)]
            if common:
                splice = min(common, key=lambda b: abs(b - (begin + hi) // 2))
                total += sum(cut <= b < splice for b in own)
                cut, lo, hi, own, width = splice, begin, until, following, self.overlap
            elif begin > cut:
                width *= 2
            else:
                hi = min(end, hi + max(self.chunk, hi - lo))
                own, width = self.boundaries(text, lo, hi), self.overlap
        return total + sum(b >= cut for b in own)


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; no row moves."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model_path, chunk, overlap)
        for b in batches:
            texts = b.column(1)
            n = pa.array((counter.count(t) if (t := texts[i].as_py()) else 0 for i in range(b.num_rows)), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), n], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col), F.col(text_col), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))
    return rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
