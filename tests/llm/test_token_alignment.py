"""Operator 11 against a plain version that compares all token pairs of each group, with its own decoding."""

import hashlib
from collections import defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cuesheet.llm import common, queries, token_alignment

SMALL = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    import base64
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {int(i): base64.b64decode(t) for t, i in map(bytes.split, f)}
    return a, b, ranks


def spans(tokens):
    at = 0
    for i, t in tokens:
        yield i, at, at + len(t)
        at += len(t)


def plain(texts, tokenizers):
    a, b, ranks = tokenizers
    docs, holds = [], defaultdict(set)
    for n, text in enumerate(texts):
        ta = [(i, ranks.get(i, b"")) for i in a.encode(" " + text, add_special_tokens=False).ids] if text else []
        tb = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)] if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in ta) != whole or b"".join(t for _, t in tb) != whole:
            docs.append(None)
            continue
        sa, sb = list(spans(ta)), list(spans(tb))
        common_ends = sorted({e for *_, e in sa} & {e for *_, e in sb})
        groups, lo = [], 0
        for e in common_ends:
            groups.append(([x for x in sa if lo <= x[1] and x[2] <= e], [x for x in sb if lo <= x[1] and x[2] <= e]))
            lo = e
        links = [(x[0], y[0]) for ga, gb in groups for x in ga for y in gb if x[1] < y[2] and y[1] < x[2]]
        for p in links:
            holds[p].add(n)
        text = ";".join(",".join(str(x[0]) for x in ga) + "|" + ",".join(str(x[0]) for x in gb) for ga, gb in groups)
        docs.append((len(sa), len(sb), len(groups), links, hashlib.sha256(text.encode()).hexdigest()))
    best = defaultdict(int)
    for (x, _), d in holds.items():
        best[x] = max(best[x], len(d))
    return [(0, 0, 0, 0, 0, 0, "") if d is None else (*d[:3], len(d[3]), sum(len(holds[p]) == best[p[0]] for p in d[3]), sum(len(holds[p]) for p in d[3]), d[4]) for d in docs]


def found(df):
    return [tuple(r) for r in sorted(df.select("doc_id", *COLUMNS).collect(), key=str)]


def test_whole_table_equals_plain_version(spark, tokenizers):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = [(d, *x) for (d, _), x in zip(rows, plain([t for _, t in rows], tokenizers), strict=True)]
    assert found(queries.op11_token_alignment(spark, SMALL)) == sorted(want, key=str)


def test_odd_texts(spark, monkeypatch, tokenizers):
    """Scripts, special strings, the blank sign itself, pairs in several groups of a text, copies; small tables of counted groups, look-ups that are not broadcast."""
    monkeypatch.setattr(token_alignment, "HELD", 50)
    monkeypatch.setattr(common, "FEW_ROWS", 0)
    texts = [None, "", " ", "  two  blanks ", "\n\n\ttabs\r\n", "a▁b", "<|endoftext|> and <s> </s> <0x41>", "Ünïcödé straße 漢字かな 🙂🙃 ​", "aaaa aaaaa aaaaaaa" * 9,
             "unhappiness kindness happiness carelessness", "unhappiness unhappinesss 1234567 12345678", "x", "x", "\x00\x01", "don't I'll we've", "ée", "word " * 300, " word"]
    rows = list(enumerate(texts)) + [(None, "null id"), (3, "again"), (3, "again")]
    df = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], "doc_id long, text string, code long, groups string, n int").repartition(3)
    want = [(d, *x) for (d, _), x in zip(rows, plain([t for _, t in rows], tokenizers), strict=True)]
    assert found(token_alignment.alignment(df, A, B)) == sorted(want, key=str)
    assert token_alignment.alignment(df.limit(0), A, B).count() == 0


def test_segments_equal_whole_texts(spark, monkeypatch, tokenizers):
    """Texts cut into many parts and segments against the tokenizers' encodings of the whole: blanks of all kinds, other spaces, signs beside blanks."""
    text = "\n".join(r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if r.text)[:12_000]
    odd = " ".join(f"{x} {y}" for x in ("a", ",", "\u3000", "\x85", "\x1c", "\u200b", "'", "1", "é", "\n", "\t", "<s>", "\u2028", "🙂") for y in ("'s", "b", "\u3000", "\xa0", "2", "\r\n", ".", "'ll"))
    texts = [text, text[:4_000].replace(" ", "  "), text[:4_000].replace(" ", ""), odd, odd.replace(" ", "\n "), "don 't we 'll 've " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = [(n, *x) for n, x in enumerate(plain(texts, tokenizers))]
    assert found(token_alignment.alignment(df, A, B)) == whole
    monkeypatch.setattr(token_alignment, "PART", 50)
    own = token_alignment.Aligner(A, B)
    assert own.in_parts and len(own.parts(text)) > 150
    assert found(token_alignment.alignment(df, A, B)) == whole


def test_colliding_keys_take_another_seed(spark, monkeypatch, tokenizers):
    """Two groups under one key are noticed, and the documents are read once more with other keys."""
    seeds, coded = [], token_alignment.coded

    def colliding(*args):
        seeds.append(args[-1])
        rows = coded(*args)
        return rows.withColumn("code", F.when((F.col("code") < 0) & (F.lit(args[-1]) == 0), -1).otherwise(F.col("code")))

    monkeypatch.setattr(token_alignment, "coded", colliding)
    texts = ["unhappiness carelessness 1234567", "straße 漢字"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(token_alignment.alignment(df, A, B)) == [(n, *x) for n, x in enumerate(plain(texts, tokenizers))] and seeds == [0, 1]
