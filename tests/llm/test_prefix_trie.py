"""Operator 12 against a plain trie of whole paths, and against SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb

from cuesheet.llm import common, prefix_trie, queries

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rest(c):
    """c modulo 100 with the sign of c."""
    return abs(c) % 100 * (1 if c >= 0 else -1)


def plain(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append(((t is not None, t or 0), hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest(), (r, x)))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    nodes, ends = defaultdict(set), defaultdict(set)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - rest(c), [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes[path[:d]].add(c)
        ends[path].add(c)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)

    def below(p):
        leaves, saved, todo = 0, 0, [p]
        while todo:
            q = todo.pop()
            leaves += not kids[q]
            saved += (len(nodes[q]) - 1) * len(q[-1][1]) if q else 0
            todo += kids[q]
        return leaves, saved

    return sorted(((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids[p]), *below(p), hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in list(nodes.items())), key=str)


def found(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def sql_rows(conversations):
    con = duckdb.connect()
    con.sql(f"create view conversations as {conversations}")
    return sorted(con.sql(f"select {', '.join(COLUMNS)} from ({queries.ORACLE_SQL['op12_prefix_trie']})").fetchall(), key=str)


def test_equals_sql_and_plain(spark):
    got = found(queries.op12_prefix_trie(spark, SMALL))
    assert got == sql_rows(f"select * from '{SMALL}/conversations.parquet'")
    assert got == plain([tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])


def test_shared_families_and_odd_rows(spark, monkeypatch):
    """Paths shared over families, copies, deep conversations, absent bases, negative ids, nulls, ties, repeated rows; tables that are full
    after a few nodes, pieces of a few ids, look-ups that are not broadcast."""
    monkeypatch.setattr(prefix_trie, "HELD", 7)
    monkeypatch.setattr(prefix_trie, "PIECE", 9)
    monkeypatch.setattr(common, "FEW_ROWS", 0)
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 160), *range(205, 320), *range(-130, -90), 5_000_000_000]:
        n = rng.choice((1, 2, 3, 7, 12))
        rows += [(c, t, rng.choice(("user", "bot")), rng.choice(("a", "bb", "é€")) if t < 3 else f"{rng.random():.1f}") for t in range(n)]
    rows += [(c, t, "user", f"same {t}") for c in range(400, 460) for t in range(5)]
    rows += [(777, t, "user", f"long {t % 3}") for t in range(70)] + [(700, 0, "user", "x")]
    rows += [(800, None, "u", "first"), (800, 1, "u", "b"), (800, 1, "u", "a"), (800, 1, "u", "a"), (800, 2, None, None), (801, 0, "", ""), (None, 1, "u", "lost"), (802, None, None, None)]
    rows += [(820, 0, "a", "1:b"), (920, 0, "a1:b", ""), (1020, 0, "", "a1:b")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, base int, up string")
    assert found(prefix_trie.prefix_trie(df)) == plain(rows)
    assert prefix_trie.prefix_trie(df.limit(0)).count() == 0
    path = common.shared_path(spark, "test-conversations")
    df.select("conv_id", "turn", "role", "text").where("conv_id <> 777").write.parquet(path)
    assert sql_rows(f"select * from '{path.removeprefix('file:')}/*.parquet'") == plain([r for r in rows if r[0] != 777])
