"""The prefix trie against a plain dictionary of prefixes, and its parentheses against a stack."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from keyloom.llm import trie
from keyloom.llm.queries import ORACLE_SQL, QUERIES

KIND = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes of the trie by prefixes, from (conv_id, turn, role, text) without ties of different rows."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, m in members.items()
    )


def got(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1], str(r)))


def same(df, rows):
    want = sorted(brute(rows), key=lambda r: (r[0], r[1], str(r)))
    assert got(df) == want
    return want


def some_rows(seed, n, texts, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        c = c * 7 if c % 3 else c * 100
        for turn in range(rng.choice([0, 1, 2, 3, longest]) + 1):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(texts)))
    rng.shuffle(rows)
    return list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())


@pytest.mark.parametrize("seed", range(4))
def test_parentheses(seed):
    rng = np.random.default_rng(seed)
    bits, depth = [], 0
    for _ in range(3000):
        up = depth == 0 or rng.random() < (0.8 if rng.random() < 0.5 else 0.2)
        bits.append(int(up))
        depth += 1 if up else -1
    bits += [0] * depth
    tree = trie.Parentheses(np.array(bits))
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    assert dict(zip(tree.opens.tolist(), tree.findclose().tolist())) == want


@pytest.mark.parametrize("width, shard", [(2, 3), (3, 40), (32, 10), (32, 100_000)])
def test_trie(spark, width, shard):
    rows = some_rows(width, 60, ["a", "b", "", "ccc"], 14)
    turns = trie.rebuilt_turns(spark.createDataFrame(rows, KIND).repartition(5))
    assert len(same(trie.prefix_trie(turns, width, shard), rows)) > 100


def test_copies_and_long_conversations(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(200, 260) for t in range(3)] + [(c, t, "user", "x" if t < 150 else str(c)) for c in (700, 801, 900) for t in range(200)]
    turns = trie.rebuilt_turns(spark.createDataFrame(rows, KIND))
    same(trie.prefix_trie(turns, 4, 50), rows)
    same(trie.prefix_trie(turns), rows)
    # a node where more conversations end than one range of ids holds
    many = [(c * 100, 0, "user", "same") for c in range(3000)]
    same(trie.prefix_trie(trie.rebuilt_turns(spark.createDataFrame(many, KIND))), many)


def test_odd_rows(spark):
    long = "wort \U0001f600 " * 20_000
    rows = [(100, None, None, None), (100, 0, "user", long), (100, 5, "", ""), (101, 1, "user", "a"), (103, None, "system", None), (103, 2, "user", ""), (-250, 0, "a", "b"), (-230, 3, "a", "b")]
    odd = [*rows, (None, 1, "user", "nobody's")]
    frame = spark.createDataFrame(odd, KIND).withColumn("pos", F.lit(1)).withColumn("k1", F.lit("x"))
    def c_mod(c):
        return c - int(np.fmod(c, 100))
    assert c_mod(-250) == -200
    got_rows = got(trie.prefix_trie(trie.rebuilt_turns(frame)))
    assert [r for r in got_rows if r[1] == 0][0][3] == 5 and len({r[:2] for r in got_rows}) == len(got_rows)
    positive = [r for r in rows if r[0] >= 0]
    same(trie.prefix_trie(trie.rebuilt_turns(spark.createDataFrame(positive, KIND))), positive)
    # repeated rows are turns of their own
    twice = [(100, 1, "user", "a")] * 3 + [(100, 2, "user", "b")]
    assert [(r[1], r[3]) for r in got(trie.prefix_trie(trie.rebuilt_turns(spark.createDataFrame(twice, KIND))))] == [(d, 1) for d in range(5)]
    assert trie.prefix_trie(trie.rebuilt_turns(spark.createDataFrame([], KIND))).collect() == []


def test_query_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = same(QUERIES["op13_prefix_trie"](spark, sf), rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    names = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    found = con.execute(f"SELECT {names} FROM ({ORACLE_SQL['op13_prefix_trie']})").fetchall()
    assert sorted(found, key=lambda r: (r[0], r[1], str(r))) == want
