"""The repair of conversations against a search over all edit strings."""

import hashlib
import heapq
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from keyloom.llm import repair
from keyloom.llm.queries import ORACLE_SQL, QUERIES

KIND = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
FULL = re.compile(r"(s?(ua)+)?\Z")
PREFIX = re.compile(r"(s?(ua)*u?)?\Z")


def dijkstra(rows):
    """(cost, audit, repaired rows) by the cheapest, then least, string over whole role strings; rows are (role, text, fault)."""
    heap = [(0, "", 0, "", ())]
    seen = set()
    while heap:
        cost, audit, i, roles, out = heapq.heappop(heap)
        if i == len(rows) and FULL.match(roles):
            return cost, audit, out
        # two paths that agree in row and last role have the same ways on
        if (i, roles[-1:], audit[-1:] == "I") in seen:
            continue
        seen.add((i, roles[-1:], audit[-1:] == "I"))
        grown = [("I", 3, i, r, (name, "")) for r, name in (("u", "user"), ("a", "assistant"))]
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, roles, out))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                grown.append(("K", extra, i + 1, role[:1] or "-", (role, text)))
                grown += [("R", 3 + extra, i + 1, r, (name, text)) for r, name in (("u", "user"), ("a", "assistant"))]
        for letter, more, j, r, row in grown:
            if PREFIX.match(roles + r):
                heapq.heappush(heap, (cost + more, audit + letter, j, roles + r, (*out, row)))


def brute(data):
    convs = {}
    for c, turn, role, text in data:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        rows = convs.setdefault(c, [])
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        rows.extend([(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1))
    want = []
    for c, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            kept = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, out = dijkstra([(r, t, f) for (_, r, t), f in zip(rows, faults)])
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        want.append((c, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha))
    return sorted(want, key=str)


def got(df):
    return sorted(map(tuple, df.select(*NAMES).collect()), key=str)


def some_rows(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "s", "", None])
            text = rng.choice(["Yes.", "No!", "What?", "cut off", "Done.  \n", " \t", "", None, f"text {rng.random()}.", f"text {rng.random()}"])
            rows.append((c, None if rng.random() < 0.02 else turn + rng.randint(0, 1), role, text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_cheapest(seed):
    rng = random.Random(seed)
    names = {"0": "", "1": "blank", "2": "duplicate", "3": "truncated"}
    for _ in range(400):
        n = rng.randint(0, 9)
        initials, faults = "".join(rng.choice("suuaax") for _ in range(n)), "".join(rng.choice("00000123") for _ in range(n))
        want = dijkstra([(i, "t", names[f]) for i, f in zip(initials, faults)])
        assert repair.cheapest(initials, faults) == want[:2], (initials, faults)


def test_long_search():
    rng = random.Random(9)
    initials, faults = "".join(rng.choice("suuuaaax") for _ in range(20_000)), "".join(rng.choice("00000123") for _ in range(20_000))
    cost, audit = repair.cheapest(initials, faults)
    assert len(audit.replace("I", "")) == 20_000 and cost > 20_000


def test_repair(spark):
    data = some_rows(3, 250, 9)
    frame = spark.createDataFrame(data, KIND).withColumn("digest", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("gone", F.lit(1))
    assert got(repair.repair(repair.damaged(frame.repartition(7)))) == brute(data)


def test_odd_conversations(spark):
    long = "wort \U0001f600. " * 20_000
    data = [(1, t, "user" if t % 2 else "assistant", f"{t // 3}.") for t in range(9000)]
    data += [(None, 0, "user", long), (None, None, "assistant", long), (2, None, None, None), (3, 5, "user", "a."), (3, 5, "assistant", "b."), (3, 900, "user", "a.")]
    data += [(c, 0, "user", "only row.") for c in range(100, 160)]
    want = brute(data)
    assert [w for w in want if w[-2] == "" and w[-1] == hashlib.sha256(b"").hexdigest() and w[1:7] == (0,) * 6]
    assert got(repair.repair(repair.damaged(spark.createDataFrame(data, KIND)))) == want
    assert repair.repair(repair.damaged(spark.createDataFrame([], KIND))).collect() == []


def test_query_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(data)
    assert got(QUERIES["op11_repair_conversations"](spark, sf)) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    assert sorted(con.execute(f"SELECT {', '.join(NAMES)} FROM ({ORACLE_SQL['op11_repair_conversations']})").fetchall(), key=str) == want
