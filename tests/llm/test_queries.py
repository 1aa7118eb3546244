"""The registered queries on the smallest tables, against brute force, SQL and held-out labels."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keyloom.llm import lines, simhash
from keyloom.llm.components import local_roots
from keyloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def of(name):
    return QUERIES[next(n for n in QUERIES if n.startswith(name + "_"))]


def test_names_and_columns(spark):
    want = {
        "op1": ["doc_id", "held_out", "score", "predicted"], "op2": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"], "op3": ["doc_id", "held_out", "lang_pred", "score"],
        "op6": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"], "op9": ["doc_id", "fingerprint", "component_id"],
        "op10": ["doc_id", "size", "source_size", "target", "taken"],
    }
    for op, columns in want.items():
        assert of(op)(spark, SF).columns[: len(columns)] == columns
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(f"op{i}" for i in range(1, 14))


def test_op9(spark, documents):
    prints = [simhash.fingerprint(t) for _, t, _, _ in documents]
    a, b = np.nonzero([[int.bit_count(x ^ y) <= 3 for y in prints] for x in prints])
    ids = sorted(range(len(documents)), key=lambda i: documents[i][0])
    place = np.argsort(ids)
    root = local_roots(place[a], place[b], len(ids))
    want = {documents[i][0]: (f"{prints[i]:016x}", documents[ids[root[place[i]]]][0]) for i in range(len(ids))}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in of("op9")(spark, SF).collect()} == want


def test_op10_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({ORACLE_SQL['op10_mix_sources']})").fetchall()
    got = [tuple(r) for r in of("op10")(spark, SF).select("doc_id", "size", "source_size", "target", "taken").collect()]
    assert sorted(got) == sorted(want) and sum(g[4] for g in got) > sum(g[1] for g in got)
    # DataFrame functions only
    plan = of("op10")(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_op2(spark, documents):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, ids = {}, {d: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for d, t, _, _ in documents}
    for r in of("op2")(spark, SF).collect():
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes())
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for d, own in pieces.items():
        own.sort()
        assert [s for s, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) == len(ids[d])
    assert set(pieces) == set(ids)


def test_op4(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= 0.95
    a, b = np.nonzero(hit)
    root = local_roots(a, b, len(x))
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in of("op4")(spark, SF).collect())
    assert got == [(r["vec_id"], int(n) - 1, rows[c]["vec_id"]) for r, n, c in zip(rows, hit.sum(1), root)]


def test_held_out(spark):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_LARGER}/labels.parquet").collect()}
    toxic = [(labels[r["doc_id"]]["toxic"], r["predicted"]) for r in of("op1")(spark, SF_LARGER).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(p for t, p in toxic if t) >= 0.75 * sum(t for t, _ in toxic) and sum(p for t, p in toxic if not t) <= 0.01 * len(toxic)
    graded = [(labels[r["doc_id"]]["quality"], r["kept"]) for r in of("op8")(spark, SF_LARGER).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(k for q, k in graded if q) >= 0.99 * sum(q for q, _ in graded) and sum(not k for q, k in graded if not q) >= 0.9 * sum(not q for q, _ in graded)
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_LARGER}/documents.parquet").select("doc_id", "lang").collect()}
    found = [lang[r["doc_id"]] == r["lang_pred"] for r in of("op3")(spark, SF_LARGER).collect() if r["held_out"] and lang[r["doc_id"]]]
    assert np.mean(found) >= 0.99


def test_op6(spark, documents):
    for r in of("op6")(spark, SF).collect():
        text = next(t for d, t, _, _ in documents if d == r["doc_id"]) or ""
        words = text.encode().split()
        three = list(zip(words, words[1:], words[2:]))
        twice = {w for w in three if three.count(w) > 1} if len(three) < 3000 else None
        assert r["n_words"] == len(words)
        if twice is not None:
            assert r["n_repeat_words"] == len({i + k for i, w in enumerate(three) if w in twice for k in range(3)})
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["kept"] and r["base_failed"])


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_LARGER.replace('0.1', '0.01')}/documents.parquet")
    names, before, seen = docs.columns, docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, SF_LARGER.replace("0.1", "0.01"))
        out.write.parquet(str(tmp_path / name.replace(" ", "_")))
        seen[name] = before, (before := spark.read.parquet(str(tmp_path / name.replace(" ", "_"))))
        if name != "packing":
            assert before.columns == names and before.schema == docs.schema
    first, last = seen["quality classifier"]
    bad = spark.read.parquet(f"{SF_LARGER.replace('0.1', '0.01')}/labels.parquet")
    gone = first.join(last, "doc_id", "left_anti").join(bad, "doc_id").collect()
    assert gone and sum(r["quality"] for r in gone) == 0
    first, last = ({r["doc_id"]: r["text"] for r in d.collect()} for d in seen["line dedup"])
    assert set(first) == set(last)
    runs = {}
    for i in sorted(first):
        parts = [p.strip() for p in lines.split_lines(first[i])]
        for a in range(len(parts)):
            b, n = a, 0
            while b < len(parts) and n < 50:
                n, b = n + len(parts[b].split()), b + 1
            if n >= 50 and parts[a]:
                runs.setdefault(tuple(parts[a:b]), i)
    for i in last:
        parts = [p.strip() for p in lines.split_lines(last[i])]
        if first[i] == last[i]:
            continue
        for a in range(len(parts)):
            for b in range(a + 1, min(a + 12, len(parts)) + 1):
                assert runs.get(tuple(parts[a:b]), i) == i
    first, last = ({r["doc_id"]: r["text"] for r in d.collect()} for d in seen["simhash near-dedup"])
    sets = {i: frozenset(simhash.shingle_hashes(t, 5).tolist()) for i, t in first.items()}
    kept = list(last)
    for i, x in enumerate(kept):
        assert all(len(sets[x] & sets[y]) < 0.8 * len(sets[x] | sets[y]) or not (sets[x] or sets[y]) for y in kept[:i] if sets[x] and sets[y])
    ids = sorted(first)
    links = [(i, j) for i in range(len(ids)) for j in range(i) if sets[ids[i]] == sets[ids[j]] or len(sets[ids[i]] & sets[ids[j]]) >= 0.8 * len(sets[ids[i]] | sets[ids[j]])]
    root = local_roots(np.array([a for a, _ in links], dtype=int), np.array([b for _, b in links], dtype=int), len(ids))
    assert set(last) == {ids[r] for r in root}
    mixed, packed = seen["packing"]
    assert packed.agg(F.sum("length")).first()[0] >= mixed.count() and packed.where("length > 1024").count() == 0
    n = corpus_pipeline.run(spark, SF).count()
    assert n > 0
