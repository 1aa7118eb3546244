"""Each operator on small hand-made tables: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyloom.llm import html, langid, lines, mixing, packing, quality, rules, simhash, similar, toxicity, vectors
from keyloom.llm.components import connected_components, local_roots

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "one"), (5, "one"), (None, "no id"), (6, "été \U0001f600 <b>")]


def rows(df, *cols):
    return [tuple(r) for r in df.select(*(cols or df.columns)).collect()]


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(300)] + [(7, 7)]
    links = spark.createDataFrame(pairs, "a long, b long").unionByName(spark.createDataFrame([(None, 3)], "a long, b long"))
    got = dict(rows(connected_components(links)))
    names = sorted({x for p in pairs if p[0] != p[1] for x in p})
    at = {x: i for i, x in enumerate(names)}
    a, b = (np.array([at[p[k]] for p in pairs if p[0] != p[1]]) for k in (0, 1))
    assert got == {x: names[r] for x, r in zip(names, local_roots(a, b, len(names)))}


def brute_links(values, radius):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(values):
        for j in range(i):
            if bin(x ^ values[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_bk_forest():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([base ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a, b in rng.integers(0, 63, (12, 2))]))
    a, b = simhash.BKForest(np.zeros(len(values), dtype=np.int64), values).links(np.arange(len(values)), 3, at_once=500)
    want = {(i, j) for i in range(len(values)) for j in range(i) if int(values[i] ^ values[j]).bit_count() <= 3}
    assert set(zip(a.tolist(), b.tolist())) == want and want


def test_simhash(docs_of, monkeypatch):
    rng = np.random.default_rng(3)
    vocabulary = [f"word{i}" for i in range(300)]
    texts = []
    for i in range(60):
        words = list(rng.choice(vocabulary, 150))
        texts.append(" ".join(words))
        if i % 3 == 0:
            words[int(rng.integers(0, 150))] = "changed"
            texts.append(" ".join(words).upper())
    cases = [(10 + i, t) for i, t in enumerate(texts)] + ODD
    for shard_rows in (8192, 4):  # the second deals every shard out and has more of them
        monkeypatch.setattr(simhash, "SHARD_ROWS", shard_rows)
        got = sorted(rows(simhash.near_duplicates(docs_of(cases)), "doc_id", "fp", "component_id"), key=str)
        prints = [simhash.fingerprint(t) for _, t in cases]
        root = brute_links(prints, 3)
        least = {}
        for (i, _), r in zip(cases, root):
            if i is not None:
                least[r] = min(least.get(r, i), i)
        want = sorted([(i, int(np.array(p, dtype=np.uint64).view(np.int64)), least.get(r)) for (i, _), p, r in zip(cases, prints, root)], key=str)
        assert got == want
    assert len({r for r in root}) < len(cases)
    assert simhash.fingerprint("A b") == simhash.fingerprint("a  B\n") and simhash.fingerprint(None) == 0
    kept = simhash.keep_one(docs_of(cases), simhash.near_duplicates(docs_of(cases)))
    assert kept.columns == docs_of(cases).columns and kept.count() == len({r for r in root})
    assert simhash.near_duplicates(docs_of(cases[:1]).limit(0)).count() == 0


def test_simhash_blocks(spark):
    """Any number of blocks gives the same groups, those of brute force."""
    rng = np.random.default_rng(13)
    values = rng.integers(0, 1 << 64, 50, dtype=np.uint64)
    for _ in range(3):
        flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (3, 50)).astype(np.uint64))
        values = np.unique(np.concatenate((values[:150], values[:50] ^ flips)))
    root = brute_links([int(v) for v in values], 3)
    distinct = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    for blocks in (4, 5, 6):
        got = dict(rows(connected_components(simhash.fingerprint_links(distinct, 3, blocks))))
        groups = {}
        for v, r in zip(values.view(np.int64).tolist(), root):
            groups.setdefault(r, set()).add(got.get(v, v))
        assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups) < len(values)
    assert [simhash.blocks_for(n, 3, 8192) for n in (1000, 1 << 29, 1 << 32, 1 << 45)] == [4, 4, 5, 6]


def test_similar(docs_of, monkeypatch):
    rng = np.random.default_rng(9)
    vocabulary = [f"word{i}" for i in range(300)]
    texts = []
    for i in range(40):
        words = list(rng.choice(vocabulary, 120))
        texts.append(" ".join(words))
        for changes in (1, 2, 4)[: 1 + i % 3]:
            other = list(words)
            for at in rng.integers(0, 120, changes):
                other[at] = f"changed{at}"
            texts.append(" ".join(other).upper())
    dense = list(rng.choice(vocabulary, 200))
    for i in range(60):  # a large group of copies that differ from each other
        other = list(dense)
        other[i * 3] = "altered"
        texts.append(" ".join(other))
    cases = [(10 + i, t) for i, t in enumerate(texts)] + ODD
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for _, t in cases]
    a, b = zip(*[(i, j) for i in range(len(cases)) for j in range(i + 1) if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])])
    root = local_roots(np.array(a), np.array(b), len(cases))
    least = {}
    for (i, _), r in zip(cases, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = sorted([(i, least.get(r)) for (i, _), r in zip(cases, root)], key=str)
    for shard_rows in (1024, 8):
        monkeypatch.setattr(similar, "SHARD_ROWS", shard_rows)
        monkeypatch.setattr(similar, "PAIRS", 50 * shard_rows)
        assert sorted(rows(similar.similar_groups(docs_of(cases))), key=str) == want
    kept = simhash.keep_one(docs_of(cases), similar.similar_groups(docs_of(cases)))
    assert kept.count() == len(set(root.tolist())) < len(cases)
    assert similar.similar_groups(docs_of(cases).limit(0)).count() == 0


def test_similar_keys():
    rng = np.random.default_rng(12)
    for n in [1, 2, 4, 5, 6, 9, 10, 40, 41, 300, 2000]:
        for _ in range(60):
            x = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
            out = int(rng.integers(0, n // 5 + 1))  # as few in common as 0.8 allows, in sets of like or unlike sizes
            new = int((n - out) / 0.8 + 1e-9) - n
            y = np.unique(np.concatenate((x[rng.permutation(n)[out:]], rng.integers(0, 1 << 64, max(new, 0), dtype=np.uint64))))
            if similar.jaccard(x, y) >= 0.8:
                often = np.sort(rng.permutation(np.concatenate((x, y)))[: int(rng.integers(0, len(x)))])
                assert len(np.intersect1d(similar.keys(x, 0.8, often), similar.keys(y, 0.8, often)))


def test_similar_parity():
    """Maps of sets of any sizes differ in no more bits than the sets in elements, folded to the shorter of the two."""
    rng = np.random.default_rng(20)
    for n in (1, 5, 31, 32, 63, 64, 500, 3000):
        x = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        for m in (0, 1, n // 10, n // 4):
            y = np.concatenate((x[m:], rng.integers(0, 1 << 64, m // 2 + 1, dtype=np.uint64)))
            a, b = similar.parity(np.unique(x)), similar.parity(np.unique(y))
            words = min(len(a), len(b))
            apart = np.bitwise_count(similar.fold(a[None, :], words) ^ similar.fold(b[None, :], words)).sum()
            assert apart <= len(np.setxor1d(x, y)) and 2 * n <= 64 * len(a) <= 4 * n + 64


def test_similar_far_prints(docs_of):
    """Pairs of exactly 4 shingles in 5, of which bands and fingerprints within 22 bits lose some."""
    cases = [(i, " ".join([*(f"t{i // 2}w{k}" for k in range(7)), f"t{i // 2}w7", *([f"t{i // 2}end"] if i % 2 else [])])) for i in range(6000)]
    got = dict(rows(similar.similar_groups(docs_of(cases))))
    assert all(got[i] == i - i % 2 for i in got) and len(got) == 6000


def brute_mix(cases, weights=(3, 1, 2)):
    sizes = {}
    for _, text, _, source in cases:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        for s in full:
            target[s] = 2.0 * sizes[s]
        if not full:
            return sizes, target | {s: left * weight[s] / total for s in open_}
        left -= sum(target[s] for s in full)
        open_ -= full
        if not open_:
            return sizes, target


def test_mixing(docs_of, monkeypatch):
    rng = np.random.default_rng(4)
    sources = ["b", "a", None, "é", "Z"]
    cases = [(i, " ".join(["w"] * int(rng.integers(0, 40))), "en", sources[min(int(rng.integers(0, 9)), 4)]) for i in range(900)]
    cases += [(i, t, "en", "a") for i, t in ODD]
    sizes, target = brute_mix(cases)
    got = {}
    for ranges in (4096, 7):
        monkeypatch.setattr(mixing, "RANGE_ROWS", ranges)
        got[ranges] = sorted(rows(mixing.mix(docs_of(cases), mixing.word_count())), key=str)
    assert got[4096] == got[7] and len(got[7]) == len(cases)
    for source in sizes:
        own = [r for r in got[7] if r[1] == source]
        assert all(r[3] == sizes[source] and math.isclose(r[4], target[source]) and 0 <= r[5] <= 2 * r[2] for r in own)
        assert sum(r[5] for r in own) == math.floor(target[source])
    mixed = mixing.mixed_documents(docs_of(cases)).collect()
    words = {}
    for r in mixed:
        words[r["source"]] = words.get(r["source"], 0) + len((r["text"] or "").encode().split())
    assert {s: words.get(s, 0) for s in sizes} == {s: math.floor(target[s]) for s in sizes}
    assert mixing.mix(docs_of(cases).limit(0), mixing.word_count()).count() == 0


def test_packing(docs_of):
    import public_tokenizers
    import zlib
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    cases = ODD + [(20 + i, "some words " * (i * 7)) for i in range(60)]
    fast = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = Tokenizer.from_file(path)

    def slow(text):
        return np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4")

    assert slow("a <|endoftext|> b").tolist() == fast("a <|endoftext|> b").tolist() and 50256 in fast("<|endoftext|>")
    odd = [" " * 1_000_000 + "x", "\n" * 1_000_000, "y" * 1_000_000, "a" + "\t" * 999 + "b", "'" * 100_000]
    for text in odd:
        assert np.array_equal(slow(text), fast(text))
    assert packing.pack(docs_of([(1, odd[0]), (2, odd[1])]), public_tokenizers.path("byte_bpe_50k.tiktoken")).agg(F.sum("length")).first()[0] == sum(len(slow(t)) + 1 for t in odd[:2])
    odd = ["<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|> \n", "  <|endoftext|>  x", "<|endoftext|", "<|startoftext|>", "a‍b́ 中文　\U0001f468‍\U0001f469", "x" * 3000, "  \n\n\t 12345 it's 'LL"]
    for text in [t or "" for _, t in cases] + odd:
        assert slow(text).tolist() == fast(text).tolist()
    pieces = packing.pack(docs_of(cases).repartition(3), path)
    got = pieces.collect()
    by_doc, by_sequence = {}, {}
    for p in got:
        assert len(p["ids"]) == 4 * p["length"] and p["length"] > 0
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for (i, n), own in by_doc.items():
        whole = b"".join(bytes(p["ids"]) for p in sorted(own, key=lambda p: p["start"]))
        texts = [t or "" for j, t in cases if j == i]
        want = np.append(slow(texts[0]), np.uint32(0)).astype("<u4").tobytes()
        if len(texts) == 1:
            assert whole == want and len(whole) == 4 * n
    total = sum(p["length"] for p in got)
    assert total == sum(len(slow(t or "")) + 1 for _, t in cases)
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == [sum(q["length"] for q in own[:k]) for k in range(len(own))]
        assert sum(p["length"] for p in own) <= 1024
    assert len(by_sequence) <= -(-total // 1024) + 2
    digest = {(r["doc_id"], r["start"], r["sequence_id"], r["offset"]): r["ids_crc32"] for r in packing.with_digest(pieces).collect()}
    assert all(digest[p["doc_id"], p["start"], p["sequence_id"], p["offset"]] == zlib.crc32(bytes(p["ids"])) for p in got)
    assert packing.pack(docs_of(cases).limit(0), path).count() == 0


def test_pack_lengths_balances():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 900, 500)
    pieces = packing.pack_lengths(lengths, 1024, 1.0, 1 / 1024)
    used = {}
    for _, _, n, s, _ in pieces:
        used[s] = used.get(s, 0) + n
    assert sum(used.values()) == lengths.sum() and max(used.values()) <= 1024 and len(used) == -(-lengths.sum() // 1024)


def test_line_dedup(docs_of):
    rng = np.random.default_rng(6)
    vocabulary = [f"v{i}" for i in range(500)]
    sentence = lambda n: " ".join(rng.choice(vocabulary, n)) + "."
    passage = "\n".join(sentence(20) for _ in range(3))
    short = sentence(12)
    cases = [(i, "\n".join([sentence(15), short, *([passage] if i % 3 == 0 else []), sentence(30) + " " + sentence(30)])) for i in range(1, 12)]
    cases += [(40, cases[1][1]), (41, "start " + passage + " mid " + sentence(3)), (42, passage + "\n" + passage)] + [(60 + (i or 0), t) for i, t in ODD] + [(None, "no id at all")]
    got = rows(lines.dedup_lines(docs_of(cases), words_as="words"), "doc_id", "text", "words")
    seen, want = set(), []
    distinct = list({(i, t): None for i, t in cases})
    text_of = {}
    for i, t in sorted(distinct, key=lambda c: (c[0] is not None, c[0] or 0, 0)):
        parts = lines.split_lines(t or "")
        assert "".join(parts) == (t or "")
        gone = [False] * len(parts)
        for a in range(len(parts)):
            b, n = a, 0
            while b < len(parts) and n < 50:
                n, b = n + len(parts[b].split()), b + 1
            if n >= 50 and parts[a].split():
                key = tuple(p.strip() for p in parts[a:b])
                if key in seen:
                    gone[a:b] = [True] * (b - a)
                seen.add(key)
        text_of[i, t] = None if t is None else "".join(p for p, g in zip(parts, gone) if not g)
    want = sorted([(i, text_of[i, t]) for i, t in cases], key=str)
    assert sorted([r[:2] for r in got], key=str) == want
    by_id = {r[0]: r for r in got}
    assert by_id[40][1] == "" and short in by_id[11][1] and passage not in by_id[6][1] and by_id[1][2] == 0
    assert lines.dedup_lines(docs_of(cases).limit(0)).count() == 0


def brute_runs(cases, min_words):
    """Lines of maximal common runs with an earlier place, by every pair of places."""
    cut = [(i, [p.strip() for p in lines.split_lines(t)]) for i, t in sorted(cases)]
    gone = {i: set() for i, _ in cut}
    for y, (j, b) in enumerate(cut):
        for i, a in cut[: y + 1]:
            for s in range(len(b)):
                for r in range(s if i == j else len(a)):
                    n = 0
                    while r + n < len(a) and s + n < len(b) and a[r + n] == b[s + n]:
                        n += 1
                    if sum(len(x.split()) for x in b[s : s + n]) >= min_words:
                        gone[j] |= set(range(s, s + n))
    return gone


def test_lines_whole_runs(docs_of):
    rng = np.random.default_rng(11)

    def line(n, name):
        return " ".join(f"{name}{k}" for k in range(n)) + "."

    long, short, tail, odd = line(60, "a"), line(40, "b"), [line(30, "c"), line(30, "d"), line(5, "e")], line(9, "z")
    cases = [(1, " ".join([long, short])), (2, " ".join([long, short])), (3, " ".join(tail)), (4, " ".join([odd, *tail, line(7, "y")])), (5, " ".join([short, *tail, long]))]
    pool = [line(int(n), f"p{k}x") for k, n in enumerate(rng.integers(3, 40, 30))]
    for i in range(40):
        own = []
        for k in range(4):
            at = int(rng.integers(0, 24))
            own += [*pool[at : at + int(rng.integers(2, 7))], line(int(rng.integers(1, 30)), f"n{i}x{k}x")]
        cases.append((10 + i, " ".join(own)))
    want = brute_runs(cases, 50)
    got = {r["doc_id"]: (r["text"], r["n"]) for r in lines.dedup_lines(docs_of(cases), lines_as="n").collect()}
    for i, t in cases:
        parts = lines.split_lines(t)
        assert got[i] == ("".join(p for k, p in enumerate(parts) if k not in want[i]), len(want[i]))
    assert got[2] == ("", 2) and got[4][1] == 3 and got[5][1] == 4


def test_helper_names_give_way(docs_of):
    """Columns named as an operator's own helpers are."""
    clash = ["_kl_v", "_kl_id", "_KL_runs", "_kl__n", "_kl_taken"]
    text = " ".join(f"w{i}." for i in range(60))
    docs = docs_of([(1, text), (2, text), (2, text), (3, None)]).withColumns({c: F.lit(i) for i, c in enumerate(clash)})
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns and sorted(map(str, (r["text"] for r in out.collect()))) == sorted(["", "", "None", text])
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() >= 3


def brute_fences(rates, names):
    """Fences of one group from exact quantiles, the least value with that share at or below it."""
    out = {}
    for c in names:
        share, reach = rules.RULES[c]
        low, middle, high = (np.quantile(rates[c], q, method="inverted_cdf") for q in (1 - share, 0.5, share))
        out[c] = low - reach * (middle - low), high + reach * (high - middle)
    return out


def test_rules(docs_of):
    rng = np.random.default_rng(14)

    def text(spread, i):
        words = ["x" * int(n) + f"{i}_{k}" for k, n in enumerate(np.clip(rng.normal(6, spread, 80), 1, 30))]
        return " ".join(f"{w}{'&' * int(rng.random() < 0.002 * spread)}" for w in words) + ("\nsame\nsame" if i % 9 == 0 else "")

    cases = [(1000 * g + i, text(spread, i), lang, source) for g, (lang, source, spread, n) in enumerate([("en", "a", 1, 90), ("en", "b", 9, 60), ("de", "a", 3, 12), (None, None, 2, 30)]) for i in range(n)]
    plain = " ".join(f"plain{i} text" for i in range(60))
    cases += [(9000, "| " * 80 + plain, "en", "a"), (9001, " ".join(f"{'y' * 40}{i}" for i in range(80)), "en", "a"), (9002, plain, "fr", "z")]
    cases += [(9100 + k, t, None, "b") for k, (_, t) in enumerate(ODD)]
    got = {r["doc_id"]: r for r in rules.quality_rules(docs_of(cases)).collect()}
    rates, groups = {}, {}
    for i, t, lang, source in cases:
        n, chars, symbols, dup, repeat = rules.base_counts(t)
        assert tuple(got[i][c] for c in rules.BASE) == (n, chars, symbols, dup, repeat) and got[i]["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        if not got[i]["base_failed"]:
            lines_ = (t or "").count("\n") + 1
            rates[i] = {"symbol_rate": symbols / n, "dup_line_rate": dup / lines_, "repeat_rate": repeat / n, "chars_a_word": chars / n}, {"symbol_rate": symbols**0.5 / n, "dup_line_rate": dup**0.5 / lines_, "repeat_rate": repeat**0.5 / n}
            for g in ((lang, source), (lang,), ()):
                groups.setdefault(g, []).append(i)
    fences = {g: brute_fences({c: [rates[i][0][c] for i in own] for c in rules.RULES}, rules.RULES) for g, own in groups.items()}

    def lean(g, c, side):
        if g == ():
            return fences[g][c][side]
        return (len(groups[g]) * fences[g][c][side] + 50 * lean(g[:-1], c, side)) / (len(groups[g]) + 50)

    for i, _, lang, source in cases:
        want = not got[i]["base_failed"] and all(rates[i][0][c] - 3 * rates[i][1].get(c, 0) <= lean((lang, source), c, 1) for c in rules.RULES) and rates[i][0]["chars_a_word"] >= lean((lang, source), "chars_a_word", 0)
        assert got[i]["kept"] == want, i
    assert not got[9000]["kept"] and not got[9001]["kept"] and got[9002]["n_words"] == 120
    # a group of wider spread has wider fences
    assert lean(("en", "b"), "chars_a_word", 1) > lean(("en", "a"), "chars_a_word", 1) + 0.5
    assert rules.base_counts("a b c a b c d\na b\n\n\na b\n #x") == (12, 13, 1, 1, 6) and rules.base_counts("a a a a") == (4, 4, 0, 0, 4)
    assert rules.quality_rules(docs_of(cases).limit(0)).count() == 0
    assert not any(r["kept"] for r in rules.quality_rules(docs_of([(1, "few words"), (2, None)])).collect())


def test_language(docs_of):
    train = [(i, "the cat and the dog are here with them", "en", "s") for i in range(30)] + [(100 + i, "der hund und die katze sind hier mit ihnen", "de", "s") for i in range(30)]
    asked = [(900, "the doghouse", None, "s"), (901, "Katzenhund", None, "s"), (902, "123 !", None, "s"), (903, None, None, "s"), (904, "THE AND " * 20_000, None, "s"), (905, "中", None, "s")]
    got = {r["doc_id"]: r for r in langid.identify(docs_of(train + asked), F.lit(True)).collect()}
    assert [got[i]["lang_pred"] for i in (900, 901, 902, 903, 904)] == ["en", "de", "und", "und", "en"]
    assert got[902]["score"] == 0 and all(0 <= r["score"] <= 1 for r in got.values())
    assert [langid.words_of(t) for t in ("Ab-c\u00e9", "\u00bd\u00b2", "x\u2167y", "\u2460", "it's", "\u4e2d\u6587")] == [["ab", "c\u00e9"], [], ["x", "y"], [], ["it", "s"], ["\u4e2d\u6587"]]
    signs = langid.identify(docs_of(train + [(999, "\u00bd \u00b2 \u2167", None, "s")]), F.lit(True)).where("doc_id = 999").collect()
    assert signs[0]["lang_pred"] == "und" and signs[0]["score"] == 0
    unlabelled = langid.identify(docs_of([(1, "hello", None, "s")]), F.lit(True)).collect()
    assert unlabelled[0]["lang_pred"] == "und"
    assert langid.identify(docs_of(train).limit(0), F.lit(True)).count() == 0


def test_language_brute(docs_of):
    """The backoff score, written out."""
    rng = np.random.default_rng(15)
    made = lambda letters: ["".join(rng.choice(list(letters), int(rng.integers(2, 7)))) for _ in range(60)]
    own = {"aa": made("abcde"), "bb": made("cdefg")}
    train = [(i, " ".join(rng.choice(own[lang], 30)), lang, "s") for i in range(40) for lang in own]
    asked = [(900 + i, ", ".join([*rng.choice(own["aa"], 3), *made("bcdefgz")[:6]]), None, "s") for i in range(30)]
    got = {r["doc_id"]: r for r in langid.identify(docs_of(train + asked), F.lit(True)).collect()}
    counts = {(n, x): {} for n in (0, 4, 3, 2, 1) for x in own}
    pieces = lambda w, n: list(w) if n == 1 else [f" {w} "[i : i + n] for i in range(len(w) + 3 - n)]
    for _, t, lang, _ in train:
        for w in t.split():
            counts[0, lang][w] = counts[0, lang].get(w, 0) + 1
            for n in (4, 3, 2, 1):
                for g in pieces(w, n):
                    counts[n, lang][g] = counts[n, lang].get(g, 0) + 1

    def log(n, g, lang):
        kinds = len(set(counts[n, "aa"]) | set(counts[n, "bb"]))
        return math.log((counts[n, lang].get(g, 0) + 0.5) / (sum(counts[n, lang].values()) + 0.5 * (kinds + 1)))

    for i, t, _, _ in asked:
        words, z = t.split(", "), {}
        for lang in own:
            z[lang] = 0.0
            for w in words:
                n, found = next((n, f) for n in (0, 4, 3, 2, 1) if (f := [g for g in ([w] if n == 0 else pieces(w, n)) if any(g in counts[n, x] for x in own)]))
                z[lang] += sum(log(n, g, lang) for g in found) / len(found)
        p = {x: math.exp((v - max(z.values())) / math.sqrt(len(words))) for x, v in z.items()}
        assert got[i]["lang_pred"] == max(p, key=p.get) and got[i]["score"] == pytest.approx(max(p.values()) / sum(p.values()), abs=1e-4)


def labelled(spark, docs_of, bad):
    rng = np.random.default_rng(7)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    cases, marks = [], []
    for i in range(600):
        words = list(rng.choice(vocabulary, 60))
        if i % 5 == 0:
            words = bad(words, rng)
        cases.append((i, " ".join(" ".join(words[k : k + 12]) + "." for k in range(0, 60, 12))))
        marks.append((i, int(i % 5 == 0)))
    return docs_of(cases + [(1000 + (i or 9), t) for i, t in ODD]), spark.createDataFrame(marks + [(3, None), (None, 1)], "doc_id long, toxic int")


def test_toxicity(spark, docs_of):
    def bad(words, rng):
        words[int(rng.integers(0, 60))] = "scoundrel"
        return words

    docs, labels = labelled(spark, docs_of, bad)
    model = toxicity.train(docs, labels, F.col("doc_id") < 400)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i in range(600):
        assert (got[i]["score"] >= 0.7) == (i % 5 == 0), i
        if i % 5 == 0:
            assert any("scoundrel" in text[i][s["start"] : s["end"]] for s in got[i]["spans"]) and len(got[i]["spans"]) == 1
    assert got[1001]["score"] == got[1002]["score"] == 0
    assert toxicity.score(docs.limit(0), model).count() == 0
    none = toxicity.train(docs, labels.limit(0), F.lit(True))
    assert toxicity.score(docs, none).count() == docs.count()
    assert toxicity.noisy_or(np.array([0.5, 0.5])) == pytest.approx(0.75)
    assert toxicity.train(docs.limit(0), labels, F.lit(True)).weight == {}
    text = "One two. Two?!  three-four\n\n... \u00e9\u00c9, a_b"
    assert [(text[a:b], w) for a, b, w in toxicity.sentences(text, toxicity.Words())] == [("One two", {"one", "two"}), (" Two", {"two"}), ("  three-four", {"three", "four"}), (" \u00e9\u00c9, a_b", {"\u00e9\u00e9", "a", "b"})]


def test_toxicity_brute():
    """Loss and slope of the noisy-or at the fitted weights, by differences, and a score written out."""
    rng = np.random.default_rng(16)
    docs = [[list(rng.choice(6, int(rng.integers(0, 4)), replace=False)) for _ in range(int(rng.integers(1, 5)))] for _ in range(80)]
    y = np.array([float(any(0 in s for s in d)) for d in docs])
    sizes = np.array([len(s) for d in docs for s in d])
    ids = np.array([i for d in docs for s in d for i in s])
    x = toxicity.fit(y, np.array([len(d) for d in docs]), sizes, ids, 6, 2000, 0.05, 1e-3)

    def loss(x):
        p = [1 - np.prod([1 - 1 / (1 + math.exp(-(x[-1] + sum(x[i] for i in s)))) for s in d]) for d in docs]
        return np.mean([-math.log(p) if t else -math.log(1 - p) for p, t in zip(p, y)]) + 5e-4 * (x[:-1] ** 2).sum()

    slope = [(loss(x + 1e-5 * e) - loss(x - 1e-5 * e)) / 2e-5 for e in np.eye(7)]
    assert np.abs(slope).max() < 2e-3 and x[0] > 2 and loss(x) < loss(np.zeros(7)) / 3


def test_quality(spark, docs_of):
    docs, labels = labelled(spark, docs_of, lambda words, rng: [w.upper() + "!!" for w in words])
    graded = labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("doc_id") % 2 == 0, 1).otherwise(2).alias("grade"))
    model = quality.train(docs, graded, F.col("doc_id") < 400)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = {r["doc_id"]: r for r in quality.grades(docs, model).collect()}
    assert all((got[i]["tails"][0] < 0.5) == (i % 5 == 0) and got[i]["tails"][0] >= got[i]["tails"][1] for i in range(600))
    kept = quality.select_documents(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} & set(range(600)) == {i for i in range(600) if i % 5}
    assert quality.select_documents(docs, quality.train(docs, graded.limit(0), F.lit(True))).count() == docs.count()


def test_quality_brute(docs_of):
    """The cumulative-link loss at the fitted weights has no slope, by differences; tails written out."""
    rng = np.random.default_rng(17)
    x = rng.random((120, 4)) * (rng.random((120, 4)) < 0.7)
    grade = np.clip((x @ np.array([4.0, -3.0, 2.0, 0.0]) + rng.normal(0, 0.5, 120)).round().astype(int), 0, 2)
    doc_of, ids = np.nonzero(x)
    model = quality.fit(grade, doc_of, ids, x[doc_of, ids], 3, 3000, 0.05, 1e-3)
    weigh = 1 / np.sqrt(np.bincount(grade) / 120 * 3)[grade]

    def loss(w, t):
        tail = 1 / (1 + np.exp(-((x @ w)[:, None] - t)))
        p = np.hstack([np.ones((120, 1)), tail])[np.arange(120), grade] - np.hstack([tail, np.zeros((120, 1))])[np.arange(120), grade]
        return np.mean(-weigh * np.log(p)) + 5e-4 * (w**2).sum()

    w, t = model.weight[:4].astype(float), model.thresholds
    slope = [(loss(w + 1e-4 * e, t) - loss(w - 1e-4 * e, t)) / 2e-4 for e in np.eye(4)] + [(loss(w, t + 1e-4 * e) - loss(w, t - 1e-4 * e)) / 2e-4 for e in np.eye(2)]
    assert np.abs(slope).max() < 2e-3 and t[0] < t[1]
    own = quality.Model(rng.normal(size=1 << 16), np.array([-1.0, 1.0]))
    cases = [(1, "Some WORDS here!!\nand 12 more more"), *[(10 + i, t) for i, (_, t) in enumerate(ODD)]]
    for r in quality.grades(docs_of(cases), own).collect():
        found, values = quality.features(dict(cases)[r["doc_id"]], quality.Tokens())
        z = float(own.weight[found] @ np.array(values, dtype=np.float32))
        assert r["tails"] == pytest.approx([1 / (1 + math.exp(-z + c)) for c in (-1, 1)], abs=1e-6) and r["expected_grade"] == pytest.approx(sum(r["tails"]))
    assert quality.grades(docs_of(cases).limit(0), own).count() == quality.select_documents(docs_of(cases).limit(0), own).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p>a{}</style><script>var x="<p>no</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li>Menu<li>More</ul></nav><div class="cookie-notice">Accept</div>
<article><header><h1>Head &amp; more</h1></header><p>First   <b>bold</b>
line<br>next<p>Second &eacute;&#x20AC;<div class="ad">Buy</div><table><tr><td>a<td>b</table><ul><li>one<li>two</ul>
<section id="comments"><p>I disagree</p></section><form>x</form></article><aside>Side</aside><footer>Foot</footer></body></html>"""


def test_html_rules():
    assert html.main_text(PAGE) == "Head & more\nFirst bold line next\nSecond é€\na b\none\ntwo"
    assert html.main_text(None) == html.main_text("") == html.main_text("<!-- x -->") == ""
    assert html.main_text("plain  text") == "plain text"
    assert html.main_text('<div class="layout has-sidebar"><div class="sidebar">x</div><article><div class="post-header"><h1>T</h1></div><p>a</p></article></div>') == "T\na"
    assert html.main_text('<div class="page with-sidebar"><p>some longer text of the page</p></div><div class="sidebar">x</div>') == "some longer text of the page"
    assert html.main_text('<article><pre><span class="comment"># code</span></pre></article><section class="comments"><article>me</article></section>') == "# code"
    assert html.main_text("<p>a<p>b</p>c") == "a\nb\nc"
    assert html.main_text("<div>" * 5000 + "deep") == "deep"
    assert html.main_text("a < b <p title='>'>c</p>") == "a < b\nc"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<article><h1>T</h1><div class="entry-content no-sidebar"><p>one</p><p>two</p></div></article>', "T\none\ntwo"),
        ('<article class="post comments-open"><h1>T</h1><div class="post comments-open"><p>one</p></div></article>', "T\none"),
        ('<main><div class="with-sidebar"><p>one</p></div></main>', "one"),
        ('<article><p class="share-price">Price</p><h2 class="related-work">Work</h2><p>x</p></article>', "Price\nWork\nx"),
        ('<main><div class="content-sidebar-wrap"><p>one long text of the page</p></div><div class="related-posts"><p>more</p></div></main>', "one long text of the page"),
        ('<article><p>short</p><div class="comments-area"><p>a much longer remark of a reader</p></div><div class="share-buttons">Share</div></article>', "short"),
        ('<div class="site-header">S</div><div class="main-nav">N</div><p>body of the text</p><div id="site-footer">F</div><p class="ad">A</p>', "body of the text"),
        ('<article class="widget"><p>one</p></article>', "one"),
        ('<main class="sidebar"><div class="widget"><p>all there is</p></div></main>', "all there is"),
    ],
)
def test_html_layouts(page, want):
    """Names of layouts, and what only sounds like furniture, leave the article whole."""
    assert html.main_text(page) == want


def test_html_query(spark):
    """The registered query against a count of subtrees page by page."""
    from keyloom.llm.queries import QUERIES

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    count, sizes = {}, {}
    host = lambda u: (u or "").split("://")[-1].split("/")[0].lower() if "://" in (u or "") else ""
    for r in pages:
        sizes[host(r["url"])] = sizes.get(host(r["url"]), 0) + 1
        for h in set(html.outline(r["html"])[1]):
            count[host(r["url"]), h] = count.get((host(r["url"]), h), 0) + 1
    gone = {k for k, n in count.items() if n >= max(8, min(0.2 * sizes[k[0]], 4 * sizes[k[0]] ** 0.5))}
    want = sorted((r["page_id"], r["url"], html.main_text(r["html"], {h for x, h in gone if x == host(r["url"])})) for r in pages)
    got = sorted((r["page_id"], r["url"], r["text"]) for r in QUERIES["op5_extract_html"](spark, "/root/testdata/sf0.01").collect())
    assert got == want


def test_html_large_host(spark):
    """Menus of sections, each on a twentieth of a large host's pages, go, by either way of joining; a small host's rare ones stay."""
    body = "<html><body><div class=x{s}><b>Section {s}</b></div><div><p>Story {i} of {i}</p></div></body></html>"
    cases = [(i, f"http://a.example/{i}", body.replace("{i}", str(i)).replace("{s}", str(i % 20))) for i in range(8000)] + [(9000 + i, f"http://b.example/{i}", body.replace("{i}", str(i)).replace("{s}", str(i % 2))) for i in range(14)]
    pages = spark.createDataFrame(cases, "page_id long, url string, html string")
    for rows_ in (html.BROADCAST_ROWS, 3):
        html.BROADCAST_ROWS, before = rows_, html.BROADCAST_ROWS
        got = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
        html.BROADCAST_ROWS = before
        assert all(got[i] == f"Story {i} of {i}" for i in range(8000)) and all(got[9000 + i] == f"Section {i % 2}\nStory {i} of {i}" for i in range(14))


def test_html_templates(spark):
    body = "<html><body><div><span>Our site, since 1999</span></div><div><p>Story {i} of {i}</p></div><div><p>Read {i}</p></div></body></html>"
    cases = [(i, f"http://a.example/{i}", body.replace("{i}", str(i))) for i in range(20)] + [(99, "http://b.example/x", body.replace("{i}", "9")), (100, None, None), (101, "bad", ""), (99, "http://b.example/x", body.replace("{i}", "9"))]
    pages = spark.createDataFrame(cases, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(rows(html.extract(pages)), key=str)
    want = [(i, u, "" if not h else (f"Story {i} of {i}\nRead {i}" if i < 20 else "Our site, since 1999\nStory 9 of 9\nRead 9")) for i, u, h in cases]
    assert [r[:3] for r in got] == sorted(want, key=str) and all(r[3] == len(r[2]) for r in got)
    assert html.extract(pages.limit(0)).count() == 0


def brute_vectors(x, threshold=0.95):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = unit @ unit.T >= threshold
    return hit.sum(1) - 1, local_roots(*np.nonzero(hit), len(x))


def check_vectors(spark, x, **options):
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df, recall=1.0, **options).collect()}
    links, root = brute_vectors(x)
    assert [got[i]["n_links"] for i in range(len(x))] == links.tolist() and [got[i]["component_id"] for i in range(len(x))] == root.tolist()
    return links, root


def test_vectors_touching_groups(spark):
    """Dense groups whose links to each other no list can hold, wide groups of many rings, and pairs at the very threshold."""
    rng = np.random.default_rng(18)
    axes = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    near = lambda c, n, noise: c + noise * rng.standard_normal((n, 64)) / 8
    other = 0.955 * axes[0] + math.sqrt(1 - 0.955**2) * axes[1]
    links, root = check_vectors(spark, np.concatenate([near(axes[0], 300, 0.02), near(other, 300, 0.02)]))
    assert links.min() == 599 or links.mean() > 590 and len(set(root.tolist())) == 1
    chain = [math.cos(a) * axes[3] + math.sin(a) * axes[4] for a in np.linspace(0, 1.5, 200)]
    pairs = np.concatenate([(c, 0.9501 * c + math.sqrt(1 - 0.9501**2) * d, 0.9499 * c - math.sqrt(1 - 0.9499**2) * d) for c, d in ((axes[i], axes[i + 1]) for i in range(10, 50, 3))])
    links, root = check_vectors(spark, np.concatenate([near(axes[5], 500, 0.22), near(axes[7], 150, 0.2), chain, pairs, rng.standard_normal((300, 64))]))
    assert links.max() > 200 and len(set(root.tolist())) > 300


def test_vectors_block_pairs(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 48)
    rng = np.random.default_rng(19)
    c = rng.standard_normal((3, 32))
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    check_vectors(spark, np.concatenate([x + s * rng.standard_normal((n, 32)) / math.sqrt(32) for x, s, n in zip(c, (0.05, 0.2, 0.3), (150, 150, 60))]), k=6)


def test_vectors(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((120, 16))
    many = np.concatenate([base, base[:30] + 0.05 * rng.standard_normal((30, 16)), np.repeat(base[:1], 40, axis=0), base[5] + 0.03 * rng.standard_normal((60, 16)), base[:4] * 1e-200, base[:2] * 1e150])
    cases = [(i, [float(v) for v in x]) for i, x in enumerate(many)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [1.0, None]), (905, [float("inf")] + [0.0] * 15), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (907, [2.0, 4.0])]
    df = spark.createDataFrame(cases + odd, "vec_id long, embedding array<double>").withColumn("node", F.lit(1))
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 16)
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df, k=6).collect()}
    scaled = many / np.abs(many).max(axis=1, keepdims=True)
    unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    a, b = np.nonzero(hit)
    root = local_roots(a, b, len(many))
    assert [got[i]["n_links"] for i in range(len(many))] == (hit.sum(1) - 1).tolist()
    assert [got[i]["component_id"] for i in range(len(many))] == root.tolist()
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i for i in range(900, 906))
    assert got[906]["n_links"] == 2 and got[907]["component_id"] == 906
    assert vectors.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_vectors_isolated_pairs(spark, seed):
    """Pairs just over the threshold among many vectors that nothing leads to: all are found, and the recall says what was measured."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((30_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(60):
        off = x[i] - (x[i] @ x[1000 + i]) * x[1000 + i]
        x[i] = 0.952 * x[1000 + i] + math.sqrt(1 - 0.952**2) * off / np.linalg.norm(off)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = vectors.near_duplicates(df).where("n_links > 0").collect()
    assert {(r["vec_id"], r["component_id"]) for r in got} == {(j, i) for i in range(60) for j in (i, 1000 + i)}
    assert all(r["n_links"] == 1 and r["audited_recall"] >= 0.999 for r in got)


def test_vectors_without_links(spark):
    """Where nothing measured has a link, no recall is claimed."""
    df = spark.createDataFrame([(i, [float(i == j) for j in range(40)]) for i in range(40)], "vec_id long, embedding array<double>")
    assert {(r["n_links"], r["audited_recall"]) for r in vectors.near_duplicates(df).collect()} == {(0, None)}


def test_training_rows_with_clashing_names(docs_of, spark):
    """Columns of the documents under any name, the operators' own ones among them, don't matter."""
    docs = docs_of([(i, f"text {i}") for i in range(20)]).withColumns({"_kl_id": F.lit(1), "_kl_label": F.lit(2), "_kl_doc": F.lit(3), "label": F.lit(4)})
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, toxic int").withColumn("text", F.lit("x"))
    got = toxicity.training_rows(docs, labels, F.lit(True), 100, "doc_id", "text", "toxic")
    assert sorted(rows(got)) == sorted((i % 2, f"text {i}") for i in range(10))
