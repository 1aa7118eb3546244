"""Similar texts: BK-trees over SimHash in shards of one shingle, then an exact look at every pair that shares a shard.

At a Jaccard similarity of 0.8, fingerprints differ in about 10 of 64 bits and in more than any radius now and then. So the
trees find what they can, and the pairs that they leave are looked at in shards that every similar pair shares.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from keyloom.llm.common import cut, map_texts, small_enough, type_of
from keyloom.llm.components import connected_components, local_roots
from keyloom.llm.simhash import BKForest, deal, fingerprint_of, shingle_hashes

#: Rows of the largest shard that one task compares, and pairs that it holds at once, about.
SHARD_ROWS = 1024
PAIRS = 2_000_000
#: Rows that a sample of texts has for the order of shingles, texts in it that make a shingle frequent, and such shingles at most.
SAMPLE_ROWS = 20_000
FREQUENT_TEXTS = 3
FREQUENT = 200_000
#: Rows that are broadcast at most.
BROADCAST_ROWS = 500_000


def keys(hashes: np.ndarray, similarity: float, frequent: np.ndarray) -> np.ndarray:
    """The first elements of a set of sorted shingle hashes; two sets of ``similarity`` or more have one of them in common.

    Of n elements, at least ``similarity`` n are in a similar set too. So if all sets are in one order, and each gives one
    element more than those it may have to itself, two similar ones share the first that they have in common. The order is
    by hash with ``frequent`` elements last: those name large shards, and any choice of them gives the same result.
    """
    if not len(hashes):
        return np.empty(0, dtype=np.int64)
    own = len(hashes) - math.ceil(similarity * len(hashes) - 1e-9) + 1
    if len(frequent):
        last = frequent[np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)] == hashes
        hashes = np.concatenate((hashes[~last], hashes[last]))
    return hashes[:own].view(np.int64)


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def joined(a: np.ndarray, b: np.ndarray, n: int, similar) -> tuple[np.ndarray, np.ndarray]:
    """Of the links (a[i], b[i]), a set of similar ones that joins all that the similar ones join.

    Each round, every group of joined nodes looks at one link to another group. A link inside a group needs no look.
    """
    root = np.arange(n)
    kept_a, kept_b = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    while len(a):
        _, first = np.unique(root[a], return_index=True)
        good = first[[similar(a[i], b[i]) for i in first]]
        rest = np.ones(len(a), dtype=bool)
        rest[first] = False
        if len(good):
            kept_a.append(a[good])
            kept_b.append(b[good])
            root = local_roots(np.concatenate(kept_a), np.concatenate(kept_b), n)
        rest &= root[a] != root[b]
        a, b = a[rest], b[rest]
    return np.concatenate(kept_a), np.concatenate(kept_b)


def parity(hashes: np.ndarray) -> np.ndarray:
    """A set's parity map: which values of the low bits an odd number of elements has, in words of 64 bits.

    Two maps of one length differ in no more bits than the sets in elements. A map has two to four bits an element, and
    folds to any shorter length, so it tells almost all sets apart that are not nearly similar, at a thirtieth of their size.
    """
    bits = 64 << max(int(len(hashes) // 32).bit_length(), 0)
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(maps: np.ndarray, words: int) -> np.ndarray:
    """Rows of parity maps folded to ``words`` words."""
    return np.bitwise_xor.reduce(maps.reshape(len(maps), -1, words), axis=1)


def _near(similarity: float):
    """Rows of a shard whose set may be similar to one of another group there, by sizes and parity maps."""

    def run(table: pa.Table) -> pa.Table:
        _, tree = np.unique(np.stack([table.column("shard").to_numpy(), table.column("piece").to_numpy()]), axis=1, return_inverse=True)
        order = np.argsort(tree, kind="stable")
        tree, root, size = tree[order], table.column("root").to_numpy()[order], table.column("size").to_numpy()[order].astype(np.int64)
        maps = [np.frombuffer(x, dtype=np.uint64) for x in table.column("parity").take(pa.array(order)).to_pylist()]
        words = np.array([len(x) for x in maps])
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(tree)) + 1, [len(tree)]))
        flagged = np.zeros(len(tree), dtype=bool)
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            for w in np.unique(words[low:high]):
                # at this length: all maps of it or longer; sets of sizes that allow similarity are at most twice as long
                at = low + np.flatnonzero((words[low:high] == w) | (words[low:high] == 2 * w))
                folded = np.concatenate([fold(maps[i][None, :], int(w)) for i in at])
                for k in np.flatnonzero(words[at] == w):
                    i = at[k]
                    near = (root[at] != root[i]) & (np.minimum(size[at], size[i]) >= similarity * np.maximum(size[at], size[i]) - 1e-6)
                    if near.any():
                        apart = np.bitwise_count(folded[near] ^ folded[k]).sum(axis=1, dtype=np.int64)
                        hit = np.flatnonzero(near)[apart <= (1 - similarity) / (1 + similarity) * (size[at[near]] + size[i]) + 1e-6]
                        if len(hit):
                            flagged[at[hit]] = flagged[i] = True
        own = table.select(["shard", "node", "root"]).take(pa.array(order[flagged]))
        return own

    return run


def _links(similarity: float, radius: int, every: bool):
    """Links of similar nodes of different groups, by trees, and with ``every`` by a look at all other pairs of a shard too."""

    def run(table: pa.Table) -> pa.Table:
        _, tree = np.unique(np.stack([table.column("shard").to_numpy(), table.column("piece").to_numpy()]), axis=1, return_inverse=True)
        order = np.lexsort((table.column("node").to_numpy(), tree))
        tree, node = tree[order], table.column("node").to_numpy()[order]
        value = table.column("fp").to_numpy().view(np.uint64)[order]
        lists = table.column("shingles").combine_chunks()
        flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        size = np.diff(offsets)[order]
        start = offsets[:-1][order]

        def similar(i: int, j: int) -> bool:
            return jaccard(flat[start[i] : start[i] + size[i]], flat[start[j] : start[j] + size[j]]) >= similarity

        # rows of a node, and those of a group that earlier rounds joined, are joined from the start
        name, first, which = np.unique(node, return_index=True, return_inverse=True)
        group, at = np.unique(table.column("root").to_numpy()[order][first], return_inverse=True)
        least = np.full(len(group), len(name))
        np.minimum.at(least, at, np.arange(len(name)))
        root = least[at]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(tree)) + 1, [len(tree)]))
        part = np.cumsum(np.diff(cuts).astype(np.int64) ** 2) // PAIRS
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            low, high = cuts[own[0]], cuts[own[-1] + 1]
            a, b = BKForest(tree[low:high], value[low:high]).links(np.arange(high - low), radius)
            a, b = a + low, b + low
            # sets whose sizes alone keep them apart need no look
            near = (np.minimum(size[a], size[b]) >= similarity * np.maximum(size[a], size[b]) - 1e-6) & (root[which[a]] != root[which[b]])
            a, b = joined(a[near], b[near], len(node), similar)
            found.append((a, b))
            pairs = np.concatenate((root, which[a])), np.concatenate((np.arange(len(name)), which[b]))
            root = local_roots(*pairs, len(name))
        a, b = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        if every:
            more = _rest(cuts, which, root, size, similarity, similar)
            a, b = np.append(a, more[:, 0]), np.append(b, more[:, 1])
        return pa.table({"a": node[a], "b": node[b]})

    return run


def _rest(cuts, which, root, size, similarity: float, similar) -> np.ndarray:
    """Rows of similar nodes that no link joins yet, of all pairs of each shard; ``root`` follows what is found."""
    found: list[tuple[int, int]] = []
    seen: set[tuple[int, int]] = set()
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        for i in range(low, high - 1):
            others = np.arange(i + 1, high)
            others = others[root[which[others]] != root[which[i]]]
            for j in others[np.minimum(size[others], size[i]) >= similarity * np.maximum(size[others], size[i]) - 1e-6].tolist():
                x, y = int(which[i]), int(which[j])
                if root[x] == root[y] or (x, y) in seen:
                    continue
                if similar(i, j):
                    found.append((i, j))
                    root[root == root[y]] = root[x]
                elif len(seen) < PAIRS:
                    seen.add((x, y))
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def frequent_shingles(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> np.ndarray:
    """Sorted hashes of shingles in FREQUENT_TEXTS different texts or more of a sample of about SAMPLE_ROWS rows; at most FREQUENT of them."""

    def hashes(b: pa.RecordBatch) -> pa.RecordBatch:
        h = [np.unique(shingle_hashes(t.as_py(), shingle)) for t in b.column(0)]
        names = np.array([xxh64_intdigest(x.tobytes()) for x in h], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array([x.view(np.int64) for x in h], pa.list_(pa.int64()))], ["node", "shingles"])

    share = min(1.0, SAMPLE_ROWS / max(docs.count(), 1))
    sample = docs.where(F.pmod(F.xxhash64(id_col, text_col, F.lit(3)), F.lit(1 << 40)) < int(share * (1 << 40)))
    each = map_texts(sample, [text_col], "node bigint, shingles array<bigint>", hashes).select("node", F.explode("shingles").alias("h")).distinct()
    counted = each.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT_TEXTS)
    return np.sort(counted.orderBy(F.col("n").desc(), "h").limit(FREQUENT).select("h").toArrow().column("h").to_numpy().view(np.uint64))


def _dealt(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (``shard, n, node, root, ...``) in groups ``g`` of pieces, so that nodes of two groups of a shard meet in one.

    A large shard is nearly one group that earlier rounds joined: that group is sliced, and the few other rows go to every
    slice. Where the others are many, ``deal`` makes a piece of each pair of slices.
    """
    names = [c for c in rows.columns if c != "n"]
    large = rows.where(F.col("n") > SHARD_ROWS).groupBy("shard", "root").agg(F.count(F.lit(1)).alias("own")).groupBy("shard").agg(F.max(F.struct("own", "root")).alias("top"), F.sum("own").alias("all"))
    large = cut(large.select("shard", F.col("top.root").alias("main"), (F.col("all") - F.col("top.own")).alias("others"), F.ceil(F.col("top.own") / SHARD_ROWS).cast("int").alias("slices")).where(F.col("others") <= SHARD_ROWS))
    known = rows.join(small_enough(large, BROADCAST_ROWS), "shard", "left")
    mine = F.array(F.pmod(F.xxhash64("node"), F.col("slices")).cast("long"))
    sliced = known.where(F.col("main").isNotNull()).withColumn("piece", F.explode(F.when(F.col("root") == F.col("main"), mine).otherwise(F.sequence(F.lit(0).cast("long"), F.col("slices").cast("long") - 1))))
    sliced = sliced.select(*names, "piece", F.concat_ws("/", F.lit("s"), "shard", "piece").alias("g"))
    return deal(known.where(F.col("main").isNull()).select(*names), total, SHARD_ROWS, 16 * SHARD_ROWS).select(*names, "piece", "g").unionByName(sliced)


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = 22
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``component_id``, the smallest id reachable over links of similar texts.

    Texts are similar where the Jaccard similarity of their sets of ``shingle``-word shingles, by 64-bit hashes, is
    ``similarity`` or more; words and case as for fingerprints. Equal sets are one node. First, nodes meet in the shard of
    the first of their ``keys``: BK-trees find fingerprints within ``radius`` bits, for which the exact similarity
    decides, for one link between two groups at a time, so that a group of copies costs a few looks for each member. A
    large shard goes slice by slice, then by one node of each group found. Then nodes meet by all of their ``keys``, of
    which similar ones share one. A shard whose nodes are one group by now is done; in the others trees go first again,
    and then every pair of different groups is looked at, so that no link between groups is lost.

    That look goes by sizes and parity maps first, so that sets are sent only where one may be similar to another.

    Null, empty and wordless texts are one node. Rows with a null id take part and get the component's id, or null if no
    row there has an id. Repeated rows give repeated rows; an empty table gives none; other columns are ignored.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, id_col, text_col, shingle))

    def prints_of(b: pa.RecordBatch) -> pa.RecordBatch:
        names, prints, first, sizes, maps = [], [], [], [], []
        for t in b.column(1):
            h = np.unique(shingle_hashes(t.as_py(), shingle))
            names.append(xxh64_intdigest(h.tobytes()))
            prints.append(fingerprint_of(h))
            first.append(int(keys(h, similarity, frequent.value)[0]) if len(h) else None)
            sizes.append(len(h))
            maps.append(parity(h).tobytes())
        ids = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (names, prints)]
        return pa.RecordBatch.from_arrays([b.column(0), *ids, pa.array(first, pa.int64()), pa.array(sizes, pa.int32()), pa.array(maps, pa.binary())], ["doc_id", "node", "fp", "shard", "size", "parity"])

    def lists_of(make):
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            h = [np.unique(shingle_hashes(t.as_py(), shingle)) for t in b.column(0)]
            names = np.array([xxh64_intdigest(x.tobytes()) for x in h], dtype=np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array([make(x) for x in h], pa.list_(pa.int64()))], ["node", "items"])

        return run

    def lists(rows: DataFrame, make) -> DataFrame:
        return map_texts(rows, [text_col], "node bigint, items array<bigint>", lists_of(make)).groupBy("node").agg(F.first("items").alias("items"))

    def sets(met: DataFrame) -> DataFrame:
        """``node, shingles`` of the nodes of ``met``, from one row of each, by its id."""
        wanted = small_enough(met.select(F.col("least").alias("_kl_id")).distinct(), BROADCAST_ROWS)
        own = docs.select(id_col, text_col)
        return lists(own.join(wanted, F.col(id_col).eqNullSafe(F.col("_kl_id")), "left_semi"), lambda x: x.view(np.int64)).withColumnRenamed("items", "shingles")

    def linked(dealt: DataFrame, every: bool) -> DataFrame:
        rows = dealt.select("node", "fp", "root", "shingles", "shard", "piece", "g")
        return rows.groupBy("g").applyInArrow(_links(similarity, radius, every), "a bigint, b bigint").distinct()

    prints = cut(map_texts(docs, [id_col, text_col], f"doc_id {type_of(docs, id_col)}, node bigint, fp bigint, shard bigint, size int, parity binary", prints_of))
    nodes = cut(prints.groupBy("node").agg(F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("fp", "shard", "size", "parity")]))
    # the first key: slices, then one node of each group of a sliced shard
    shards = cut(nodes.where("shard is not null").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = cut(nodes.drop("size", "parity").join(shards, "shard").withColumn("root", F.col("node")))
    slices = F.ceil(F.col("n") / SHARD_ROWS).cast("int")
    held = cut(met.join(sets(met), "node").withColumn("piece", F.pmod(F.xxhash64("node"), slices).cast("long")))
    small = F.pmod(F.xxhash64("shard"), F.lit(met.count() // (16 * SHARD_ROWS) + 32))
    links = cut(linked(held.withColumn("g", F.when(F.col("n") > SHARD_ROWS, F.concat_ws("/", "shard", "piece")).otherwise(F.concat(F.lit("g"), small))), False))
    large = held.where(F.col("n") > SHARD_ROWS)
    if large.take(1):
        parts = connected_components(links)
        heads = large.join(parts, "node", "left").withColumn("root", F.coalesce("component", "node")).groupBy("shard", "root").agg(F.min("node").alias("node"))
        heads = cut(large.drop("root", "piece").join(heads, ["shard", "node"]))
        again = deal(heads.select("node", "fp", "root", "shingles", "shard"), heads.count(), SHARD_ROWS, 16 * SHARD_ROWS)
        links = cut(links.unionByName(linked(again, False)).distinct())
    # all keys, in shards that still hold several groups; of those with the same nodes, one
    parts = cut(connected_components(links))
    shard = Window.partitionBy("shard")
    own = [F.count(F.lit(1)).over(shard).alias("n"), F.min("root").over(shard).alias("low"), F.max("root").over(shard).alias("high"), *[F.bit_xor(F.xxhash64("node", F.lit(k))).over(shard).alias(f"x{k}") for k in (0, 1)]]
    keyed = lists(docs, lambda x: keys(x, similarity, frequent.value)).join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("root"), F.explode("items").alias("shard"))
    mixed = cut(keyed.select("node", "root", "shard", *own).where("low < high").drop("low", "high"))
    # written, so that the joins shuffle both sides and Spark may split a shard that very many nodes share
    once = cut(mixed.groupBy("n", "x0", "x1").agg(F.min("shard").alias("shard")).select("shard"))
    met = cut(mixed.select("node", "root", "shard", "n").join(once, "shard"))
    dealt = _dealt(met.join(nodes.select("node", "size", "parity"), "node"), met.count())
    flagged = dealt.groupBy("g").applyInArrow(_near(similarity), "shard bigint, node bigint, root bigint").distinct()
    flagged = cut(flagged.select("node", "root", "shard", *own).where("low < high").drop("low", "high"))
    once = cut(flagged.groupBy("n", "x0", "x1").agg(F.min("shard").alias("shard")).select("shard"))
    met = cut(flagged.select("node", "root", "shard", "n").join(once, "shard").join(nodes.select("node", "least", "fp"), "node"))
    rest = _dealt(met.drop("least").join(sets(met), "node"), met.count())
    parts = connected_components(links.unionByName(cut(linked(rest, True))))
    of = nodes.join(parts, "node", "left").select("node", "least", F.coalesce("component", "node").alias("root"))
    names = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.select("doc_id", "node").join(of.join(names, "root").select("node", "component_id"), "node").select("doc_id", "component_id")
