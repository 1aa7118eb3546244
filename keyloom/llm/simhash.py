"""SimHash near-duplicates: 64-bit fingerprints linked through BK-trees."""

from __future__ import annotations

from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from keyloom.llm.common import cut, free_names, map_texts, type_of
from keyloom.llm.components import connected_components, local_roots

SEED = 42
#: Fingerprints that one forest of BK-trees compares at most; larger shards are compared slice by slice.
SHARD_ROWS = 8192
#: Rows in a group of small shards, on average.
GROUP_ROWS = 32_768


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Hashes of a text's shingles, repeats included; of the whole sequence if it is shorter, of none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < shingle:
        grams = [b" ".join(words)]
    elif shingle == 3:
        grams = [b"%b %b %b" % x for x in zip(words, words[1:], words[2:])]
    else:
        grams = [b" ".join(x) for x in zip(*(words[i:] for i in range(shingle)))]
    return np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), dtype=np.uint64, count=len(grams))


def fingerprint_of(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; 0 without any."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text; 0 where it has no word."""
    return fingerprint_of(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)`` per row of ``docs``, fp as a signed 64-bit number. ``bytes.lower`` and ``bytes.split`` touch ASCII alone."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fp"])

    return map_texts(docs, [id_col, text_col], f"doc_id {type_of(docs, id_col)}, fp bigint", batch)


class BKForest:
    """BK-trees over 64-bit values, one for each shard, as arrays.

    A node's children are keyed by their integer Hamming distance to it. All trees grow together, level by level: the
    first value that reaches a (parent, distance) edge becomes the child there and the others move on to it.
    """

    def __init__(self, shard: np.ndarray, value: np.ndarray) -> None:
        n = len(value)
        self.value = value
        _, first, inverse = np.unique(shard, return_index=True, return_inverse=True)
        self.root = first[inverse]
        parent, edge = np.full(n, -1), np.zeros(n, dtype=np.int64)
        at, left = self.root.copy(), np.setdiff1d(np.arange(n), first)
        while len(left):
            key = at[left] * 65 + np.bitwise_count(value[left] ^ value[at[left]])
            found, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            child = left[first]
            parent[child], edge[child] = found // 65, found % 65
            at[left] = child[inverse]
            left = np.delete(left, first)
        order = np.lexsort((edge, parent))
        self.child, self.key = order, (parent * 65 + edge)[order]

    def links(self, query: np.ndarray, radius: int, at_once: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node), query > node, within ``radius``: each query walks its tree along edges in reach."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        stack = [(query[i : i + at_once], self.root[query[i : i + at_once]]) for i in range(0, len(query), at_once)]
        while stack:
            q, node = stack.pop()
            d = np.bitwise_count(self.value[q] ^ self.value[node]).astype(np.int64)
            hit = (d <= radius) & (q > node)
            if hit.any():
                out.append((q[hit], node[hit]))
            low = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), side="right")
            n = high - low
            for s in _pieces(n, at_once):
                m = n[s]
                if total := int(m.sum()):
                    step = np.arange(total) - np.repeat(np.cumsum(m) - m, m)
                    stack.append((np.repeat(q[s], m), self.child[np.repeat(low[s], m) + step]))
        if not out:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def _pieces(n: np.ndarray, at_once: int) -> list[slice]:
    """Slices of ``n`` whose sums stay near ``at_once``."""
    upto = np.cumsum(n)
    if not len(n) or upto[-1] <= at_once:
        return [slice(0, len(n))]
    cuts = np.unique(np.concatenate(([0], np.searchsorted(upto, np.arange(at_once, upto[-1], at_once)) + 1, [len(n)])))
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def _shard_links(radius: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard").to_numpy()
        value = table.column("fp").to_numpy().view(np.uint64)
        # rows of one shard and piece side by side, so that trees and their queries keep to them
        piece = table.column("piece").to_numpy()
        order = np.lexsort((value, piece, shard))
        shard, piece, value = shard[order], piece[order], value[order]
        tree = np.concatenate(([0], np.cumsum((np.diff(shard) != 0) | (np.diff(piece) != 0))))
        a, b = BKForest(tree, value).links(np.arange(len(value)), radius)
        root = local_roots(a, b, len(value))
        kept = np.flatnonzero(root != np.arange(len(value)))
        return pa.table({"a": value[kept].view(np.int64), "b": value[root[kept]].view(np.int64)})

    return run


def deal(rows: DataFrame, total: int, most: int, together: int) -> DataFrame:
    """``rows`` with a column ``shard`` in groups ``g`` for one task each, with ``piece`` and ``slices``; lone rows of a shard go.

    Small shards share groups of ``together`` rows or so, of ``total`` in all. A shard of more than ``most`` rows is
    dealt into slices by a hash of ``node``, and each pair of slices is a piece and a group of its own, so that a dense
    shard spreads over many tasks of bounded memory.
    """
    counts = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slices = F.when(F.col("n") > most, F.ceil(F.col("n") / F.lit(most // 2)).cast("int")).otherwise(F.lit(1))
    mine = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    both = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda t: F.least(F.col("mine"), t) * F.col("slices") + F.greatest(F.col("mine"), t))
    group = F.when(F.col("slices") > 1, F.concat_ws("/", "shard", "piece")).otherwise(F.concat(F.lit("g"), F.pmod(F.xxhash64("shard"), F.lit(total // together + 32))))
    dealt = rows.join(counts, "shard").withColumn("slices", slices).withColumn("mine", mine).withColumn("piece", F.explode(both)).withColumn("piece", F.col("piece").cast("long"))
    return dealt.withColumn("g", group).drop("n", "mine", "slices")


def block_keys(fp: Column, radius: int, blocks: int) -> Column:
    """An array of shards of a fingerprint: the values of every choice of ``blocks - radius`` of its ``blocks`` blocks of bits.

    Values within ``radius`` bits differ in at most ``radius`` blocks, so they share a shard and no pair is lost. The more
    blocks, the more bits name a shard.
    """
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    keys = []
    for k, chosen in enumerate(combinations(masks, blocks - radius)):
        mask = sum(chosen)
        keys.append(F.xxhash64(fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")), F.lit(k)))
    return F.array(*keys)


def blocks_for(n: int, radius: int, most: int) -> int:
    """The fewest blocks with which ``n`` evenly spread fingerprints have ``most`` rows in a shard; ``radius`` + 3 at most."""
    for blocks in range(radius + 1, radius + 3):
        if n >> (64 * (blocks - radius) // blocks) <= most:
            return blocks
    return radius + 3


def fingerprint_links(distinct: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """Links ``(a, b)`` that join all of ``distinct.fp`` within ``radius`` bits of each other, a forest for each shard.

    The number of blocks, and with it that of shards, follows the number of fingerprints; any number gives the same links.
    """
    n = distinct.count()
    blocks = blocks or blocks_for(n, radius, SHARD_ROWS)
    keyed = distinct.select("fp", F.col("fp").alias("node"), F.explode(block_keys(F.col("fp"), radius, blocks)).alias("shard"))
    return deal(keyed, n * comb(blocks, radius), SHARD_ROWS, GROUP_ROWS).select("fp", "shard", "piece", "g").groupBy("g").applyInArrow(_shard_links(radius), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp`` and ``component_id``, the smallest id reachable over links.

    Texts link where their fingerprints differ in at most ``radius`` bits. Rows with equal fingerprints are one node,
    named by their smallest id, so a group of copies of any size costs one row in the search. A null or empty text has
    fingerprint 0 and links like any other; rows with a null id take part in a component and get its id, or null if no
    row there has an id. Repeated rows give repeated rows; an empty table gives none; other columns are ignored.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = cut(fingerprint_links(distinct, radius))
    parts = connected_components(links)
    # the component of a fingerprint is a fingerprint; its name is the smallest id among its members
    of = distinct.join(parts, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    names = of.groupBy("root").agg(F.min("least").alias("component_id"))
    final = of.join(names, "root").select("fp", "component_id")
    return prints.join(final, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group in ``found`` (``doc_id``, ``component_id``), that with the smallest id; groups without ids stay.

    Rows that repeat an id are one document: the first of those by a hash of the text, then by the other columns, is kept.
    Rows with a null id stay where no row of their group has one. An empty table gives no rows.
    """
    named = docs.columns
    own, n, r = free_names(docs, "id", "n", "r")
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias(own)).agg(F.count(F.lit(1)).alias(n))
    rows = docs.join(kept, F.col(id_col).eqNullSafe(F.col(own)))
    once = rows.where((F.col(n) == 1) | F.col(own).isNull())
    order = Window.partitionBy(own).orderBy(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), *[F.col(c) for c, t in docs.dtypes if t in ("string", "bigint", "int") and c != text_col])
    again = rows.where((F.col(n) > 1) & F.col(own).isNotNull()).withColumn(r, F.row_number().over(order)).where(F.col(r) == 1)
    return once.select(*named).unionByName(again.select(*named))
