"""The prefix trie of conversations: shards in balanced parentheses, with the spines that shards share merged after."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import cut
from keyloom.llm.conversations import positions

#: Turns of one piece of a conversation, parentheses pairs of one shard, and ids of one piece of a list of members.
BAND = 32
SHARD_NODES = 65_536
ID_CHUNK = 512


class Parentheses:
    """Ordered trees as balanced parentheses (1 opens), with the least excess of every block of ``BLOCK`` places in a tree of minima."""

    BLOCK = 128
    FAR = np.int32(2**31 - 1)

    def __init__(self, bits: np.ndarray) -> None:
        self.opens = np.flatnonzero(bits)
        excess = np.cumsum(2 * bits.astype(np.int32) - 1, dtype=np.int32)
        self.depth = excess[self.opens] - 1
        self.blocks = np.full((len(bits) // self.BLOCK + 1, self.BLOCK), self.FAR, dtype=np.int32)
        self.blocks.ravel()[: len(bits)] = excess
        self.levels = [self.blocks.min(axis=1)]
        while len(self.levels[-1]) > 1:
            lower = self.levels[-1]
            if len(lower) % 2:
                lower = self.levels[-1] = np.append(lower, self.FAR)
            self.levels.append(lower.reshape(-1, 2).min(axis=1))

    def _in_block(self, block: np.ndarray, below: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The first place of each block behind ``after`` whose excess is under ``below``, or -1."""
        found = np.empty(len(block), dtype=np.int64)
        columns = np.arange(self.BLOCK)
        for a in range(0, len(block), 4096):
            part = slice(a, a + 4096)
            fits = (self.blocks[block[part]] < below[part, None]) & (columns > after[part, None])
            first = fits.argmax(axis=1)
            found[part] = np.where(fits[np.arange(len(first)), first], first, -1)
        return found

    def findclose(self) -> np.ndarray:
        """For every opening parenthesis the place of the one that closes it: the next place of lower excess."""
        below = self.depth + 1
        block, at = np.divmod(self.opens, self.BLOCK)
        close = self._in_block(block, below, at)
        close = np.where(close >= 0, block * self.BLOCK + close, -1)
        far = np.flatnonzero(close < 0)
        node, low = block[far], below[far]
        height = np.full(len(far), -1)
        # up, until a right neighbour holds a lower excess; then down to its first such block
        for level, minima in enumerate(self.levels[:-1]):
            left = (height < 0) & (node % 2 == 0)
            stop = left & (minima[np.where(left, node, 0) + 1] < low)
            height[stop] = level
            node = np.where(stop, node + 1, np.where(height < 0, node // 2, node))
        for level in range(len(self.levels) - 2, -1, -1):
            minima = self.levels[level]
            down = height > level
            left = np.where(down, node * 2, node)
            node = np.where(down & (minima[np.minimum(left, len(minima) - 1)] >= low), left + 1, left)
        close[far] = node * self.BLOCK + self._in_block(node, low, np.full(len(far), -1))
        return close


def _prefix_xor(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, carry: np.ndarray) -> np.ndarray:
    """Running exclusive or within each run of ``sizes``, from ``carry`` on."""
    running = np.concatenate([[0], np.bitwise_xor.accumulate(values)]) if len(values) else np.zeros(1, dtype=np.int64)
    return running[1:] ^ np.repeat(running[starts] ^ carry, sizes)


SHARD_SCHEMA = (
    "k1 bigint, k2 bigint, p1 bigint, p2 bigint, r1 bigint, r2 bigint, depth bigint, root boolean, merged boolean, port boolean, n_convs bigint, conv_id bigint, "
    "parent_conv_id bigint, n_children bigint, n_leaves bigint, saved bigint, n_chars bigint, a1 array<bigint>, a2 array<bigint>"
)


def encode_shard(rows: pa.Table, width: int) -> pa.Table:
    """Nodes of the trie over sorted, distinct pieces of conversations, with what each sums up over its subtree in this shard.

    A piece hangs below the node ``r1, r2`` where it begins. Nodes that other shards may hold too (the tops of pieces, and the
    paths of the first and the last piece) are ``merged``: they count nothing of their own here. A ``port`` is a node at the
    lower end of a band where conversations go on; it is no leaf.
    """
    m = rows.num_rows
    r1, r2, band, n, low, more = (rows.column(c).to_numpy() for c in ("r1", "r2", "band", "n", "conv_id", "more"))
    h1, h2, chars = (pa.concat_arrays(rows.column(c).chunks) if rows.column(c).num_chunks != 1 else rows.column(c).chunk(0) for c in ("h1", "h2", "n_chars"))
    size = np.diff(h1.offsets.to_numpy()).astype(np.int64)
    h1, h2, chars = (x.flatten().to_numpy() for x in (h1, h2, chars))
    starts = np.concatenate([[0], np.cumsum(size)])[:-1]
    k1, k2 = _prefix_xor(h1, starts, size, r1), _prefix_xor(h2, starts, size, r2)
    # turns that a piece has in common with the one before it
    same_root = (r1[1:] == r1[:-1]) & (r2[1:] == r2[:-1])
    shared = np.where(same_root, np.minimum(size[1:], size[:-1]), 0)
    pair = np.repeat(np.arange(m - 1), shared)
    step = np.arange(len(pair)) - np.repeat(np.cumsum(shared) - shared, shared)
    here, there = starts[1:][pair] + step, starts[:-1][pair] + step
    alike = (k1[here] == k1[there]) & (k2[here] == k2[there])
    common = np.bincount(pair, weights=alike, minlength=max(m - 1, 0)).astype(np.int64)
    opens = size + 1
    opens[1:] -= common + same_root
    closes = np.concatenate([[0], size[:-1] + 1 - common - same_root, size[-1:] + 1])
    runs = np.empty(2 * m + 1, dtype=np.int64)
    runs[0::2], runs[1::2] = closes, opens
    tree = Parentheses(np.repeat(np.arange(2 * m + 1) % 2, runs))
    close = tree.findclose()
    piece_at = np.repeat(np.arange(2 * m + 1) // 2, runs)
    first, end, rel = piece_at[tree.opens], piece_at[close], tree.depth.astype(np.int64)
    span = (close - tree.opens + 1) // 2
    nodes = np.arange(len(rel))
    turn = starts[first] + rel - 1
    top = rel == 0
    safe = np.where(top, 0, turn)
    if not len(k1):
        k1 = k2 = chars = np.zeros(1, dtype=np.int64)
    key1, key2 = np.where(top, r1[first], k1[safe]), np.where(top, r2[first], k2[safe])
    above = np.where(rel > 1, turn - 1, 0)
    up1, up2 = np.where(rel > 1, k1[above], r1[first]), np.where(rel > 1, k2[above], r2[first])
    length = np.where(top, 0, chars[safe])
    members = np.concatenate([[0], np.cumsum(n)])
    n_convs = members[end] - members[first]
    least = np.minimum.reduceat(np.append(low, np.iinfo(np.int64).max), np.stack([first, end], axis=1).ravel())[::2]
    port = (rel == width) & more[first]
    merged = top | (first == 0) | (end == m)
    counts = ~merged
    # leaves are pairs "()": ranks and savings in the order of opening, so a subtree is a range
    leaf_rank = np.concatenate([[0], np.cumsum((span == 1) & counts & ~port)])
    saving = np.concatenate([[0], np.cumsum(np.where(counts, (n_convs - 1) * length, 0))])
    parent = np.full(len(rel), -1)
    for d in range(1, int(rel.max(initial=0)) + 1):
        at, up = np.flatnonzero(rel == d), np.flatnonzero(rel == d - 1)
        parent[at] = up[np.searchsorted(up, at) - 1]
    children = np.bincount(parent[counts], minlength=len(rel))
    parent_known = (parent >= 0) & ~merged[parent]
    listed = merged | port
    spines = [[], []]
    for v in nodes[listed]:
        a, b, s = starts[first[v]], starts[first[v]] + rel[v], first[v]
        spines[0].append([r1[s], *k1[a:b]])
        spines[1].append([r2[s], *k2[a:b]])
    place = pa.array(np.where(listed, np.cumsum(listed) - 1, -1))
    lists = [pa.array(s, pa.list_(pa.int64())).take(pc.if_else(pc.less(place, 0), None, place)) for s in spines]
    columns = [
        key1, key2, up1, up2, r1[first], r2[first], band[first] * width + rel, top, merged, port, n_convs, least,
        pa.array(least[parent], mask=~parent_known), children, leaf_rank[nodes + span] - leaf_rank[nodes], saving[nodes + span] - saving[nodes], length, *lists,
    ]
    return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], [c.split()[0] for c in SHARD_SCHEMA.split(", ")])


def _shards(batches: Iterator[pa.RecordBatch], width: int, most: int) -> Iterator[pa.RecordBatch]:
    """Sorted pieces, encoded in shards of about ``most`` nodes."""
    held: list[pa.RecordBatch] = []
    nodes = 0
    for batch in batches:
        start = 0
        totals = np.cumsum(batch.column("size").to_numpy() + 1)
        while start < batch.num_rows:
            base = totals[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(totals, base + most - nodes, side="right")))
            held.append(batch.slice(start, stop - start))
            nodes += int(totals[stop - 1] - base)
            start = stop
            if nodes >= most or stop < batch.num_rows:
                yield from encode_shard(pa.Table.from_batches(held), width).to_batches()
                held, nodes = [], 0
    if held:
        yield from encode_shard(pa.Table.from_batches(held), width).to_batches()


def rebuilt_turns(conversations: DataFrame, every: int = 100, shared: int = 6) -> DataFrame:
    """``conv_id, depth, digest, n_chars``: a row of depth 0 for each conversation, and its turns from depth 1 on.

    The first h turns are those of conversation ``c - c % every``, h the crc32 of c modulo ``shared``; then come its
    own behind its first h. The texts go no further than their digests here.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"), F.length(text).cast("long").alias("n_chars")
    )
    ordered = cut(
        positions(turns, "conv_id", ["turn", "digest"])
        .withColumn("head", F.col("conv_id") - F.col("conv_id") % every)
        .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared)
    )
    heads = ordered.where((F.col("conv_id") == F.col("head")) & (F.col("pos") < shared - 1)).select(F.col("head").alias("from"), F.col("pos").alias("at"), F.col("digest").alias("d"), F.col("n_chars").alias("c"))
    convs = ordered.where(F.col("pos") == 0).select("conv_id", "head", "h")
    begun = convs.join(heads, (F.col("head") == F.col("from")) & (F.col("at") < F.col("h"))).select("conv_id", (F.col("at") + 1).alias("depth"), F.col("d").alias("digest"), F.col("c").alias("n_chars"))
    known = heads.groupBy("from").agg(F.count(F.lit(1)).alias("n"))
    taken = F.least(F.col("h"), F.coalesce(F.col("n"), F.lit(0)))
    own = (
        ordered.where(F.col("pos") >= F.col("h"))
        .join(known, F.col("head") == F.col("from"), "left")
        .select("conv_id", (F.col("pos") - F.col("h") + taken + 1).alias("depth"), "digest", "n_chars")
    )
    tops = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("n_chars"))
    return tops.unionByName(begun).unionByName(own)


def _keyed(a: str, b: str, *more: str) -> Column:
    """Equality of two-part keys, by pairs of names."""
    names = [a, b, *more]
    on = F.col(names[0]) == F.col(names[1])
    for x, y in zip(names[2::2], names[3::2]):
        on &= F.col(x) == F.col(y)
    return on


def _digests(ends: DataFrame) -> DataFrame:
    """``e1, e2, ends_sha256``: of the ids of the conversations that end at a node, ascending, joined by commas.

    Ids are joined in ranges of ``ID_CHUNK`` first, so a node where a third of all conversations end is as many
    times fewer rows; only nodes of several ranges are read in order, a batch at a time.
    """
    ranges = ends.groupBy("e1", "e2", F.floor(F.col("conv_id") / ID_CHUNK).alias("range")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    ranges = cut(ranges.select("e1", "e2", "range", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids")))
    nodes = ranges.groupBy("e1", "e2").agg(F.count(F.lit(1)).alias("n"), F.min("ids").alias("ids"))
    single = nodes.where(F.col("n") == 1).select("e1", "e2", F.sha2("ids", 256).alias("ends_sha256"))
    several = ranges.join(nodes.where(F.col("n") > 1).select(F.col("e1").alias("n1"), F.col("e2").alias("n2")), _keyed("e1", "n1", "e2", "n2"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for e1, e2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (e1, e2) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (e1, e2), hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["e1", "e2", "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], ["e1", "e2", "ends_sha256"])

    streamed = several.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "range").mapInArrow(run, "e1 bigint, e2 bigint, ends_sha256 string")
    return single.unionByName(streamed)


def prefix_trie(turns: DataFrame, width: int = BAND, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per node of the trie over ``conv_id, depth, digest, n_chars`` (see ``rebuilt_turns``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. A node is named by the exclusive or of two hashes of its turns and their depths, which
    sums in any order. Conversations are cut into bands of ``width`` turns, equal pieces counted once, sorted by range,
    and encoded shard by shard in balanced parentheses: the matching parenthesis delimits a subtree, and ranks of leaf pairs and
    cumulative savings at both ends give its sums. What several shards hold, the spines at their borders, is
    summed by node; then the sums of lower bands are added to the nodes above, by doubling, so a conversation of a
    million turns takes 15 rounds and no task holds more than a band of it.

    Rows of one conversation and turn number are ordered by the digest of role and text; a null role or text is an empty
    one; repeated rows are turns of their own; rows without a conv_id belong to no conversation; an empty table
    gives no rows; other columns are ignored, whatever their names.
    """
    band = F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / width)
    turn = F.when(F.col("depth") > 0, F.struct("depth", "digest", "h1", "h2", "n_chars"))
    pieces = (
        turns.withColumn("h1", F.when(F.col("depth") > 0, F.xxhash64("depth", "digest")))
        .withColumn("h2", F.when(F.col("depth") > 0, F.xxhash64("digest", "depth")))
        .groupBy("conv_id", band.alias("band"))
        .agg(F.sort_array(F.collect_list(turn)).alias("t"), F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    )
    by_conv = Window.partitionBy("conv_id").orderBy("band")
    earlier = by_conv.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    placed = cut(
        pieces.withColumn("r1", F.coalesce(F.bit_xor("x1").over(earlier), zero))
        .withColumn("r2", F.coalesce(F.bit_xor("x2").over(earlier), zero))
        .withColumn("more", F.lead("band").over(by_conv).isNotNull())
    )
    ends = placed.where(~F.col("more")).select("conv_id", F.col("r1").bitwiseXOR(F.coalesce("x1", zero)).alias("e1"), F.col("r2").bitwiseXOR(F.coalesce("x2", zero)).alias("e2"))
    path = F.unhex(F.array_join(F.col("t.digest"), ""))
    distinct = (
        placed.groupBy("r1", "r2", "band", path.alias("path"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.max("more").alias("more"),
            F.first("t.h1").alias("h1"), F.first("t.h2").alias("h2"), F.first("t.n_chars").alias("n_chars"),
        )
        .withColumn("size", F.size("h1"))
    )
    ranged = distinct.repartitionByRange("r1", "r2", "path").sortWithinPartitions("r1", "r2", "path")
    nodes = cut(ranged.drop("path").mapInArrow(lambda batches: _shards(batches, width, shard_nodes), SHARD_SCHEMA))
    inner = nodes.where(~F.col("merged"))

    # what several shards may hold
    firsts = ["p1", "p2", "r1", "r2", "depth", "n_chars", "a1", "a2"]
    sums = ["n_convs", "n_children", "n_leaves", "saved"]
    spine = cut(
        nodes.where("merged").groupBy("k1", "k2", "root").agg(
            *[F.first(c).alias(c) for c in firsts], *[F.sum(c).alias(c) for c in sums], F.max("port").alias("port"), F.min("conv_id").alias("conv_id")
        )
    )
    below = spine.where(~F.col("root")).groupBy(F.col("p1").alias("c1"), F.col("p2").alias("c2"), ((F.col("depth") - 1) % width == 0).alias("c_root")).agg(F.count(F.lit(1)).alias("c_n"))
    spine = spine.join(below, _keyed("k1", "c1", "k2", "c2", "root", "c_root"), "left").withColumn("n_children", F.col("n_children") + F.coalesce("c_n", zero)).drop("c1", "c2", "c_root", "c_n")
    childless = (F.col("n_children") == 0) & ~F.col("port") & (~F.col("root") | (F.col("depth") == 0))
    spine = cut(
        spine.withColumn("own_leaves", childless.cast("long")).withColumn("own_saved", F.when(F.col("root"), zero).otherwise((F.col("n_convs") - 1) * F.col("n_chars")))
    )
    up = spine.select(F.posexplode(F.arrays_zip("a1", "a2")).alias("at", "a"), "own_leaves", "own_saved")
    up = up.groupBy(F.col("a.a1").alias("u1"), F.col("a.a2").alias("u2"), (F.col("at") == 0).alias("u_root")).agg(F.sum("own_leaves").alias("more_leaves"), F.sum("own_saved").alias("more_saved"))
    spine = cut(
        spine.join(up, _keyed("k1", "u1", "k2", "u2", "root", "u_root"), "left")
        .withColumn("n_leaves", F.col("n_leaves") + F.coalesce("more_leaves", zero))
        .withColumn("saved", F.col("saved") + F.coalesce("more_saved", zero))
        .withColumn("parent_conv_id", F.lit(None).cast("long"))
        .select(*inner.columns[:8], "port", "n_convs", "conv_id", "parent_conv_id", *sums[1:], "n_chars", "a1", "a2")
    )
    inner = inner.drop("merged")
    whole = inner.unionByName(spine.where(~F.col("root") | (F.col("depth") == 0)))

    # what lower bands add to the nodes above their tops
    ports = whole.where("port").select("k1", "k2", "r1", "r2", "a1", "a2", "conv_id")
    tops = spine.where(F.col("root") & (F.col("depth") > 0)).select(F.col("k1").alias("t1"), F.col("k2").alias("t2"), "n_children", "n_leaves", "saved")
    lower = cut(ports.join(tops, _keyed("k1", "t1", "k2", "t2")).select("k1", "k2", "r1", "r2", "a1", "a2", "n_children", "n_leaves", "saved"))
    totals = lower.select("k1", "k2", "r1", "r2", "n_leaves", "saved")
    deepest = lower.agg(F.max(F.size("a1"))).first()[0]
    bands = (placed.agg(F.max("band")).first()[0] or 0) if deepest else 0
    for _ in range(math.ceil(math.log2(bands)) if bands > 1 else 0):
        added = totals.groupBy(F.col("r1").alias("g1"), F.col("r2").alias("g2")).agg(F.sum("n_leaves").alias("g_leaves"), F.sum("saved").alias("g_saved"))
        higher = totals.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("r1").alias("n1"), F.col("r2").alias("n2"))
        totals = cut(
            totals.join(added, _keyed("k1", "g1", "k2", "g2"), "left").join(higher, _keyed("r1", "q1", "r2", "q2"), "left")
            .select("k1", "k2", F.col("n1").alias("r1"), F.col("n2").alias("r2"), (F.col("n_leaves") + F.coalesce("g_leaves", zero)).alias("n_leaves"), (F.col("saved") + F.coalesce("g_saved", zero)).alias("saved"))
        )
    sides = lower.select("k1", "k2", "a1", "a2", "n_children").join(totals.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), "n_leaves", "saved"), _keyed("k1", "q1", "k2", "q2"))
    sides = sides.select(F.posexplode(F.arrays_zip("a1", "a2")).alias("at", "a"), "n_children", "n_leaves", "saved", F.size("a1").alias("n"))
    sides = sides.where((F.col("at") > 0) | ((F.col("a.a1") == 0) & (F.col("a.a2") == 0)))
    sides = sides.select(F.col("a.a1").alias("s1"), F.col("a.a2").alias("s2"), F.when(F.col("at") == F.col("n") - 1, F.col("n_children")).otherwise(zero).alias("s_children"), F.col("n_leaves").alias("s_leaves"), F.col("saved").alias("s_saved"), F.lit(None).cast("string").alias("ends_sha256"))
    closing = _digests(ends).select(F.col("e1").alias("s1"), F.col("e2").alias("s2"), zero.alias("s_children"), zero.alias("s_leaves"), zero.alias("s_saved"), "ends_sha256")
    sides = sides.unionByName(closing).groupBy("s1", "s2").agg(*[F.sum(c).alias(c) for c in ("s_children", "s_leaves", "s_saved")], F.max("ends_sha256").alias("ends_sha256"))

    # parents that a shard couldn't tell: the root, of one row, and nodes of spines and ports
    root = spine.where(F.col("root") & (F.col("depth") == 0)).select(F.lit(1).cast("long").alias("o_depth"), F.col("conv_id").alias("o_conv"))
    parents = spine.where(~F.col("root")).select("k1", "k2", "conv_id").unionByName(ports.select("k1", "k2", "conv_id")).distinct()
    open_ = whole.where(F.col("parent_conv_id").isNull())
    first = open_.where(F.col("depth") <= 1).join(F.broadcast(root), F.col("depth") == F.col("o_depth"), "left").withColumn("parent_conv_id", F.col("o_conv"))
    later = open_.where(F.col("depth") > 1).join(parents.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("conv_id").alias("o_conv")), _keyed("p1", "o1", "p2", "o2"), "left").withColumn("parent_conv_id", F.col("o_conv"))
    columns = ["k1", "k2", "conv_id", "depth", "parent_conv_id", *sums]
    known = whole.where(F.col("parent_conv_id").isNotNull())
    found = known.select(columns).unionByName(first.select(columns)).unionByName(later.select(columns))
    joined = found.join(sides, _keyed("k1", "s1", "k2", "s2"), "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", (F.col("n_children") + F.coalesce("s_children", zero)).alias("n_children"), (F.col("n_leaves") + F.coalesce("s_leaves", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("s_saved", zero)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
