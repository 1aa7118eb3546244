"""Embedding near-duplicates by NN-descent."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import cut, small_enough, type_of
from keyloom.llm.components import connected_components

#: Vectors that a seed leaf holds on average, the most that one product of blocks compares, and rows in a group of small ones.
LEAF_ROWS = 64
BLOCK_ROWS = 1024
GROUP_ROWS = 20_000
#: Width in radians of the rings about a group's centre, and members whose mean is that centre.
RING = math.radians(0.5)
CENTRE_ROWS = 32
#: Neighbours under ``bridge`` that one comparison gives a node: they lead on, but seldom far.
WEAK = 3


class Lists:
    """The vectors of an Arrow list column, by row."""

    def __init__(self, column: pa.ChunkedArray | pa.Array) -> None:
        flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        self.values, self.offsets = flat.flatten().to_numpy(), flat.offsets.to_numpy() - (flat.offsets[0].as_py() if len(flat) else 0)
        self.sizes = np.diff(self.offsets)
        self.all = self.values.reshape(len(self.sizes), -1) if len(set(self.sizes.tolist())) == 1 else None

    def rows(self, at: np.ndarray) -> np.ndarray:
        """Rows ``at``, which must be of one length, as a matrix."""
        return self.all[at] if self.all is not None else np.stack([self.values[self.offsets[i] : self.offsets[i + 1]] for i in at])


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """An order that brings equal keys together, and the slices of equal ones."""
    order = np.lexsort(keys[::-1])
    if not len(order):
        return order, []
    edge = np.zeros(len(order) - 1, dtype=bool)
    for k in keys:
        edge |= np.diff(k[order]) != 0
    cuts = [0, *(np.flatnonzero(edge) + 1).tolist(), len(order)]
    return order, list(zip(cuts, cuts[1:]))


def node_of(vector: Column) -> Column:
    """A 64-bit name for a vector, equal for equal ones; null if it is null, zero, or holds a null or non-finite component."""
    usable = (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(vector, lambda x: x != 0)
    return F.when(F.coalesce(usable, F.lit(False)), F.xxhash64(vector))


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with unit vectors. Dividing by the largest component first keeps squares of very large and very small ones in range."""
    for b in batches:
        if not b.num_rows:
            continue
        lists = Lists(b.column(3))
        if lists.all is not None:
            x = lists.all / np.abs(lists.all).max(axis=1, keepdims=True)
            flat = (x / np.linalg.norm(x, axis=1, keepdims=True)).ravel()
        else:
            scaled = [r / np.abs(r).max() for r in (lists.rows(np.array([i]))[0] for i in range(b.num_rows))]
            flat = np.concatenate([r / np.linalg.norm(r) for r in scaled])
        offsets = pa.array((lists.offsets - lists.offsets[0]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.ListArray.from_arrays(offsets, pa.array(flat))], ["node", "least", "n", "v"])


def unit_nodes(rows: DataFrame) -> DataFrame:
    """``node, least, n, v`` of rows ``vec_id, raw, node``: smallest id, number of rows and unit vector of each node."""
    same = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("raw").alias("v"))
    return same.mapInArrow(_unit, f"node bigint, least {type_of(rows, 'vec_id')}, n bigint, v array<double>")


def seed_leaves(nodes: DataFrame, tables: int, bits: int, turn: int, vectors: bool) -> DataFrame:
    """``node, leaf`` and if asked ``v``: each node in one leaf of every random-hyperplane table of this turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = Lists(b.column(1))
            leaf = np.zeros((b.num_rows, tables), dtype=np.int64)
            for d in np.unique(lists.sizes):
                own = np.flatnonzero(lists.sizes == d)
                x = lists.rows(own)
                planes = np.random.default_rng([turn, int(d)]).standard_normal((int(d), tables * bits))
                sign = ((x @ planes) > 0).reshape(len(own), tables, bits)
                leaf[own] = (sign @ (1 << np.arange(bits, dtype=np.int64))) * tables + np.arange(tables)
            at = pa.array(np.repeat(np.arange(b.num_rows), tables))
            size = pa.array(np.repeat(lists.sizes.astype(np.int64), tables))
            found = {"node": b.column(0).take(at), "leaf": pa.array(leaf.ravel()), "d": size} | ({"v": b.column(1).take(at)} if vectors else {})
            yield pa.RecordBatch.from_pydict(found)

    found = nodes.select("node", "v").mapInArrow(run, "node bigint, leaf bigint, d bigint" + ", v array<double>" * vectors)
    return found.withColumn("leaf", F.xxhash64("leaf", "d")).drop("d")


def _best(s: np.ndarray, m: int, bridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the ``m`` largest of each row; of those under ``bridge`` the ``WEAK`` largest."""
    top = np.argpartition(-s, m - 1, axis=1)[:, :m]
    value = np.take_along_axis(s, top, axis=1)
    order = np.argsort(-value, axis=1)
    top, value = np.take_along_axis(top, order, axis=1), np.take_along_axis(value, order, axis=1)
    weak = np.cumsum(value < bridge, axis=1)
    row, at = np.nonzero(weak <= WEAK)
    return row, top[row, at], value[row, at]


def _leaf_neighbours(k: int, bridge: float):
    def run(table: pa.Table) -> pa.Table:
        node, lists = table.column("node").to_numpy(), Lists(table.column("v"))
        order, runs = _runs(table.column("leaf").to_numpy())
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a, b in runs:
            if b - a < 2:
                continue
            own = order[a:b]
            x, names = lists.rows(own), node[own]
            m = min(k, len(own) - 1)
            for at in range(0, len(own), 512):
                s = x[at : at + 512] @ x.T
                s[np.arange(len(s)), np.arange(at, at + len(s))] = -2
                row, column, value = _best(s, m, bridge)
                out.append((names[at + row], names[column], value))
        a, b, c = (np.concatenate(z) for z in zip(*out)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({"a": a, "b": b, "cos": c})

    return run


def seed(nodes: DataFrame, n: int, k: int, tables: int, bits: int, turn: int, bridge: float) -> DataFrame:
    """``a, b, cos, fresh``: up to ``k`` nearest of each node in each of its leaves, few of them under ``bridge``; a leaf over BLOCK_ROWS is dealt into parts."""
    sizes = seed_leaves(nodes, tables, bits, turn, False).groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BLOCK_ROWS)
    rows = seed_leaves(nodes, tables, bits, turn, True).join(small_enough(sizes, 100_000), "leaf", "left")
    part = F.pmod(F.xxhash64("node", "leaf", F.lit(turn)), F.ceil(F.coalesce("size", F.lit(1)) / BLOCK_ROWS).cast("int"))
    dealt = rows.select("node", "v", F.xxhash64("leaf", part).alias("leaf"))
    group = F.pmod(F.xxhash64("leaf"), F.lit(n * tables // GROUP_ROWS + 24))
    return dealt.withColumn("g", group).groupBy("g").applyInArrow(_leaf_neighbours(k, bridge), "a bigint, b bigint, cos double").withColumn("fresh", F.lit(1))


def nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best distinct neighbours ``b`` of each ``a``, ties by ``b``; ``fresh`` is 0 for pairs seen before."""
    order = Window.partitionBy("a").orderBy(F.col("cos").desc(), "b")
    return pairs.groupBy("a", "b").agg(F.max("cos").alias("cos"), F.min("fresh").alias("fresh")).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def _local_join(fan: int, bridge: float):
    """For the neighbours ``c`` of each ``b``: the best ``fan`` others of each among them."""

    def run(table: pa.Table) -> pa.Table:
        node, lists = table.column("c").to_numpy(), Lists(table.column("v"))
        order, runs = _runs(table.column("b").to_numpy())
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for low, high in runs:
            if high - low < 2:
                continue
            own = order[low:high]
            x, names = lists.rows(own), node[own]
            m = min(fan, len(own) - 1)
            s = x @ x.T
            np.fill_diagonal(s, -2)
            row, column, value = _best(s, m, bridge)
            out.append((names[row], names[column], value))
        return pa.table(dict(zip(("a", "b", "cos"), (np.concatenate(z) for z in zip(*out)))))

    return run


def descend(graph: DataFrame, nodes: DataFrame, n: int, k: int, fan: int, bridge: float) -> DataFrame:
    """One round: neighbours of neighbours, over the ``fan`` best links either way, whatever their cosine.

    The neighbours of a node meet in one group, each vector once, and are compared there; only lists with a link that is
    new since the last round take part.
    """
    ahead = nearest(graph, fan)
    back = nearest(ahead.select(F.col("b").alias("a"), F.col("a").alias("b"), "cos", "fresh"), fan)
    near = ahead.unionByName(back).groupBy(F.col("a").alias("b"), F.col("b").alias("c")).agg(F.max("fresh").alias("fresh"))
    near = near.join(near.where("fresh = 1").select("b").distinct(), "b", "left_semi")
    placed = near.select("b", "c").join(nodes.select(F.col("node").alias("c"), "v"), "c").withColumn("g", F.pmod(F.xxhash64("b"), F.lit(2 * n * fan // GROUP_ROWS + 24)))
    found = placed.groupBy("g").applyInArrow(_local_join(fan, bridge), "a bigint, b bigint, cos double").withColumn("fresh", F.lit(1))
    return nearest(graph.withColumn("fresh", F.lit(0)).unionByName(found), k)


def _centres(table: pa.Table) -> pa.Table:
    """The unit mean of each component's vectors."""
    component, lists = table.column("component").to_numpy(), Lists(table.column("v"))
    order, runs = _runs(component)
    means = [lists.rows(order[a:b]).mean(axis=0) for a, b in runs]
    return pa.table({"component": component[order[[a for a, _ in runs]]], "centre": pa.array([m / max(np.linalg.norm(m), 1e-300) for m in means], pa.list_(pa.float64()))})


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with their angle to their component's centre."""
    for b in batches:
        x, y = Lists(b.column(3)), Lists(b.column(4))
        cos = np.array([x.rows(np.array([i]))[0] @ y.rows(np.array([i]))[0] for i in range(b.num_rows)]) if x.all is None else np.einsum("ij,ij->i", x.all, y.all)
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(np.arccos(np.clip(cos, -1, 1)))], ["node", "n", "component", "v", "angle"])


def _near_centres(reach: float):
    """Pairs of components of a pair of blocks whose vectors can be within ``reach`` of each other, with the centres' angle."""

    def run(table: pa.Table) -> pa.Table:
        side, name, radius, lists = (table.column("side").to_numpy(), table.column("component").to_numpy(), table.column("radius").to_numpy(), Lists(table.column("centre")))
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for d in np.unique(lists.sizes):
            left, right = np.flatnonzero((lists.sizes == d) & (side != 1)), np.flatnonzero((lists.sizes == d) & (side != 0))
            if len(left) and len(right):
                angle = np.arccos(np.clip(lists.rows(left) @ lists.rows(right).T, -1, 1))
                i, j = np.nonzero((angle <= reach + radius[left][:, None] + radius[right][None, :] + 1e-9) & (name[left][:, None] < name[right][None, :]))
                k, m = np.nonzero((angle <= reach + radius[left][:, None] + radius[right][None, :] + 1e-9) & (name[left][:, None] > name[right][None, :]) & (side[left][:, None] != 2))
                out += [(name[left[i]], name[right[j]], angle[i, j]), (name[right[m]], name[left[k]], angle[k, m])]
        return pa.table(dict(zip(("ca", "cb", "gap"), (np.concatenate(z) for z in zip(*out)))))

    return run


def _block_links(threshold: float):
    """Links by node of each pair of blocks, and one link ``a, b`` of a pair from two components."""

    def run(table: pa.Table) -> pa.Table:
        side, node, n, lists, component = *(table.column(c).to_numpy() for c in ("side", "node", "n")), Lists(table.column("v")), table.column("component").to_numpy()
        out = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        across: list[tuple[int, int]] = []
        order, runs = _runs(table.column("pair").to_numpy())
        for a, b in runs:
            own = order[a:b]
            left, right = own[side[own] != 1], own[side[own] != 0]
            if not len(left) or not len(right):
                continue
            y = lists.rows(right)
            for at in range(0, len(left), 512):
                rows = left[at : at + 512]
                hit = (lists.rows(rows) @ y.T >= threshold) & (node[rows][:, None] != node[right][None, :])
                out.append((node[rows], hit @ n[right]))
                if side[right[0]] == 1:
                    out.append((node[right], n[rows] @ hit))
                if component[rows[0]] != component[right[0]] and hit.any():
                    i, j = np.unravel_index(int(hit.argmax()), hit.shape)
                    across.append((int(node[rows[i]]), int(node[right[j]])))
        names, links = (np.concatenate(z).astype(np.int64) for z in zip(*out))
        none = [None] * len(across)
        return pa.table(
            {"node": pa.array([*names.tolist(), *none], pa.int64()), "links": pa.array([*links.tolist(), *none], pa.int64())}
            | {c: pa.array([*([None] * len(names)), *(x[k] for x in across)], pa.int64()) for k, c in enumerate("ab")}
        )

    return run


def exact_links(members: DataFrame, n: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``node, links``, the rows within ``threshold`` of each member among all of them, and ``a, b``, links that join components.

    ``members`` are ``node, n, v, component``. Vectors of a component lie in rings about its centre, and angles obey the
    triangle inequality: rings close enough to the centre are linked as a whole and only counted, rings and components too
    far apart are left out, and what remains is dealt into blocks of BLOCK_ROWS whose pairs are multiplied out, in bounded
    memory. No pair of vectors is ever a row, and a tight group of any size costs no product.
    """
    reach = math.acos(threshold)
    first = Window.partitionBy("component").orderBy(F.xxhash64("node", F.lit(5)), "node")
    picked = members.select("component", "node", "v").withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= CENTRE_ROWS)
    group = F.pmod(F.xxhash64("component"), F.lit(n // GROUP_ROWS + 24))
    centres = cut(picked.select("component", "v", group.alias("g")).groupBy("g").applyInArrow(_centres, "component bigint, centre array<double>"))
    held = members.join(small_enough(centres, 5_000), "component").select("node", "n", "component", "v", "centre")
    placed = cut(held.mapInArrow(_angles, "node bigint, n bigint, component bigint, v array<double>, angle double").withColumn("ring", F.floor(F.col("angle") / RING).cast("int")))
    rings = cut(
        placed.groupBy("component", "ring").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.max("angle").alias("angle"))
        .withColumn("parts", F.ceil(F.col("size") / BLOCK_ROWS).cast("int"))
    )

    def side(x: str) -> DataFrame:
        return rings.select(F.col("component").alias(f"c{x}"), F.col("ring").alias(f"r{x}"), F.col("weight").alias(f"w{x}"), F.col("parts").alias(f"p{x}"))

    sum_of_outer = (F.col("ra") + F.col("rb") + 2) * RING
    both = side("a").join(side("b").withColumnRenamed("cb", "ca"), "ca")
    sure = both.where(sum_of_outer <= reach - 1e-9).groupBy(F.col("ca").alias("component"), F.col("ra").alias("ring")).agg(F.sum("wb").alias("sure"))
    inside = both.where((F.col("ra") <= F.col("rb")) & (sum_of_outer > reach - 1e-9) & ((F.col("rb") - F.col("ra") - 1) * RING <= reach + 1e-9)).withColumn("cb", F.col("ca"))
    # components whose centres and radii let a link pass between them
    count = centres.count()
    blocks = -(-count // BLOCK_ROWS)
    balls = centres.join(rings.groupBy("component").agg(F.max("angle").alias("radius")), "component").withColumn("mine", F.pmod(F.xxhash64("component"), F.lit(blocks)).cast("int"))
    dealt = balls.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "component", "centre", "radius", F.concat_ws("/", F.least("mine", "other"), F.greatest("mine", "other")).alias("g"),
        F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    near = dealt.groupBy("g").applyInArrow(_near_centres(reach), "ca bigint, cb bigint, gap double")
    between = side("a").join(near, "ca").join(side("b"), "cb").where(F.col("gap") <= reach + sum_of_outer + 1e-9)
    columns = ["ca", "ra", "pa", "cb", "rb", "pb"]
    pairs = inside.select(*columns).unionByName(between.select(*columns))
    pairs = pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("pa") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("pb") - 1)))
    same = (F.col("ca") == F.col("cb")) & (F.col("ra") == F.col("rb"))
    pairs = cut(pairs.where(~same | (F.col("i") <= F.col("j"))).withColumn("one", same & (F.col("i") == F.col("j"))).withColumn("pair", F.xxhash64("ca", "ra", "i", "cb", "rb", "j")))
    own = placed.join(small_enough(rings.select("component", "ring", "parts"), 100_000), ["component", "ring"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    sides = pairs.select(F.col("ca").alias("component"), F.col("ra").alias("ring"), F.col("i").alias("part"), "pair", "pa", "pb", F.when(F.col("one"), 2).otherwise(0).alias("side")).unionByName(
        pairs.where("not one").select(F.col("cb").alias("component"), F.col("rb").alias("ring"), F.col("j").alias("part"), "pair", "pa", "pb", F.lit(1).alias("side"))
    )
    group = F.when(F.col("pa") + F.col("pb") > 2, F.col("pair")).otherwise(F.pmod("pair", F.lit(n // GROUP_ROWS + 24)))
    multiplied = own.join(sides, ["component", "ring", "part"]).select("node", "n", "v", "component", "pair", "side", group.alias("g"))
    found = cut(multiplied.groupBy("g").applyInArrow(_block_links(threshold), "node bigint, links bigint, a bigint, b bigint"))
    # a ring that is sure of itself counts its own rows too
    itself = F.when((F.col("ring") + 1) * 2 * RING <= reach - 1e-9, F.col("n")).otherwise(F.lit(0))
    certain = placed.select("node", "n", "component", "ring").join(small_enough(sure, 100_000), ["component", "ring"]).select("node", (F.col("sure") - itself).alias("links"))
    counted = found.where("node is not null").select("node", "links").unionByName(certain)
    return counted.groupBy("node").agg(F.sum("links").alias("links")), found.where("a is not null").select("a", "b")


def links_of(graph: DataFrame, nodes: DataFrame, n: int, reach: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``node, links`` and ``node, component`` of the nodes with links, from the threshold edges of the lists.

    A list that is half full of links may lack some. Those of two nodes with such lists are found by ``exact_links``; any
    other link lost here stands in the other node's list.
    """
    ahead = cut(graph.where(F.col("cos") >= threshold).select("a", "b"))
    both = ahead.unionByName(ahead.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    full = cut(ahead.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= reach // 2).select("node"))
    weight = nodes.select(F.col("node").alias("b"), F.col("n").alias("w"))
    if not full.take(1):
        parts = connected_components(ahead)
        return both.join(weight, "b").groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("links")), parts
    flag = lambda x: full.select(F.col("node").alias(x), F.lit(True).alias(f"full_{x}"))
    loose = both.join(flag("a"), "a", "left").join(flag("b"), "b", "left").where(F.col("full_a").isNull() | F.col("full_b").isNull())
    parts = cut(connected_components(ahead))
    members = cut(nodes.join(full, "node").join(parts, "node").select("node", "n", "v", "component"))
    exact, across = exact_links(members, n, threshold)
    counted = loose.join(weight, "b").select(F.col("a").alias("node"), F.col("w").alias("links")).unionByName(exact).groupBy("node").agg(F.sum("links").alias("links"))
    return counted, connected_components(ahead.unionByName(across)) if across.take(1) else parts


def missed(fresh: DataFrame, graph: DataFrame, full: int, threshold: float) -> float | None:
    """The share of the links of ``fresh`` seeds, of tables that the graph was not made of, that the graph has; None if they have none.

    Links between two nodes whose lists are half full, which ``full`` is half of, are found by ``exact_links`` and left out.
    """
    names = lambda x: F.struct(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).alias(x)
    links = graph.where(F.col("cos") >= threshold)
    heavy = links.groupBy(F.col("a").alias("h")).agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= full).select("h")
    new = fresh.where(F.col("cos") >= threshold).select("a", "b", names("link")).dropDuplicates(["link"])
    open_ = new.join(heavy.select(F.col("h").alias("a"), F.lit(1).alias("ha")), "a", "left").join(heavy.select(F.col("h").alias("b"), F.lit(1).alias("hb")), "b", "left").where(F.col("ha").isNull() | F.col("hb").isNull())
    known = links.select(names("link")).distinct().withColumn("known", F.lit(1))
    row = open_.join(known, "link", "left").agg(F.count(F.lit(1)), F.count("known")).first()
    return row[1] / row[0] if row[0] else None


def audit(counted: DataFrame, nodes: DataFrame, n: int, threshold: float, sample: int) -> float | None:
    """Links counted for about ``sample`` nodes, over those that brute force finds; None if none of these nodes has any.

    Half of the sample, by a hash of their names, are nodes with links, so that rare links are measured too, and half are nodes
    without. The lower of two shares: that of all their links, and the mean of each node's, which a large group can't outweigh.

    The sample, whose size the parameter bounds, goes to every task and meets all nodes there, batch by batch.
    """
    linked = counted.where("links > 0").select("node", F.lit(True).alias("linked"))
    several = max(linked.count(), 1)
    draw = F.pmod(F.xxhash64("node", F.lit(17)), F.lit(1 << 40))
    share = lambda of: F.lit(int(min(1.0, sample / 2 / max(of, 1)) * (1 << 40)))
    drawn = nodes.select("node", "v", draw.alias("draw")).join(linked, "node", "left").where(F.col("draw") < F.when(F.col("linked"), share(several)).otherwise(share(n - several)))
    chosen = drawn.select("node", "v").toArrow()
    if not chosen.num_rows:
        return None
    ids, lists = chosen.column("node").to_numpy(), Lists(chosen.column("v"))
    held = {int(d): (ids[lists.sizes == d], lists.rows(np.flatnonzero(lists.sizes == d))) for d in np.unique(lists.sizes)}
    shared = nodes.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, names, weight = Lists(b.column(1)), b.column(0).to_numpy(), b.column(2).to_numpy()
            for d, (q, x) in shared.value.items():
                at = np.flatnonzero(own.sizes == d)
                if len(at):
                    hit = (x @ own.rows(at).T >= threshold) & (q[:, None] != names[at][None, :])
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array((hit @ weight[at]).astype(np.int64))], ["node", "held"])

    true = nodes.select("node", "v", "n").mapInArrow(run, "node bigint, held bigint").groupBy("node").agg(F.sum("held").alias("held"))
    own = F.coalesce("links", F.lit(0))
    row = true.where("held > 0").join(counted, "node", "left").agg(F.sum("held"), F.sum(own), F.avg(own / F.col("held"))).first()
    return min(row[1] / row[0], row[2]) if row and row[0] else None


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    k: int = 10,
    most: int = 80,
    rounds: int = 12,
    recall: float = 0.999,
    sample: int = 2048,
    bridge: float = 0.8,
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept, audited_recall``.

    Equal vectors (by a 64-bit hash) are one node with a weight. Leaves of random-hyperplane tables seed each node's ``k``
    nearest neighbours, whatever their cosine, and rounds of neighbours-of-neighbours joins refine the lists; there are as many
    tables as make a pair at the threshold miss all leaves of a round once in a hundred. A list whose last entry is within the
    threshold is saturated; then the lists double before the round, up to ``most``, and ``exact_links`` finds what lists half full
    of links may lack. Links are the lists' edges of at least ``threshold``.

    Two measures say when to stop, and ``audited_recall`` is the lower: fresh tables seed the lists after each round, and
    the share of their links that were known measures what is far from all others; brute force over about ``sample`` nodes, half
    of them with links, measures all links of these. Below ``recall`` another round follows, over what the tables brought.
    If the target isn't met in ``rounds``, an error says so. Where nothing measured has a link, the recall is null. All
    cosines are of unit vectors in double precision.

    A vector that is null, zero, or holds null or non-finite components links with nothing and is its own component.
    Vectors of different lengths never link; repeated rows link with each other; a row with a null id counts as a link
    of others; an empty table gives no rows; other columns are ignored.
    """
    raw = F.col(vector_col).cast("array<double>")
    rows = cut(vectors.select(F.col(id_col).alias("vec_id"), raw.alias("raw"), node_of(raw).alias("node")))
    units = cut(unit_nodes(rows))
    nodes = units.select("node", "n", "v")
    n = nodes.count()
    bits = int(np.clip(np.ceil(np.log2(max(n, 2) / LEAF_ROWS)), 1, 40))
    met = (1 - math.acos(threshold) / math.pi) ** bits
    tables = int(np.clip(math.ceil(math.log(0.01) / math.log1p(-met)), 4, 64))
    graph, reach = cut(nearest(seed(nodes, n, k, tables, bits, 0, bridge), k)), k
    for turn in range(1, rounds + 1):
        if reach < most and graph.where(F.col("cos") >= threshold).groupBy("a").count().where(F.col("count") >= reach).take(1):
            reach = min(2 * reach, most)
        graph = cut(descend(graph, nodes, n, reach, k, bridge))
        fresh = cut(seed(nodes, n, k, tables, bits, turn, bridge))
        known = missed(fresh, graph, reach // 2, threshold)
        graph = cut(nearest(graph.unionByName(fresh), reach))
        if known is not None and known < recall:
            measured = known
            continue
        counted, parts = map(cut, links_of(graph, nodes, n, reach, threshold))
        found = audit(counted, nodes, n, threshold, sample)
        measured = min((x for x in (known, found) if x is not None), default=None)
        if measured is None or measured >= recall:
            break
    else:
        raise RuntimeError(f"the audit found {measured:.4f} of the links after {rounds} rounds, not {recall}")
    of = units.select("node", "least", "n").join(parts, "node", "left").join(counted, "node", "left")
    of = of.select("node", "n", "least", F.coalesce("component", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    names = of.groupBy("root").agg(F.min("least").alias("component_id"))
    final = of.join(names, "root").select("node", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    own = rows.select("vec_id", "node")
    linked = own.where(F.col("node").isNotNull()).join(final, "node").select("vec_id", "n_links", "component_id")
    alone = own.where(F.col("node").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"), F.lit(measured).cast("double").alias("audited_recall"))
