"""Hot keys in time slices.

A key's events are cut into slices of about equal size, with a column ``SLICE``. Every kernel that looks back over a key then
works in two levels: windows inside a slice, a total for each slice that can be merged, a scan over the totals, and what lies
before a slice joined to its rows. Without that column the same calls are plain windows over the key. So one
definition of a signal serves both, and a key with a third of all events is as many tasks as its slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.functions.tables import written

KEY, TIME, TIE, SLICE = "entity_id", "ts", "event_id", "_slice"

#: Grains of time whose running counts one task takes at once, where slices are cut.
STRETCH = 4096


def is_sliced(d: DataFrame) -> bool:
    return SLICE in d.columns


def lane(d: DataFrame) -> list[str]:
    """The columns that one window of ``d`` is partitioned by."""
    return [KEY, SLICE] if is_sliced(d) else [KEY]


def cut_slices(events: DataFrame, most: int, grain_ms: int = 1000) -> DataFrame:
    """``events`` with ``SLICE``: consecutive stretches of time of a key, each of ``most`` events, and one time grain more at most.

    Events are counted by key and grain, and the running count of a key divided by ``most`` numbers its slices. Events
    of one grain, so all of one time, share a slice. The running count has two levels, over stretches of ``STRETCH`` grains and within
    each, so no task gets more of a key than its stretches.
    """
    grain = F.floor(F.col(TIME) / grain_ms).alias("_grain")
    wide = F.floor(F.col("_grain") / STRETCH)
    counted = events.groupBy(F.col(KEY).alias("_of"), grain).agg(F.count(F.lit(1)).alias("_n")).withColumn("_wide", wide)
    whole = events.select(F.col(KEY).alias("_for"), grain).groupBy("_for", wide.alias("_stretch")).agg(F.count(F.lit(1)).alias("_m"))
    past = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("_for", "_stretch", F.coalesce(F.sum("_m").over(past("_for").orderBy("_stretch")), F.lit(0)).alias("_m"))
    within = F.coalesce(F.sum("_n").over(past("_of", "_wide").orderBy("_grain")), F.lit(0))
    counted = counted.withColumn("_within", within).join(whole, (F.col("_of") == F.col("_for")) & (F.col("_wide") == F.col("_stretch")))
    edges = counted.select("_of", F.col("_grain").alias("_at"), F.floor((F.col("_m") + F.col("_within")) / most).alias(SLICE))
    joined = events.withColumn("_grain", grain).join(edges, (F.col(KEY) == F.col("_of")) & (F.col("_grain") == F.col("_at")))
    return joined.drop("_grain", "_of", "_at")


def largest(d: DataFrame) -> int:
    """How many events the largest slice has; 1 where there is none."""
    return d.groupBy(KEY, SLICE).count().agg(F.max("count")).first()[0] or 1


@dataclass(frozen=True)
class Part:
    """A running value of a column: ``sum``, ``max`` or ``last`` (of those that are not null), with the current row or only before it."""

    kind: str
    column: str
    before: bool = False

    def over(self, w) -> Column:
        frame = w.rowsBetween(Window.unboundedPreceding, -1 if self.before else 0)
        return {"sum": F.sum(self.column), "max": F.max(self.column), "last": F.last(self.column, ignorenulls=True)}[self.kind].over(frame)

    def total(self) -> Column:
        if self.kind == "last":
            return F.max(F.when(F.col(self.column).isNotNull(), F.struct(TIME, TIE, F.col(self.column).alias("v"))))["v"]
        return {"sum": F.sum, "max": F.max}[self.kind](self.column)

    def scan(self, total: str, w) -> Column:
        return {"sum": F.sum(total), "max": F.max(total), "last": F.last(total, ignorenulls=True)}[self.kind].over(w.rowsBetween(Window.unboundedPreceding, -1))

    def merge(self, carried: Column, own: Column) -> Column:
        if self.kind == "sum":
            return F.coalesce(carried + own, carried, own)
        return F.greatest(carried, own) if self.kind == "max" else F.coalesce(own, carried)


def _carried(d: DataFrame, by: tuple[str, ...], totals: dict[str, Column], scans: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``d`` with the columns that ``scans`` makes of the totals of a key's (and ``by``'s) slices, each from the slices before its own.

    They are written, so Spark knows their size and broadcasts what is small, rather than shuffle ``d`` once more.
    """
    names = [KEY, SLICE, *by]
    table = written(scans(d.groupBy(*names).agg(*[c.alias(n) for n, c in totals.items()])))
    on = F.lit(True)
    for n in names:
        table = table.withColumnRenamed(n, f"_of_{n}")
        on &= F.col(n).eqNullSafe(F.col(f"_of_{n}"))
    return d.join(table, on, "left").drop(*[f"_of_{n}" for n in names])


def running(d: DataFrame, *by: str, **parts: Part) -> DataFrame:
    """``d`` with running values, by name, over the events of a key (and ``by``) in order."""
    w = Window.partitionBy(*lane(d), *by).orderBy(TIME, TIE)
    d = d.withColumns({n: p.over(w) for n, p in parts.items()})
    if not is_sliced(d):
        return d
    d = written(d)
    over = Window.partitionBy(KEY, *by).orderBy(SLICE)

    def scans(t: DataFrame) -> DataFrame:
        t = t.withColumns({f"_c_{n}": p.scan(f"_t_{n}", over) for n, p in parts.items()}).drop(*[f"_t_{n}" for n in parts])
        # what lies in one slice gets nothing from before
        return t.where(F.coalesce(*[F.when(F.col(f"_c_{n}").isNotNull(), True) for n in parts], F.lit(False)))

    d = _carried(d, by, {f"_t_{n}": p.total() for n, p in parts.items()}, scans)
    return d.withColumns({n: p.merge(F.col(f"_c_{n}"), F.col(n)) for n, p in parts.items()}).drop(*[f"_c_{n}" for n in parts])


def ranked_apart(d: DataFrame) -> DataFrame:
    """``d``, in slices, with the rank ``rn`` of an event in its key, and times moved up so that they strictly increase, in one level.

    With k the rank in a slice and o the events before it, rn is o + k, and the largest t - rn so far that of the slice less o, or one before.
    """
    w = Window.partitionBy(KEY, SLICE).orderBy(TIME, TIE)
    d = d.withColumn("_k", F.row_number().over(w).cast("long")).withColumn("_shift", F.col(TIME) - F.col("_k"))
    d = written(d.withColumn("_most", F.max("_shift").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_shift"))
    before = Window.partitionBy(KEY).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)

    def scans(t: DataFrame) -> DataFrame:
        t = t.withColumn("_off", F.coalesce(F.sum("_tn").over(before), F.lit(0)))
        return t.withColumn("_ahead", F.max(F.col("_tm") - F.col("_off")).over(before)).drop("_tn", "_tm")

    d = _carried(d, (), {"_tn": F.count(F.lit(1)), "_tm": F.max("_most")}, scans).withColumn("rn", F.col("_off") + F.col("_k"))
    return d.withColumn(TIME, F.greatest("_ahead", F.col("_most") - F.col("_off")) + F.col("rn")).drop("_k", "_most", "_off", "_ahead")


def lagged(d: DataFrame, name: str, column: str, n: int, rank: str = "rn") -> DataFrame:
    """``d`` with the value that ``column`` had ``n`` events earlier; ``rank`` numbers the events of a key."""
    d = d.withColumn(name, F.lag(column, n).over(Window.partitionBy(*lane(d)).orderBy(TIME, TIE)))
    if not is_sliced(d):
        return d
    d = written(d)
    # at most n events of a slice look into those before it
    open_ = d.where(F.col(name).isNull() & (F.col(rank) > n)).select(F.col(KEY).alias("_of"), F.col(rank).alias("_for"), (F.col(rank) - n).alias("_want"))
    found = d.join(open_, (F.col(KEY) == F.col("_of")) & (F.col(rank) == F.col("_want"))).select("_of", "_for", F.col(column).alias("_far"))
    return d.join(found, (F.col(KEY) == F.col("_of")) & (F.col(rank) == F.col("_for")), "left").withColumn(name, F.coalesce(name, "_far")).drop("_of", "_for", "_far")


def near(d: DataFrame, *by: str):
    """A window over the events of a key (and ``by``) in order; in a slice, over those of the slice and its ``haloed`` ones."""
    return Window.partitionBy(*lane(d), *by).orderBy(TIME, TIE)


def haloed(d: DataFrame, n: int, rank: str = "rn") -> DataFrame:
    """``d`` where a window of ``n`` rows may look back from any event: slices get the ``n - 1`` events before them, until ``settled``."""
    if not is_sliced(d):
        return d
    d = written(d)
    starts = d.groupBy(F.col(KEY).alias("_of"), F.col(SLICE).alias("_to")).agg(F.min(rank).alias("_start")).where("_start > 1")
    wanted = starts.select("_of", "_to", F.explode(F.sequence(F.greatest(F.col("_start") - (n - 1), F.lit(1).cast("long")), F.col("_start") - 1)).alias("_want"))
    before = d.join(wanted, (F.col(KEY) == F.col("_of")) & (F.col(rank) == F.col("_want"))).withColumn(SLICE, F.col("_to")).drop("_of", "_to", "_want")
    return d.withColumn("_halo", F.lit(False)).unionByName(before.withColumn("_halo", F.lit(True)))


def settled(d: DataFrame) -> DataFrame:
    """``d`` without the events that slices were lent."""
    return d.where(~F.col("_halo")).drop("_halo") if "_halo" in d.columns else d


def moments(d: DataFrame, column: str) -> DataFrame:
    """``d`` with ``_mean`` and ``_sd`` (sample deviation) of a column over the events of a key so far.

    Slices are merged by their counts, means and sums of squared deviations; the scan over slices measures the means
    from that of the whole key, so nothing large cancels.
    """
    w = Window.partitionBy(*lane(d)).orderBy(TIME, TIE).rowsBetween(Window.unboundedPreceding, 0)
    if not is_sliced(d):
        return d.withColumn("_mean", F.avg(column).over(w)).withColumn("_sd", F.stddev_samp(column).over(w))
    d = written(d.withColumn("_n1", F.count(column).over(w)).withColumn("_m1", F.avg(column).over(w)).withColumn("_q1", F.var_pop(column).over(w) * F.col("_n1")))
    before = Window.partitionBy(KEY).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(KEY)

    def scans(t: DataFrame) -> DataFrame:
        t = t.withColumn("_pivot", F.sum(F.col("_tn") * F.col("_tm")).over(whole) / F.sum("_tn").over(whole)).withColumn("_off", F.col("_tm") - F.col("_pivot"))
        t = t.withColumn("_n2", F.coalesce(F.sum("_tn").over(before), F.lit(0))).withColumn("_o2", F.sum(F.col("_tn") * F.col("_off")).over(before) / F.col("_n2").try_cast("double"))
        t = t.withColumn("_q2", F.sum(F.col("_tq") + F.col("_tn") * F.col("_off") * F.col("_off")).over(before) - F.col("_n2") * F.col("_o2") * F.col("_o2"))
        return t.select(KEY, SLICE, "_n2", (F.col("_pivot") + F.col("_o2")).alias("_m2"), "_q2")

    totals = {"_tn": F.count(column), "_tm": F.avg(column), "_tq": F.var_pop(column) * F.count(column)}
    d = _carried(d, (), totals, scans)
    n, apart, first = F.col("_n1") + F.col("_n2"), F.col("_m1") - F.col("_m2"), F.col("_n2") == 0
    mean = F.when(first, F.col("_m1")).otherwise(F.col("_m2") + apart * F.col("_n1") / n)
    square = F.when(first, F.col("_q1")).otherwise(F.col("_q1") + F.col("_q2") + apart * apart * F.col("_n1") * F.col("_n2") / n)
    d = d.withColumn("_mean", mean).withColumn("_sd", F.when(n > 1, F.sqrt(square / (n - 1))))
    return d.drop("_n1", "_m1", "_q1", "_n2", "_m2", "_q2")


def in_range(d: DataFrame, name: str, width_ms: int, most: int | None = None, of: str | None = None) -> DataFrame:
    """``d`` with the number of events in ``[ts - width, ts]`` up to the current one, by the ranks ``rn`` of a key; or, where times
    strictly increase, with the sum of the whole numbers ``of`` over these events.

    Over slices, each event sends a probe to the time where its range begins; probes and events are cut into slices of
    their own (of ``most``, or as many as the largest of ``d``) and in one order, and the running number of events at a probe says how many lie before the range. So a range may
    span any number of slices.
    """
    if not is_sliced(d):
        # what lies before the range is taken off: such a frame only grows, while a sliding one is summed anew at each event
        past = Window.partitionBy(KEY).orderBy(TIME).rangeBetween(Window.unboundedPreceding, -width_ms - 1)
        upto = F.sum(of).over(Window.partitionBy(KEY).orderBy(TIME, TIE).rowsBetween(Window.unboundedPreceding, 0)) if of else F.col("rn")
        return d.withColumn(name, upto - F.coalesce((F.sum(of) if of else F.max("rn")).over(past), F.lit(0)))
    d = running(d, _upto=Part("sum", of)) if of else d.withColumn("_upto", F.col("rn"))
    d = written(d)
    events = d.select(KEY, TIME, F.col("rn").alias(TIE), F.col(of).cast("int").alias("_one") if of else F.lit(1).alias("_one"))
    # at one time, probes come before events
    probes = d.select(KEY, (F.col(TIME) - width_ms).alias(TIME), (-F.col("rn")).alias(TIE), F.lit(0).alias("_one"))
    counted = running(cut_slices(events.unionByName(probes), most or largest(d)), _before=Part("sum", "_one"))
    starts = counted.where(F.col(TIE) < 0).select(F.col(KEY).alias("_of"), (-F.col(TIE)).alias("_for"), "_before")
    return d.join(starts, (F.col(KEY) == F.col("_of")) & (F.col("rn") == F.col("_for"))).withColumn(name, F.col("_upto") - F.col("_before")).drop("_of", "_for", "_before", "_upto")


def kinds_in_range(d: DataFrame, name: str, value: str, width_ms: int, most: int | None = None) -> DataFrame:
    """``d``, in slices, with the number of distinct values in ``[ts - width, ts]``; times strictly increase, ``rn`` are a key's ranks.

    A value is present from an event on until ``width`` after the last event with it that is no further from the one before. So
    presences open at events and close at times of their own, and the running sum of both, in slices of their own as ``in_range``
    has them, is the number of values.
    """
    d = written(running(d, value, _was=Part("last", TIME, before=True)))
    opens = F.col("_was").isNull() | (F.col(TIME) - F.col("_was") > width_ms)
    events = d.select(KEY, TIME, F.col("rn").alias(TIE), opens.cast("int").alias("_step"))
    ends = d.where(opens & F.col("_was").isNotNull()).select(KEY, F.col("_was").alias(TIME)).unionByName(d.groupBy(KEY, value).agg(F.max(TIME).alias(TIME)).select(KEY, TIME))
    # what ends at a time is gone for the event of that time
    closes = ends.select(KEY, (F.col(TIME) + width_ms + 1).alias(TIME), F.lit(-1).cast("long").alias(TIE), F.lit(-1).alias("_step"))
    counted = running(cut_slices(events.unionByName(closes), most or largest(d)), _now=Part("sum", "_step"))
    found = counted.where(F.col(TIE) > 0).select(F.col(KEY).alias("_of"), F.col(TIE).alias("_for"), F.col("_now").alias(name))
    return d.drop("_was").join(found, (F.col(KEY) == F.col("_of")) & (F.col("rn") == F.col("_for"))).drop("_of", "_for")


def values_in_range(alerts: DataFrame, rows: DataFrame, name: str, value: str, width_ms: int) -> DataFrame:
    """``alerts``, which are few, with the sorted distinct values that the ``rows`` of their key have in ``[ts - width, ts]``.

    They are met in the two stretches of ``width`` that the range touches, so a key's rows are spread by time.
    """
    stretch = F.floor(F.col(TIME) / width_ms)
    asked = alerts.select(F.col(KEY).alias("_of"), F.col(TIME).alias("_at"), F.explode(F.array(stretch, stretch - 1)).alias("_in"))
    met = rows.select(KEY, TIME, value, stretch.alias("_own")).join(asked, (F.col(KEY) == F.col("_of")) & (F.col("_own") == F.col("_in")) & F.col(TIME).between(F.col("_at") - width_ms, F.col("_at")))
    sets = met.groupBy("_of", "_at").agg(F.sort_array(F.collect_set(value)).alias(name))
    return alerts.join(sets, (F.col(KEY) == F.col("_of")) & (F.col(TIME) == F.col("_at"))).drop("_of", "_at")


def first_of(d: DataFrame, name: str, value: str, *by: str) -> DataFrame:
    """``d`` with whether an event is the first of its key (and ``by``) with its value; never where that is null."""
    if not is_sliced(d):
        nth = F.row_number().over(Window.partitionBy(KEY, *by, value).orderBy(TIME, TIE))
        return d.withColumn(name, (nth == 1) & F.col(value).isNotNull())
    d = written(d)
    place = F.struct(TIME, TIE)
    firsts = d.where(F.col(value).isNotNull()).groupBy(*[F.col(c).alias(f"_of_{c}") for c in (KEY, *by, value)]).agg(F.min(place).alias("_first"))
    on = F.lit(True)
    for c in (KEY, *by, value):
        on &= F.col(c) == F.col(f"_of_{c}")
    return d.join(firsts, on, "left").withColumn(name, F.coalesce(place == F.col("_first"), F.lit(False))).drop("_first", *[f"_of_{c}" for c in (KEY, *by, value)])


def reach(times: np.ndarray, width: int, inclusive: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of a slice's sorted times: stretches of events, by their last time, and the last anchor if a segment opens in one of them."""
    after = np.searchsorted(times, times + width, side="left" if inclusive else "right")
    after = np.maximum(after, np.arange(1, len(times) + 1))
    last = times.copy()
    for i in range(len(times) - 1, -1, -1):
        if after[i] < len(times):
            last[i] = last[after[i]]
    ends = np.flatnonzero(np.append(last[1:] != last[:-1], True))
    return times[ends], last[ends]


def entry_anchors(d: DataFrame, width_ms: int, inclusive: bool, *by: str) -> DataFrame:
    """``KEY, SLICE, _entry`` (and ``by``): the anchor that holds where a slice begins, null at the first of a key (and ``by``).

    A slice is summed up as a step function from where the first segment opens in it to its last anchor: chains of anchors
    soon meet, so it has few steps. The steps of a key (and ``by``) are followed slice by slice. With ``by``, what lies in one slice
    is left out, as no anchor holds where it begins.
    """
    names = [KEY, *by]
    if by:
        over = d.groupBy(*[F.col(n).alias(f"_of_{n}") for n in names]).agg(F.min(SLICE).alias("_low"), F.max(SLICE).alias("_high")).where("_low < _high").drop("_low", "_high")
        on = F.lit(True)
        for n in names:
            on &= F.col(n) == F.col(f"_of_{n}")
        d = d.join(written(over), on, "left_semi")
    kinds = ", ".join(f"`{n}` {d.schema[n].dataType.simpleString()}" for n in (*names, SLICE))

    def groups(batch: pa.RecordBatch, columns: list[str]) -> list[tuple]:
        return list(zip(*(batch.column(c).to_pylist() for c in columns)))

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of, kept = [], None, None

        def close() -> pa.RecordBatch:
            upto, last = reach(np.concatenate(held), width_ms, inclusive)
            steps = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (upto, last)]
            return pa.RecordBatch.from_arrays([*kept.columns, *steps], [*names, SLICE, "upto", "last"])

        for batch in batches:
            lanes, times = groups(batch, [*names, SLICE]), batch.column(TIME).to_numpy()
            cuts = [0, *(i for i in range(1, len(lanes)) if lanes[i] != lanes[i - 1]), len(lanes)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if of is not None and of != lanes[a]:
                    yield close()
                    held = []
                of, kept = lanes[a], batch.select([*names, SLICE]).slice(a, 1)
                held.append(times[a:b])
        if of is not None:
            yield close()

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchor = None, None
        for batch in batches:
            entries = []
            for k, upto, last in zip(groups(batch, names), batch.column("upto").to_pylist(), batch.column("last").to_pylist()):
                if k != key:
                    key, anchor = k, None
                entries.append(anchor)
                # the first stretch with an event out of the anchor's reach
                at = 0 if anchor is None else int(np.searchsorted(upto, anchor + width_ms, side="left" if inclusive else "right"))
                anchor = last[at] if at < len(upto) else anchor
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*names, SLICE)), pa.array(entries, pa.int64())], [*names, SLICE, "_entry"])

    ordered = d.select(*names, SLICE, TIME).repartition(*names, SLICE).sortWithinPartitions(*names, SLICE, TIME)
    steps = written(ordered.mapInArrow(sum_up, f"{kinds}, upto array<bigint>, last array<bigint>"))
    return written(steps.repartition(*names).sortWithinPartitions(*names, SLICE).mapInArrow(follow, f"{kinds}, _entry bigint"))
