"""The kernels that all signals are made of.

Events are rows with ``entity_id`` (the key), ``ts`` (event time in milliseconds), ``event_id`` (breaks ties) and the
fields of the event. The one order used is ``(ts, event_id)`` within a key, so every kernel needs the same exchange and sort,
and Spark plans these once for a chain of kernels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from keyloom.functions.tables import written
from keyloom.operators.slices import KEY, SLICE, TIE, TIME, Part, entry_anchors, first_of, in_range, is_sliced, lane, ranked_apart, running


#: A column that says after how many idle milliseconds a signal forgets a key.
LIFE = "_life_ms"


def ordered(*more: str) -> WindowSpec:
    """A key's events (within the further columns ``more``) in order."""
    return Window.partitionBy(KEY, *more).orderBy(TIME, TIE)


def before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def prefix(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def prepare(events: DataFrame, eligible: Column | None = None, dedup: bool = False, nudge: bool = False, rank: bool = True) -> DataFrame:
    """Eligible events with their rank ``rn``, unless ``rank`` is off.

    ``dedup`` drops an event whose id equals the last non-empty id before it. ``nudge`` moves times up so that they strictly
    increase: t' = max(t, t'_before + 1), whose closed form is rn + max over the prefix of (t - rn).
    """
    d = events if eligible is None else events.where(eligible)
    if LIFE in d.columns:
        d = expire(d, F.col(LIFE)).drop(LIFE)
    if dedup:
        own = F.when(F.col("eventId") != "", F.col("eventId"))
        d = running(d.withColumn("_id", own), _last=Part("last", "_id", before=True))
        d = d.where(F.col("_id").isNull() | F.col("_last").isNull() | (F.col("_id") != F.col("_last"))).drop("_id", "_last")
    if not rank:
        return d
    if nudge and is_sliced(d):
        return ranked_apart(d)
    d = ranked(d)
    if nudge:
        d = running(d.withColumn("_shift", F.col(TIME) - F.col("rn")), _most=Part("max", "_shift"))
        d = d.withColumn(TIME, F.col("_most") + F.col("rn")).drop("_shift", "_most")
    return d


def ranked(d: DataFrame) -> DataFrame:
    """``d`` with the rank ``rn`` of an event in its key."""
    if is_sliced(d):
        return running(d.withColumn("_one", F.lit(1).cast("long")), rn=Part("sum", "_one")).drop("_one")
    return d.withColumn("rn", F.row_number().over(ordered()))


def latch(d: DataFrame, on: Column, off: Column, *more: str) -> DataFrame:
    """Rows where ``on`` holds and the latch is open; ``on`` closes it and ``off`` opens it again, neither keeps it."""
    d = running(d.withColumn("_sig", F.when(on, 1).when(off, 0)), *more, _held=Part("last", "_sig", before=True))
    return d.where((F.col("_sig") == 1) & (F.coalesce("_held", F.lit(0)) == 0)).drop("_sig", "_held")


def islands(d: DataFrame, starts: Column, name: str = "island") -> DataFrame:
    """Numbers the islands of a key: an event where ``starts`` holds begins a new one."""
    return running(d.withColumn("_start", F.when(starts, 1).otherwise(0)), **{name: Part("sum", "_start")}).drop("_start")


def change_of(value: Column, w: WindowSpec | None = None) -> Column:
    """Whether ``value`` differs from that of the event before; true for the first."""
    return ~value.eqNullSafe(F.lag(value).over(w or ordered())) | (F.col("rn") == 1)


def fold(rows: DataFrame, function: Callable[[], Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]], schema: str, *by: str) -> DataFrame:
    """An ordered pass over the events of each key (and ``by``), in bounded memory.

    A window that numbers the events lies under the pass, so Spark itself brings a key's events together in order, by an exchange
    where they don't lie so already. Batches stream through, so a key of any length is never held. For each partition
    ``function()`` makes a step that gets a batch and the places where a key begins, and keeps what it must. Numbers that don't follow
    one another say that a key was torn apart, and fail the job.
    """
    names = [*lane(rows), *by]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, last = function(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            nth = batch.column("_nth").to_numpy()
            new = nth == 1
            if not (new | (nth == np.append(last, nth[:-1]) + 1)).all():
                raise RuntimeError("the events of a key don't lie together in order")
            last = nth[-1]
            yield step(batch.select([n for n in batch.schema.names if n != "_nth"]), new)

    numbered = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*names).orderBy(TIME, TIE)))
    return numbered.sortWithinPartitions(*names, TIME, TIE).mapInArrow(run, schema)


def _anchors(width: int, inclusive: bool):
    """For a sorted run of times: the time of the last anchor at or before each. An anchor holds for ``width`` ms."""

    def make():
        held: list[int | None] = [None]

        def step(batch: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
            t = batch.column(TIME).to_numpy()
            entry = batch.column("_entry") if "_entry" in batch.schema.names else None
            out = np.empty(len(t), dtype=np.int64)
            cuts = [0, *np.flatnonzero(new[1:]) + 1, len(t)]
            for a, b in zip(cuts, cuts[1:]):
                anchor = held[0] if not new[a] else entry[a].as_py() if entry is not None else None
                at = a
                while at < b:
                    if anchor is None or (at == a and new[a] and (t[at] - anchor >= width if inclusive else t[at] - anchor > width)):
                        anchor = int(t[at])
                    # the first event past the anchor's reach takes over
                    end = a + int(np.searchsorted(t[a:b], anchor + width, side="left" if inclusive else "right"))
                    end = max(end, at)
                    out[at:end] = anchor
                    at = end
                    if at < b:
                        anchor = None
                held[0] = anchor
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "anchor"])

        return step

    return make


def segments(rows: DataFrame, width_ms: int, *by: str, inclusive: bool = False) -> DataFrame:
    """``rows`` with ``anchor``, the time of the event that opened their segment.

    The first event of a key (and ``by``) opens one; an event more than ``width_ms`` after the anchor (``inclusive``: that or more)
    opens the next. Where each anchor lies depends on the one before, so this is an ordered pass that jumps from anchor
    to anchor. One exchange after it serves all windows of the segments, and is shared by all that read them.
    """
    if not is_sliced(rows):
        return fold(rows, _anchors(width_ms, inclusive), f"{_schema(rows)}, anchor bigint", *by).repartition(KEY)
    rows = written(rows)
    entries = entry_anchors(rows, width_ms, inclusive, *by)
    on = F.lit(True)
    for c in (KEY, SLICE, *by):
        entries = entries.withColumnRenamed(c, f"_of_{c}")
        on &= F.col(c) == F.col(f"_of_{c}")
    rows = rows.join(entries, on, "left").drop(*[f"_of_{c}" for c in (KEY, SLICE, *by)])
    return fold(rows, _anchors(width_ms, inclusive), f"{_schema(rows)}, anchor bigint", *by).drop("_entry")


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def first_seen(d: DataFrame, value: Column, name: str, *by: str) -> DataFrame:
    """Adds ``name``_new, whether this is the first event of its key (and ``by``) with the value, and ``name``_n, distinct values so far."""
    d = first_of(d.withColumn("_v", value), f"{name}_new", "_v", *by)
    return running(d.withColumn("_new", F.col(f"{name}_new").cast("int")), *by, **{f"{name}_n": Part("sum", "_new")}).drop("_v", "_new")


def counts_at(alerts: DataFrame, rows: DataFrame, value: str, *by: str) -> DataFrame:
    """``alerts``, which are few, with ``_counts``: how often each value came in the ``rows`` of their key (and ``by``) up to them, by rank."""
    names = [KEY, *by]
    until = alerts.select(*names, F.col("rn").alias("_at")).join(rows.select(*names, "rn", F.col(value).alias("_v")), names).where(F.col("rn") <= F.col("_at"))
    each = until.groupBy(*names, "_at", "_v").agg(F.count(F.lit(1)).alias("_c"))
    maps = each.groupBy(*names, F.col("_at").alias("rn")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("_v", "_c")))).alias("_counts"))
    return alerts.join(maps, [*names, "rn"])


def expire(events: DataFrame, idle_ms: int | Column) -> DataFrame:
    """Splits each key where it was idle for ``idle_ms``, as state with that time to live would be forgotten.

    The parts are keys of their own, ``<key>\\0<number>``; ``unexpire`` restores the key.
    """
    idle = F.col(TIME) - F.lag(TIME).over(ordered()) >= idle_ms
    part = F.sum(F.when(idle, 1).otherwise(0)).over(prefix(ordered()))
    return events.withColumn("_part", part).withColumn(KEY, F.concat_ws("\0", F.col(KEY), F.col("_part"))).drop("_part")


def with_life(events: DataFrame, idle_ms: int) -> DataFrame:
    """``events`` whose signals forget a key that was idle for ``idle_ms``.

    The clock of each signal counts the events that touch its state, which are its eligible ones, so ``prepare`` reads the
    mark and splits keys below its filter.
    """
    return events.withColumn(LIFE, F.lit(idle_ms))


def unexpire(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn(KEY, F.substring_index(KEY, "\0", 1))


def emit(d: DataFrame, name: str | Column, kind: str, value: Column, start: Column | None = None, end: Column | None = None, comments: dict[str, Column] | None = None) -> DataFrame:
    """Alert rows in the common form. Without ``comments`` the envelope adds the default ones."""
    none = F.lit(None).cast("bigint")
    return d.select(
        F.col(KEY),
        (F.lit(name) if isinstance(name, str) else name).alias("feature_name"),
        F.lit(kind).alias("feature_type"),
        value.cast("double").alias("feature_value"),
        F.col(TIME).cast("long").alias("event_ts_ms"),
        (start.cast("long") if start is not None else none).alias("window_start_ms"),
        (end if end is not None else F.col(TIME)).cast("long").alias("window_end_ms"),
        (F.to_json(F.struct(*[c.alias(k) for k, c in comments.items()])) if comments else F.lit(None).cast("string")).alias("comments"),
    )
