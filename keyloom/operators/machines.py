"""Signals whose state depends on earlier alerts: ordered passes with a small step for each event."""

from __future__ import annotations

from bisect import bisect_right
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.parse import filled, is_no, is_yes
from keyloom.operators.kernels import KEY, TIE, TIME, emit, fold, last_rows, ordered, prepare


class RateLadder:
    """Failure rates that alert at the first of ``steps`` above the last rate alerted; a fall by ``reset`` below that starts over."""

    def __init__(self, steps: tuple[float, ...] = (0.3, 0.5, 0.7, 0.9), reset: float = 0.2) -> None:
        self.steps, self.reset, self.last = steps, reset, 0.0

    def step(self, rate: float) -> bool:
        if self.last > 0 and rate < self.last - self.reset:
            self.last = 0.0
        at = bisect_right(self.steps, self.last)
        if at == len(self.steps) or rate < self.steps[at]:
            return False
        self.last = rate
        return True


class DeviceCrowd:
    """Distinct devices within ``width_ms``; forgets all of them when ``on`` are reached."""

    def __init__(self, width_ms: int = 10_000, on: int = 3) -> None:
        self.width, self.on, self.seen = width_ms, on, deque()

    def step(self, ts: int, device: str) -> list[str] | None:
        self.seen.append((ts, device))
        while self.seen[0][0] < ts - self.width:
            self.seen.popleft()
        found = {d for _, d in self.seen}
        if len(found) < self.on:
            return None
        self.seen.clear()
        return sorted(found)


class ErrorEscalation:
    """Distinct errors in a streak of failures; ``on`` of them end it, as does a success or more than ``width_ms`` since its start."""

    def __init__(self, width_ms: int = 1_800_000, on: int = 4) -> None:
        self.width, self.on = width_ms, on
        self.start, self.errors = None, []

    def step(self, ts: int, error: str | None) -> tuple[int, list[str]] | None:
        """``error`` is None on a success. Returns the streak's start and its errors when it alerts."""
        if error is None:
            self.start, self.errors = None, []
            return None
        if self.start is None or ts - self.start > self.width:
            self.start, self.errors = ts, []
        self.errors.append(error)
        if len(set(self.errors)) < self.on:
            # only the last hundred failures count
            del self.errors[:-100]
            return None
        out = self.start, self.errors
        self.start, self.errors = None, []
        return out


def _machine(make, columns: list[str], act, names: list[str], types: list[pa.DataType]):
    """A fold step: one machine a key; rows where ``act(machine, *values)`` gives a tuple come out with it."""

    def build():
        held = [make()]

        def step(batch: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
            at, found = [], []
            for i, (fresh, *values) in enumerate(zip(new.tolist(), *(batch.column(c).to_pylist() for c in columns))):
                if fresh:
                    held[0] = make()
                if (got := act(held[0], *values)) is not None:
                    at.append(i)
                    found.append(got)
            rows = batch.take(pa.array(at, pa.int64()))
            more = [pa.array([f[k] for f in found], t) for k, t in enumerate(types)]
            return pa.RecordBatch.from_arrays([*rows.columns, *more], [*batch.schema.names, *names])

        return step

    return build


def _schema(d: DataFrame, more: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields) + ", " + more


def failure_rate(events: DataFrame, n: int = 50, least: int = 20, steps: tuple[float, ...] = (0.3, 0.5, 0.7, 0.9), reset: float = 0.2) -> DataFrame:
    """Share of failures among the last ``n`` results on a ladder of ``steps``; the shares are window sums, the ladder is a fold."""
    d = prepare(events, F.col("authResult").isNotNull(), dedup=True, nudge=True).withColumn("_no", is_no().cast("int"))
    w = last_rows(ordered(), n)
    d = d.withColumn("failed", F.sum("_no").over(w)).withColumn("n", F.least("rn", F.lit(n))).withColumn("rate", F.col("failed") / F.col("n"))
    d = d.where(F.col("n") >= least).select(KEY, TIME, TIE, "failed", "n", "rate")
    act = lambda m, rate: (True,) if m.step(rate) else None
    out = fold(d, _machine(lambda: RateLadder(steps, reset), ["rate"], act, ["hit"], [pa.bool_()]), _schema(d, "hit boolean"))
    return emit(out, "auth_failure_rate_rolling_v1", "Ratio", F.col("rate"), comments={"failure_count": F.col("failed"), "total_events": F.col("n"), "failure_rate": F.col("rate")})


def multi_device(events: DataFrame, width_ms: int = 10_000, on: int = 3) -> DataFrame:
    """Distinct devices within ``width_ms``; the devices seen are forgotten after an alert."""
    d = prepare(events, filled("deviceCode")).select(KEY, TIME, TIE, "deviceCode", "rn")
    act = lambda m, ts, device: (x,) if (x := m.step(ts, device)) else None
    out = fold(d, _machine(lambda: DeviceCrowd(width_ms, on), [TIME, "deviceCode"], act, ["devices"], [pa.list_(pa.string())]), _schema(d, "devices array<string>"))
    notes = {"alert_reason": F.lit("Several devices at the same time"), "distinct_device_count": F.size("devices"), "device_codes_involved": F.col("devices")}
    return emit(out, "auth_multi_device_concurrency_v1", "Count", F.size("devices"), F.col(TIME) - width_ms, comments=notes)


def error_escalation(events: DataFrame, width_ms: int = 1_800_000, on: int = 4) -> DataFrame:
    """The failure that makes ``on`` distinct errors in a streak of at most ``width_ms``."""
    d = prepare(events, filled("authResult"), dedup=True).where(is_no() | is_yes())
    error = F.when(is_no(), F.concat(F.coalesce("errorCode", F.lit("")), F.lit(":"), F.coalesce("subErrorCode", F.lit(""))))
    d = d.select(KEY, TIME, TIE, error.alias("error"), "rn")
    act = lambda m, ts, e: m.step(ts, e)
    out = fold(d, _machine(lambda: ErrorEscalation(width_ms, on), [TIME, "error"], act, ["start", "errors"], [pa.int64(), pa.list_(pa.string())]), _schema(d, "start bigint, errors array<string>"))
    n = F.size(F.array_distinct("errors"))
    notes = {
        "error_code_sequence": F.array_join("errors", " -> "), "distinct_error_count": n, "distinct_errors": F.sort_array(F.array_distinct("errors")), "total_failures_in_streak": F.size("errors"),
        "streak_duration_sec": (F.col(TIME) - F.col("start")) / 1000, "first_failure_time": F.col("start"), "last_failure_time": F.col(TIME),
        "explanation": F.format_string("%d different errors in %d failures in a row", n, F.size("errors")),
    }
    return emit(out, "auth_progressive_error_escalation", "Count", n, F.col("start"), comments=notes)


