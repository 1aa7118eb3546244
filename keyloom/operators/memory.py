"""Bounded memories of a key: maps that hold so many values and forget the one that came in first."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keyloom.operators.kernels import fold

#: What a memory says of a value: whether it is held, its count, the most frequent value and its count, and how many are held.
SAYS = "struct<known boolean, n bigint, top string, top_n bigint, size bigint>"


@dataclass
class Memory:
    """Counts of values in the order in which they came in. Beyond ``most``, the first goes, and its count with it."""

    most: int
    by_name: bool
    counts: dict[str, int] = field(default_factory=dict)
    born: dict[str, int] = field(default_factory=dict)
    top: str | None = None
    top_n: int = 0
    came: int = 0

    def _leads(self, value: str, n: int) -> bool:
        if n != self.top_n or self.top is None:
            return n > self.top_n
        return value < self.top if self.by_name else self.born[value] < self.born[self.top]

    def add(self, value: str) -> None:
        n = self.counts[value] = self.counts.get(value, 0) + 1
        if n == 1:
            self.came += 1
            self.born[value] = self.came
        if self._leads(value, n):
            self.top, self.top_n = value, n
        if len(self.counts) > self.most:
            oldest = next(iter(self.counts))
            del self.counts[oldest], self.born[oldest]
            if oldest == self.top:
                self.top, self.top_n = None, 0
                for v, c in self.counts.items():
                    if self._leads(v, c):
                        self.top, self.top_n = v, c

    def says(self, value: str) -> tuple[bool, int, str | None, int, int]:
        return value in self.counts, self.counts.get(value, 0), self.top, self.top_n, len(self.counts)


def remember(d: DataFrame, most: dict[str, int], by_name: bool = False, after: bool = False) -> DataFrame:
    """``d`` with ``<column>_seen`` (``SAYS``) for each column of ``most``: what a memory of that many of its values says of an event's
    value, before the event is added or ``after`` it.

    The most frequent value is, of several, the first in the alphabet (``by_name``) or the one that came in first. An ordered
    pass where the rows lie by key, with one memory a column and key; whether a value is still held depends on
    all that came since, which no window can say.
    """
    names = list(most)
    kind = pa.struct([("known", pa.bool_()), ("n", pa.int64()), ("top", pa.string()), ("top_n", pa.int64()), ("size", pa.int64())])

    def make() -> Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]:
        held = {c: Memory(most[c], by_name) for c in names}

        def step(batch: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
            columns = []
            fresh = new.tolist()
            for c in names:
                memory, said = held[c], []
                for begins, value in zip(fresh, batch.column(c).to_pylist()):
                    if begins:
                        memory = Memory(most[c], by_name)
                    if after:
                        memory.add(value)
                        said.append(memory.says(value))
                    else:
                        said.append(memory.says(value))
                        memory.add(value)
                held[c] = memory
                columns.append(pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*said), kind)], fields=list(kind)))
            return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *(f"{c}_seen" for c in names)])

        return step

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields), *(f"`{c}_seen` {SAYS}" for c in names)])
    return fold(d, make, schema)


def cooled(d: DataFrame, column: str, wait_ms: int, most: int) -> DataFrame:
    """Rows of ``d`` whose value didn't come out in the ``wait_ms`` before, by a memory of the last times of ``most`` values.

    A value that the memory forgot comes out again at once. An ordered pass, as a row that comes out decides on those after it.
    """

    def make() -> Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]:
        last: dict[str, int] = {}

        def step(batch: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
            out = []
            for i, (begins, value, ts) in enumerate(zip(new.tolist(), batch.column(column).to_pylist(), batch.column("ts").to_pylist())):
                if begins:
                    last.clear()
                if value in last and ts - last[value] < wait_ms:
                    continue
                last[value] = ts
                out.append(i)
                if len(last) > most:
                    del last[next(iter(last))]
            return batch.take(pa.array(out, pa.int64()))

        return step

    return fold(d, make, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields))


def distinct_within(d: DataFrame, column: str, width_ms: int, on: int) -> DataFrame:
    """``d`` with ``_c``, the distinct values in ``[ts - width, ts]``, and ``_set``, which they are where ``_c`` comes to ``on`` from below.

    An ordered pass that counts the values of the range as events come into it and leave it, so an event costs the same however many
    share its range. Times must strictly increase.
    """

    def make() -> Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]:
        inside: deque[tuple[int, str]] = deque()
        counts: dict[str, int] = {}

        def step(batch: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
            sizes, sets = [], []
            for begins, value, ts in zip(new.tolist(), batch.column(column).to_pylist(), batch.column("ts").to_pylist()):
                if begins:
                    inside.clear()
                    counts.clear()
                before = len(counts)
                while inside and inside[0][0] < ts - width_ms:
                    _, gone = inside.popleft()
                    counts[gone] -= 1
                    if not counts[gone]:
                        del counts[gone]
                inside.append((ts, value))
                counts[value] = counts.get(value, 0) + 1
                sizes.append(len(counts))
                sets.append(sorted(counts) if before < on <= len(counts) else None)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(sets, pa.list_(pa.string()))], [*batch.schema.names, "_c", "_set"])

        return step

    return fold(d, make, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields) + ", _c bigint, _set array<string>")
