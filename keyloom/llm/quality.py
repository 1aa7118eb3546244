"""Quality by ordinal cumulative-link regression on graded ratings."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import tidy, type_of
from keyloom.llm.toxicity import training_rows

BITS = 16
#: Tokens whose buckets a task keeps at most; then it starts afresh.
KNOWN = 100_000
CORE = re.compile(r"[^\W\d_]+")
RUNS = re.compile(r"(.)\1+", re.S)


def bucket(name: str) -> int:
    return crc32(name.encode()) & ((1 << BITS) - 1)


class Tokens(dict):
    """``(word bucket, shape bucket, kind)`` by token; the shape is its case and the marks around its letters, repeats once.

    The kind is 0 for plain tokens, 1 for words in capitals, 2 for tokens without a letter, 4 where several marks end a word.
    """

    def __missing__(self, token: str) -> tuple[int, int, int]:
        if len(self) > KNOWN:
            self.clear()
        if m := CORE.search(token):
            upper = m.end() - m.start() > 1 and m[0].isupper()
            end = token[m.end() :]
            shape, kind = "sU" * upper + "sl" * (not upper) + RUNS.sub(r"\1", end), upper + 4 * (len(end) > 1)
        else:
            shape, kind = "s-" + RUNS.sub(r"\1", token), 2
        found = self[token] = bucket("w" + token.lower()), bucket(shape), kind
        return found


def _level(rate: float) -> int:
    return min(int(rate * 10 + 0.999), 10)


def features(text: str | None, known: Tokens) -> tuple[list[int], list[float]]:
    """Hashed buckets of a whole text with their values: words and shapes by share, and levels of its rates by its size.

    Shares of words carry topic, shapes and levels carry layout: capitals, marks, repeats, repeated and short lines.
    """
    words = (text or "").split()
    n = len(words)
    found: dict[int, float] = {}
    size = n.bit_length()
    if n:
        counts = Counter(words)
        kinds = [0] * 8
        for (word, shape, kind), c in zip(map(known.__getitem__, counts), counts.values()):
            found[word] = found.get(word, 0.0) + c / n
            found[shape] = found.get(shape, 0.0) + 4 * c / n
            kinds[kind] += c
        lines = [x for x in text.split("\n") if x.strip()]
        rates = {
            "upper": (kinds[1] + kinds[5]) / n, "bare": kinds[2] / n, "marks": (kinds[4] + kinds[5]) / n, "again": sum(map(eq, words, words[1:])) / n, "top": max(counts.values()) / n, "kinds": len(counts) / n,
            "lines": 1 - len(set(lines)) / len(lines),
        }
        for name, rate in rates.items():
            found[bucket(f"r{name}{_level(rate)}")] = 1.0
            found[bucket(f"r{name}{_level(rate)}n{size}")] = 0.5
        for level, c in Counter(len(x.split()).bit_length() for x in lines).items():
            found[bucket(f"l{level}")] = c / len(lines)
    found[bucket(f"n{size}")] = 0.5
    return list(found), list(found.values())


class Model:
    """Weights shared by all thresholds, and the ordered thresholds: P(grade > k) = sigmoid(w.x - t[k])."""

    def __init__(self, weight: np.ndarray, thresholds: np.ndarray) -> None:
        self.weight, self.thresholds = weight.astype(np.float32), thresholds.astype(np.float64)

    def tails(self, text: str | None, known: Tokens) -> np.ndarray:
        ids, values = features(text, known)
        z = float(self.weight[ids] @ np.array(values, dtype=np.float32)) if ids else 0.0
        return 1 / (1 + np.exp(-np.clip(z - self.thresholds, -40, 40)))


def fit(grade: np.ndarray, doc_of: np.ndarray, ids: np.ndarray, values: np.ndarray, grades: int, rounds: int, rate: float, penalty: float) -> Model:
    """Adam on the cumulative-link likelihood; gaps between thresholds stay positive as exponentials."""
    names, ids = np.unique(ids, return_inverse=True)
    k, n = grades - 1, len(grade)
    x = np.zeros(len(names) + k)
    x[-k] = -1.0
    m, v = np.zeros_like(x), np.zeros_like(x)
    share = np.bincount(grade, minlength=grades) / n
    weigh = 1 / np.maximum(share[grade] * grades, 1e-9) ** 0.5
    for step in range(1, rounds + 1):
        gaps = np.exp(x[len(names) + 1 :])
        t = x[len(names)] + np.concatenate(([0.0], np.cumsum(gaps)))
        z = np.bincount(doc_of, x[ids] * values, minlength=n)
        tail = 1 / (1 + np.exp(-np.clip(z[:, None] - t, -40, 40)))
        full = np.hstack([np.ones((n, 1)), tail, np.zeros((n, 1))])
        p = np.maximum(full[np.arange(n), grade] - full[np.arange(n), grade + 1], 1e-12)
        d = full * (1 - full)
        up, down = d[np.arange(n), grade], d[np.arange(n), grade + 1]
        dz = -weigh * (up - down) / p / n
        dt = np.zeros(k)
        for j in range(k):
            dt[j] = (weigh * (np.where(grade == j + 1, up, 0) - np.where(grade == j, down, 0)) / p).sum() / n
        g = np.concatenate([np.bincount(ids, dz[doc_of] * values, minlength=len(names)) + penalty * x[: len(names)], [dt.sum()], np.cumsum(dt[::-1])[::-1][1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weight = np.zeros(1 << BITS)
    weight[names] = x[: len(names)]
    return Model(weight, x[len(names)] + np.concatenate(([0.0], np.cumsum(np.exp(x[len(names) + 1 :])))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    grade: str = "grade",
    grades: int = 3,
    max_docs: int = 12_000,
    rounds: int = 150,
    rate: float = 0.1,
    penalty: float = 1e-4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """A model of the grades 0 to ``grades - 1`` on at most about ``max_docs`` labelled rows with ``learn``.

    Tasks hash the sample's texts; the driver holds the hashed features alone, whose size the bound limits. Null labels and
    ids are left out, null texts are empty ones, of several labels of an id the largest counts, and rows that repeat an
    id count each. Without labels (or rows), or with one grade only, every text gets the best grade.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        for batch in batches:
            found = [features(t, known) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.list_(pa.int32())), pa.array([y for _, y in found], pa.list_(pa.float32()))], ["label", "ids", "values"]
            )

    rows = training_rows(docs, labels, learn, max_docs, id_col, text_col, grade)
    got = rows.mapInArrow(tidy(hashed), "label int, ids array<int>, values array<float>").toArrow().combine_chunks()
    y = got.column("label").to_numpy().astype(np.int64)
    if len(np.unique(y)) < 2:
        return Model(np.zeros(1 << BITS), np.full(grades - 1, -4.0))
    ids, values = (pa.compute.list_flatten(got.column(c)).to_numpy() for c in ("ids", "values"))
    doc_of = np.repeat(np.arange(len(y)), pa.compute.list_value_length(got.column("ids")).to_numpy())
    return fit(y, doc_of, ids, values.astype(np.float64), grades, rounds, rate, penalty)


def grades(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, expected_grade, tails`` per row; ``tails[k]`` is P(grade > k).

    A null or empty text is scored by its length bucket alone; repeated rows get equal rows; an empty table gives
    none; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, Tokens()
        for batch in batches:
            tails = [own.tails(t.as_py(), known) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([float(t.sum()) for t in tails]), pa.array([t.tolist() for t in tails], pa.list_(pa.float64()))], ["doc_id", "expected_grade", "tails"])

    return docs.select(id_col, text_col).mapInArrow(tidy(run), f"doc_id {type_of(docs, id_col)}, expected_grade double, tails array<double>")


def select_documents(docs: DataFrame, model: Model, least: float = 0.5, above: int = 0, text_col: str = "text") -> DataFrame:
    """``docs`` whose probability of a grade over ``above`` is at least ``least``, scored in the same pass, without a join.

    A probability of just ``least`` stays. Null and empty texts are scored by their size alone, very long ones whole; repeated
    rows fare alike; an empty table gives no rows; all columns pass through, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, Tokens()
        for batch in batches:
            yield batch.filter(pa.array([bool(own.tails(t.as_py(), known)[above] >= least) for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
