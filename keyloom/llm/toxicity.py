"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, trained from document labels."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import small_enough, type_of

TOKEN = re.compile(r"[^\W_]+")
ENDS = re.compile(r"[.!?]*")
#: Tokens, and words, whose pieces a task keeps at most; then it starts afresh.
KNOWN = 400_000
#: One character for one: sentence ends become line ends, other ASCII marks become spaces.
MARKS = {i: " " for i in range(128) if i != 10 and not chr(i).isalnum()} | {ord(c): "\n" for c in ".!?"}


class Words(dict):
    """The words of a token in lower case, each once."""

    def __missing__(self, token: str) -> tuple[str, ...]:
        if len(self) > KNOWN:
            self.clear()
        low = token.lower()
        found = self[token] = (low,) if low.isalnum() else tuple(dict.fromkeys(TOKEN.findall(low)))
        return found


def sentences(text: str, known: Words) -> list[tuple[int, int, set[str]]]:
    """``(start, end, words)`` of the sentences with a word: runs up to a full stop, mark or line end."""
    out, at = [], 0
    for part in text.translate(MARKS).split("\n"):
        if tokens := part.split():
            if words := set(chain.from_iterable(map(known.__getitem__, tokens))):
                out.append((at, at + len(part), words))
        at += len(part) + 1
    return out


def parts(word: str) -> set[bytes]:
    """A word and its 4- and 5-byte pieces, ends marked: inflected and compound forms share pieces."""
    marked = f"^{word}$".encode("utf-8", "replace")
    own = {marked[i : i + 4] for i in range(len(marked) - 3)}
    own.update([marked[i : i + 5] for i in range(len(marked) - 4)])
    own.add(marked)
    return own


class Weights(dict):
    """Weights by word: the sum of those of its pieces."""

    def __init__(self, piece: dict[bytes, float]) -> None:
        self.piece = piece

    def __missing__(self, word: str) -> float:
        if len(self) > KNOWN:
            self.clear()
        found = self[word] = sum(map(self.piece.get, self.piece.keys() & parts(word)))
        return found


class Model:
    """Weights of word pieces and a bias."""

    def __init__(self, weight: dict[bytes, float], bias: float) -> None:
        self.weight, self.bias = weight, float(bias)

    def scorer(self):
        """A function from sentences to their probabilities."""
        weights = Weights(self.weight)

        def scores(found: list[tuple[int, int, set[str]]]) -> np.ndarray:
            z = np.array([self.bias + sum(map(weights.__getitem__, words)) for _, _, words in found])
            return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

        return scores


def noisy_or(p: np.ndarray) -> float:
    """The probability that at least one sentence is toxic, each on its own."""
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, max_docs: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``label, text`` of at most about ``max_docs`` labelled rows with ``learn``, chosen by a hash of the id.

    Three quarters of the bound go to the labels by their numbers and one to all alike, so that a rare label has rows
    however large the table is. Of several labels of an id the largest counts; null labels and ids are left out.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & learn).groupBy(F.col(id_col).alias("_kl_id")).agg(F.max(label_col).cast("int").alias("_kl_label"))
    sizes = {r["_kl_label"]: r["count"] for r in marked.groupBy("_kl_label").count().collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("_kl_label") == label, min(1.0, max_docs * (0.75 / sum(sizes.values()) + 0.25 / (len(sizes) * n)))).otherwise(share)
    at = F.pmod(F.xxhash64(F.col("_kl_id").cast("string"), F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    chosen = marked.where(at < share)
    texts = docs.select(F.col(id_col).alias("_kl_doc"), F.coalesce(text_col, F.lit("")).alias("text"))
    return texts.join(small_enough(chosen, 4 * max_docs), F.col("_kl_doc") == F.col("_kl_id")).select(F.col("_kl_label").alias("label"), "text")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part, toxic, other``: documents of a batch with a word piece, by label."""
    known = Words()
    for batch in batches:
        found: dict[bytes, list[int]] = {}
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for h in set().union(*map(parts, {w for _, _, words in sentences(text, known) for w in words})):
                found.setdefault(h, [0, 0])[label != 1] += 1
        n = np.array(list(found.values()), dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(n[:, 0]), pa.array(n[:, 1])], ["part", "toxic", "other"])


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    max_docs: int = 8_000,
    rounds: int = 300,
    rate: float = 0.05,
    penalty: float = 1e-4,
    rare: int = 5,
    screen: float = 4.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Weights fitted to document labels on a bounded sample of at most about ``max_docs`` labelled rows.

    Spark counts the sample's word pieces by label. Those in ``rare`` documents whose share among toxic documents
    differs from that among others by ``screen`` standard errors are the features; most words of a toxic document are
    not what makes it toxic. Null labels and ids are left out, null texts are empty ones, of several labels
    of an id the largest counts. Without rows of two labels all texts score low. Tasks turn sentences into features; the driver holds these alone, whose size the bound on
    documents limits, and takes ``rounds`` Adam steps on the log loss of the noisy-or.
    """
    rows = training_rows(docs, labels, learn, max_docs, id_col, text_col, label_col).persist()
    by_label = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n1, n0 = by_label.get(1, 0), sum(n for x, n in by_label.items() if x != 1)
    if not n1 or not n0:
        rows.unpersist()
        return Model({}, -4.0)
    counts = rows.mapInArrow(_counts, "part binary, toxic bigint, other bigint").groupBy("part").agg(F.sum("toxic").alias("d1"), F.sum("other").alias("d0"))
    p = (F.col("d1") + F.col("d0") + 1) / (n1 + n0 + 2)
    z = (F.col("d1") / n1 - F.col("d0") / n0) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    names = sorted(bytes(r["part"]) for r in counts.where((F.col("d1") + F.col("d0") >= rare) & (F.abs(z) >= screen)).select("part").collect())
    place = {h: i for i, h in enumerate(names)}
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known = shared.value, Words()
        for batch in batches:
            ids, sizes = [], []
            for text in batch.column(1).to_pylist():
                own = [[at[h] for w in sorted(words) for h in sorted(parts(w)) if h in at] for _, _, words in sentences(text, known)]
                ids.append([b for s in own for b in s])
                sizes.append([len(s) for s in own])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int32()))], ["label", "ids", "sizes"])

    got = rows.mapInArrow(features, "label int, ids array<int>, sizes array<int>").toArrow()
    rows.unpersist()
    got = got.filter(pa.compute.greater(pa.compute.list_value_length(got.column("sizes")), 0)).combine_chunks()
    y = (got.column("label").to_numpy() == 1).astype(np.float64)
    ids, sizes = (pa.compute.list_flatten(got.column(c)).to_numpy() for c in ("ids", "sizes"))
    x = fit(y, pa.compute.list_value_length(got.column("sizes")).to_numpy(), sizes, ids, len(names), rounds, rate, penalty)
    return Model(dict(zip(names, x[:-1].tolist())), x[-1])


def fit(y: np.ndarray, n_sentences: np.ndarray, sizes: np.ndarray, ids: np.ndarray, n: int, rounds: int, rate: float, penalty: float) -> np.ndarray:
    """Weights and bias by Adam: documents of ``n_sentences``, sentences of ``sizes`` features, features ``ids``."""
    doc_of = np.repeat(np.arange(len(y)), n_sentences)
    sentence_of = np.repeat(np.arange(len(sizes)), sizes)
    first = np.concatenate(([0], np.cumsum(n_sentences)[:-1]))
    x, m, v = (np.zeros(n + 1) for _ in range(3))
    x[-1] = -6.0
    for step in range(1, rounds + 1):
        z = np.bincount(sentence_of, x[ids], minlength=len(sizes)) + x[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        q = np.exp(np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-12)), first))
        slope = np.where(y == 1, -q / np.maximum(1 - q, 1e-12), 1.0)
        dz = slope[doc_of] * p
        g = np.append(np.bincount(ids, dz[sentence_of], minlength=n), dz.sum()) / len(y)
        g[:-1] += penalty * x[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return x


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", at: float = 0.5) -> DataFrame:
    """``doc_id, score, spans`` per row: the noisy-or of all sentences, and start, end and score of those of at least ``at``.

    A null or empty text, or one without a word, has score 0 and no spans; repeated rows get equal rows; an empty
    table gives none; other columns are ignored. Sentences of very long texts are scored one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, known = shared.value.scorer(), Words()
        for batch in batches:
            total, spans = [], []
            for text in batch.column(1).to_pylist():
                found = sentences(text or "", known)
                p = scores(found)
                total.append(noisy_or(p))
                spans.append([{"start": found[i][0], "end": ENDS.match(text, found[i][1]).end(), "score": float(p[i])} for i in np.flatnonzero(p >= at)])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "spans"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {type_of(docs, id_col)}, score double, spans array<struct<start int, end int, score double>>")
