"""Language identification: word frequencies first, shorter and shorter character n-grams for unseen words."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import small_enough, type_of

LETTERS = re.compile(r"[^\W\d_]+")
ORDERS = (4, 3, 2, 1)
UNKNOWN = "und"
#: Tokens whose scores a task keeps at most; then it starts afresh.
KNOWN_TOKENS = 200_000


def words_of(token: str) -> list[str]:
    """The runs of letters (Unicode category L) in a token, in lower case."""
    low = token.lower()
    if low.isalpha():
        return [low]
    runs = LETTERS.findall(low)
    if all(map(str.isalpha, runs)):
        return runs
    # the pattern also takes number signs such as fractions and Roman numerals
    return "".join(c if c.isalpha() else " " for c in low).split()


def _grams(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    marked = f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies by language of words and n-grams; ``tables[0]`` holds the words."""

    def __init__(self, rows: list[tuple[int, str, str, int]]) -> None:
        self.langs = sorted({lang for _, _, lang, _ in rows})
        place = {x: i for i, x in enumerate(self.langs)}
        self.tables: dict[int, tuple[dict[str, int], np.ndarray]] = {}
        for order in (0, *ORDERS):
            own = [r for r in rows if r[0] == order]
            index = {g: i for i, g in enumerate(sorted({r[1] for r in own}))}
            n = np.zeros((len(index), len(self.langs)))
            for _, gram, lang, count in own:
                n[index[gram], place[lang]] = count
            total = n.sum(axis=0) + 0.5 * (len(index) + 1)
            self.tables[order] = index, np.log((n + 0.5) / total).astype(np.float32)

    def unseen(self, word: str) -> np.ndarray:
        """Mean log frequency of an unknown word's longest n-grams that occur in the model at all, or zero."""
        for n in ORDERS:
            index, logs = self.tables[n]
            if known := [index[g] for g in _grams(word, n) if g in index]:
                return logs[known].mean(axis=0)
        return np.zeros(len(self.langs), dtype=np.float32)


class Tokens(dict):
    """Rows by token of ``table``: the summed scores of its words, and how many words it has. Known words come first in it."""

    def __init__(self, model: Model) -> None:
        self.model, (self.words, logs) = model, model.tables[0]
        self.table = np.concatenate((np.hstack((logs, np.ones((len(logs), 1), dtype=np.float32))), np.zeros((1024, len(model.langs) + 1), dtype=np.float32)))
        self.used = len(logs)

    def __missing__(self, token: str) -> int:
        words = words_of(token)
        if len(words) == 1 and (at := self.words.get(words[0])) is not None:
            self[token] = at
            return at
        at = self[token] = self.used
        self.used += 1
        if at == len(self.table):
            self.table = np.concatenate((self.table, np.zeros_like(self.table)))
        for word in words:
            self.table[at, :-1] += self.model.unseen(word) if (own := self.words.get(word)) is None else self.table[own, :-1]
        self.table[at, -1] = len(words)
        return at


def _scorer(model: Model):
    tokens = Tokens(model)

    def score(text: str | None) -> tuple[str, float]:
        nonlocal tokens
        if not text or not model.langs:
            return UNKNOWN, 0.0
        if len(tokens) > KNOWN_TOKENS:
            tokens = Tokens(model)
        counts = Counter(text.split())
        rows = list(map(tokens.__getitem__, counts))
        *total, n = np.fromiter(counts.values(), dtype=np.float64, count=len(counts)) @ tokens.table[rows]
        if not n:
            return UNKNOWN, 0.0
        # words of a text are not independent: the evidence grows with the root of their number
        z = np.array(total) / math.sqrt(n)
        p = np.exp(z - z.max())
        best = int(p.argmax())
        return model.langs[best], float(p[best] / p.sum())

    return score


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", max_docs: int = 20_000) -> Model:
    """Frequencies of all words and n-grams in at most about ``max_docs`` labelled rows, counted in Spark.

    Each language has an equal part of the rows, those first by a hash of the id; a rare one is taken whole. So the bound
    on rows limits the model and no language is missed. A column without labels gives a model without languages, which
    predicts ``und``.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).cast("string").alias("id"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).crossJoin(rows.select(F.count_distinct("lang").alias("langs")))
    shares = sizes.select(F.col("lang").alias("s_lang"), (F.lit(float(max_docs)) / F.col("langs") / F.col("n")).alias("share"))
    at = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.lit(7)), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.join(small_enough(shares, 10_000), F.col("lang") == F.col("s_lang")).where(at < F.col("share")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens.setdefault(lang, Counter()).update(text.split())
            for lang, own in tokens.items():
                tables: dict[int, Counter] = {n: Counter() for n in (0, *ORDERS)}
                for token, c in own.items():
                    for word in words_of(token):
                        tables[0][word] += c
                for word, c in tables[0].items():
                    for n in ORDERS:
                        for g in _grams(word, n):
                            tables[n][g] += c
                for n, table in tables.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n] * len(table), pa.int32()), pa.array(list(table), pa.string()), pa.array([lang] * len(table)), pa.array(list(table.values()), pa.int64())],
                        ["kind", "gram", "lang", "n"],
                    )

    counts = sample.mapInArrow(count, "kind int, gram string, lang string, n bigint").groupBy("kind", "gram", "lang").agg(F.sum("n").alias("n"))
    return Model(list(zip(*(c.to_pylist() for c in counts.select("kind", "gram", "lang", "n").toArrow().columns))))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` per row of ``docs``; see ``identify``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(shared.value)
        for batch in batches:
            found = [score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {type_of(docs, id_col)}, lang_pred string, score double")


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """``doc_id, lang_pred, score`` for every whole text, from a model of the labelled rows where ``learn`` holds.

    A word is a run of letters (Unicode category L) in lower case. Known words are scored by their log frequency in each
    language; an unseen word by its character 4-grams, or its 3-, 2- or 1-grams where none of the longer are known. The
    score is the share of the best language. A null text, or
    one without a letter, is ``und`` with score 0; repeated rows get equal rows; an empty table gives no rows; ties go
    to the first language by code points; other columns are ignored.
    """
    return predict(docs, train(docs.where(learn), text_col, lang_col, id_col, **options), id_col, text_col)
