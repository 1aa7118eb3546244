"""Quality rules whose cutoffs adapt to language and source."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import cut, map_texts, small_enough, type_of

SYMBOLS = b"#*$%&|<>"
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: For each rate, the share of a group's documents that counts as ordinary, and how many times as far beyond that as it lies
#: above the median a document may be. Repeats are ordinary in clean text, so their range takes in nearly all documents.
RULES = {"symbol_rate": (0.9, 3.0), "dup_line_rate": (0.99, 1.0), "repeat_rate": (0.99, 1.0), "chars_a_word": (0.9, 3.0)}
#: Standard errors of a document's own rate, that of a count of single events, that speak for it: short texts vary more.
ERRORS = 3.0


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """BASE of one whole text. ``bytes.split`` parts words at the six ASCII white-space characters."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, SPACE))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip(SPACE):
            seen.add(line)
    repeat = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        n = Counter(windows)
        at = np.fromiter((n[w] > 1 for w in windows), dtype=bool, count=len(windows))
        covered = np.zeros(len(words), dtype=bool)
        for k in range(3):
            covered[k : k + len(at)] |= at
        repeat = int(covered.sum())
    return len(words), len(text) - spaces, symbols, dup, repeat


def _batch(b: pa.RecordBatch) -> pa.RecordBatch:
    found = np.array([base_counts(t.as_py()) for t in b.column(3)], dtype=np.int64)
    lines = pa.array([(t.as_py() or "").count("\n") + 1 for t in b.column(3)], pa.int64())
    return pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array(c) for c in found.T), lines], ["doc_id", "lang", "source", *BASE, "n_lines"])


def _fences(level: DataFrame, prefix: str) -> DataFrame:
    """``n`` and the fences of each rate from the sketches of a level, above and for chars_a_word below, as ``<prefix>n`` and so on."""
    out: list[Column] = [F.col("n").alias(f"{prefix}n")]
    for name, (share, reach) in RULES.items():
        low, middle, high = (F.kll_sketch_get_quantile_double(name, F.lit(q)) for q in (1 - share, 0.5, share))
        out += [(high + reach * (high - middle)).alias(f"{prefix}{name}_high"), (low - reach * (middle - low)).alias(f"{prefix}{name}_low")]
    return level.select(*[c for c in level.columns if c not in ("n", *RULES)], *out)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    weight: float = 50.0,
    k: int = 400,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, BASE, ``base_failed`` and ``kept``.

    A document fails the base for under 50 words or when over half of its words lie in repeated 3-word windows. For
    the others, four rates (symbols a word, repeated lines, repeated words, characters a word) go into KLL quantile
    sketches per language and source, which merge into those of a language and of all rows. Every fence comes from
    sketch quantiles alone (RULES). That of a group counts with its number of documents and that of its language with
    ``weight``, whose own counts likewise against that of all rows; so small groups lean on larger ones, by degrees. A
    document outside a fence by more than ERRORS standard errors of its own rate is not kept.

    A null text has no words and fails the base; null languages and sources are groups of their own; a group without a
    document that passes the base needs no fence; equal rates stand on the same side of a fence; repeated rows count as
    often as they occur; an empty table gives no rows; other columns are ignored.
    """
    schema = f"doc_id {type_of(docs, id_col)}, lang string, source string, " + ", ".join(f"{c} bigint" for c in BASE) + ", n_lines bigint"
    counts = cut(map_texts(docs.select(id_col, F.col(lang_col).cast("string"), F.col(source_col).cast("string"), text_col), [id_col, lang_col, source_col, text_col], schema, _batch))
    words = F.greatest(F.col("n_words"), F.lit(1))
    rates = {
        "symbol_rate": F.col("n_symbols") / words,
        "dup_line_rate": F.col("n_dup_lines") / F.col("n_lines"),
        "repeat_rate": F.col("n_repeat_words") / words,
        "chars_a_word": F.col("word_chars") / words,
    }
    names = list(rates)
    rated = counts.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).withColumns(rates)
    sketches = cut(rated.where("not base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(c, F.lit(k)).alias(c) for c in names]))
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(c).alias(c) for c in names]]
    own = _fences(sketches, "g_").withColumnsRenamed({"lang": "f_lang", "source": "f_source"})
    langs = _fences(sketches.groupBy(F.col("lang").alias("l_lang")).agg(*merged), "l_")
    every = _fences(sketches.groupBy(F.lit(0).alias("a_all")).agg(*merged), "a_")
    both = own.join(langs, F.col("f_lang").eqNullSafe(F.col("l_lang"))).join(every)
    lean = lambda n, x, y: (F.col(n) * F.col(x) + weight * y) / (F.col(n) + weight)
    fence = {f"{c}_{side}": lean("g_n", f"g_{c}_{side}", lean("l_n", f"l_{c}_{side}", F.col(f"a_{c}_{side}"))) for c in names for side in ("high", "low")}
    fences = both.select("f_lang", "f_source", *[f.alias(n) for n, f in fence.items()])
    errors = {"symbol_rate": F.sqrt("n_symbols") / words, "dup_line_rate": F.sqrt("n_dup_lines") / F.col("n_lines"), "repeat_rate": F.sqrt("n_repeat_words") / words}
    within = F.col("chars_a_word").between(F.col("chars_a_word_low"), F.col("chars_a_word_high"))
    for c, error in errors.items():
        within = within & (F.col(c) - ERRORS * error <= F.col(f"{c}_high"))
    joined = rated.join(small_enough(fences, 50_000), F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    return joined.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & F.coalesce(within, F.lit(True))).alias("kept"))
