"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import WORD, cut, free_names, small_enough

#: Rows that a hash range of one source holds on average.
RANGE_ROWS = 4096


def source_targets(stats: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """``source, source_size`` plus ``target``: ``share`` of all sizes split by weight, at most ``most`` times a source's size.

    Sources in the order of their code points, null last, take ``weights`` in turn. What a source can't take is shared
    by weight among the others. Sorted by the level at which they fill up, the full sources are a prefix, so prefix
    sums give the level of the rest in one pass.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy((F.col("cap") / F.col("weight")), F.col("turn"))
    s = stats.withColumn("turn", F.row_number().over(order) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    s = s.withColumn("before", F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("open", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
    everything = Window.partitionBy()
    s = s.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    s = s.withColumn("level", (F.col("budget") - F.col("before")) / F.col("open"))
    s = s.withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    first = F.min(F.when(~F.col("full"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "turn", "level"))).over(everything)
    s = s.withColumn("level", first["level"])
    return s.select("source", "source_size", "n_rows", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("level")).alias("target"))


def mix(
    docs: DataFrame,
    size: Column,
    weights: list[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: id, ``source``, ``size``, ``source_size``, ``target`` and ``taken``.

    Documents of a source are put in the order of a hash of their id, cut into hash ranges of about ``RANGE_ROWS``
    rows, and summed by range; a prefix sum over the ranges and one inside each range place every document on its
    source's line of sizes. A source takes whole epochs of its size and then the line up to its budget; the document
    at the cut counts with the part before it. So a source takes ``floor(target)`` exactly, and reruns agree.

    A null source is a source of its own; null sizes count 0 and take 0; an empty table gives no rows. Rows with the
    same id lie side by side, ordered by size. Other columns are ignored, whatever their names.
    """
    sizes = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        )
    )
    stats = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    targets = source_targets(stats, list(weights), share, most).select(F.col("source").alias("t_source"), "source_size", "n_rows", "target")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    ranges = F.ceil(F.col("n_rows") / F.lit(RANGE_ROWS))
    placed = (
        sizes.join(small_enough(targets, 10_000), F.col("source").eqNullSafe(F.col("t_source")))
        .withColumn("key", key)
        .withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)))
    )
    sums = placed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    line = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("o_source"), F.col("range").alias("o_range"), F.coalesce(F.sum("range_size").over(line), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("source", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    quota = F.floor("target")
    start = F.col("offset") + F.col("upto") - F.col("size")
    left = quota % F.col("source_size") - start
    taken = F.floor(quota / F.col("source_size")) * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return (
        placed.withColumn("upto", F.sum("size").over(inside))
        .join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("range") == F.col("o_range")))
        .select("doc_id", "source", "size", "source_size", "target", F.when(F.col("source_size") > 0, taken).otherwise(F.lit(0)).cast("long").alias("taken"))
    )


def word_count(text: str = "text") -> Column:
    """Words of a text: runs of characters other than ASCII white space; none in a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each document as often as it is taken whole, then cut to its last words.

    A document with ``taken`` below its size keeps that many leading words, joined by spaces, and ``n_chars`` (where
    there is such a column) follows the text. Documents without words, null texts among them, belong to no budget and are
    kept once. Rows that agree in id, source and size share what is taken of them, the first ones a word more. A null
    source is a source; an empty table gives no rows; other columns pass through, whatever their names.
    """
    named = docs.columns
    m_id, m_source, m_size, taken, same, nth, words, part = free_names(docs, "id", "source", "size", "taken", "same", "nth", "words", "part")
    verdict = mix(docs, word_count(text_col), id_col=id_col, source_col=source_col, **options)
    copies = cut(verdict.groupBy(F.col("doc_id").alias(m_id), F.col("source").alias(m_source), F.col("size").alias(m_size)).agg(F.sum("taken").alias(taken), F.count(F.lit(1)).alias(same)))
    joined = docs.withColumn(words, word_count(text_col).cast("long")).join(
        copies,
        F.col(id_col).eqNullSafe(F.col(m_id)) & F.col(source_col).eqNullSafe(F.col(m_source)) & (F.col(words) == F.col(m_size)),
    )
    alike = Window.partitionBy(m_id, m_source, m_size).orderBy(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    once = joined.where(F.col(same) == 1).withColumn(nth, F.lit(1))
    # ids seldom repeat; without repeats the rows need no rank
    joined = once.unionByName(joined.where(F.col(same) > 1).withColumn(nth, F.row_number().over(alike))) if copies.where(F.col(same) > 1).take(1) else once
    share = F.floor(F.col(taken) / F.col(same)) + (F.col(nth) <= F.col(taken) % F.col(same)).cast("long")
    rest = F.when(F.col(m_size) > 0, share % F.col(m_size)).otherwise(F.lit(0))
    whole = F.when(F.col(m_size) > 0, F.floor(share / F.col(m_size)).cast("int")).otherwise(F.lit(1))
    parts = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    out = joined.withColumn(part, F.explode(parts))
    leading = F.array_join(F.slice(F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)), F.lit(1), F.col(part).cast("int")), " ")
    out = out.withColumn(text_col, F.when(F.col(part) < 0, F.col(text_col)).otherwise(leading))
    if "n_chars" in named:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(part) < 0, F.col("n_chars")).otherwise(F.length(text_col)).cast(kind))
    return out.select(*named)
