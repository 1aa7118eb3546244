"""Places of rows in their conversations, for conversations of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import cut


def positions(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` plus ``pos``, the place from 0 within ``key`` in the order of the columns ``order``, nulls first.

    Rows are dealt by ranges of key and order, so a key of any length lies in many slices; they are numbered in their
    slice, behind what earlier slices hold of their key. Only the first key of a slice goes on from an earlier one, so
    the table of what lies before has a row for each slice at most, and is broadcast. Rows alike in key and order get places
    of their own, in no order that matters; a null key is a key.
    """
    slices = cut(rows.repartitionByRange(key, *order).withColumn("slice", F.spark_partition_id()))
    earlier = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = slices.groupBy(key, "slice").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(F.col(key).alias("before_key"), F.col("slice").alias("before_slice"), F.sum("n").over(earlier).alias("before")).where(F.col("before").isNotNull())
    own = F.row_number().over(Window.partitionBy(key, "slice").orderBy(*order))
    joined = slices.withColumn("own", own).join(F.broadcast(before), F.col(key).eqNullSafe(F.col("before_key")) & (F.col("slice") == F.col("before_slice")), "left")
    return joined.select(*rows.columns, (F.col("own") - 1 + F.coalesce(F.col("before"), F.lit(0))).cast("long").alias("pos"))
