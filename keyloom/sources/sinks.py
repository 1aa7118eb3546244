"""Writing alerts: idempotent upserts into Parquet tables or a catalog's table, and Kafka records."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BUCKETS = 32
#: A column of a table that says when the event of a row was; rows that no longer hold are found by it.
EVENT_MS = "_event_ms"


def one_a_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key; of several, the largest by the other columns, so that a rerun keeps the same."""
    rest = [F.col(c).desc_nulls_last() for c in rows.columns if c not in keys]
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*rest))).where("_r = 1").drop("_r")


def _at(spark: SparkSession, path: str):
    """A path in its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def bucket_of(column: str, buckets: int = BUCKETS) -> F.Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int").alias("_bucket")


def upsert(
    rows: DataFrame, path: str, keys: list[str], parts: list[str], by: str, buckets: int = BUCKETS, writer: str = "main", stale: DataFrame | None = None, owns: F.Column | None = None,
) -> None:
    """Replaces the rows of a Parquet table that share ``keys`` with new ones, and adds the others.

    The table is partitioned by ``parts`` and a hash bucket of the column ``by``; only partitions that get rows are rewritten.
    ``stale`` names values of ``by`` with a time ``_from``: their rows with ``EVENT_MS`` from then on that ``rows`` doesn't hold are
    taken back (marked, as an empty partition would not be rewritten), of those rows that ``owns`` says are the writer's.

    What is to be swapped in is written beside the table first, then a mark that it is whole. A run that finds
    such a mark of its ``writer`` finishes that swap, and clears away what has none, so a writer that was stopped anywhere
    ends as one that ran through. Readers during a swap may see some partitions before and some after it; where that
    matters, use a catalog's table and ``merge_into``.
    """
    spark = rows.sparkSession
    path = path.rstrip("/")
    cols = [*parts, "_bucket"]
    finish(spark, path, cols, writer)
    new = one_a_key(rows, keys).select("*", bucket_of(by, buckets), F.lit(False).alias("_gone"))
    staged = f"{path}.staged-{writer}-{uuid.uuid4().hex}"
    new.write.partitionBy(*cols).parquet(f"{staged}/new")
    # types of the partition columns come from the rows, not from directory names
    new = spark.read.schema(new.schema).parquet(f"{staged}/new")
    merged = new
    if exists(spark, path):
        old = spark.read.schema(new.schema).parquet(path).select(*new.columns)
        wanted = new.select("_bucket").distinct()
        if stale is not None:
            wanted = wanted.union(stale.select(bucket_of(by, buckets))).distinct()
        # at most as many numbers as there are buckets: they prune the scan
        old = old.where(F.col("_bucket").isin([r[0] for r in wanted.collect()])).join(new.select(*keys), keys, "left_anti")
        changed = new.select(*cols)
        if stale is not None:
            of = stale.select(F.col(by).alias("_stale"), "_from")
            late = F.col("_from").isNotNull() & (F.col(EVENT_MS) >= F.col("_from")) & (F.lit(True) if owns is None else owns)
            old = old.join(of, F.col(by) == F.col("_stale"), "left").withColumn("_now", ~F.col("_gone") & F.coalesce(late, F.lit(False)))
            changed = changed.union(old.where("_now").select(*cols))
            old = old.withColumn("_gone", F.col("_gone") | F.col("_now")).select(*new.columns)
        merged = new.unionByName(old.join(changed.distinct(), cols, "left_semi").select(*new.columns))
    merged.repartition(*cols).write.parquet(f"{staged}/merged")
    fs, mark = _at(spark, f"{staged}/_READY")
    fs.create(mark).close()
    finish(spark, path, cols, writer)


def finish(spark: SparkSession, path: str, cols: list[str], writer: str) -> None:
    """Swaps in what a writer had ready, and clears away what it had not."""
    fs, found = _at(spark, f"{path}.staged-{writer}-*")
    for status in fs.globStatus(found) or []:
        staged = status.getPath()
        if exists(spark, f"{staged.toString()}/_READY"):
            swap(spark.read.parquet(f"{staged.toString()}/merged"), path, cols)
        fs.delete(staged, True)


def swap(done: DataFrame, path: str, cols: list[str]) -> None:
    done.repartition(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an upserted table that hold, without its own columns."""
    table = spark.read.parquet(path)
    return table.where(~F.col("_gone")).drop("_bucket", "_gone", EVENT_MS)


def merge_into(rows: DataFrame, table: str, keys: list[str]) -> None:
    """The same into a table of a catalog with row-level updates (such as Iceberg or Delta), by ``MERGE INTO``."""
    source = one_a_key(rows, keys)
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    source.alias("s").mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def kafka_records(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``key`` and JSON ``value``; the key is a hash of the row's key columns, so a record sent twice is found as such."""
    return rows.select(F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), 256).alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))


def write_kafka(rows: DataFrame, servers: str, topic: str, keys: list[str]) -> None:
    """Sends a batch to Kafka, at least once; needs the Kafka connector package on the cluster."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.linger.ms": "10", "kafka.batch.size": "8192"}
    kafka_records(rows, keys).write.format("kafka").options(**options).save()


def start(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = "120 seconds") -> StreamingQuery:
    """Runs a stream into ``sink``, which gets each batch and its number; without an interval, over all that is there now."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**trigger).start()
