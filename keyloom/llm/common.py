"""Shared helpers of the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a new one, but in local mode alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="keyloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: a short lineage that outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/keyloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_texts(df: DataFrame, columns: list[str], schema: str, function: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """``function`` over the Arrow batches of ``columns``, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.select(*columns).mapInArrow(tidy(run), schema)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, with what it no longer needs given back at its end: a Python worker waits for later tasks with all it holds."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):
            ctypes.CDLL(None).malloc_trim(0)

    return tidied


def type_of(df: DataFrame, column: str) -> str:
    """The SQL type of a column, for Arrow schemas that carry it along."""
    return df.schema[column].dataType.simpleString()


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint where a count shows that it has at most ``rows`` rows, otherwise as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` with a prefix under which ``df`` has no column, whatever its case."""
    taken, prefix = [c.lower() for c in df.columns], "_kl"
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    return [f"{prefix}_{n}" if not prefix.endswith("_") else prefix + n for n in names]
