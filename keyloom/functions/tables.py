"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a new folder, but in local mode alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="keyloom-")


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: a short lineage that outlives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/keyloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint where a count shows that it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
