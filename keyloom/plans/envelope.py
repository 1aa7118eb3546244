"""The output form of alerts: feature ids, local timestamps, default comments, and the rows of the sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.parse import ist_time

VERSION = "1"


def _iso(ms: str) -> F.Column:
    return F.date_format(ist_time(F.col(ms)), "yyyy-MM-dd'T'HH:mm:ss.SSS")


def enrich(alerts: DataFrame) -> DataFrame:
    """Alerts with ``feature_id``, ``feature_version``, ``timestamp`` (local time in India) and, where none, default comments.

    The id is the name, for counts over a minute or more the window's minutes, and the version. The time is the window's
    end, or the event's own. ``last_updated`` in the comments is the event's time, so that a rerun writes the same.
    """
    minutes = F.floor((F.col("window_end_ms") - F.col("window_start_ms")) / 60_000)
    sized = (F.col("window_start_ms") > 0) & (F.col("window_end_ms") > 0) & (minutes > 0) & F.contains(F.col("feature_name"), F.lit("count"))
    part = F.when(sized, F.concat(F.lit("_"), minutes.cast("string"), F.lit("m"))).otherwise("")
    default = F.to_json(
        F.struct(
            F.when((F.col("window_start_ms") > 0) & (F.col("window_end_ms") > 0), _iso("window_start_ms")).alias("window_start"),
            F.when((F.col("window_start_ms") > 0) & (F.col("window_end_ms") > 0), _iso("window_end_ms")).alias("window_end"),
            _iso("event_ts_ms").alias("last_updated"),
        )
    )
    end = F.when(F.col("window_end_ms") > 0, F.col("window_end_ms")).otherwise(F.col("event_ts_ms"))
    return alerts.withColumns(
        {
            "feature_id": F.concat("feature_name", part, F.lit(f"_v{VERSION}")), "feature_version": F.lit(VERSION), "timestamp": ist_time(end),
            "comments": F.when(F.col("comments").isNull() | (F.col("comments") == ""), default).otherwise(F.col("comments")),
        }
    )


def feature_rows(enriched: DataFrame, *more: F.Column) -> DataFrame:
    """The seven columns of the feature table, and ``more``; comments without line ends."""
    return enriched.select("entity_id", "feature_id", "feature_name", "feature_version", "feature_value", "timestamp", F.regexp_replace("comments", r"[\r\n]+", " ").alias("comments"), *more)


def device_rows(changes: DataFrame, *more: F.Column) -> DataFrame:
    """The seven columns of the device-change table, and ``more``."""
    return changes.select(
        "opt_id", ist_time(F.col("previous_devicecode_last_ms")).alias("previous_devicecode_last_ts"), "previous_devicecode_txns", "previous_devicecode", "current_devicecode", "current_auth_type", ist_time(F.col("ets_ms")).alias("ets"), *more
    )
