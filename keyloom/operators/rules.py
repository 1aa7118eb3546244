"""Signals of single events, and of pairs never seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.parse import filled
from keyloom.operators.kernels import KEY, TIE, TIME, emit, prepare
from keyloom.operators.memory import remember


def correlation_break(events: DataFrame, least: int = 10, most: int = 50) -> DataFrame:
    """A pair of AUA and device that the key doesn't know, after more than ``least`` events; the value counts the pairs before.

    A key remembers ``most`` AUAs, as many devices, and the square of that of pairs; what came in first is forgotten first.
    """
    pair = F.concat_ws("|", "aua", "deviceCode")
    d = prepare(events, filled("aua") & filled("deviceCode"), dedup=True).select(KEY, TIME, TIE, "rn", "aua", "deviceCode", pair.alias("pair"))
    d = remember(d, {"aua": most, "deviceCode": most, "pair": most * most}).where(~F.col("pair_seen.known") & (F.col("rn") > least))
    d = d.withColumns({"aua_new": ~F.col("aua_seen.known"), "device_new": ~F.col("deviceCode_seen.known")})
    kind = (
        F.when(~F.col("aua_new") & F.col("device_new"), "AUA_DEVICE_SHIFT").when(F.col("aua_new") & ~F.col("device_new"), "DEVICE_AUA_SHIFT")
        .when(F.col("aua_new") & F.col("device_new"), "FULL_CORRELATION_BREAK").otherwise("NEW_PAIR_EXISTING_ENTITIES")
    )
    notes = {
        "anomaly_type": kind, "triggering_aua": F.col("aua"), "triggering_device": F.col("deviceCode"), "total_known_pairs": F.col("pair_seen.size"),
        "distinct_auas_known": F.col("aua_seen.size"), "distinct_devices_known": F.col("deviceCode_seen.size"),
        "total_events_processed": F.col("rn"), "detection_timestamp": F.col(TIME),
    }
    known = lambda c: F.when(F.col(c), "new").otherwise("known")
    notes["explanation"] = F.format_string("%s AUA %s with %s device %s, a pair never used before", known("aua_new"), "aua", known("device_new"), "deviceCode")
    return emit(d, "auth_aua_device_correlation_break", "Categorical", F.col("pair_seen.size"), comments=notes)


def capture_spoof(events: DataFrame, below_ms: int = 50) -> DataFrame:
    """Liveness checks answered in less than ``below_ms``."""
    d = prepare(events, dedup=True)
    took = F.trim("livenessResponseReceivedTime").try_cast("long") - F.trim("livenessRequestInitiatedTime").try_cast("long")
    d = d.withColumn("_took", took).where((F.lower("isLivenessCheckInvoked") == "true") & (F.col("_took") > 0) & (F.col("_took") < below_ms))
    return emit(d, "bio_capture_time_spoof_v1", "Duration (ms)", F.col("_took"), comments={"capture_delta_ms": F.col("_took"), "impossible_threshold_ms": F.lit(below_ms)})


def liveness_desync(events: DataFrame, above_ms: int = 3_600_000) -> DataFrame:
    """Minutes from the end of a liveness check to its event, above ``above_ms``."""
    source = F.when(F.col("kafkaSourceTimestamp") > 0, F.col("kafkaSourceTimestamp")).otherwise(F.col(TIME))
    d = prepare(events, dedup=True).withColumn("_late", source - F.trim("biolivenessEndtime").try_cast("long")).where(F.col("_late") > above_ms)
    minutes = F.col("_late") / 60_000
    return emit(d, "bio_liveness_desync_replay_v1", "Duration (mins)", minutes, end=source, comments={"desync_gap_mins": minutes, "threshold_mins": F.lit(above_ms // 60_000)})


def deep_print_subversion(events: DataFrame, below: float = 5.0) -> DataFrame:
    """Matches claimed with a FIR score under ``below``, or with none; a score that is not a number proves nothing."""
    score = F.trim("deepPrintFIRMatchScore").try_cast("double")
    missing = F.col("deepPrintFIRMatchScore").isNull() | F.lower("deepPrintFIRMatchScore").isin("", "null")
    d = prepare(events, dedup=True, nudge=True).withColumn("_score", F.when(missing, 0.0).otherwise(score))
    d = d.where(F.upper("deepPrintIsMatched").isin("TRUE", "Y") & (F.col("_score") < below))
    notes = {"is_matched": F.col("deepPrintIsMatched"), "actual_fir_match_score": F.col("_score"), "subversion_type": F.lit("MATCH_WITHOUT_SCORE")}
    return emit(d, "bio_deep_print_subversion_v1", "Mismatch", F.lit(1.0), comments=notes)


