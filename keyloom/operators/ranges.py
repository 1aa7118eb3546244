"""Signals over a time range before each event: bursts and diversity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.functions.parse import filled, is_no, ist_hour
from keyloom.operators.kernels import KEY, TIE, TIME, emit, first_seen, in_range, latch, ordered, prepare
from keyloom.operators.memory import distinct_within
from keyloom.operators.slices import Part, is_sliced, kinds_in_range, lane, running, values_in_range


def burst(events: DataFrame, name: str, width_ms: int, on: int, off: int, eligible: Column | None = None, label: str = "events", notes: dict[str, Column] | None = None) -> DataFrame:
    """Eligible events in the last ``width_ms``: alerts at ``on``, and again only after fewer than ``off``."""
    d = in_range(prepare(events, eligible), "_c", width_ms)
    d = latch(d, F.col("_c") >= on, F.col("_c") < off)
    return emit(d, name, "Count", F.col("_c"), F.col("ts") - width_ms, comments={label: F.col("_c"), **(notes or {"threshold": F.lit(on)})})


def velocity_spike(events: DataFrame, width_ms: int = 60_000, on: int = 15, off: int = 7) -> DataFrame:
    return burst(events, "auth_velocity_spike_v1", width_ms, on, off, label="events_per_minute")


def failure_burst(events: DataFrame, width_ms: int = 30_000, on: int = 8, off: int = 4) -> DataFrame:
    return burst(events, "auth_failure_burst_v1", width_ms, on, off, is_no(), "failures_per_30s")


def enrolment_hammering(events: DataFrame, width_ms: int = 3_600_000, on: int = 5, off: int = 3) -> DataFrame:
    return burst(events, "auth_enrolment_hammering_v1", width_ms, on, off, filled("enrolmentReferenceId", True), "enrolment_count", {"window": F.lit("1_hour")})


def high_risk_hours(events: DataFrame, width_ms: int = 86_400_000, on: int = 5, off: int = 2) -> DataFrame:
    """Failures between one and four in the morning, over the last ``width_ms``, looked at on every failure."""
    d = prepare(events, is_no(), dedup=True, nudge=True).withColumn("_night", ist_hour().between(1, 3).cast("int"))
    d = in_range(d, "_c", width_ms, of="_night")
    d = latch(d, F.col("_c") >= on, F.col("_c") < off)
    return emit(d, "auth_high_risk_time_window_fails_v1", "Count", F.col("_c"), comments={"failures_between_1AM_and_4AM": F.col("_c"), "threshold": F.lit(on)})


def rapid_device_switch(events: DataFrame, width_ms: int = 600_000, on: int = 4) -> DataFrame:
    """Distinct devices in the last ``width_ms``, on a latch."""
    d = prepare(events, filled("deviceCode"), dedup=True, nudge=True)
    d = d.select(*lane(d), TIME, TIE, "rn", "deviceCode")
    if is_sliced(d):
        rows = kinds_in_range(d, "_c", "deviceCode", width_ms)
        d = values_in_range(latch(rows, F.col("_c") >= on, F.col("_c") < on - 1), rows, "_set", "deviceCode", width_ms)
    else:
        d = latch(distinct_within(d, "deviceCode", width_ms, on), F.col("_c") >= on, F.col("_c") < on - 1)
    return emit(d, "auth_rapid_device_switch_v1", "Count", F.col("_c"), comments={"distinct_devices_10m": F.col("_c"), "devices_seen": F.col("_set")})


def concurrent_aua(events: DataFrame, on: int = 3) -> DataFrame:
    """The event that makes ``on`` distinct AUAs at one instant of a key."""
    d = first_seen(prepare(events, filled("aua"), dedup=True).withColumn("_at", F.col("ts")), F.col("aua"), "aua", "_at")
    early = F.when(F.col("aua_new") & (F.col("aua_n") <= on), F.col("aua"))
    d = d.withColumn("_set", F.collect_list(early).over(ordered("_at").rowsBetween(Window.unboundedPreceding, 0)))
    d = d.where(F.col("aua_new") & (F.col("aua_n") == on))
    notes = {"distinct_auas_in_same_ms": F.col("aua_n"), "auas_list": F.sort_array("_set"), "exact_timestamp_ms": F.col("ts")}
    return emit(d, "auth_concurrent_aua_burst_v1", "Count", F.col("aua_n"), F.col("ts"), comments=notes)


def brute_force(events: DataFrame, least: int = 5, width_ms: int = 300_000) -> DataFrame:
    """A success right after ``least`` or more failures in a row within ``width_ms``."""
    d = in_range(prepare(events, filled("authResult")), "_c", width_ms).withColumn("_other", F.when(~is_no(), F.col("rn")))
    run = F.col("rn") - 1 - F.coalesce("_end", F.lit(0))
    d = running(d, _end=Part("last", "_other", before=True)).withColumn("_run", F.least(run, F.col("_c") - 1)).where((F.upper("authResult") == "Y") & (F.col("_run") >= least))
    notes = {"pattern_matched": F.lit("FAILURES_THEN_SUCCESS"), "preceding_failures": F.col("_run"), "window_ms": F.lit(width_ms)}
    return emit(d, "auth_brute_force_compromise_v1", "Count", F.col("_run"), F.col("ts") - width_ms, comments=notes)
