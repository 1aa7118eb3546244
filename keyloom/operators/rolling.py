"""Signals over the last events of a key: shares, trends, spreads, and deviations from a personal baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.functions.parse import filled, is_yes, ist_hour, number
from keyloom.functions.tables import written
from keyloom.operators.kernels import KEY, TIE, TIME, change_of, counts_at, emit, last_rows, latch, prepare, segments
from keyloom.operators.slices import Part, haloed, is_sliced, lagged, lane, moments, near, running, settled


def rolling_share(
    events: DataFrame, name: str, flag: Column, n: int, least: int, on: float, off: float, eligible: Column | None = None,
    guarded: bool = False, strict: bool = False, flagged: str = "flagged", share: str = "ratio", total: str = "total_events", kind: str = "Ratio",
) -> DataFrame:
    """Share of the last ``n`` eligible events where ``flag`` holds, from ``least`` events on.

    Alerts when the share reaches ``on`` (``strict``: exceeds it), again only after it fell below ``off`` (to it). The
    sums are differences of running sums, so a row costs the same for any ``n``.
    """
    d = prepare(events, eligible, dedup=guarded, nudge=guarded).withColumn("_flag", F.coalesce(flag, F.lit(False)).cast("int"))
    d = lagged(running(d, _sum=Part("sum", "_flag")), "_old", "_sum", n).withColumn("_n", F.least("rn", F.lit(n)))
    d = d.withColumn("_hit", F.col("_sum") - F.coalesce("_old", F.lit(0))).withColumn("_share", F.col("_hit") / F.col("_n"))
    enough = F.col("_n") >= least
    rate = F.col("_share")
    d = latch(d, enough & ((rate > on) if strict else (rate >= on)), enough & ((rate <= off) if strict else (rate < off)))
    return emit(d, name, kind, rate, comments={flagged: F.col("_hit"), total: F.col("_n"), share: rate})


def otp_fallback(events: DataFrame, n: int = 30, least: int = 10, on: float = 0.5) -> DataFrame:
    return rolling_share(events, "auth_otp_fallback_ratio_v1", F.upper("authType").isin("O", "OTP"), n, least, on, on, F.col("authType").isNotNull(), True, flagged="otp_count", share="otp_ratio")


def success_without_bio(events: DataFrame, n: int = 30, least: int = 10, on: float = 0.4) -> DataFrame:
    none = [F.coalesce(F.trim(c).try_cast("int"), F.lit(0)) == 0 for c in ("fmrCount", "firCount")]
    flag = none[0] & none[1] & (F.col("faceUsed").isNull() | (F.upper("faceUsed") == "N"))
    return rolling_share(events, "auth_success_without_bio_ratio_v1", flag, n, least, on, on, is_yes(), True, flagged="suspicious_successes", share="suspicious_ratio", total="total_successes")


def location_mismatch(events: DataFrame, n: int = 20, least: int = 10, on: float = 0.6) -> DataFrame:
    flag = F.upper(F.trim("locationStateCode")) != F.upper(F.trim("residentStateCode"))
    ok = filled("locationStateCode") & filled("residentStateCode")
    return rolling_share(events, "auth_location_resident_mismatch_v1", flag, n, least, on, on, ok, True, flagged="mismatch_count", share="mismatch_ratio")


def night_surge(events: DataFrame, n: int = 200, least: int = 50, on: float = 0.4) -> DataFrame:
    hour = ist_hour()
    return rolling_share(events, "auth_night_surge_v1", (hour >= 23) | (hour < 5), n, least, on, on, None, True, flagged="night_transactions", share="surge_ratio", total="total_sampled")


def deep_print_failures(events: DataFrame, n: int = 20, least: int = 20, on: float = 0.3) -> DataFrame:
    return rolling_share(events, "bio_deepprint_failure_rate_v1", F.upper(F.trim("deepPrintIsMatched")) != "Y", n, least, on, on, filled("deepPrintIsMatched"), False, True, "failures", "failure_rate", kind="Rate")


def success_cliff(events: DataFrame, n: int = 50, recent: int = 10, on: float = 40.0, off: float = 20.0) -> DataFrame:
    """Percentage points by which the success rate of the last ``recent`` events lies below that of the last ``n``."""
    d = prepare(events, filled("authResult"), dedup=True).withColumn("_yes", is_yes().cast("int"))
    d = haloed(d, n)
    long, short = (F.avg("_yes").over(last_rows(near(d), k)) for k in (n, recent))
    d = settled(d.withColumn("_long", long).withColumn("_short", short)).withColumn("_cliff", (F.col("_long") - F.col("_short")) * 100)
    enough = F.col("rn") >= n
    d = latch(d, enough & (F.col("_cliff") >= on), enough & (F.col("_cliff") < off))
    value = F.round("_cliff", 2)
    notes = {"historical_success_rate": F.round("_long", 4), "recent_success_rate": F.round("_short", 4), "cliff_size_pct_points": value, "historical_window_size": F.lit(n), "recent_window_size": F.lit(recent), "cliff_threshold": F.lit(on), "detection_timestamp": F.col("ts")}
    rates = [F.round(F.col(c) * 100, 2) for c in ("_long", "_short")]
    notes["explanation"] = F.format_string("successes fell from %s%% of the last %d events to %s%% of the last %d, by %s points", rates[0], F.lit(n), rates[1], F.lit(recent), value)
    return emit(d, "auth_success_ratio_cliff", "Percentage Points", value, comments=notes)


def modality_switch(events: DataFrame, n: int = 10, on: int = 6, off: int = 4) -> DataFrame:
    """Changes of authType between neighbours among the last ``n`` events."""
    d = haloed(prepare(events, filled("authType")), n + 1)
    d = d.withColumn("_changed", F.when(F.col("rn") > 1, change_of(F.col("authType"), near(d)).cast("int")).otherwise(0))
    d = d.withColumn("_switches", F.sum("_changed").over(last_rows(near(d), n - 1)))
    d = settled(d.withColumn("_recent", F.collect_list("authType").over(last_rows(near(d), n))))
    enough = F.col("rn") >= n
    d = latch(d, enough & (F.col("_switches") >= on), enough & (F.col("_switches") < off))
    return emit(d, "auth_modality_switch_v1", "Count", F.col("_switches"), comments={"switch_count": F.col("_switches"), "window_size": F.lit(n), "recent_modalities": F.col("_recent")})


def score_decline(events: DataFrame, name: str, field: str, n: int = 10, on: float = -1.5, off: float = -0.75, literal_null: bool = False, notes: str = "recent_scores") -> DataFrame:
    """Least-squares slope of the last ``n`` positive scores against their order."""
    ok = (filled(field, True) if literal_null else filled(field)) & (number(field) > 0)
    d = haloed(prepare(events, ok).withColumn("_y", number(field)), n)
    w = last_rows(near(d), n)
    d = settled(d.withColumn("_slope", F.regr_slope("_y", "rn").over(w)).withColumn("_recent", F.collect_list("_y").over(w)))
    enough = F.col("rn") >= n
    d = latch(d, enough & (F.col("_slope") <= on), enough & (F.col("_slope") > off))
    return emit(d, name, "Trend", F.col("_slope"), comments={"slope": F.col("_slope"), notes: F.col("_recent")})


def finger_decline(events: DataFrame, on: float = -1.5) -> DataFrame:
    return score_decline(events, "auth_finger_score_decline_v1", "fingerMatchScore", on=on, off=on / 2)


def face_decline(events: DataFrame, on: float = -1.5) -> DataFrame:
    return score_decline(events, "auth_face_score_decline_v1", "faceMatchScore", on=on, off=on / 2)


def match_trend(events: DataFrame, on: float = -2.0) -> DataFrame:
    return score_decline(events, "bio_match_score_trend_v1", "matchScore", on=on, off=on / 2)


def liveness_decline(events: DataFrame, on: float = -1.5) -> DataFrame:
    return score_decline(events, "bio_face_liveness_score_decline_v1", "faceLivenessScore", n=8, on=on, off=on / 2, literal_null=True, notes="recent_face_liveness_scores")


def fmr_spread(events: DataFrame, n: int = 10, on: float = 15.0, off: float = 7.5) -> DataFrame:
    """Population standard deviation of the last ``n`` positive fmr counts."""
    count = F.trim("fmrCount").try_cast("int")
    d = haloed(prepare(events, count > 0).withColumn("_y", count), n)
    w = last_rows(near(d), n)
    d = settled(d.withColumn("_sd", F.stddev_pop("_y").over(w)).withColumn("_recent", F.collect_list("_y").over(w)))
    enough = F.col("rn") >= n
    d = latch(d, enough & (F.col("_sd") >= on), enough & (F.col("_sd") < off))
    return emit(d, "auth_fmr_count_anomaly_v1", "Variance", F.col("_sd"), comments={"stddev": F.col("_sd"), "recent_counts": F.col("_recent")})


def biometric_replay(events: DataFrame, n: int = 50, on: int = 2) -> DataFrame:
    """Events among the ``n`` before that carry the same five-field signature, nulls as "0"; the value counts the current one too."""
    fields = ["fmrCount", "firCount", "fingerMatchScore", "faceMatchScore", "pidSize"]
    ok = ~((F.coalesce("fmrCount", F.lit("0")) == "0") & (F.coalesce("firCount", F.lit("0")) == "0"))
    d = prepare(events, ok, dedup=True, nudge=True)
    d = d.withColumn("_sig", F.concat_ws("|", *[F.coalesce(c, F.lit("0")) for c in fields]))
    d = haloed(d, n + 1)
    same = Window.partitionBy(*lane(d), "_sig").orderBy("rn").rangeBetween(-n, -1)
    d = settled(d.withColumn("_sig2", F.col("_sig")).withColumn("_same", F.count(F.lit(1)).over(same))).drop("_sig")
    d = latch(d, F.col("_same") >= on, F.col("_same") < on)
    return emit(d, "auth_biometric_replay_v1", "Count", F.col("_same") + 1, comments={"exact_signature_matches": F.col("_same") + 1, "signature_blob": F.col("_sig2"), "buffer_size": F.least("rn", F.lit(n))})


def time_entropy(events: DataFrame, every: int = 50, low: float = 1.5, high: float = 4.2) -> DataFrame:
    """Entropy in bits of a key's histogram of hours, looked at each ``every`` events.

    With c the events of an hour so far, the sum of c log2 c grows by c log2 c - (c-1) log2 (c-1) at each event, so the
    entropy log2 n - S / n is a running sum. The histogram in the comments is 24 running counts of the same window.
    """
    d = running(prepare(events).withColumn("_hour", ist_hour()).withColumn("_one", F.lit(1)), "_hour", _k=Part("sum", "_one"))
    bits = lambda x: F.when(x > 0, x * F.log2(x)).otherwise(0.0)
    d = d.withColumn("_c", F.col("_k").cast("double")).withColumn("_grows", bits(F.col("_c")) - bits(F.col("_c") - 1))
    d = d.withColumns({f"_is{k}": (F.col("_hour") == k).cast("int") for k in range(24)})
    d = running(d, _s=Part("sum", "_grows"), **{f"_at{k}": Part("sum", f"_is{k}") for k in range(24)})
    d = d.withColumn("_h", F.log2("rn") - F.col("_s") / F.col("rn"))
    d = d.where((F.col("rn") % every == 0) & ((F.col("_h") < low) | (F.col("_h") > high)))
    notes = {"entropy_bits": F.col("_h"), "total_events": F.col("rn"), "hour_distribution": F.array(*[f"_at{k}" for k in range(24)])}
    return emit(d, "auth_time_entropy_bits_v1", "Entropy Bits", F.col("_h"), comments=notes)


def modality_concentration(events: DataFrame, chunk: int = 100, least: int = 30, on: float = 0.95) -> DataFrame:
    """Largest share of one bioType so far in a chunk of ``chunk`` events; counts and latch begin anew with each chunk."""
    d = prepare(events, filled("bioType", True)).withColumn("_chunk", F.floor((F.col("rn") - 1) / chunk)).withColumn("_n", (F.col("rn") - 1) % chunk + 1)
    d = written(d) if is_sliced(d) else d
    found = running(d.withColumn("_one", F.lit(1)), "_chunk", "bioType", _c=Part("sum", "_one")).withColumn("_pair", F.struct("_c", "bioType"))
    found = running(found, "_chunk", _top=Part("max", "_pair")).withColumn("_share", F.col("_top._c") / F.col("_n"))
    found = latch(found, (F.col("_n") >= least) & (F.col("_share") > on), (F.col("_n") >= least) & (F.col("_share") <= on), "_chunk")
    found = counts_at(found.select(KEY, TIME, "_chunk", "rn", "_share", "_top", "_n"), d, "bioType", "_chunk")
    notes = {"concentration_ratio": F.col("_share"), "dominant_type": F.col("_top.bioType"), "counts": F.col("_counts"), "window_size": F.col("_n")}
    return emit(found, "bio_modality_concentration_v1", "Ratio", F.col("_share"), comments=notes)


def outliers(events: DataFrame, name: str, value: Column, label: str, least: int = 10, on: float = 3.0, mean: str = "mean") -> DataFrame:
    """Values more than ``on`` sample deviations, either way, from the key's mean so far, the value itself counted, from ``least`` events on."""
    d = moments(prepare(events, value > 0).withColumn("_x", value), "_x")
    d = d.withColumn("_z", F.abs(F.col("_x") - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0)))
    d = d.where((F.col("rn") >= least) & (F.col("_z") > on))
    return emit(d, name, "Z-Score", F.col("_z"), comments={"z_score": F.col("_z"), label: F.col("_x"), mean: F.col("_mean"), "stddev": F.col("_sd"), "event_count": F.col("rn")})


def duration_outlier(events: DataFrame, least: int = 20, on: float = 3.0) -> DataFrame:
    return outliers(events, "auth_duration_outlier_v1", number("authDuration"), "duration_ms", least, on, "mean_ms")


def pid_size_anomaly(events: DataFrame, least: int = 10, on: float = 3.0) -> DataFrame:
    return outliers(events, "auth_pid_size_anomaly_v1", number("pidSize"), "current_size", least, on)


def image_size_anomaly(events: DataFrame, least: int = 10, on: float = 3.0) -> DataFrame:
    return outliers(events, "bio_image_size_anomaly_v1", number("imageSize"), "image_size", least, on)


def response_time_anomaly(events: DataFrame, least: int = 10, on: float = 3.0) -> DataFrame:
    took = (F.trim("livenessResponseReceivedTime").try_cast("long") - F.trim("livenessRequestInitiatedTime").try_cast("long")).cast("double")
    return outliers(events, "bio_response_time_anomaly_v1", took, "response_time_ms", least, on, "mean_ms")


def probe_minutiae(events: DataFrame, least: int = 10, on: float = 15.0) -> DataFrame:
    """Running sample deviation of the minutiae count above ``on``."""
    d = moments(prepare(events, number("probeMinutiae") > 0).withColumn("_x", number("probeMinutiae")), "_x").where((F.col("rn") >= least) & (F.col("_sd") > on))
    return emit(d, "bio_probe_minutiae_anomaly_v1", "Variance", F.col("_sd"), comments={"standard_deviation": F.col("_sd"), "current_minutiae": F.col("_x"), "mean": F.col("_mean"), "event_count": F.col("rn")})


def credential_velocity(events: DataFrame, least: int = 15, on: float = 3.0, cooldown_ms: int = 60_000) -> DataFrame:
    """Gaps between events ``on`` or more deviations from the key's mean gap; after an alert, none for ``cooldown_ms``."""
    d = running(prepare(events), _last=Part("last", TIME, before=True)).withColumn("_gap", (F.col(TIME) - F.col("_last")).cast("double")).where(F.col("_gap").isNotNull())
    d = moments(d, "_gap").withColumn("_n", F.col("rn") - 1)
    d = d.withColumn("_z", (F.col("_gap") - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0)))
    d = d.where((F.col("_n") >= least) & (F.abs("_z") >= on)).select(*lane(d), TIME, TIE, "_n", "_gap", "_mean", "_sd", "_z")
    d = segments(d, cooldown_ms, inclusive=True)
    d = running(d.withColumn("_one", F.lit(1)), "anchor", _first=Part("sum", "_one")).where("_first = 1")
    notes = {"z_score": F.round("_z", 4), "direction": F.when(F.col("_z") < 0, "FASTER").otherwise("SLOWER"), "current_gap_sec": F.col("_gap") / 1000, "mean_gap_sec": F.col("_mean") / 1000, "stddev_gap_sec": F.col("_sd") / 1000, "sample_count": F.col("_n")}
    return emit(d, "auth_credential_velocity_anomaly", "Z-Score", F.col("_z"), comments=notes)
