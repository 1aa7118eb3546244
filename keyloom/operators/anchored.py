"""Signals over anchored segments: diversity and concentration that begin anew with each segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.functions.parse import DAY_MS, HOUR_MS, filled, ist_weekday
from keyloom.functions.tables import written
from keyloom.operators.kernels import KEY, TIE, TIME, counts_at, emit, first_seen, is_sliced, lane, latch, ordered, prefix, prepare, segments
from keyloom.operators.memory import cooled, remember
from keyloom.operators.slices import Part, running


def _placed(events: DataFrame, eligible: Column | None, width_ms: int, values: dict[str, Column], guarded: bool = False) -> DataFrame:
    """Eligible events with ``values`` and the anchor of their segment; nothing else is sent through the ordered pass."""
    d = prepare(events, eligible, dedup=guarded, nudge=guarded)
    return segments(d.select(*lane(d), TIME, TIE, "rn", *[c.alias(n) for n, c in values.items()]), width_ms)


def _diverse(d: DataFrame, name: str, value: str, on: int, notes: tuple[str, str], more: dict[str, Column] | None = None) -> DataFrame:
    """The event of a segment that brings its distinct values over ``on``. Sets hold first events alone, no more than that."""
    d = first_seen(d, F.col(value), "v", "anchor")
    early = F.when(F.col("v_new") & (F.col("v_n") <= on + 1), F.col(value))
    if is_sliced(d):
        sets = d.groupBy(F.col(KEY).alias("_of"), F.col("anchor").alias("_at")).agg(F.collect_list(early).alias("_set"))
        d = d.join(sets, (F.col(KEY) == F.col("_of")) & (F.col("anchor") == F.col("_at")))
    else:
        d = d.withColumn("_set", F.collect_list(early).over(prefix(ordered("anchor"))))
    d = d.where(F.col("v_new") & (F.col("v_n") == on + 1))
    return emit(d, name, "Count", F.col("v_n"), F.col("anchor"), comments={notes[0]: F.col("v_n"), **(more or {}), notes[1]: F.sort_array("_set")})


def diversity(
    events: DataFrame, name: str, value: Column, width_ms: int, on: int, eligible: Column | None = None, guarded: bool = False,
    notes: tuple[str, str] = ("distinct_count", "codes_seen"), more: dict[str, Column] | None = None,
) -> DataFrame:
    """The event that brings more than ``on`` distinct values into a segment; at most one for each."""
    return _diverse(_placed(events, eligible, width_ms, {"v": value}, guarded), name, "v", on, notes, more)


def geo_drift(events: DataFrame, width_ms: int = HOUR_MS, states: int = 2, districts: int = 5) -> DataFrame:
    """More than ``states`` states, and more than ``districts`` districts, in a segment; blank codes open one but don't count."""
    ok = F.col("locationStateCode").isNotNull() | F.col("locationDistrictCode").isNotNull()
    d = _placed(events, ok, width_ms, {v: F.when(filled(c), F.col(c)) for v, c in (("s", "locationStateCode"), ("d", "locationDistrictCode"))})
    parts = (("auth_geo_states_drift_v1", "s", states), ("auth_geo_districts_drift_v1", "d", districts))
    a, b = (_diverse(d, n, v, on, ("distinct_count", "codes_seen")) for n, v, on in parts)
    return a.unionByName(b)


def device_diversity(events: DataFrame, width_ms: int = 2 * HOUR_MS, on: int = 3) -> DataFrame:
    return diversity(events, "auth_device_diversity_v1", F.col("deviceCode"), width_ms, on, filled("deviceCode"), notes=("distinct_devices", "device_codes"))


def model_diversity(events: DataFrame, width_ms: int = 4 * HOUR_MS, on: int = 2) -> DataFrame:
    return diversity(events, "auth_model_diversity_v1", F.col("modelId"), width_ms, on, filled("modelId"), notes=("distinct_models", "model_ids"))


def provider_switch(events: DataFrame, width_ms: int = 4 * HOUR_MS, on: int = 1) -> DataFrame:
    return diversity(events, "auth_device_provider_switch_v1", F.col("deviceProviderId"), width_ms, on, filled("deviceProviderId"), notes=("distinct_providers", "provider_ids"))


def aua_sa_diversity(events: DataFrame, width_ms: int = 2 * HOUR_MS, on: int = 8) -> DataFrame:
    pair = F.concat(F.trim("aua"), F.lit(":"), F.trim("sa"))
    return diversity(events, "auth_aua_sa_diversity_v1", pair, width_ms, on, filled("aua") & filled("sa"), notes=("distinct_pairs", "aua_sa_pairs"))


def error_spray(events: DataFrame, width_ms: int = HOUR_MS, on: int = 8) -> DataFrame:
    return diversity(events, "auth_multi_error_spray_v1", F.col("subErrorCode"), width_ms, on - 1, filled("subErrorCode", True), True, ("distinct_errors_1h", "error_codes"), {"threshold": F.lit(on)})


def concentration(events: DataFrame, name: str, value: str, width_ms: int, least: int, on: float, eligible: Column, dominant: str, total: str, counts: str) -> DataFrame:
    """Largest share of one value so far in a segment above ``on``, from ``least`` events on; the latch begins anew with each.

    The counts by value are taken for alerts alone, which are few, from the events of their segment up to them.
    """
    rows = _placed(events, eligible, width_ms, {"v": F.col(value)})
    rows = written(rows) if is_sliced(rows) else rows
    d = running(rows.withColumn("_one", F.lit(1)), "anchor", "v", _c=Part("sum", "_one")).withColumn("_pair", F.struct("_c", "v"))
    d = running(d, "anchor", _n=Part("sum", "_one"), _top=Part("max", "_pair")).withColumn("_share", F.col("_top._c") / F.col("_n"))
    enough = F.col("_n") >= least
    d = latch(d, enough & (F.col("_share") > on), enough & (F.col("_share") <= on), "anchor").select(KEY, TIME, "anchor", "rn", "_share", "_top", "_n")
    d = counts_at(d, rows, "v", "anchor")
    return emit(d, name, "Ratio", F.col("_share"), F.col("anchor"), comments={"concentration_ratio": F.col("_share"), dominant: F.col("_top.v"), total: F.col("_n"), counts: F.col("_counts")})


def error_hotspot(events: DataFrame, width_ms: int = HOUR_MS, least: int = 20, on: float = 0.8) -> DataFrame:
    return concentration(events, "auth_error_code_hotspot_v1", "subErrorCode", width_ms, least, on, filled("subErrorCode", True), "dominant_error", "total_errors", "error_counts")


def server_concentration(events: DataFrame, width_ms: int = HOUR_MS, least: int = 50, on: float = 0.95) -> DataFrame:
    return concentration(events, "auth_server_concentration_v1", "serverId", width_ms, least, on, filled("serverId"), "dominant_server", "total_requests", "server_counts")


def weekend(events: DataFrame, width_ms: int = 7 * DAY_MS, least: int = 20, on: float = 0.5) -> DataFrame:
    """Share of events on Saturday and Sunday (India) so far in a segment above ``on``."""
    d = _placed(events, None, width_ms, {"w": (ist_weekday() >= 5).cast("int")})
    d = running(d.withColumn("_one", F.lit(1)), "anchor", _n=Part("sum", "_one"), _w=Part("sum", "w")).withColumn("_share", F.col("_w") / F.col("_n"))
    enough = F.col("_n") >= least
    d = latch(d, enough & (F.col("_share") > on), enough & (F.col("_share") <= on), "anchor")
    return emit(d, "auth_weekend_anomaly_v1", "Ratio", F.col("_share"), F.col("anchor"), comments={"weekend_ratio": F.col("_share"), "weekend_count": F.col("_w"), "weekday_count": F.col("_n") - F.col("_w")})


def location_anchor(events: DataFrame, least: int = 15, cooldown_ms: int = HOUR_MS, most: int = 100) -> DataFrame:
    """Share of a key's most frequent location, on events elsewhere; each location alerts once in ``cooldown_ms``.

    A key remembers ``most`` locations and the alerts of as many; what came in first is forgotten first.
    """
    place = F.concat_ws("|", "locationStateCode", F.coalesce("locationDistrictCode", F.lit("UNKNOWN")))
    d = prepare(events, filled("locationStateCode"), dedup=True).select(KEY, TIME, TIE, "rn", place.alias("place"))
    d = remember(d, {"place": most}, after=True).where((F.col("rn") >= least) & (F.col("place") != F.col("place_seen.top")))
    d = d.select(
        KEY, TIME, TIE, "place", "rn", F.col("place_seen.top").alias("home"), (F.col("place_seen.top_n") / F.col("rn")).alias("share"), (F.col("place_seen.n") / F.col("rn")).alias("own"), F.col("place_seen.size").alias("places"),
    )
    d = cooled(d, "place", cooldown_ms, most)
    strength = F.when(F.col("share") >= 0.8, "VERY_STRONG").when(F.col("share") >= 0.5, "STRONG").otherwise("WEAK_OR_NO_ANCHOR")
    percent = lambda c: F.concat((F.floor(F.col(c) * 10_000 + 0.5) / 100).cast("string"), F.lit("%"))
    notes = {
        "anchor_location": F.col("home"), "anchor_percentage": percent("share"), "anchor_strength": strength, "current_location": F.col("place"), "current_location_percentage": percent("own"),
        "total_distinct_locations": F.col("places"), "total_events_with_location": F.col("rn"), "detection_timestamp": F.col(TIME),
        "explanation": F.format_string("seen at %s, away from the usual %s (%s)", "place", "home", strength),
    }
    return emit(d, "auth_geo_location_anchor_drift", "Ratio", F.round("share", 4), comments=notes)


def fingerprint_break(events: DataFrame, least: int = 20, most: int = 2, cooldown_ms: int = 300_000, values: int = 30) -> DataFrame:
    """How many of four fields equal the key's most frequent earlier value, when at most ``most`` do; one alert in ``cooldown_ms``.

    A key remembers ``values`` values of each field; what came in first is forgotten first.
    """
    fields = {"auth_type": "authType", "model": "modelId", "provider": "deviceProviderId", "software": "registeredDeviceSoftwareId"}
    d = events.withColumns({f"_{k}": F.when(filled(c), F.col(c)).otherwise("UNKNOWN") for k, c in fields.items()})
    known = F.lit(False)
    for k in fields:
        known = known | (F.col(f"_{k}") != "UNKNOWN")
    d = prepare(d, known, dedup=True).select(KEY, TIME, TIE, "rn", *[f"_{k}" for k in fields])
    d = remember(d, {f"_{k}": values for k in fields}, by_name=True)
    d = d.withColumns({f"mode_{k}": F.col(f"_{k}_seen.top") for k in fields})
    score = sum(((F.col(f"_{k}") == F.col(f"mode_{k}")).cast("int") for k in fields), F.lit(0))
    d = d.withColumn("score", score).where((F.col("rn") > least) & (F.col("score") <= most))
    d = d.select(KEY, TIME, TIE, "rn", "score", *[c for k in fields for c in (f"_{k}", f"mode_{k}")])
    d = segments(d, cooldown_ms, inclusive=True)
    d = d.withColumn("_nth", F.row_number().over(ordered("anchor"))).where("_nth = 1")
    compared = F.struct(*[F.struct(F.col(f"mode_{k}").alias("baseline"), F.col(f"_{k}").alias("current"), (F.col(f"_{k}") == F.col(f"mode_{k}")).alias("match")).alias(k) for k in fields])
    notes = {"similarity_score": F.col("score"), "dimension_comparison": compared, "total_events_in_baseline": F.col("rn") - 1, "detection_timestamp": F.col(TIME)}
    grade = F.when(F.col("score") == 0, "CRITICAL").when(F.col("score") == 1, "HIGH").otherwise("MEDIUM")
    notes["severity"] = F.format_string("%s: %d of 4 fields as usual", grade, "score")
    return emit(d, "auth_session_identity_fingerprint_break", "Similarity Score", F.col("score"), comments=notes)


def cert_expiry(events: DataFrame, within_ms: int = 7 * DAY_MS, again_ms: int = DAY_MS, zone: str = "Asia/Kolkata") -> DataFrame:
    """Days until a certificate expires, when at most ``within_ms`` are left.

    Every event is looked at until the first alert of a key; from then on, only one more than ``again_ms`` after the last look.
    """
    expiry = F.unix_millis(F.to_utc_timestamp(F.try_to_timestamp(F.substring("certExpiryDate", 1, 8), F.lit("yyyyMMdd")), zone))
    d = prepare(events, filled("certExpiryDate")).withColumn("left", expiry - F.col(TIME))
    d = d.withColumn("_hit", F.coalesce((F.col("left") > 0) & (F.col("left") <= within_ms), F.lit(False)))
    d = running(d.withColumn("_one", F.col("_hit").cast("int")), _hits=Part("sum", "_one")).where(F.col("_hits") > 0)
    d = segments(d.select(*lane(d), TIME, TIE, "left", "certExpiryDate", F.col("_hit").alias("hit")), again_ms)
    d = running(d.withColumn("_one", F.lit(1)), "anchor", _order=Part("sum", "_one")).where((F.col("_order") == 1) & F.col("hit"))
    days = F.col("left") / DAY_MS
    return emit(d, "auth_cert_expiry_alert_v1", "Days", days, comments={"cert_id": F.col("certExpiryDate"), "days_remaining": F.format_string("%.1f", days), "alert": F.lit("Approaching expiration")})
