"""Hot keys in time slices: the same rows for any number of slices, and no task with a whole key."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyloom.operators.kernels import KEY, segments
from keyloom.operators.slices import SLICE, Part, cut_slices, in_range, moments, reach, running
from keyloom.operators.streaks import device_changes
from keyloom.plans.catalog import SIGNALS, SLICED, compute, compute_sliced
from keyloom.sources.fixtures import FIELDS


@pytest.fixture(scope="module")
def events(spark):
    """Half of all events are of one key, with ties in time, repeated ids, blanks, bursts and long silences."""
    rng = random.Random(4)
    rows, t = [], 0
    for i in range(3000):
        t += rng.choice([0, 1, 400, 900, 5_000, 40_000, 600_000 if rng.random() < 0.05 else 2_000, 8_000_000 if rng.random() < 0.01 else 1_000])
        rows.append((i, rng.choice(["", None, f"E{i // 2}", f"E{i}"]), "HOT" if i % 2 else f"K{i % 9}", 1_704_067_200_000 + t))
    base = spark.createDataFrame(rows, "event_id long, eventId string, entity_id string, ts long").withColumn("k", (F.hash("event_id") % 100 + 100) % 100).withColumn("value", F.col("k") * 1.7 + 1).withColumn("ms0", F.col("ts")).withColumn("user_id", F.col("k"))
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("click", "error", "purchase", "view", "signup")]), (F.hash("event_id", "k") % 5 + 5).cast("int") % 5 + 1)
    base = base.withColumn("event_type", kinds).selectExpr("*", *[f"{sql} AS {n}" for n, sql in (FIELDS["txn"] | FIELDS["bio"]).items() if n not in ("deviceCode",)], "concat('D',k%7) AS deviceCode")
    return base.drop("k", "value", "ms0", "user_id", "event_type").withColumn("probeMinutiae", F.col("faceMatchScore")).repartition(6).persist()


def rows(alerts):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in alerts.drop("comments").collect())


CASES = {
    "auth_velocity_spike": {"width_ms": 600_000}, "auth_otp_fallback": {"on": 0.35}, "auth_duration_outlier": {"on": 1.5}, "auth_geo_drift": {}, "auth_error_spray": {"on": 4},
    "auth_finger_decline": {}, "auth_fmr_spread": {"on": 35.0, "off": 25.0}, "auth_success_cliff": {"on": 25.0, "off": 12.0}, "auth_modality_switch": {}, "auth_txn_gap_avg": {}, "auth_txn_gaps": {},
    "auth_dormancy": {"gap_ms": 400_000}, "auth_brute_force": {"least": 2}, "auth_cross_border": {}, "auth_bot_recovery_speed": {"least": 1, "within_ms": 60_000}, "auth_ghost_uptime": {"gap_ms": 300_000, "least_ms": 200_000},
    "auth_liveness_streak": {}, "auth_failure_streak": {}, "bio_liveness_streak": {}, "auth_packet_replay": {"length": 2, "fields": ("deviceCode",)}, "bio_image_size_replay": {"length": 2, "field": "bioType"},
    "auth_night_surge": {"n": 300, "on": 0.1}, "bio_probe_minutiae": {}, "auth_enrolment_hammering": {"width_ms": 20_000_000, "on": 40, "off": 10},
    "auth_txn_counts": {}, "auth_retry_session": {}, "auth_txn_oddhour_ratio": {}, "auth_rd_software_change": {}, "auth_biometric_replay": {"n": 400, "on": 1}, "auth_time_entropy": {"every": 7, "low": 3.0, "high": 3.5},
    "auth_credential_velocity": {"on": 2.0}, "auth_high_risk_hours": {"on": 3}, "auth_rapid_device_switch": {"width_ms": 60_000}, "auth_concurrent_aua": {"on": 2}, "auth_error_hotspot": {"least": 3, "on": 0.4},
    "auth_server_concentration": {"least": 3, "on": 0.4}, "auth_weekend": {"least": 3, "on": 0.2, "width_ms": 3_600_000}, "auth_cert_expiry": {"within_ms": 4000 * 86_400_000, "again_ms": 300_000}, "bio_modality_concentration": {"chunk": 20, "least": 4, "on": 0.5},
    "bio_capture_spoof": {"below_ms": 5_000}, "bio_liveness_desync": {"above_ms": 1}, "bio_deep_print_subversion": {"below": 60.0},
}


#: Nights and weekends are elsewhere.
SHIFTS = {"auth_high_risk_hours": 12 * 3_600_000, "auth_weekend": 4 * 86_400_000 + 10 * 3_600_000}


@pytest.mark.parametrize("name", sorted(CASES))
def test_any_number_of_slices(events, name):
    events = events.withColumn("ts", F.col("ts") + SHIFTS.get(name, 0))
    plain = rows(compute(name, events, **CASES[name]))
    assert plain
    for most in (1500 - 1, 1500 // 7, 30) if name in ("auth_otp_fallback", "auth_geo_drift") else (1500 // 7,):
        assert rows(compute_sliced(name, events, most, **CASES[name])) == plain


def test_a_thousand_slices(events):
    for name in ("auth_velocity_spike", "auth_otp_fallback", "auth_duration_outlier", "auth_geo_drift"):
        assert rows(compute_sliced(name, events, 2, **CASES[name])) == rows(compute(name, events, **CASES[name]))


def test_comments_of_sliced_sets(events):
    for name in ("auth_geo_drift", "auth_rapid_device_switch", "auth_concurrent_aua", "auth_error_hotspot", "auth_rd_software_change", "bio_modality_concentration"):
        a, b = (sorted(r["comments"] for r in f(name, events, **CASES[name]).collect()) for f in (compute, lambda n, e, **p: compute_sliced(n, e, 200, **p)))
        assert a and a == b


def test_all_sliced_signals_are_held_against_plain_ones():
    same = {"auth_failure_burst", "auth_success_without_bio", "auth_location_mismatch", "bio_deep_print_failures", "auth_face_decline", "bio_match_trend", "bio_liveness_decline", "bio_uncanny_scores"}
    same |= {"auth_pid_size_anomaly", "bio_image_size_anomaly", "bio_response_time_anomaly", "auth_device_diversity", "auth_model_diversity", "auth_provider_switch", "auth_aua_sa_diversity"}
    assert SLICED == set(CASES) | same


def test_device_changes_in_slices(events):
    a, b = (sorted(map(tuple, device_changes(e).collect())) for e in (events, cut_slices(events, 100)))
    assert a and a == b


def test_no_slice_is_large(events):
    """Half of all rows share a key; no slice, and so no task of a window, has more than its share of them."""
    sliced = cut_slices(events.where(F.col(KEY) == "HOT"), 100)
    sizes = [r["count"] for r in sliced.groupBy(SLICE).count().collect()]
    instants = max(r["count"] for r in events.where(F.col(KEY) == "HOT").groupBy((F.col("ts") / 1000).cast("long")).count().collect())
    assert sum(sizes) == 1500 and len(sizes) >= 14 and max(sizes) <= 100 + instants
    order = [(r["ts"], r[SLICE]) for r in sliced.select("ts", SLICE).orderBy("ts", SLICE).collect()]
    assert [s for _, s in order] == sorted(s for _, s in order)
    plan = running(sliced, x=Part("max", "event_id"))._jdf.queryExecution().toString()
    assert "Window" not in plan.split("== Physical Plan ==")[1] or f"hashpartitioning({KEY}" in plan


def test_kernels(spark):
    rng = np.random.default_rng(8)
    times = np.sort(rng.integers(0, 5_000, 400))
    values = rng.normal(1e9, 1.0, 400)
    d = spark.createDataFrame([("a", int(t), i, float(x), i + 1) for i, (t, x) in enumerate(zip(times, values))], "entity_id string, ts long, event_id long, x double, rn long")
    sliced = cut_slices(d, 37, 1)
    got = sorted((r["event_id"], r["_mean"], r["_sd"]) for r in moments(sliced, "x").collect())
    for i, mean, sd in got:
        assert abs(mean - values[: i + 1].mean()) < 1e-5 and (sd is None if i == 0 else abs(sd - values[: i + 1].std(ddof=1)) < 1e-4)
    got = sorted((r["event_id"], r["c"]) for r in in_range(sliced, "c", 700, 50).collect())
    assert got == [(i, int(sum(times[j] >= t - 700 for j in range(i + 1)))) for i, t in enumerate(times)]
    for inclusive in (False, True):
        a, b = (sorted((r["event_id"], r["anchor"]) for r in segments(x, 90, inclusive=inclusive).collect()) for x in (d, sliced))
        assert a == b


def test_reach():
    times = np.array([0, 10, 11, 30, 45, 60], dtype=np.int64)
    upto, last = reach(times, 15, False)
    chain = lambda i: i if not (times > times[i] + 15).any() else chain(int(np.argmax(times > times[i] + 15)))
    for i, t in enumerate(times):
        assert last[np.searchsorted(upto, t)] == times[chain(i)]


def test_only_sliced_signals(events):
    assert SLICED <= set(SIGNALS)
    with pytest.raises(ValueError):
        compute_sliced("auth_location_anchor", events)


def test_an_ordered_pass_brings_keys_together(spark):
    """Whatever order rows come in, and where Spark takes a partitioning by fewer columns for not enough."""
    d = spark.range(2000).selectExpr("concat('K', id % 3) AS entity_id", "id * 100 AS ts", "id AS event_id").repartition(7)
    got = sorted((r[KEY], r["event_id"], r["anchor"]) for r in segments(d, 5_000).collect())
    anchors = {}
    for k, i in sorted((f"K{i % 3}", i) for i in range(2000)):
        if k not in anchors or i * 100 - anchors[k] > 5_000:
            anchors[k] = i * 100
        assert got.pop(0) == (k, i, anchors[k])


def test_slices_over_many_stretches(spark):
    """Slices number the running count of a key, over more stretches of time than one."""
    rng = np.random.default_rng(3)
    times = np.sort(rng.integers(-10_000_000, 10_000_000_000, 500))
    d = spark.createDataFrame([("a", int(t), i) for i, t in enumerate(times)] + [("b", 5, 1)], "entity_id string, ts long, event_id long")
    grains = times // 1000
    expected = {("a", i): int((grains < g).sum()) // 40 for i, g in enumerate(grains)} | {("b", 1): 0}
    assert {(r[KEY], r["event_id"]): r[SLICE] for r in cut_slices(d, 40).collect()} == expected
