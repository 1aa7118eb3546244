"""Hand-made sequences of one key with the alerts that they must give."""

import pytest
from pyspark.sql import functions as F

from keyloom.plans.catalog import compute, compute_all, placed
from keyloom.sources.fixtures import BIO_FIELDS, TXN_FIELDS, events_view

SF = "/root/testdata/sf0.001"
H = 3_600_000
MIN = 60_000


def make(spark, rows, kind="txn"):
    """Events from dictionaries; times in milliseconds from a fixed start, ids in order."""
    names = [n for n in (TXN_FIELDS if kind == "txn" else BIO_FIELDS) if n != "kafkaSourceTimestamp"]
    full = [(r.get("event_id", i), r.get("eventId", f"E{i}"), r.get("key", "K"), 1_704_100_000_000 + r["t"], *[r.get(n) for n in names]) for i, r in enumerate(rows)]
    schema = "event_id long, eventId string, entity_id string, ts long, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(full, schema)


def alerts(spark, name, rows, kind="txn", **parameters):
    got = compute(name, make(spark, rows, kind), **parameters).orderBy("event_ts_ms", "feature_name").collect()
    return [(r["event_ts_ms"] - 1_704_100_000_000, round(r["feature_value"], 6)) for r in got]


def test_velocity(spark):
    assert alerts(spark, "auth_velocity_spike", [{"t": 4000 * i} for i in range(16)]) == [(56_000, 15)]
    assert alerts(spark, "auth_velocity_spike", [{"t": 4000 * i} for i in range(14)]) == []
    twice = [{"t": 1000 * i} for i in range(20)] + [{"t": 1_000_000 + 1000 * i} for i in range(16)]
    assert alerts(spark, "auth_velocity_spike", twice) == [(14_000, 15), (1_014_000, 15)]
    ties = [{"t": 0} for _ in range(15)]
    assert alerts(spark, "auth_velocity_spike", ties) == [(0, 15)]


def test_failure_rate(spark):
    ys = lambda s: [{"t": 1000 * i, "authResult": c} for i, c in enumerate(s)]
    assert alerts(spark, "auth_failure_rate", ys("Y" * 14 + "N" * 16)) == [(19_000, 0.3), (27_000, 0.5)]
    got = alerts(spark, "auth_failure_rate", ys("N" * 20 + "Y" * 60 + "N" * 20))
    assert got == [(19_000, 1.0), (25_000, 0.769231), (35_000, 0.555556), (52_000, 0.34), (94_000, 0.3)]


def test_multi_device(spark):
    rows = [{"t": 1000 * t, "deviceCode": d} for t, d in ((0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "a"), (5, "b"), (20, "a"))]
    assert alerts(spark, "auth_multi_device", rows) == [(2000, 3), (5000, 3)]


def test_device_diversity(spark):
    times = [(0, "a"), (H // 2, "b"), (H, "c"), (2 * H, "d"), (2 * H + 1, "e"), (3 * H, "f"), (3 * H + 5, "g"), (3 * H + 9, "h"), (3 * H + 9, "i")]
    got = compute("auth_device_diversity", make(spark, [{"t": t, "deviceCode": d} for t, d in times])).orderBy("event_ts_ms").collect()
    assert [(r["event_ts_ms"] - 1_704_100_000_000, r["feature_value"], r["window_start_ms"] - 1_704_100_000_000) for r in got] == [(2 * H, 4, 0), (3 * H + 9, 4, 2 * H + 1)]


def test_retry(spark):
    seq = [("N", 0), ("N", 30), ("Y", 90), ("Y", 100), ("N", 200), ("N", 321), ("Y", 330), ("N", 400), ("Y", 520.001)]
    got = alerts(spark, "auth_retry_session", [{"t": int(1000 * t), "authResult": r} for r, t in seq])
    assert got == [(90_000, 2), (90_000, 90), (330_000, 1), (330_000, 9)]


def test_error_escalation(spark):
    seq = [(1, "N", "1"), (2, "N", "1"), (3, "N", "2"), (4, "N", "3"), (5, "N", "4"), (6, "N", "5"), (7, "Y", None), (8, "N", "1"), (9, "N", "2"), (10, "N", "3"), (39, "N", "4"), (50, "N", "5")]
    assert alerts(spark, "auth_error_escalation", [{"t": MIN * t, "authResult": r, "errorCode": e} for t, r, e in seq]) == [(5 * MIN, 4)]


@pytest.mark.parametrize(
    ("name", "field", "values", "expected"),
    [
        ("auth_pid_size_anomaly", "pidSize", [100] * 9 + [1000], []),
        ("auth_pid_size_anomaly", "pidSize", [100] * 10 + [1000], [(10_000, 3.015113)]),
        ("auth_duration_outlier", "authDuration", [100] * 19 + [1000], [(19_000, 4.248529)]),
        ("auth_finger_decline", "fingerMatchScore", list(range(90, 71, -2)), [(9000, -2.0)]),
        ("auth_finger_decline", "fingerMatchScore", list(range(90, 80, -1)), []),
    ],
)
def test_numbers(spark, name, field, values, expected):
    assert alerts(spark, name, [{"t": 1000 * i, field: str(v)} for i, v in enumerate(values)]) == expected
    # fields that are null, blank or no number leave no trace
    noisy = [r for i, v in enumerate(values) for r in ({"t": 1000 * i, field: str(v)}, {"t": 1000 * i, field: [None, " ", "x", "-3"][i % 4]})]
    assert alerts(spark, name, noisy) == expected


def test_entropy(spark):
    hours = lambda seq: [{"t": h * H + i} for i, h in enumerate(seq)]
    value = lambda seq: [v for _, v in alerts(spark, "auth_time_entropy", hours(seq))]
    assert value([0] * 50) == [0.0]
    assert value([0] * 25 + [1] * 25) == [1.0]
    assert value(sorted(list(range(24)) * 2) + [24, 25]) == [4.573661]


def test_cross_border(spark):
    seq = [(1000, "27"), (1000 + 15 * MIN, "07"), (1000 + 15 * MIN + 2 * H, "27"), (1000 + 15 * MIN + 2 * H + 7_199_000, "09"), (1000 + 15 * MIN + 2 * H + 7_199_000, "10")]
    assert [round(v, 6) for _, v in alerts(spark, "auth_cross_border", [{"t": t, "locationStateCode": s} for t, s in seq])] == [15.0, 119.983333, round(1 / 60_000, 6)]


def test_repeated_ids_count_once(spark):
    rows = [{"t": 1000 * i, "eventId": f"E{i // 2}", "authType": "O"} for i in range(20)]
    # ten distinct ids: the share is first known at the tenth
    assert alerts(spark, "auth_otp_fallback", rows) == [(18_000, 1.0)]


def test_bio_streak(spark):
    rows = [{"t": 1000 * i, "isLive": x} for i, x in enumerate(["Y", "N", None, "N", "Y", "N"])]
    assert alerts(spark, "bio_liveness_streak", rows, "bio") == [(4000, 2)]


def test_shared_plan_equals_single_ones(spark):
    events = {k: placed(events_view(spark, SF, k)) for k in ("txn", "bio")}
    names = ["auth_velocity_spike", "auth_geo_drift", "auth_retry_session", "bio_match_trend", "auth_failure_streak"]
    rows = lambda d: sorted(map(tuple, d.drop("comments").collect()), key=str)
    together = rows(compute_all(events, names))
    apart = sorted([r for n in names for r in rows(compute(n, events_view(spark, SF, n[:3].replace("aut", "txn"))))], key=str)
    assert together == apart and together
    plan = compute("auth_velocity_spike", events["txn"])._jdf.queryExecution().executedPlan().toString()
    # all but the range frame's sort come from the shared layout
    assert "Exchange" not in plan.split("InMemoryTableScan")[0]
    for e in events.values():
        e.unpersist()


def test_idle_keys_start_afresh(spark):
    rows = [{"t": 1000 * i, "authType": "O"} for i in range(9)] + [{"t": 1000 * i + 49 * H, "authType": "O"} for i in range(9)]
    assert len(alerts(spark, "auth_otp_fallback", rows)) == 1
    assert compute("auth_otp_fallback", make(spark, rows), state_ttl=True).count() == 0


def test_long_key_streams_through_segments(spark):
    """A key over many Arrow batches keeps its anchor from one to the next."""
    rows = spark.range(30_000).select(F.col("id").alias("event_id"), F.concat(F.lit("E"), "id").alias("eventId"), F.lit("K").alias("entity_id"), (F.col("id") * 1000).alias("ts"), (F.col("id") % 5).cast("string").alias("deviceCode"))
    got = compute("auth_device_diversity", rows).orderBy("event_ts_ms").collect()
    assert [r["window_start_ms"] for r in got] == [k * 7_201_000 for k in range(5)]


def test_device_range_is_linear(spark):
    """A key with very many events in one range: their values are counted as they come and go."""
    rows = spark.range(200_000, numPartitions=4).select(F.col("id").alias("event_id"), F.concat(F.lit("E"), "id").alias("eventId"), F.lit("K").alias("entity_id"), F.col("id").alias("ts"), F.concat(F.lit("D"), F.floor(F.col("id") / 50_000)).alias("deviceCode"))
    got = compute("auth_rapid_device_switch", rows).collect()
    assert [(r["event_ts_ms"], r["feature_value"]) for r in got] == [(150_000, 4.0)]
    assert '"devices_seen":["D0","D1","D2","D3"]' in got[0]["comments"]


def test_memory_forgets_what_came_first():
    import random

    from keyloom.operators.memory import Memory

    for by_name in (False, True):
        rng, memory, held = random.Random(6), Memory(5, by_name), {}
        for _ in range(3000):
            v = rng.choice("abcdefghijkl")
            memory.add(v)
            held[v] = held.get(v, 0) + 1
            if len(held) > 5:
                del held[next(iter(held))]
            most = max(held.values())
            top = [x for x, c in held.items() if c == most]
            assert memory.counts == held and memory.says(v) == (True, held[v], min(top) if by_name else top[0], most, len(held))


def test_life_counts_events_that_touch_the_state(spark):
    """An event that a signal doesn't look at, amid a long silence, keeps no state alive."""
    rows = [{"t": 1000 * i, "authType": "O"} for i in range(9)] + [{"t": 30 * H}] + [{"t": 60 * H, "authType": "O"}]
    assert len(alerts(spark, "auth_otp_fallback", rows)) == 1
    assert compute("auth_otp_fallback", make(spark, rows), state_ttl=True).count() == 0
    touched = rows[:9] + [{"t": 30 * H, "authType": "P"}] + rows[10:]
    assert compute("auth_otp_fallback", make(spark, touched), state_ttl=True).count() == 1
