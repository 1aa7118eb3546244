"""Many events of a key at one time, as in large tables: streaks that end together, and ranges that hold most of a key."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from keyloom.operators.slices import in_range
from keyloom.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    """Two keys with about ten events a minute, which is one time of the views."""
    rng = random.Random(11)
    rows = [(i, 60_000_000 * (i // 20) + rng.randrange(60_000_000), rng.choice([15, 31]), rng.choice(["error", "error", "click", "view", "signup"]), 1.0, json.dumps({"k": rng.choice([3, 3, 3, 5, 9, 10])})) for i in range(1500)]
    folder = str(tmp_path_factory.mktemp("crowded"))
    spark.createDataFrame(rows, "event_id long, us long, user_id long, event_type string, value double, props string").select(
        "event_id", F.timestamp_micros(F.col("us") + 1_704_067_200_000_000).cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props").coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["auth_failure_streak", "auth_failure_streak_no_code", "auth_liveness_streak", "bio_liveness_streak", "bio_liveness_streak_notes"])
def test_streaks_that_end_together(spark, crowded, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{crowded}/events.parquet/*.parquet'")
    got = QUERIES[name](spark, crowded)
    columns = sorted(got.columns)
    found = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert found and sorted(map(tuple, got.select(*columns).collect())) == sorted(found)


def test_a_range_is_not_summed_anew_at_each_event(spark):
    """Its cost an event mustn't grow with the events in range: no frame but those that only grow."""
    rng = random.Random(2)
    times = sorted(rng.randrange(3000) for _ in range(400))
    d = spark.createDataFrame([("a", t, i, i + 1) for i, t in enumerate(times)], "entity_id string, ts long, event_id long, rn long")
    counted = in_range(d, "c", 700)
    assert {r["event_id"]: r["c"] for r in counted.collect()} == {i: sum(x >= t - 700 for x in times[: i + 1]) for i, t in enumerate(times)}
    apart = d.withColumn("ts", F.col("ts") * 1000 + F.col("rn")).withColumn("odd", (F.col("rn") % 2).cast("int"))
    moved = [t * 1000 + i + 1 for i, t in enumerate(times)]
    summed = in_range(apart, "c", 700_000, of="odd")
    assert {r["event_id"]: r["c"] for r in summed.collect()} == {i: sum((j + 1) % 2 for j in range(i + 1) if moved[j] >= t - 700_000) for i, t in enumerate(moved)}
    for plan in (counted, summed):
        assert "RangeFrame, -" not in plan._jdf.queryExecution().toString()
