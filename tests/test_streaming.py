"""The job says what the batch says: after late events, repeats, faults, replays and stops."""

import json

import pytest
from pyspark.sql import functions as F

from keyloom.operators.streaks import device_changes
from keyloom.plans.catalog import SIGNALS, compute, compute_all
from keyloom.plans.envelope import device_rows, enrich, feature_rows
from keyloom.sources import sinks
from keyloom.sources.fixtures import events_view
from keyloom.sources.readers import decode, distinct_events, json_files, keyed
from keyloom.sources.sinks import read_table
from keyloom.streaming.job import Job

SF = "/root/testdata/sf0.001"
NAMES = ["auth_velocity_spike", "auth_geo_drift", "auth_provider_switch", "auth_otp_fallback", "auth_retry_session", "auth_txn_counts", "auth_location_anchor"]


def as_rows(df):
    cols = ["entity_id", "feature_name", "event_ts_ms", "feature_value", "window_start_ms"]
    return sorted(((r[0], r[1], r[2], round(r[3], 6), r[4] or 0) for r in df.select(*cols).collect()))


@pytest.fixture(scope="module")
def lines(spark):
    view = events_view(spark, SF).where("entity_id IN ('OP1', 'OP2', 'OP3')")
    sent = view.select(
        F.lit("TXN").alias("topic"), F.col("entity_id").alias("optId"), "eventId", F.date_format(F.timestamp_millis(F.col("ts") + 19_800_000), "yyyy-MM-dd'T'HH:mm:ss").alias("reqDateTime"),
        "authResult", "authType", "deviceCode", "deviceProviderId", "locationStateCode", "locationDistrictCode",
    ).orderBy("reqDateTime", "eventId")
    return [r["value"] for r in sent.select(F.to_json(F.struct("*")).alias("value")).collect()]


class Files:
    """A folder that records come into, and the job over it."""

    def __init__(self, spark, root, names=NAMES, **options):
        self.spark, self.root, self.n, self.names, self.options, self.told = spark, root, 0, names, options, []
        (root / "in").mkdir()

    def come(self, lines):
        self.n += 1
        (self.root / "in" / f"{self.n:03d}.json").write_text("\n".join(lines))
        self.run()

    def run(self):
        Job(self.spark, {"TXN": json_files(self.spark, str(self.root / "in"), stream=True)}, f"{self.root}/out", self.names, interval=None, also=self.told.append, **self.options).run(f"{self.root}/ck")

    def features(self):
        return read_table(self.spark, f"{self.root}/out/features")

    def batch(self):
        return distinct_events(keyed(decode(json_files(self.spark, f"{self.root}/in"), "TXN"), "TXN"))

    def same(self):
        """The tables hold what the batch says of all events, with the same comments, and nothing else."""
        columns = ["entity_id", "feature_id", "timestamp", "feature_value", "comments"]
        want = feature_rows(enrich(compute_all({"txn": self.batch()}, self.names, state_ttl=True)))
        want = sinks.one_a_key(want, ["feature_id", "entity_id", "timestamp"])
        got = self.features()
        assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect())) != []
        want = device_rows(device_changes(self.batch()))
        if rows := sorted(map(tuple, want.select(sorted(want.columns)).collect())):
            assert sorted(map(tuple, read_table(self.spark, f"{self.root}/out/devices").select(sorted(want.columns)).collect())) == rows


def test_job_equals_batch(spark, tmp_path, lines):
    """In three parts, with late events, repeats of ids in and across batches, and records that are no events."""
    files = Files(spark, tmp_path)
    late, rest = lines[40:60:3], [x for i, x in enumerate(lines) if not (40 <= i < 60 and (i - 40) % 3 == 0)]
    third = len(rest) // 3
    files.come(rest[:third] + rest[10:13] + ["{bad", '{"topic": "TXN"}', '{"topic": "other", "optId": "K"}'])
    files.come(rest[third : 2 * third] + rest[5:8])
    files.come(late + rest[2 * third :])
    files.same()
    bad = spark.read.parquet(f"{tmp_path}/out/quarantine/TXN").collect()
    assert sorted(r["reason"] for r in bad) == ["bad_json", "no_key", "unknown_topic"]
    assert files.told and Job(spark, {"TXN": None}, f"{tmp_path}/out").archive("TXN").count() == files.batch().count() == len(lines)


def test_events_without_an_id_all_count(spark, tmp_path):
    one = {"topic": "TXN", "optId": "K", "authResult": "N", "reqDateTime": "2024-01-01T10:00:00"}
    files = Files(spark, tmp_path, ["auth_txn_counts", "auth_velocity_spike"])
    files.come([json.dumps(one | ({"eventId": ""} if i % 2 else {})) for i in range(5)])
    files.come([json.dumps(one)] * 2)
    assert [r["feature_value"] for r in files.features().where("feature_name = 'auth_txn_failure_count'").collect()] == [7.0]
    files.same()


def test_late_event_takes_an_alert_back(spark, tmp_path):
    """Failures before a success are a session; a success that comes late, in their midst, ends it earlier."""
    at = lambda s, result: json.dumps({"topic": "TXN", "optId": "K", "eventId": f"{s}{result}", "authResult": result, "reqDateTime": f"2024-01-01T10:00:{s:02d}"})
    files = Files(spark, tmp_path, ["auth_retry_session"])
    files.come([at(1, "N"), at(5, "N"), at(20, "Y"), at(50, "N")])
    before = {(r["feature_name"], r["feature_value"]) for r in files.features().collect()}
    files.come([at(10, "Y")])
    after = {(r["feature_name"], r["feature_value"]) for r in files.features().collect()}
    assert before == {("auth_retry_attempts", 2.0), ("auth_retry_duration_sec", 19.0)} and after == {("auth_retry_attempts", 2.0), ("auth_retry_duration_sec", 9.0)}
    files.same()


def test_replay_and_stop(spark, tmp_path, lines, monkeypatch):
    """A batch that runs twice, and one that stops in the midst of its writing, end as one run."""
    files = Files(spark, tmp_path)
    half = len(lines) // 2
    files.come(lines[:half])
    whole = sinks.swap
    monkeypatch.setattr(sinks, "swap", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(Exception):
        files.come(lines[half:])
    monkeypatch.setattr(sinks, "swap", whole)
    files.run()
    files.same()
    job = Job(spark, {"TXN": None}, f"{tmp_path}/out", NAMES)
    step = job.step("TXN", "again")
    records = spark.createDataFrame([(x,) for x in lines[half - 5 : half + 5]], "value string").withColumn("timestamp", F.current_timestamp())
    for _ in range(2):
        step(records, 7)
    files.same()
    n = job.archive("TXN").count()
    step(records, 7)
    assert job.archive("TXN").count() == n == len(lines)


def test_horizon_bounds_what_is_read(spark, tmp_path):
    """With a horizon, a micro-batch reads the days of it alone, and only the buckets of its keys."""
    at = lambda day, i: json.dumps({"topic": "TXN", "optId": f"K{i % 3}", "eventId": f"{day}-{i}", "authResult": "N", "reqDateTime": f"2024-01-{day:02d}T10:00:{i:02d}"})
    files = Files(spark, tmp_path, ["auth_txn_gaps"], horizon_days=1)
    for day in (1, 5, 9):
        files.come([at(day, i) for i in range(9)])
    # each day's first event of a key knows of none before it
    assert files.features().where("feature_name = 'auth_txn_gap_sec'").count() == 18
    archive = Job(spark, {"TXN": None}, f"{tmp_path}/out").archive("TXN")
    plan = archive.where((F.col("day") >= 19_700) & F.col("_bucket").isin([3]))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "_bucket" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_counts_on_a_stream(spark, tmp_path):
    events = events_view(spark, SF).withColumn("ts", F.col("ts") - F.pmod("ts", F.lit(5000)))
    timed = events.withColumn("event_time", F.timestamp_millis("ts"))
    timed.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    far = timed.limit(1).withColumns({"entity_id": F.lit("far"), "ts": F.col("ts") + 10**10, "event_time": F.timestamp_millis(F.col("ts") + 10**10)})
    far.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(timed.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).withWatermark("event_time", "60 seconds")
    query = SIGNALS["auth_txn_counts"].make(stream).writeStream.format("memory").queryName("counted").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert as_rows(spark.table("counted").where("entity_id <> 'far'")) == as_rows(compute("auth_txn_counts", events))
