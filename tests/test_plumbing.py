"""Reading, envelope and sinks."""

import json

import pytest
from pyspark.sql import functions as F

from keyloom.operators import streaks
from keyloom.plans.catalog import compute
from keyloom.plans.envelope import device_rows, enrich, feature_rows
from keyloom.sources import readers, sinks
from keyloom.sources.fixtures import events_view
from keyloom.sources.schemas import BIO, FEATURE, FEATURE_KEYS, TXN

SF = "/root/testdata/sf0.001"


def test_layouts():
    assert len(TXN.fields) == 45 and len(BIO.fields) == 41


def test_decode_routes_and_quarantines(spark, tmp_path):
    lines = [
        json.dumps({"topic": "TXN", "optId": "A", "eventId": "1", "reqDateTime": "2024-01-01T05:30:00", "other": 1}),
        json.dumps({"topic": "BIO", "optId": "B", "eventId": "2", "eventTimestamp": "1704067200123"}), "{bad", json.dumps({"topic": "X"}),
        json.dumps({"topic": "TXN", "optId": "A", "eventId": "3", "reqDateTime": "soon"}),
    ]
    (tmp_path / "in.json").write_text("\n".join(lines))
    records = readers.json_files(spark, str(tmp_path))
    txn, bio = (readers.keyed(readers.decode(records, k), k) for k in ("TXN", "BIO"))
    # a time that can't be read is the record's own
    own = {r["eventId"]: r for r in txn.collect()}
    assert own["1"]["ts"] == 1704067200000 and own["3"]["ts"] == own["3"]["record_ms"] and set(own) == {"1", "3"}
    assert [r["eventId"] for r in readers.unreadable(readers.decode(records, "TXN"), "TXN").collect()] == ["3"]
    assert [(r["entity_id"], r["ts"]) for r in bio.collect()] == [("B", 1704067200123)]
    for kind in ("TXN", "BIO"):
        assert {(r["value"], r["reason"]) for r in readers.quarantine(records, kind).collect()} == {(lines[2], "bad_json"), (lines[3], "unknown_topic")}


def test_every_record_has_a_reason(spark):
    """What is decoded and what is not add up to the input, fault by fault."""
    faults = {
        "ok": [{"topic": "TXN", "optId": "A", "reqDateTime": "2024-01-01T05:30:00"}, {"topic": "TXN", "optId": "A", "kafkaSourceTimestamp": "x"}], "no_key": [{"topic": "TXN"}, {"topic": "TXN", "optId": " "}],
        "other_kind": [{"topic": "BIO", "optId": "A"}], "unknown_topic": [{"topic": "txn"}, {"a": 1}, {}], "bad_json": ["{bad", "", None, "[1", "text"],
    }
    rows = [(json.dumps(v) if isinstance(v, dict) else v, 1.7e9) for values in faults.values() for v in values]
    records = spark.createDataFrame([(v, t) for v, t in rows], "value string, t double").select("value", F.timestamp_seconds("t").alias("timestamp"))
    timeless = records.limit(1).withColumn("value", F.lit('{"topic": "TXN", "optId": "A", "reqDateTime": "soon"}')).withColumn("timestamp", F.lit(None).cast("timestamp"))
    tagged = readers.tagged(records.unionByName(timeless), "TXN")
    assert {r["reason"]: r["count"] for r in tagged.groupBy("reason").count().collect()} == {k: len(v) for k, v in faults.items()} | {"bad_time": 1}
    everything = records.unionByName(timeless)
    parts = [readers.decode(everything, k).count() for k in ("TXN", "BIO")]
    assert parts[0] == 2 and parts[1] == 1 and readers.quarantine(everything, "TXN").count() == len(rows) + 1 - sum(parts)


def test_repeats_at_the_source(spark):
    rows = [("K", "a", 2), ("K", "a", 1), ("L", "a", 3), ("K", "b", 4), *[("K", x, 5) for x in (None, "", " ", None, "")]]
    events = spark.createDataFrame(rows, "entity_id string, eventId string, ts long")
    got = [tuple(r) for r in readers.distinct_events(events).collect()]
    assert sorted(got, key=str) == sorted(rows[1:], key=str)
    known = spark.createDataFrame([("K", "b", 0), ("K", "", 0)], events.schema)
    assert len(readers.distinct_events(events, known).collect()) == len(got) - 1


def test_envelope(spark):
    rows = [("K", "auth_txn_count", "Count", 3.0, 3_600_000, 1_704_067_200_000, 1_704_070_800_000, None), ("K", "x_v1", "Ratio", 0.5, 1_704_067_200_000, None, 1_704_067_200_000, '{"a":\n1}')]
    alerts = spark.createDataFrame(rows, "entity_id string, feature_name string, feature_type string, feature_value double, event_ts_ms long, window_start_ms long, window_end_ms long, comments string")
    got = {r["feature_name"]: r for r in feature_rows(enrich(alerts)).collect()}
    assert got["auth_txn_count"]["feature_id"] == "auth_txn_count_60m_v1" and got["x_v1"]["feature_id"] == "x_v1_v1"
    assert str(got["auth_txn_count"]["timestamp"]) == "2024-01-01 06:30:00"
    assert json.loads(got["auth_txn_count"]["comments"])["window_start"] == "2024-01-01T05:30:00.000"
    assert "\n" not in got["x_v1"]["comments"]
    assert [f.dataType for f in feature_rows(enrich(alerts)).schema.fields] == [f.dataType for f in FEATURE.fields]


def test_device_rows(spark):
    got = device_rows(streaks.device_changes(events_view(spark, SF)))
    assert got.columns == ["opt_id", "previous_devicecode_last_ts", "previous_devicecode_txns", "previous_devicecode", "current_devicecode", "current_auth_type", "ets"]
    assert got.where("previous_devicecode = current_devicecode").count() == 0 and got.count() > 0


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "features")
    rows = feature_rows(enrich(compute("auth_geo_drift", events_view(spark, SF))))
    n = rows.select(*FEATURE_KEYS).distinct().count()
    sinks.upsert(rows, path, FEATURE_KEYS, ["feature_name"], "entity_id", 4)
    sinks.upsert(rows, path, FEATURE_KEYS, ["feature_name"], "entity_id", 4)
    table = sinks.read_table(spark, path)
    assert table.count() == n
    changed = rows.limit(3).withColumn("feature_value", F.lit(-1.0))
    extra = rows.limit(1).withColumn("entity_id", F.lit("new"))
    sinks.upsert(changed.unionByName(extra), path, FEATURE_KEYS, ["feature_name"], "entity_id", 4)
    table = sinks.read_table(spark, path)
    assert table.count() == n + 1 and table.where("feature_value = -1").count() == changed.select(*FEATURE_KEYS).distinct().count()


@pytest.mark.parametrize("stop", ["merged", "swap", "half"])
def test_stopped_writer(spark, tmp_path, monkeypatch, stop):
    """A writer that is stopped between two steps, and started again, ends as one that ran through."""
    path, keys = str(tmp_path / "t"), ["k"]
    schema = "k long, e string, v long"
    first = spark.createDataFrame([(i, f"e{i % 5}", 0) for i in range(20)], schema)
    sinks.upsert(first, path, keys, [], "e", 4)
    second = spark.createDataFrame([(i, f"e{i % 5}", 1) for i in range(15, 25)], schema)
    whole = sinks.swap

    def stopped(done, path, cols):
        if stop == "half":
            whole(done.where("_bucket = 0"), path, cols)
        raise RuntimeError("stopped")

    if stop == "merged":
        monkeypatch.setattr(sinks, "_at", lambda s, p, own=sinks._at: (_ for _ in ()).throw(RuntimeError("stopped")) if p.endswith("_READY") else own(s, p))
    else:
        monkeypatch.setattr(sinks, "swap", stopped)
    with pytest.raises(RuntimeError):
        sinks.upsert(second, path, keys, [], "e", 4)
    monkeypatch.undo()
    third = spark.createDataFrame([(30, "e0", 3)], schema)
    sinks.upsert(third, path, keys, [], "e", 4)
    if stop == "merged":
        # nothing of it was ready, so its source runs again
        assert sinks.read_table(spark, path).count() == 21
        sinks.upsert(second, path, keys, [], "e", 4)
    got = {tuple(r) for r in sinks.read_table(spark, path).collect()}
    assert got == {(i, f"e{i % 5}", int(i >= 15)) for i in range(25)} | {(30, "e0", 3)}
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_conflict_keeps_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark.createDataFrame([(1, "e", "text")], "k long, e string, v string"), path, ["k"], [], "e", 1)
    with pytest.raises(Exception):
        sinks.upsert(spark.createDataFrame([(2, "e", 1.5)], "k long, e string, v double"), path, ["k"], [], "e", 1)
    assert [tuple(r) for r in sinks.read_table(spark, path).collect()] == [(1, "e", "text")]


def test_stream_into_table(spark, tmp_path):
    rows = feature_rows(enrich(compute("auth_provider_switch", events_view(spark, SF))))
    rows.coalesce(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    path = str(tmp_path / "out")
    sinks.start(stream, lambda batch, _: sinks.upsert(batch, path, FEATURE_KEYS, ["feature_name"], "entity_id", 2), str(tmp_path / "ck"), None).awaitTermination()
    assert sinks.read_table(spark, path).count() == rows.select(*FEATURE_KEYS).distinct().count()


def test_kafka_records(spark):
    rows = feature_rows(enrich(compute("auth_provider_switch", events_view(spark, SF))))
    got = sinks.kafka_records(rows, FEATURE_KEYS).collect()
    assert len({r["key"] for r in got}) == rows.select(*FEATURE_KEYS).distinct().count()
    assert set(json.loads(got[0]["value"])) == set(rows.columns)
