"""The two kinds of events as views over the table ``events``, in Spark and in DuckDB.

``ms`` is a sixty times faster clock, on which few keys are dense; ``cal_ms`` is the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BASE = """SELECT event_id, user_id, event_type, value, CAST(get_json_object(props,'$.k') AS INT) k,
 unix_millis(CAST(ts AS TIMESTAMP)) ms0 FROM {events}"""
_CLOCKS = {"ms": "1704067200000 + ((ms0-1704067200000) div 60000)*1000", "cal_ms": "(ms0 div 1000)*1000"}
_KEYS = {"optId": "concat('OP',user_id % 15)", "user_id": "concat('U',user_id)", "half": "CASE WHEN user_id % 2 = 0 THEN 'HOT' ELSE concat('OP',user_id % 15) END"}
TXN_FIELDS = {
    "authCode": "concat('C',event_id div 2)", "enrolmentReferenceId": "concat('ENR',k%20)",
    "authResult": "CASE WHEN event_type IN ('error','view') THEN 'N' WHEN event_type='signup' AND k%10=0 THEN NULL ELSE 'Y' END",
    "authType": "CASE event_type WHEN 'click' THEN 'P' WHEN 'purchase' THEN 'O' WHEN 'error' THEN 'F' WHEN 'signup' THEN 'I' ELSE 'P' END",
    "deviceCode": "concat('D',k%7)", "modelId": "concat('M',k%4)", "deviceProviderId": "concat('V',k%3)", "aua": "concat('A',k%9)", "sa": "concat('S',k%3)",
    "locationStateCode": "CAST(k%5 AS STRING)", "locationDistrictCode": "CAST(k%12 AS STRING)", "residentStateCode": "CAST(event_id%5 AS STRING)",
    "errorCode": "CASE WHEN event_type='error' THEN CAST(300+k%4 AS STRING) END", "subErrorCode": "CASE WHEN event_type='error' THEN concat('300-',k%6) END",
    "registeredDeviceSoftwareId": "concat('RD',k%2)", "registeredDeviceSoftwareVersion": "concat('1.',k%3)",
    "certExpiryDate": "concat('202401',lpad(CAST(1+k%28 AS STRING),2,'0'))", "authDuration": "CAST(value AS STRING)", "fmrCount": "CAST(k AS STRING)",
    "firCount": "CAST(k%2 AS STRING)", "fingerMatchScore": "CAST(value AS STRING)", "faceMatchScore": "CAST(k AS STRING)",
    "faceUsed": "CASE WHEN event_id%3=0 THEN 'Y' WHEN event_id%3=1 THEN 'N' END", "pidSize": "CAST(100+k%11 AS STRING)", "serverId": "concat('SRV',k%2)",
}
BIO_FIELDS = {
    "bioType": "CASE k%3 WHEN 0 THEN 'FINGER' WHEN 1 THEN 'FACE' ELSE 'IRIS' END", "matchScore": "CAST(value AS STRING)", "faceLivenessScore": "CAST(k AS STRING)",
    "imageSize": "CAST(1000+k AS STRING)", "probeMinutiae": "CAST(k AS STRING)", "deviceCode": "concat('D',k%7)",
    "isLive": "CASE WHEN event_type='error' THEN 'N' WHEN event_type='view' THEN NULL ELSE 'Y' END",
    "deepPrintIsMatched": "CASE WHEN k%4=0 THEN 'N' ELSE 'Y' END", "deepPrintFIRMatchScore": "CAST(k%25 AS STRING)",
    "isLivenessCheckInvoked": "CASE WHEN k%2=0 THEN 'true' ELSE 'false' END", "livenessRequestInitiatedTime": "CAST(ms0 AS STRING)",
    "livenessResponseReceivedTime": "CAST(ms0+k*10 AS STRING)", "biolivenessEndtime": "CAST(ms0-k*60000 AS STRING)", "kafkaSourceTimestamp": "ms0",
    "authCode": "concat('C',event_id div 2)", "modelId": "concat('M',k%4)",
}
FIELDS = {"txn": TXN_FIELDS, "bio": BIO_FIELDS}


def _select(kind: str, clock: str, key: str, changed: dict[str, str]) -> str:
    fields = ", ".join(f"{sql} AS {name}" for name, sql in (FIELDS[kind] | changed).items())
    return f"SELECT event_id, concat('E',event_id) AS eventId, {_KEYS[key]} AS entity_id, {_CLOCKS[clock]} AS ts, {fields} FROM b"


def events_view(spark: SparkSession, sf_dir: str, kind: str = "txn", clock: str = "ms", key: str = "optId", changed: dict[str, str] | None = None) -> DataFrame:
    """The events of ``sf_dir`` as ``kind``, some fields ``changed``; Catalyst reads only the columns that a signal needs."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = raw.select(
        "event_id", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms0")
    )
    named = {"eventId": "concat('E',event_id)", "entity_id": _KEYS[key], "ts": _CLOCKS[clock], **FIELDS[kind], **(changed or {})}
    return base.selectExpr("event_id", *[f"{sql} AS {name}" for name, sql in named.items()])


def duckdb_view(kind: str = "txn", clock: str = "ms", key: str = "optId", changed: dict[str, str] | None = None) -> str:
    """Two common table expressions, ``b`` and ``ev``, with the same rows for DuckDB."""
    sql = f"b AS ({_BASE.format(events='events')}), ev AS ({_select(kind, clock, key, changed or {})})"
    for spark_sql, duck in (("get_json_object", "json_extract_string"), ("unix_millis(CAST(ts AS TIMESTAMP))", "epoch_us(ts)//1000"), (" div ", " // "), ("AS STRING", "AS VARCHAR")):
        sql = sql.replace(spark_sql, duck)
    return sql
