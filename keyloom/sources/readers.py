"""Reading events: Kafka or files, JSON decoding and routing, event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.sources.schemas import BIO, TXN

#: Lateness that each kind of event is waited for.
LATENESS = {"TXN": "60 seconds", "BIO": "10 seconds"}
#: Where a new reader of each kind begins.
STARTING = {"TXN": "earliest", "BIO": "latest"}


def kafka(spark: SparkSession, servers: str, topic: str, group: str, kind: str = "TXN") -> DataFrame:
    """The stream of a Kafka topic of one kind; needs the Kafka connector package on the cluster."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "groupIdPrefix": group, "startingOffsets": STARTING[kind]}
    return spark.readStream.format("kafka").options(**options).load()


def json_files(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Files of one JSON record a line in the form of Kafka records: ``value`` and ``timestamp`` (when the file changed)."""
    reader = (spark.readStream if stream else spark.read).format("text").schema("value string")
    return reader.load(path).select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def tagged(records: DataFrame, kind: str) -> DataFrame:
    """Every record with its decoded fields, its ``value``, and a ``reason``.

    ``ok``, or why it is no event of ``kind`` (TXN or BIO): ``bad_json``, ``unknown_topic``, ``other_kind`` (an event of the
    other), ``no_key``, or ``bad_time`` (it gives no time that can be read, and came in at none). So what is decoded and what is
    not add up to the input.
    """
    schema = {"TXN": TXN, "BIO": BIO}[kind]
    text = F.col("value").cast("string")
    whole = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    flat = records.select(text.alias("value"), F.unix_millis("timestamp").alias("record_ms"), F.from_json(text, whole, options).alias("r")).select("value", "record_ms", "r.*")
    flat = flat.withColumn("kafkaSecondSourceTimestamp", F.col("record_ms"))
    reason = (
        F.when(F.col("topic").isNull() & ((F.trim(F.coalesce("value", F.lit(""))) == "") | F.col("_bad").isNotNull()), "bad_json").when(F.col("topic").isNull() | ~F.col("topic").isin("TXN", "BIO"), "unknown_topic")
        .when(F.col("topic") != kind, "other_kind").when(F.col("optId").isNull() | (F.trim("optId") == ""), "no_key").when(event_ms(kind).isNull(), "bad_time").otherwise("ok")
    )
    return flat.withColumn("reason", reason).drop("_bad")


def decode(records: DataFrame, kind: str) -> DataFrame:
    """The events of one kind, ``TXN`` or ``BIO``, from their JSON ``value``; unknown fields are ignored, other records left out."""
    return tagged(records, kind).where("reason = 'ok'").drop("value", "reason")


def quarantine(records: DataFrame, kind: str) -> DataFrame:
    """``value`` and ``reason`` of the records that are no events of either kind."""
    return tagged(records, kind).where(~F.col("reason").isin("ok", "other_kind")).select("value", "record_ms", "reason")


def _given_ms(kind: str) -> Column:
    """The time that a record gives itself in milliseconds; null where there is none or it can't be read."""
    if kind == "TXN":
        return F.unix_millis(F.to_utc_timestamp(F.try_to_timestamp(F.col("reqDateTime"), F.lit("yyyy-MM-dd'T'HH:mm:ss")), "Asia/Kolkata"))
    return F.trim("eventTimestamp").try_cast("long")


def event_ms(kind: str) -> Column:
    """Event time in milliseconds.

    TXN: ``reqDateTime`` as local time in India to the second. BIO: ``eventTimestamp`` in milliseconds. Where that is
    missing or can't be read, the record's own time, at which it came in.
    """
    return F.coalesce(_given_ms(kind), F.col("record_ms"))


def unreadable(decoded: DataFrame, kind: str) -> DataFrame:
    """Decoded records that give a time which can't be read; they count at their own time."""
    given = {"TXN": "reqDateTime", "BIO": "eventTimestamp"}[kind]
    return decoded.where(F.col(given).isNotNull() & _given_ms(kind).isNull())


def keyed(decoded: DataFrame, kind: str, key: str = "optId") -> DataFrame:
    """Decoded records as events: ``entity_id``, ``ts``, ``event_id``.

    The tie-break is the event's id; one without an id gets a hash of its fields, which is no id that repeats are known by.
    """
    own = F.concat(F.lit("~"), F.lower(F.hex(F.xxhash64(*decoded.columns))))
    events = decoded.withColumn("ts", event_ms(kind)).withColumn("entity_id", F.col(key))
    return events.withColumn("event_id", F.when(F.trim("eventId") != "", F.col("eventId")).otherwise(own))


def watermarked(events: DataFrame, kind: str) -> DataFrame:
    """Events with ``event_time`` and its watermark."""
    return events.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", LATENESS[kind])


def distinct_events(events: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A batch of events without repeats of an id of a key, in itself or in ``known`` events; those without an id all stay.

    Of several, the earliest stays.
    """
    named = F.col("eventId").isNotNull() & (F.trim("eventId") != "")
    first = Window.partitionBy("entity_id", "eventId").orderBy("ts", F.xxhash64(*events.columns))
    once = events.where(named).withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")
    if known is not None:
        once = once.join(known.where(named).select("entity_id", "eventId").distinct(), ["entity_id", "eventId"], "left_anti")
    return once.select(*events.columns).unionByName(events.where(~F.coalesce(named, F.lit(False))))
