"""The whole job: records of both kinds in, rows of the feature and device tables out."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyloom.functions.parse import DAY_MS
from keyloom.operators.kernels import KEY
from keyloom.operators.streaks import device_changes
from keyloom.plans.catalog import SIGNALS, compute_all
from keyloom.plans.envelope import device_rows, enrich, feature_rows
from keyloom.sources.readers import distinct_events, keyed, tagged
from keyloom.sources.schemas import DEVICE_KEYS, FEATURE_KEYS
from keyloom.sources.sinks import BUCKETS, EVENT_MS, bucket_of, exists, start, upsert

KINDS = {"TXN": "txn", "BIO": "bio"}
#: How the features of a kind are named.
PREFIX = {"TXN": "auth_", "BIO": "bio_"}
#: Days around a batch's events in which a repeat of an id is looked for.
REPEAT_DAYS = 1


class Job:
    """Streams over ``records`` (by kind, in the form of Kafka's) that keep tables under ``out`` up to date.

    Signals are those of the batch, over the archive: a micro-batch adds its events to ``events``, an archive by day and
    bucket of the key, and the signals of the keys that it touches are worked out from there. What holds from the time of a key's
    first new event on replaces what was published of that, so a late event counts as it would have in time and takes alerts
    back. Live and batch share one definition, and there is no state to lose but the archive.

    All writes are named by the batch: its part of the archive and of ``quarantine`` (with a reason) is overwritten, and
    results are upserts. So a batch that runs again, after a stop anywhere, ends the same. A repeated id of a key is dropped, in a
    batch and against the archive of the days around; events without an id all count.

    A micro-batch reads the buckets of its keys, over the whole archive, or its last ``horizon_days``: then what a signal
    remembers ends there, as state with a time to live would, and reading doesn't grow with history. ``also`` gets every
    batch of feature rows too, such as a Kafka sink.
    """

    def __init__(
        self, spark: SparkSession, records: dict[str, DataFrame], out: str, names: list[str] | None = None, also: Callable[[DataFrame], None] | None = None,
        interval: str | None = "120 seconds", state_ttl: bool = True, horizon_days: int | None = None,
    ) -> None:
        self.spark, self.records, self.out, self.also, self.interval, self.ttl, self.horizon = spark, records, out.rstrip("/"), also, interval, state_ttl, horizon_days
        self.names = {k: [n for n in (names or SIGNALS) if SIGNALS[n].kind == KINDS[k]] for k in records}

    def archive(self, kind: str) -> DataFrame:
        """The events of a kind that have come in, with ``day``, ``_bucket`` and ``batch``."""
        decoded = tagged(self.spark.createDataFrame([], "value string, timestamp timestamp"), kind).drop("value", "reason")
        return self.spark.read.schema(self._placed(keyed(decoded, kind), "").schema).parquet(f"{self.out}/events/{kind}")

    def _placed(self, events: DataFrame, batch: str) -> DataFrame:
        return events.select("*", F.floor(F.col("ts") / DAY_MS).cast("int").alias("day"), bucket_of(KEY), F.lit(batch).alias("batch"))

    def _write(self, rows: DataFrame, path: str, *by: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    def step(self, kind: str, tag: str) -> Callable[[DataFrame, int], None]:
        """What a micro-batch of records does; ``tag`` tells apart streams that number their batches alike."""

        def sink(records: DataFrame, number: int) -> None:
            batch = f"{tag}-{number:010d}"
            decoded = tagged(records, kind).persist()
            try:
                bad = decoded.where(~F.col("reason").isin("ok", "other_kind")).select("value", "record_ms", "reason", F.lit(batch).alias("batch"))
                self._write(bad, f"{self.out}/quarantine/{kind}", "batch")
                events = self._placed(keyed(decoded.where("reason = 'ok'").drop("value", "reason"), kind), batch)
                span = events.agg(F.min("day"), F.max("day"), F.collect_set("_bucket")).first()
                if span[0] is not None:
                    self._take(kind, batch, events, *span)
            finally:
                decoded.unpersist()

        return sink

    def _take(self, kind: str, batch: str, events: DataFrame, first: int, last: int, buckets: list[int]) -> None:
        path = f"{self.out}/events/{kind}"
        known = None
        if exists(self.spark, path):
            near = F.col("day").between(first - REPEAT_DAYS, last + REPEAT_DAYS) & F.col("_bucket").isin(buckets)
            known = self.archive(kind).where(near & (F.col("batch") != batch))
        self._write(distinct_events(events, known), path, "day", "_bucket", "batch")
        own = self.archive(kind).where(F.col("_bucket").isin(buckets))
        new = own.where((F.col("batch") == batch) & F.col("day").between(first, last)).groupBy(KEY).agg(F.min("ts").alias("_from"))
        history = own if self.horizon is None else own.where(F.col("day") >= first - self.horizon)
        history = history.join(new, KEY, "left_semi").drop("day", "_bucket", "batch")
        found = compute_all({KINDS[kind]: history}, self.names[kind], state_ttl=self.ttl)
        held = enrich(found.join(new, KEY).where(F.col("event_ts_ms") >= F.col("_from")).drop("_from"))
        rows = feature_rows(held, F.col("event_ts_ms").alias(EVENT_MS)).persist()
        upsert(rows, f"{self.out}/features", FEATURE_KEYS, ["feature_name"], KEY, BUCKETS, kind, new, F.col("feature_name").startswith(PREFIX[kind]))
        if kind == "TXN":
            since = new.withColumnRenamed(KEY, "opt_id")
            changes = device_changes(history).join(since, "opt_id").where(F.col("ets_ms") >= F.col("_from"))
            upsert(device_rows(changes, F.col("ets_ms").alias(EVENT_MS)), f"{self.out}/devices", DEVICE_KEYS, [], "opt_id", BUCKETS, kind, since)
        if self.also:
            self.also(rows.drop(EVENT_MS))
        rows.unpersist()

    def run(self, checkpoint: str) -> list[StreamingQuery]:
        """Starts a query for each kind. Without an interval, each takes what is there now and ends before the next begins."""
        begun = []
        for kind, records in self.records.items():
            place = f"{checkpoint.rstrip('/')}/{kind}"
            begun.append(start(records, self.step(kind, hashlib.sha256(place.encode()).hexdigest()[:12]), place, self.interval))
            if self.interval is None:
                begun[-1].awaitTermination()
        return begun
