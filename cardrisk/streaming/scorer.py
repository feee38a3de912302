"""Streaming scorers: a stream of transactions in, verdicts out, one micro-batch at a time."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardrisk.functions import cleaning as C
from cardrisk.operators.features import join_profiles_batch, join_profiles_stream, user_relative_features
from cardrisk.operators.scoring import score, to_verdicts
from cardrisk.operators.sizing import MAX_BROADCAST_ROWS
from cardrisk.sources.streams import decode_events

# ---- fixed values: pace, result sizes and message fields -----------------------------------
FILE_TRIGGER, EVENT_TRIGGER = "5 seconds", "4 seconds"
FILE_TOP_K, EVENT_TOP_K = 25, 40
FILE_RUN_SECONDS, EVENT_RUN_SECONDS = 600, 1200
EVENT_INTS = [
    "user", "card", "day", "month", "year", "hour", "minute", "day_of_week", "is_weekend",
    "day_of_year", "mcc", "error_flag", "vpn_flag", "geo_missing", "hw_missing",
    "imputed_city", "imputed_state", "imputed_zip", "is_online", "is_foreign_or_unknown",
    "is_night", "is_outlier", "is_refund", "is_fraud",
]
EVENT_DOUBLES = [
    "amount", "amount_abs", "amount_log", "amount_capped", "device_lat", "device_lon",
    "merchant_lat", "merchant_lon", "device_merchant_distance_km",
]
EVENT_TEXTS = [
    "use_chip", "merchant_name", "merchant_city", "merchant_state", "zip", "error_type",
    "device_ip", "device_os",
]
# --------------------------------------------------------------------------------------------


def coerce_event(
    df: DataFrame,
    ints: list[str] = EVENT_INTS,
    doubles: list[str] = EVENT_DOUBLES,
    texts: list[str] = EVENT_TEXTS,
) -> DataFrame:
    """Untyped text columns to message types; absent columns get the type's default."""

    def source(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    typed = [C.coerce_int(source(c)).alias(c) for c in ints]
    typed += [C.coerce_double(source(c)).alias(c) for c in doubles]
    typed += [C.coerce_text(source(c)).alias(c) for c in texts]
    named = {*ints, *doubles, *texts}
    return df.select(*[c for c in df.columns if c not in named], *typed)


def to_event_json(df: DataFrame, key: str = "user") -> DataFrame:
    """Message key and JSON body of every row."""
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), body.alias("value"))


def to_kafka_records(verdicts: DataFrame) -> DataFrame:
    """Verdicts as records of the outgoing topic, every field present even when null."""
    return to_event_json(verdicts, "user")


def file_verdicts(stream: DataFrame, users: DataFrame, mccs: DataFrame, scorer) -> DataFrame:
    enriched = user_relative_features(join_profiles_stream(stream, users, mccs))
    return to_verdicts(score(enriched, scorer))


def event_verdicts(messages: DataFrame, users: DataFrame, mccs: DataFrame, scorer, schema=None) -> DataFrame:
    events = decode_events(messages, schema)
    enriched = user_relative_features(join_profiles_stream(events, users, mccs))
    return to_verdicts(score(enriched, scorer), event_form=True)


def file_scorer(users: DataFrame, mccs: DataFrame, scorer, max_rows: int = MAX_BROADCAST_ROWS) -> Callable[[DataFrame], DataFrame]:
    """The scoring of one micro-batch of files, for ``start_scoring``; profiles of any size."""

    def prepare(batch: DataFrame) -> DataFrame:
        return to_verdicts(score(user_relative_features(join_profiles_batch(batch, users, mccs, max_rows)), scorer))

    return prepare


def event_scorer(users: DataFrame, mccs: DataFrame, scorer, max_rows: int = MAX_BROADCAST_ROWS) -> Callable[[DataFrame], DataFrame]:
    """The scoring of one micro-batch of decoded events, for ``start_scoring``; profiles of any size."""

    def prepare(batch: DataFrame) -> DataFrame:
        enriched = user_relative_features(join_profiles_batch(batch, users, mccs, max_rows))
        return to_verdicts(score(enriched, scorer), event_form=True)

    return prepare


def batch_top_k(verdicts: DataFrame, k: int, batch_id: int) -> DataFrame:
    """The batch's riskiest rows; all columns break ties, so a replay picks the same."""
    ordered = verdicts.orderBy(F.desc("fraud_probability"), *verdicts.columns)
    return ordered.limit(k).withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def batch_metrics(verdicts: DataFrame, batch_id: int) -> DataFrame:
    return verdicts.agg(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("predicted_fraud"), F.lit(0)).alias("flagged"),
    )


def running_counters(metrics: DataFrame) -> DataFrame:
    """Totals over all batches written so far; they survive a restart with the files."""
    return metrics.agg(
        F.count(F.lit(1)).alias("batches"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged"),
    )


def written_counters(spark: SparkSession, out: str) -> DataFrame:
    """The running counters of an output folder; zeros where no batch has run yet."""
    schema = "batch_id long, rows long, flagged long"
    try:
        metrics = spark.read.schema(schema).parquet(f"{out}/metrics")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        metrics = spark.createDataFrame([], schema)
    return running_counters(metrics)


def batch_writer(
    out: str,
    k: int,
    publish: Callable[[DataFrame], None] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
):
    """The per-batch action.

    Each batch owns the folder of its id and overwrites it, so a batch replayed after a
    failure leaves one copy. Results: ``verdicts`` and ``metrics`` (Parquet), ``top`` (JSON).
    ``prepare`` turns a batch into verdicts where the stream doesn't carry these already.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if prepare is None:
            return finish(batch, batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                finish(prepare(batch), batch_id)
        finally:
            batch.unpersist()

    def finish(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            batch.write.mode("overwrite").parquet(f"{out}/verdicts/batch_id={batch_id}")
            if publish:
                publish(to_kafka_records(batch))
            top = batch_top_k(batch, k, batch_id).coalesce(1)
            top.write.mode("overwrite").option("ignoreNullFields", False).json(f"{out}/top/batch-{batch_id}")
            metrics = batch_metrics(batch, batch_id).drop("batch_id")
            metrics.write.mode("overwrite").parquet(f"{out}/metrics/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def publish_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def kafka_publisher(servers: str, topic: str) -> Callable[[DataFrame], None]:
    def publish(records: DataFrame) -> None:
        records.write.format("kafka").options(**publish_options(servers, topic)).save()

    return publish


def start_scoring(
    verdicts: DataFrame,
    out: str,
    checkpoint: str,
    trigger: str | None = FILE_TRIGGER,
    k: int = FILE_TOP_K,
    publish: Callable[[DataFrame], None] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Starts the scorer. ``trigger=None`` takes what is there now and stops.

    The stream is one of verdicts, or one of rows that ``prepare`` scores batch by batch.
    """
    pace = {"processingTime": trigger} if trigger else {"availableNow": True}
    return (
        verdicts.writeStream.foreachBatch(batch_writer(out, k, publish, prepare))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**pace)
        .start()
    )


@dataclass
class RunTotals:
    """What one run of a stream took in, by batch id, as its progress reports said."""

    rows_by_batch: dict[int, int] = field(default_factory=dict)

    def read(self, query: StreamingQuery) -> None:
        """Takes up the reports since the last time; the session keeps the last hundred."""
        for report in query.recentProgress:
            if report["numInputRows"]:
                self.rows_by_batch[report["batchId"]] = report["numInputRows"]

    @property
    def batches(self) -> int:
        return len(self.rows_by_batch)

    @property
    def rows(self) -> int:
        return sum(self.rows_by_batch.values())


def run_bounded(query: StreamingQuery, run_seconds: float | None = None, poll_seconds: float = 1.0) -> RunTotals:
    """Waits for the end or the time limit, then stops; a failed query raises here.

    Returns what the run took in. Reports are read every ``poll_seconds``, so that a run of
    many batches loses none.
    """
    totals = RunTotals()
    ends = None if run_seconds is None else time.monotonic() + run_seconds
    try:
        while True:
            left = poll_seconds if ends is None else min(poll_seconds, ends - time.monotonic())
            if left <= 0 or query.awaitTermination(left):
                break
            totals.read(query)
    finally:
        query.stop()
    totals.read(query)
    return totals
