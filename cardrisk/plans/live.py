"""Queries of the event codec, the streaming scorers and the live views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.operators import scoring
from cardrisk.operators.features import join_profiles_batch, join_profiles_stream, user_relative_features
from cardrisk.plans import tables, views
from cardrisk.plans.registry import query, rounded
from cardrisk.schemas import event_schema, silver_columns, stream_csv_schema
from cardrisk.session import scratch
from cardrisk.sources import files, streams
from cardrisk.streaming import liveops, scorer

# A message in every 97 is broken text, as a topic may carry.
BROKEN = "event_id % 97 = 5"
FILES_PER_BATCH = 1000


@query(
    "coerced_events",
    ("raw_txn",),
    """
    SELECT coalesce(try_cast(trunc(try_cast(t.user AS DOUBLE)) AS INTEGER), 0) AS user,
      coalesce(try_cast(trunc(try_cast(mcc AS DOUBLE)) AS INTEGER), 0) AS mcc,
      coalesce(try_cast(trunc(try_cast(zip AS DOUBLE)) AS INTEGER), 0) AS zip,
      coalesce(try_cast(t.month AS DOUBLE), 0e0) AS month, coalesce(try_cast(amount AS DOUBLE), 0e0) AS amount,
      coalesce(nullif(trim(merchant_city), ''), 'UNKNOWN') AS merchant_city,
      coalesce(nullif(trim(errors), ''), 'UNKNOWN') AS errors, 'UNKNOWN' AS device_os
    FROM raw_txn t
    """,
)
def coerced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.raw_txn(spark, sf_dir).select("user", "mcc", "zip", "month", "amount", "merchant_city", "errors")
    return scorer.coerce_event(
        raw, ["user", "mcc", "zip"], ["month", "amount"], ["merchant_city", "errors", "device_os"]
    )


@query(
    "event_json",
    ("event_rows",),
    """
    SELECT CAST(e.user AS VARCHAR) AS key,
      '{"event_id":' || event_id || ',"user":' || e.user || ',"merchant_state":"' || merchant_state
      || '","mcc":' || mcc || ',"hour":' || e.hour || ',"vpn_flag":' || vpn_flag
      || ',"emitted_at":"' || emitted_at || '"}' AS value
    FROM event_rows e
    """,
)
def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.event_rows(spark, sf_dir).select(
        "event_id", "user", "merchant_state", "mcc", "hour", "vpn_flag", "emitted_at"
    )
    return scorer.to_event_json(rows)


def messages(events: DataFrame) -> DataFrame:
    """Events in the shape a Kafka source delivers; works on a batch or a stream."""
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return events.select(
        F.col("user").cast("string").cast("binary").alias("key"),
        F.when(F.expr(BROKEN), F.lit("{broken")).otherwise(body).cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).cast("bigint").alias("offset"),
        F.to_timestamp("emitted_at", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )


_DECODED = [
    "event_id", "user", "amount", "amount_abs", "merchant_state", "mcc", "hour", "vpn_flag", "is_online",
    "is_night", "is_fraud", "emitted_at",
]


@query(
    "decoded_events",
    ("event_rows",),
    f"""
    SELECT {', '.join('e.' + c for c in _DECODED)}, CAST(event_id % 4 AS INTEGER) AS kafka_partition,
      CAST(event_id // 4 AS BIGINT) AS kafka_offset
    FROM event_rows e WHERE NOT ({BROKEN})
    """,
)
def decoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = streams.decode_events(messages(views.event_rows(spark, sf_dir)))
    return decoded.select(*_DECODED, "kafka_partition", "kafka_offset")


# ---- streams, run over what is there and stopped ---------------------------------------------


def drain(verdicts: DataFrame, spark: SparkSession, label: str, k: int) -> str:
    """Runs a scorer until its input is used up; returns where its results are."""
    out = scratch(spark, label)
    query_ = scorer.start_scoring(verdicts, out, scratch(spark, f"{label}-log"), trigger=None, k=k)
    scorer.run_bounded(query_)
    return out


def kafka_shape_out(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        stream = messages(views.event_stream(spark, sf_dir, FILES_PER_BATCH))
        users, mccs = tables.profiles(spark, sf_dir)
        scored = scorer.event_verdicts(stream, users, mccs, scoring.rule_score())
        return drain(scored, spark, "kafka-shape", scorer.EVENT_TOP_K)

    return tables.once(spark, sf_dir, "kafka-shape", build)


@query(
    "stream_kafka_shape_verdicts",
    ("verdicts",),
    f"""
    SELECT event_id, v.user, amount, merchant_state, mcc, v.hour, vpn_flag, fraud_probability, predicted_fraud,
      actual_fraud, CAST(event_id % 4 AS INTEGER) AS kafka_partition, CAST(event_id // 4 AS BIGINT) AS kafka_offset,
      emitted_at
    FROM verdicts v WHERE NOT ({BROKEN})
    """,
)
def stream_kafka_shape_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kafka_shape_out(spark, sf_dir)
    return spark.read.parquet(f"{out}/verdicts").drop("scored_at", "batch_id")


@query(
    "stream_batch_totals",
    ("verdicts",),
    f"""
    SELECT count(*) AS rows, CAST(sum(predicted_fraud) AS BIGINT) AS flagged
    FROM verdicts WHERE NOT ({BROKEN})
    """,
)
def stream_batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over the batch log; how many batches there are depends on the files."""
    out = kafka_shape_out(spark, sf_dir)
    return scorer.running_counters(spark.read.parquet(f"{out}/metrics")).drop("batches")


def file_stream_out(spark: SparkSession, sf_dir: str) -> str:
    """The cleaned table as CSV files, scored as a file stream."""

    def build() -> str:
        folder = scratch(spark, "stream-csv")
        schema = stream_csv_schema()
        tables.silver(spark, sf_dir).select(*schema.fieldNames()).write.option("header", True).csv(folder)
        stream = streams.stream_csv(spark, folder, FILES_PER_BATCH)
        users, mccs = tables.profiles(spark, sf_dir)
        scored = scorer.file_verdicts(stream, users, mccs, scoring.rule_score())
        return drain(scored, spark, "file-stream", scorer.FILE_TOP_K)

    return tables.once(spark, sf_dir, "file-stream", build)


@query(
    "stream_file_verdicts",
    ("scored",),
    """
    SELECT s.user, amount, merchant_state, mcc, s.hour, round(p, 6) AS fraud_probability,
      CASE WHEN p >= 0.5e0 THEN 1 ELSE 0 END AS predicted_fraud, is_fraud AS actual_fraud
    FROM scored s
    """,
)
def stream_file_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = file_stream_out(spark, sf_dir)
    return spark.read.parquet(f"{out}/verdicts").drop("scored_at", "batch_id")


def _drain_rows(stream: DataFrame, spark: SparkSession, label: str) -> DataFrame:
    """Plain append of a stream's rows to Parquet, read back."""
    out = scratch(spark, label)
    writer = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch(spark, f"{label}-log"))
        .trigger(availableNow=True)
    )
    scorer.run_bounded(writer.start())
    return spark.read.schema(stream.schema).parquet(out)


@query(
    "stream_csv_source",
    ("silver",),
    f"SELECT {', '.join('s.' + c for c in silver_columns() if c not in ('processed_at', 'txn_timestamp'))} FROM silver s",
)
def stream_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "csv-source")
    names = stream_csv_schema().fieldNames()
    tables.silver(spark, sf_dir).select(*names).write.option("header", True).csv(folder)
    rows = _drain_rows(streams.stream_csv(spark, folder, FILES_PER_BATCH), spark, "csv-rows")
    return rows.drop("processed_at", "txn_timestamp").withColumn("amount_log", F.round("amount_log", 6))


@query(
    "stream_static_join",
    ("event_rows", "users", "mccs"),
    """
    SELECT event_id, e.user, e.mcc, round(coalesce(user_amount_mean, 0) + 1e-9, 6) AS user_amount_mean,
      coalesce(user_txn_count, 0) AS user_txn_count, coalesce(mcc_frequency, 0) AS mcc_frequency,
      round(coalesce(e.amount_abs / (user_amount_mean + 1), 0) + 1e-9, 6) AS amount_vs_user_mean
    FROM event_rows e LEFT JOIN users u ON e.user = u.user LEFT JOIN mccs m ON e.mcc = m.mcc
    """,
)
def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, mccs = tables.profiles(spark, sf_dir)
    stream = views.event_stream(spark, sf_dir, FILES_PER_BATCH)
    joined = user_relative_features(join_profiles_stream(stream, users, mccs))
    rows = _drain_rows(joined, spark, "static-join")
    return rows.select(
        "event_id", "user", "mcc", rounded("user_amount_mean"), "user_txn_count", "mcc_frequency",
        rounded("amount_vs_user_mean"),
    )


@query(
    "stream_pruned_profiles",
    ("event_rows", "users", "mccs"),
    """
    SELECT event_id, e.user, e.mcc, round(coalesce(user_amount_mean, 0) + 1e-9, 6) AS user_amount_mean,
      coalesce(user_txn_count, 0) AS user_txn_count, coalesce(mcc_frequency, 0) AS mcc_frequency,
      round(coalesce(e.amount_abs / (user_amount_mean + 1), 0) + 1e-9, 6) AS amount_vs_user_mean
    FROM event_rows e LEFT JOIN users u ON e.user = u.user LEFT JOIN mccs m ON e.mcc = m.mcc
    """,
)
def stream_pruned_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles taken to be too large for a broadcast: each batch joins the rows of its own keys."""
    users, mccs = tables.profiles(spark, sf_dir)
    out = scratch(spark, "pruned-join")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            joined = user_relative_features(join_profiles_batch(batch, users, mccs, max_rows=0))
            joined.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    stream = views.event_stream(spark, sf_dir, FILES_PER_BATCH)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", scratch(spark, "pruned-log"))
    scorer.run_bounded(writer.trigger(availableNow=True).start())
    return spark.read.parquet(out).select(
        "event_id", "user", "mcc", rounded("user_amount_mean"), "user_txn_count", "mcc_frequency",
        rounded("amount_vs_user_mean"),
    )


# ---- paced and bounded runs ------------------------------------------------------------------

PACED_FILES = 6
PACED_SECONDS = 6


def paced_runs(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A folder scored one file at a time by two runs: one that the clock ends, one that goes on from there.

    Three files are there for the first run, three more come before the second. A batch that the
    clock cuts off is taken up again under its own id.
    """

    def build() -> tuple[str, DataFrame]:
        folder, out, log = (scratch(spark, f"paced-{part}") for part in ("in", "out", "log"))
        events = views.event_rows(spark, sf_dir)

        def put(number: int) -> None:
            events.filter(F.col("event_id") % PACED_FILES == number).coalesce(1).write.mode("append").parquet(folder)

        def run(trigger: str | None, seconds: float | None) -> scorer.RunTotals:
            stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
            prepare = scorer.event_scorer(*tables.profiles(spark, sf_dir), scoring.rule_score())
            rows = stream.withColumns({"kafka_partition": F.lit(0), "kafka_offset": F.col("event_id").cast("bigint")})
            return scorer.run_bounded(scorer.start_scoring(rows, out, log, trigger, prepare=prepare), seconds)

        for number in range(PACED_FILES // 2):
            put(number)
        first = run("500 milliseconds", PACED_SECONDS)
        for number in range(PACED_FILES // 2, PACED_FILES):
            put(number)
        second = run(None, None)
        by_batch = {**first.rows_by_batch, **second.rows_by_batch}
        reported = spark.createDataFrame(sorted(by_batch.items()), "batch_id long, rows long")
        return out, reported

    return tables.once(spark, sf_dir, "paced-runs", build)


@query(
    "stream_paced_batches",
    ("verdicts",),
    f"""
    SELECT CAST(event_id % {PACED_FILES} AS BIGINT) AS batch_id, count(*) AS rows, CAST(sum(predicted_fraud) AS BIGINT) AS flagged
    FROM verdicts GROUP BY 1
    """,
)
def stream_paced_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every micro-batch's own log row: one file each, in the order in which the files came."""
    out, _ = paced_runs(spark, sf_dir)
    return spark.read.parquet(f"{out}/metrics").select(F.col("batch_id").cast("bigint"), "rows", "flagged")


@query(
    "stream_progress_rows",
    ("event_rows",),
    f"SELECT CAST(event_id % {PACED_FILES} AS BIGINT) AS batch_id, count(*) AS rows FROM event_rows GROUP BY 1",
)
def stream_progress_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every micro-batch as the progress reports of both runs said."""
    return paced_runs(spark, sf_dir)[1]


@query(
    "published_records",
    ("verdicts",),
    """
    SELECT CAST(v.user AS VARCHAR) AS key, event_id, amount, merchant_state, fraud_probability, predicted_fraud, emitted_at
    FROM verdicts v
    """,
)
def published_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the outgoing topic, their bodies read as a consumer would."""
    records = scorer.to_kafka_records(verdict_table(spark, sf_dir).drop("scored_at"))
    body = F.from_json(
        "value", "event_id int, user int, amount double, merchant_state string, fraud_probability double, predicted_fraud int, emitted_at string"
    )
    return records.select("key", body.alias("v")).select(
        "key", "v.event_id", "v.amount", "v.merchant_state", "v.fraud_probability", "v.predicted_fraud", "v.emitted_at"
    )


BATCH_TOP = 25


@query(
    "batch_top_files",
    ("verdicts",),
    f"""
    SELECT batch_id, event_id, fraud_probability FROM verdicts
    QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY fraud_probability DESC, event_id) <= {BATCH_TOP}
    """,
)
def batch_top_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The riskiest rows of each batch, written as JSON lines by the batch's own action, read back."""
    folder = scratch(spark, "batch-top")
    table = verdict_table(spark, sf_dir).select("event_id", "fraud_probability", "predicted_fraud", "batch_id").persist()
    write = scorer.batch_writer(folder, BATCH_TOP)
    for batch in range(8):
        write(table.filter(F.col("batch_id") == batch).drop("batch_id"), batch)
    table.unpersist()
    return spark.read.schema("batch_id long, event_id int, fraud_probability double").json(f"{folder}/top/*")


# ---- live views ------------------------------------------------------------------------------


def verdict_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored events with a batch number and a score time that do not depend on the clock."""
    rows = scoring.score(views.event_rows(spark, sf_dir), scoring.rule_score())
    published = scoring.to_verdicts(
        rows.withColumns(
            {
                "kafka_partition": (F.col("event_id") % 4).cast("int"),
                "kafka_offset": F.floor(F.col("event_id") / 4).cast("bigint"),
            }
        ),
        event_form=True,
    )
    return published.withColumns(
        {
            "scored_at": F.to_timestamp("emitted_at", "yyyy-MM-dd'T'HH:mm:ss"),
            "batch_id": (F.col("event_id") % 8).cast("bigint"),
        }
    )


@query(
    "stream_kpis",
    ("verdicts",),
    """
    SELECT count(*) AS scored, CAST(sum(predicted_fraud) AS BIGINT) AS flagged,
      CAST(sum(actual_fraud) AS BIGINT) AS labelled_fraud, count(DISTINCT batch_id) AS batches,
      max(fraud_probability) AS peak_risk, round(100e0 * sum(predicted_fraud) / count(*), 4) AS flag_rate_pct
    FROM verdicts
    """,
)
def stream_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liveops.stream_kpis(verdict_table(spark, sf_dir))


@query(
    "risk_histogram",
    ("verdicts",),
    """
    SELECT b.band_order, b.band, count(v.event_id) AS n
    FROM (VALUES (0, 'minimal', -0.001e0, 0.15e0), (1, 'low', 0.15e0, 0.4e0), (2, 'elevated', 0.4e0, 0.7e0),
                 (3, 'high', 0.7e0, 0.9e0), (4, 'critical', 0.9e0, 1.001e0)) b(band_order, band, low, high)
    LEFT JOIN verdicts v ON v.fraud_probability > low AND v.fraud_probability <= high
    GROUP BY ALL
    """,
)
def risk_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liveops.risk_histogram(verdict_table(spark, sf_dir))


@query("throughput_by_batch", ("verdicts",), "SELECT batch_id, count(*) AS events FROM verdicts GROUP BY batch_id")
def throughput_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liveops.throughput_by_batch(verdict_table(spark, sf_dir))


@query(
    "flag_rate_by_state",
    ("verdicts",),
    """
    SELECT merchant_state, count(*) AS events, CAST(sum(predicted_fraud) AS BIGINT) AS flagged,
      round(100e0 * sum(predicted_fraud) / count(*), 2) AS flag_rate_pct
    FROM verdicts GROUP BY merchant_state ORDER BY events DESC, merchant_state LIMIT 12
    """,
)
def flag_rate_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liveops.flag_rate_by_state(verdict_table(spark, sf_dir))


_LISTED = ["event_id", "user", "amount", "merchant_state", "mcc", "hour", "vpn_flag", "fraud_probability",
           "predicted_fraud", "actual_fraud", "emitted_at", "batch_id"]
_LISTED_SQL = ", ".join("v." + c for c in _LISTED)


@query(
    "recent_verdicts",
    ("verdicts",),
    f"SELECT {_LISTED_SQL} FROM verdicts v ORDER BY emitted_at DESC, batch_id DESC, event_id DESC LIMIT 25",
)
def recent_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liveops.recent_verdicts(verdict_table(spark, sf_dir)).select(*_LISTED)


@query(
    "top_risk",
    ("verdicts",),
    f"SELECT {_LISTED_SQL} FROM verdicts v ORDER BY fraud_probability DESC, event_id LIMIT 25",
)
def top_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liveops.top_risk(verdict_table(spark, sf_dir)).select(*_LISTED)


@query("verdict_files", ("verdicts",), f"SELECT {_LISTED_SQL} FROM verdicts v")
def verdict_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict JSON lines with broken lines among them, read back whole."""
    folder = scratch(spark, "verdict-json")
    table = verdict_table(spark, sf_dir)
    table.write.json(f"{folder}/good")
    broken: Column = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "user"'))
    table.filter(BROKEN).select(broken.alias("value")).write.text(f"{folder}/broken")
    return files.read_verdicts(spark, folder).select(*_LISTED)
