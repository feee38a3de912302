"""Queries of the rollup, quality, layout, profile and sampling operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.functions.sampling_hash import content_key
from cardrisk.functions.risk import amount_bucket, amount_bucket_order
from cardrisk.operators import features, layout, models, quality, rollups, sampling
from cardrisk.operators.sizing import exact_quantile
from cardrisk.plans import cleaning, jobs, live, tables, views
from cardrisk.plans.registry import query, rounded
from cardrisk.session import materialise, scratch
from cardrisk.sources import files, sinks

MEASURES = """count(*) AS total_txns, CAST(sum(is_fraud) AS BIGINT) AS fraud_txns,
      round(100e0 * sum(is_fraud) / count(*), 4) AS fraud_rate_pct"""
BY_STATE = f"SELECT merchant_state, {MEASURES} FROM cleaned GROUP BY merchant_state"
# The test tables are small; the dashboard's cut of 5000 rows per code would leave none.
MCC_MIN = 100
RATE_MIN = 1000
YEAR = 1998


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.rate_by_state_raw(views.raw_txn(spark, sf_dir))


@query("fraud_by_state_raw", ("cleaned",), BY_STATE)
def fraud_by_state_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir)


@query(
    "fraud_by_state",
    ("silver",),
    f"""
    SELECT merchant_state AS state, {MEASURES} FROM silver GROUP BY merchant_state
    HAVING count(*) >= 1000 ORDER BY total_txns DESC, state LIMIT 60
    """,
)
def fraud_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_state(tables.silver(spark, sf_dir))


@query(
    "fraud_by_mcc",
    ("silver",),
    f"""
    SELECT mcc, {MEASURES} FROM silver GROUP BY mcc
    HAVING count(*) >= {MCC_MIN} ORDER BY total_txns DESC, mcc LIMIT 40
    """,
)
def fraud_by_mcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_mcc(tables.silver(spark, sf_dir), min_rows=MCC_MIN)


@query("fraud_by_hour", ("silver",), f"SELECT s.hour, {MEASURES} FROM silver s GROUP BY s.hour")
def fraud_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_hour(tables.silver(spark, sf_dir))


@query(
    "fraud_by_os",
    ("silver",),
    f"SELECT device_os AS os, {MEASURES} FROM silver GROUP BY device_os HAVING count(*) >= 1000",
)
def fraud_by_os(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_os(tables.silver(spark, sf_dir))


@query(
    "fraud_by_flags",
    ("silver",),
    f"""
    SELECT CASE WHEN grouping(vpn_flag) = 0 THEN 'vpn' WHEN grouping(is_online) = 0 THEN 'online'
                WHEN grouping(is_night) = 0 THEN 'night' WHEN grouping(error_flag) = 0 THEN 'had_error'
                ELSE 'foreign' END AS flag,
      coalesce(vpn_flag, is_online, is_night, error_flag, is_foreign_or_unknown) AS value, {MEASURES}
    FROM silver
    GROUP BY GROUPING SETS ((vpn_flag), (is_online), (is_night), (error_flag), (is_foreign_or_unknown))
    """,
)
def fraud_by_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_flags(tables.silver(spark, sf_dir))


_BUCKETS = """CASE WHEN amount_abs < 10 THEN '0-10' WHEN amount_abs < 25 THEN '10-25'
      WHEN amount_abs < 50 THEN '25-50' WHEN amount_abs < 100 THEN '50-100'
      WHEN amount_abs < 250 THEN '100-250' WHEN amount_abs < 500 THEN '250-500'
      WHEN amount_abs < 1000 THEN '500-1000' ELSE '1000+' END"""
_BUCKET_ORDER = """CASE WHEN amount_abs < 10 THEN 0 WHEN amount_abs < 25 THEN 1 WHEN amount_abs < 50 THEN 2
      WHEN amount_abs < 100 THEN 3 WHEN amount_abs < 250 THEN 4 WHEN amount_abs < 500 THEN 5
      WHEN amount_abs < 1000 THEN 6 ELSE 7 END"""


@query(
    "amount_distribution",
    ("silver",),
    f"SELECT {_BUCKETS} AS bucket, {_BUCKET_ORDER} AS bucket_order, {MEASURES} FROM silver GROUP BY ALL",
)
def amount_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.amount_distribution(tables.silver(spark, sf_dir))


@query(
    "amount_buckets",
    ("silver",),
    f"SELECT amount_abs, {_BUCKETS} AS bucket, {_BUCKET_ORDER} AS bucket_order FROM silver",
)
def amount_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("amount_abs")
    return tables.silver(spark, sf_dir).select(
        amount, amount_bucket(amount).alias("bucket"), amount_bucket_order(amount).alias("bucket_order")
    )


SUMMARY = """
SELECT count(*) AS total_transactions, CAST(sum(is_fraud) AS BIGINT) AS fraud_transactions,
  round(avg(amount_abs), 2) AS mean_amount, round(quantile_disc(amount_abs, 0.5), 2) AS median_amount,
  round(max(amount_abs), 2) AS max_amount, count(DISTINCT merchant_state) AS distinct_states,
  count(DISTINCT mcc) AS distinct_mcc, min(s.year) AS first_year, max(s.year) AS last_year,
  round(100e0 * sum(is_fraud) / count(*), 4) AS fraud_rate_pct
FROM silver s
"""


@query("dataset_summary", ("silver",), SUMMARY)
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the exact median, so that SQL can check it; the dashboard job sketches it."""
    table = tables.silver(spark, sf_dir)
    median = exact_quantile(table, "amount_abs", 0.5).withColumnRenamed("amount_abs", "median_amount")
    return rollups.dataset_summary(table, median)


@query("top_states", ("cleaned",), f"{BY_STATE} ORDER BY total_txns DESC, merchant_state LIMIT 15")
def top_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.top_by_volume(_states(spark, sf_dir))


@query(
    "highest_rate_states",
    ("cleaned",),
    f"""
    SELECT * FROM ({BY_STATE}) g WHERE total_txns > {RATE_MIN}
    ORDER BY fraud_rate_pct DESC, total_txns DESC, merchant_state LIMIT 10
    """,
)
def highest_rate_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.highest_rates(_states(spark, sf_dir), min_rows=RATE_MIN)


@query(
    "known_states_top12",
    ("silver",),
    f"""
    SELECT * FROM (
      SELECT merchant_state AS state, {MEASURES} FROM silver GROUP BY merchant_state
      HAVING count(*) >= 1000 ORDER BY total_txns DESC, state LIMIT 60
    ) g WHERE state <> 'UNKNOWN' ORDER BY total_txns DESC, state LIMIT 12
    """,
)
def known_states_top12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.known_states(rollups.by_state(tables.silver(spark, sf_dir)))


@query(
    "rate_severity",
    ("cleaned",),
    f"""
    SELECT *, CASE WHEN fraud_rate_pct > 0.3 THEN 'critical' WHEN fraud_rate_pct > 0.1 THEN 'elevated'
                   ELSE 'normal' END AS severity FROM ({BY_STATE}) g
    """,
)
def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.with_severity(_states(spark, sf_dir))


OVERALL = f"""
SELECT count(*) AS distinct_keys, CAST(sum(total_txns) AS BIGINT) AS total_txns,
  CAST(sum(fraud_txns) AS BIGINT) AS fraud_txns,
  round(100e0 * sum(fraud_txns) / sum(total_txns), 4) AS fraud_rate_pct
FROM ({BY_STATE}) g
"""


@query("agg_reconciliation", ("cleaned",), OVERALL)
def agg_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.overall(_states(spark, sf_dir))


@query(
    "agg_summary",
    ("cleaned",),
    f"""
    SELECT g.*, 'spark' AS engine, 'fraud_rate_by_state' AS job, o.distinct_keys AS distinct_states,
      o.total_txns AS total_transactions, o.fraud_txns AS fraud_transactions,
      o.fraud_rate_pct AS overall_fraud_rate_pct
    FROM ({BY_STATE}) g, ({OVERALL}) o
    """,
)
def agg_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.agg_summary(_states(spark, sf_dir))


@query(
    "preview",
    ("silver",),
    """
    SELECT user, txn_timestamp, day_of_week, amount, amount_capped, is_outlier, merchant_state, mcc,
      device_merchant_distance_km, is_fraud
    FROM silver ORDER BY ALL LIMIT 10
    """,
)
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = cleaning.comparable_silver(tables.silver(spark, sf_dir)).select(
        "user", "txn_timestamp", "day_of_week", "amount", "amount_capped", "is_outlier",
        "merchant_state", "mcc", "device_merchant_distance_km", "is_fraud",
    )
    return shown.orderBy(*shown.columns).limit(10)


@query("silver_scan", ("silver",), "SELECT count(*) AS rows, count(DISTINCT s.year * 100 + s.month) AS months FROM silver s")
def silver_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.col("year") * 100 + F.col("month")
    return tables.silver(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(month).alias("months")
    )


@query(
    "dashboard_columns",
    ("silver",),
    f"SELECT {', '.join('s.' + c for c in rollups.DASHBOARD_COLUMNS)} FROM silver s",
)
def dashboard_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.dashboard_columns(tables.silver(spark, sf_dir))


@query(
    "filter_counts",
    ("silver",),
    f"""
    SELECT count(*) FILTER (WHERE is_fraud = 1) AS fraud_rows,
      count(*) FILTER (WHERE s.year = {YEAR}) AS year_rows,
      count(*) FILTER (WHERE s.hour = 13) AS hour_rows,
      count(*) FILTER (WHERE amount IS NOT NULL) AS amount_rows,
      count(*) FILTER (WHERE length(zip) <> 5) AS bad_zip_rows
    FROM silver s
    """,
)
def filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.silver(spark, sf_dir).agg(
        F.count_if(F.col("is_fraud") == 1).alias("fraud_rows"),
        F.count_if(F.col("year") == YEAR).alias("year_rows"),
        F.count_if(F.col("hour") == 13).alias("hour_rows"),
        F.count_if(F.col("amount").isNotNull()).alias("amount_rows"),
        F.count_if(F.length("zip") != 5).alias("bad_zip_rows"),
    )


# ---- quality -------------------------------------------------------------------------------


@query(
    "reconcile_counts",
    ("raw_txn", "silver"),
    """
    SELECT rows_in, rows_out, rows_in - rows_out AS rows_dropped,
      CASE WHEN rows_in = rows_out THEN 'PASS' ELSE 'MISMATCH' END AS reconciliation
    FROM (SELECT (SELECT count(*) FROM raw_txn) AS rows_in, (SELECT count(*) FROM silver) AS rows_out) t
    """,
)
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile(views.raw_txn(spark, sf_dir), tables.silver(spark, sf_dir))


_FLAG_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {name}" for name, c in quality.FLAG_SUMS.items())


@query(
    "quality_profile",
    ("silver",),
    f"""
    SELECT {_FLAG_SUMS}, round(avg(amount_abs) + 1e-9, 6) AS mean_amount, max(amount_abs) AS max_amount,
      count(DISTINCT s.user) AS users, count(DISTINCT merchant_state) AS states,
      count(DISTINCT mcc) AS mccs, min(s.year) AS first_year, max(s.year) AS last_year
    FROM silver s
    """,
)
def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = quality.quality_profile(tables.silver(spark, sf_dir))
    return profile.withColumn("mean_amount", rounded("mean_amount"))


@query(
    "cleanup_checks",
    ("silver",),
    """
    SELECT count(*) FILTER (WHERE amount IS NULL) AS null_amounts,
      count(*) FILTER (WHERE merchant_state IS NULL) AS null_states,
      count(*) FILTER (WHERE length(zip) <> 5) AS malformed_zips,
      count(*) FILTER (WHERE txn_timestamp IS NULL) AS null_timestamps
    FROM silver
    """,
)
def cleanup_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cleanup_checks(tables.silver(spark, sf_dir))


@query(
    "profile_json",
    ("silver",),
    """
    SELECT count(*) AS rows_in, count(*) AS rows_out, 'PASS' AS reconciliation,
      CAST(sum(is_fraud) AS BIGINT) AS fraud_rows,
      round(100e0 * sum(is_fraud) / count(*), 4) AS fraud_rate_pct,
      round(quantile_disc(amount, 0.99), 2) AS amount_p99_threshold,
      CAST(sum(imputed_state) AS BIGINT) AS imputed_states,
      CAST(sum(is_weekend) AS BIGINT) AS weekend_rows,
      count(DISTINCT s.user) AS distinct_users, min(s.year) AS first_year
    FROM silver s
    """,
)
def profile_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile document written as JSON text and read back."""
    table = tables.silver(spark, sf_dir)
    rows_in = views.raw_txn(spark, sf_dir).count()
    document = quality.profile_document(
        table, rows_in, tables.exact_p99(spark, sf_dir), "raw_txn", "silver"
    )
    path = scratch(spark, "profile")
    sinks.write_profile(document, path)
    back = spark.read.schema(document.schema).json(path)
    return back.select(
        "rows_in", "rows_out", "reconciliation", "fraud_rows", "fraud_rate_pct", "amount_p99_threshold",
        F.col("imputation_counts.merchant_state").alias("imputed_states"),
        F.col("derived_flags.weekend").alias("weekend_rows"),
        F.col("distributions.distinct_users").alias("distinct_users"),
        F.get("distributions.year_range", F.lit(0)).alias("first_year"),
    )


def _long(name: str, key: str) -> str:
    return f"SELECT '{name}' AS aggregate, CAST({key} AS VARCHAR) AS key, {MEASURES} FROM silver s GROUP BY ALL"


@query(
    "aggregate_files",
    ("silver",),
    f"""
    SELECT * FROM ({_long('fraud_by_state', 'merchant_state')} HAVING count(*) >= 1000) a
    UNION ALL SELECT * FROM ({_long('fraud_by_hour', 's.hour')}) b
    UNION ALL SELECT * FROM ({_long('amount_distribution', _BUCKETS)}) c
    UNION ALL SELECT * FROM ({_long('by_os', 'device_os')} HAVING count(*) >= 1000) d
    UNION ALL SELECT * FROM ({_long('by_vpn', 'vpn_flag')}) e
    UNION ALL SELECT * FROM ({_long('by_online', 'is_online')}) f
    UNION ALL SELECT * FROM ({_long('by_night', 'is_night')}) g
    UNION ALL SELECT * FROM ({_long('by_had_error', 'error_flag')}) h
    UNION ALL SELECT * FROM ({_long('by_foreign', 'is_foreign_or_unknown')}) i
    """,
)
def aggregate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dashboard file written with its manifest, then read back by name."""
    path = scratch(spark, "aggregates")
    sinks.write_aggregates(rollups.dashboard_aggregates(tables.silver(spark, sf_dir)), path, "silver")
    measures = "total_txns bigint, fraud_txns bigint, fraud_rate_pct double"
    parts = [
        files.read_aggregate(spark, path, name, f"{key} string, {measures}").select(
            F.lit(name).alias("aggregate"), F.col(key).alias("key"), "total_txns", "fraud_txns", "fraud_rate_pct"
        )
        for name, key in (
            ("fraud_by_state", "state"), ("fraud_by_hour", "hour"), ("amount_distribution", "bucket"),
        )
    ]
    device = files.read_aggregate(spark, path, "fraud_by_device", f"flag string, value string, {measures}")
    parts.append(
        device.select(
            F.concat(F.lit("by_"), "flag").alias("aggregate"), F.col("value").alias("key"),
            "total_txns", "fraud_txns", "fraud_rate_pct",
        )
    )
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


@query(
    "aggregate_manifest",
    ("silver",),
    f"""
    SELECT file, rows FROM (
      SELECT 'fraud_by_state' AS file, count(*) AS rows FROM ({_long('a', 'merchant_state')} HAVING count(*) >= 1000) a
      UNION ALL SELECT 'fraud_by_mcc', count(*) FROM ({_long('a', 'mcc')} HAVING count(*) >= 5000) b
      UNION ALL SELECT 'fraud_by_hour', count(*) FROM ({_long('a', 's.hour')}) c
      UNION ALL SELECT 'amount_distribution', count(*) FROM ({_long('a', _BUCKETS)}) d
      UNION ALL SELECT 'dataset_summary', 1
      UNION ALL SELECT 'fraud_by_device', (SELECT count(*) FROM ({_long('a', 'device_os')} HAVING count(*) >= 1000) e)
        + (SELECT count(DISTINCT vpn_flag) + count(DISTINCT is_online) + count(DISTINCT is_night)
             + count(DISTINCT error_flag) + count(DISTINCT is_foreign_or_unknown) FROM silver)
    ) u
    """,
)
def aggregate_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every dashboard file as the write counted them, read from the written manifest."""
    path = scratch(spark, "manifest")
    sinks.write_aggregates(rollups.dashboard_aggregates(tables.silver(spark, sf_dir)), path, "silver")
    return files.read_aggregate(spark, path, "index", "file string, rows bigint")


@query(
    "live_view_files",
    ("verdicts",),
    """
    SELECT 'kpis' AS view, CAST(count(*) AS VARCHAR) AS found FROM verdicts
    UNION ALL SELECT 'risk_histogram', '5'
    UNION ALL SELECT 'throughput', CAST(count(DISTINCT batch_id) AS VARCHAR) FROM verdicts
    UNION ALL SELECT 'flag_rate_by_state', CAST(least(12, count(DISTINCT merchant_state)) AS VARCHAR) FROM verdicts
    UNION ALL SELECT 'recent', CAST(least(25, count(*)) AS VARCHAR) FROM verdicts
    UNION ALL SELECT 'top_risk', CAST(least(25, count(*)) AS VARCHAR) FROM verdicts
    """,
)
def live_view_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live views' job over a scorer's output folder: how many rows each file has, or how many rows it scored."""
    folder, out = scratch(spark, "live-in"), scratch(spark, "live-out")
    live.verdict_table(spark, sf_dir).write.partitionBy("batch_id").parquet(f"{folder}/verdicts")
    jobs.live_views(spark, folder, out)
    parts = [
        files.read_aggregate(spark, out, view, "scored bigint").agg(
            (F.max("scored") if view == "kpis" else F.count(F.lit(1))).cast("string").alias("found")
        ).select(F.lit(view).alias("view"), "found")
        for view in ("kpis", "risk_histogram", "throughput", "flag_rate_by_state", "recent", "top_risk")
    ]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


@query(
    "metrics_bundle",
    ("silver",),
    """
    SELECT 'hours' AS section, '{"hour":' || s.hour || ',"total_txns":' || count(*) || ',"fraud_txns":'
      || CAST(sum(is_fraud) AS BIGINT) || '}' AS document FROM silver s GROUP BY s.hour
    UNION ALL
    SELECT 'data_quality', '{"null_amounts":' || count(*) FILTER (WHERE amount IS NULL)
      || ',"null_states":' || count(*) FILTER (WHERE merchant_state IS NULL)
      || ',"malformed_zips":' || count(*) FILTER (WHERE length(zip) <> 5)
      || ',"null_timestamps":' || count(*) FILTER (WHERE txn_timestamp IS NULL) || '}' FROM silver
    """,
)
def metrics_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = tables.silver(spark, sf_dir)
    return files.metrics_bundle(
        {
            "hours": rollups.by_hour(table).drop("fraud_rate_pct"),
            "data_quality": quality.cleanup_checks(table),
        }
    )


# ---- physical layout -----------------------------------------------------------------------


@query("partition_pruned_count", ("silver",), f"SELECT count(*) AS n FROM silver s WHERE s.year = {YEAR}")
def partition_pruned_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.year_count(tables.silver(spark, sf_dir), YEAR)


@query("full_scan_count", ("silver",), "SELECT count(*) AS n FROM silver s WHERE s.hour = 13")
def full_scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.hour_count(tables.silver(spark, sf_dir))


_MATCHED = "SELECT count(*) AS matched_rows FROM silver JOIN (SELECT DISTINCT zip FROM zip_coords) z USING (zip)"


@query("join_broadcast_count", ("silver", "zip_coords"), _MATCHED)
def join_broadcast_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.join_count(tables.silver(spark, sf_dir), layout.places_of(views.zip_coords(spark, sf_dir)), broadcast=True)


@query("join_shuffle_count", ("silver", "zip_coords"), _MATCHED)
def join_shuffle_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.row_shuffle_join(tables.silver(spark, sf_dir), layout.places_of(views.zip_coords(spark, sf_dir)))


@query("join_counted_shuffle", ("silver", "zip_coords"), _MATCHED)
def join_counted_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.join_count(tables.silver(spark, sf_dir), layout.places_of(views.zip_coords(spark, sf_dir)), broadcast=False)


@query(
    "cached_agg",
    ("silver",),
    "SELECT merchant_state, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS f FROM silver GROUP BY merchant_state",
)
def cached_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = tables.silver(spark, sf_dir).select("merchant_state", "is_fraud").persist()
    try:
        return materialise(layout.rate_pass(slim))
    finally:
        slim.unpersist()


@query(
    "layout_timings",
    ("silver", "zip_coords"),
    f"""
    SELECT comparison, label, rows FROM (
      SELECT 'caching' AS comparison, label, count(DISTINCT merchant_state) AS rows
      FROM silver, (VALUES ('uncached_first'), ('uncached_again'), ('cached_first'), ('cached_again')) t(label) GROUP BY label
      UNION ALL SELECT 'join_strategy', label, matched_rows
      FROM ({_MATCHED}) m, (VALUES ('shuffle'), ('broadcast')) t(label)
      UNION ALL SELECT 'partition_pruning', 'full_scan', count(*) FROM silver s WHERE s.hour = 13
      UNION ALL SELECT 'partition_pruning', 'pruned', count(*) FROM silver s WHERE s.year = {YEAR}
    ) u
    """,
)
def layout_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the compared runs finds; ``python -m cardrisk tune`` takes their times."""
    silver = tables.silver(spark, sf_dir)
    slim = silver.select("merchant_state", "is_fraud").persist()
    try:
        parts = []
        for comparison, runs in layout.comparisons(silver, slim, views.zip_coords(spark, sf_dir), year=YEAR).items():
            for label, make in runs.items():
                found = make()
                rows = F.count(F.lit(1)) if comparison == "caching" else F.max(found.columns[0])
                parts.append(found.agg(rows.cast("bigint").alias("rows")).select(
                    F.lit(comparison).alias("comparison"), F.lit(label).alias("label"), "rows"))
        first, *rest = parts
        for part in rest:
            first = first.unionByName(part)
        return materialise(first)
    finally:
        slim.unpersist()


# ---- profiles and splits -------------------------------------------------------------------


@query(
    "user_stats",
    ("users",),
    """
    SELECT u.user, round(user_amount_mean + 1e-9, 6) AS user_amount_mean,
      round(user_amount_std + 1e-9, 6) AS user_amount_std, user_txn_count FROM users u
    """,
)
def user_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.user_stats(tables.silver(spark, sf_dir)).withColumns(
        {c: rounded(c) for c in ("user_amount_mean", "user_amount_std")}
    )


@query("mcc_frequency", ("mccs",), "SELECT * FROM mccs")
def mcc_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.mcc_frequency(tables.silver(spark, sf_dir))


@query(
    "user_relative_features",
    ("silver", "users", "mccs"),
    """
    SELECT s.user, s.mcc, amount_abs, round(user_amount_mean + 1e-9, 6) AS user_amount_mean,
      round(user_amount_std + 1e-9, 6) AS user_amount_std, user_txn_count,
      round(amount_abs / (user_amount_mean + 1) + 1e-9, 6) AS amount_vs_user_mean,
      round((amount_abs - user_amount_mean) / (user_amount_std + 1) + 1e-9, 6) AS amount_zscore, mcc_frequency
    FROM silver s JOIN users u ON s.user = u.user JOIN mccs m ON s.mcc = m.mcc
    """,
)
def user_relative_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.silver(spark, sf_dir).select("user", "mcc", "amount_abs")
    built = features.build_features(rows, *tables.profiles(spark, sf_dir))
    derived = ["user_amount_mean", "user_amount_std", "amount_vs_user_mean", "amount_zscore"]
    return built.withColumns({c: rounded(c) for c in derived})


@query(
    "class_weights",
    ("silver",),
    """
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_fraud = 1) AS positives,
      round(count(*) FILTER (WHERE is_fraud = 0) / greatest(count(*) FILTER (WHERE is_fraud = 1), 1), 6)
        AS class_ratio
    FROM silver s WHERE s.user % 5 <> 0
    """,
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = sampling.user_split(tables.silver(spark, sf_dir))
    return sampling.class_ratio(train).withColumn("class_ratio", F.round("class_ratio", 6))


@query(
    "user_split",
    ("silver",),
    "SELECT s.user, s.user % 5 = 0 AS is_holdout, count(*) AS rows FROM silver s GROUP BY s.user",
)
def user_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, holdout = sampling.user_split(tables.silver(spark, sf_dir))
    sides = train.withColumn("is_holdout", F.lit(False)).unionByName(holdout.withColumn("is_holdout", F.lit(True)))
    return sides.groupBy("user", "is_holdout").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "split_report",
    ("silver",),
    """
    SELECT CASE WHEN s.user % 5 = 0 THEN 'holdout' ELSE 'train' END AS split, count(*) AS total_rows,
      CAST(sum(is_fraud) AS BIGINT) AS positives, round(100e0 * sum(is_fraud) / count(*), 4) AS rate_pct,
      round((count(*) - sum(is_fraud)) / greatest(sum(is_fraud), 1), 3) AS class_ratio
    FROM silver s GROUP BY ALL
    """,
)
def split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_report(tables.silver(spark, sf_dir))


# ---- samples -------------------------------------------------------------------------------

RAW_KEY = [
    "user", "card", "year", "month", "day", "time", "amount", "merchant_name", "merchant_city",
    "zip", "mcc", "is_fraud",
]
SILVER_KEY = [
    "user", "card", "year", "month", "day", "hour", "minute", "merchant_name", "zip", "mcc", "is_fraud",
]
_CENTS = "CAST(round(amount * 100) AS BIGINT)"


def _sql_key(columns: list[str], extra: str = "") -> str:
    parts = [f"coalesce(CAST(t.{c} AS VARCHAR), '\\N')" for c in columns]
    return "concat_ws('|', " + ", ".join(parts + ([f"CAST({extra} AS VARCHAR)"] if extra else [])) + ")"


def _sql_u(digest: str) -> str:
    return f"('0x' || substr({digest}, 1, 13))::UBIGINT / 4503599627370496e0"


def silver_key() -> Column:
    return F.concat(content_key(SILVER_KEY), F.lit("|"), F.expr(_CENTS).cast("string"))


STRATIFIED = f"""
picked AS (
  SELECT t.*, count(*) OVER (PARTITION BY {', '.join('t.' + c for c in sampling.SERVING_COLUMNS)}, k) AS copies,
    row_number() OVER (PARTITION BY {', '.join('t.' + c for c in sampling.SERVING_COLUMNS)}, k) AS copy,
    {_sql_u("md5(k || '#42')")} AS u
  FROM (SELECT t.*, {_sql_key(SILVER_KEY, _CENTS)} AS k FROM silver t) t
), sampled AS (
  SELECT * FROM picked WHERE is_fraud = 1 OR copy <= floor(copies * least(1e0,
    (SELECT sum(is_fraud) * 60e0 / greatest(count(*) - sum(is_fraud), 1) FROM silver)) + u)
)
"""


def _stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = tables.silver(spark, sf_dir)
    keyed = table.select(*sampling.SERVING_COLUMNS, silver_key().alias("_key"))
    return sampling.stratified_sample(keyed, key=F.col("_key"), by_copies=True).drop("_key")


@query(
    "stratified_sample",
    ("silver",),
    f"WITH {STRATIFIED} SELECT {', '.join('t.' + c for c in sampling.SERVING_COLUMNS)} FROM sampled t",
)
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stratified(spark, sf_dir).withColumn("amount_log", F.round("amount_log", 6))


@query(
    "sample_metadata",
    ("silver",),
    f"""
    WITH {STRATIFIED}
    SELECT full_rows, full_fraud, train_rows, train_fraud, test_rows, test_fraud, 60 AS negatives_per_positive,
      round(least(1e0, full_fraud * 60e0 / greatest(full_rows - full_fraud, 1)), 6) AS legit_keep_fraction,
      round((train_rows - train_fraud) / greatest(train_fraud, 1), 3) AS scale_pos_weight,
      'user % 5 == 0' AS split_rule
    FROM (SELECT count(*) AS full_rows, CAST(sum(is_fraud) AS BIGINT) AS full_fraud FROM silver) a,
      (SELECT count(*) FILTER (WHERE t.user % 5 <> 0) AS train_rows,
         count(*) FILTER (WHERE t.user % 5 <> 0 AND is_fraud = 1) AS train_fraud,
         count(*) FILTER (WHERE t.user % 5 = 0) AS test_rows,
         count(*) FILTER (WHERE t.user % 5 = 0 AND is_fraud = 1) AS test_fraud FROM sampled t) b
    """,
)
def sample_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_metadata(
        tables.silver(spark, sf_dir), _stratified(spark, sf_dir), sampling.NEGATIVES_PER_POSITIVE
    )


def _sql_first(source: str, n: str, columns: list[str], seed: int) -> str:
    """The ``n`` rows of ``source`` that come first in hash order."""
    key = _sql_key(RAW_KEY)
    return f"""
    SELECT {', '.join('t.' + c for c in columns)} FROM {source} t
    ORDER BY md5({key} || '#{seed}'), {', '.join('t.' + c for c in columns)} LIMIT {n}
    """


_RAW = cleaning.RAW_COLUMNS
CAPPED_TO = "(SELECT CAST(greatest(count(*) // 4 - count(*) FILTER (WHERE is_fraud = 'Yes'), 1000) AS BIGINT) FROM raw_txn)"


@query(
    "capped_sample",
    ("raw_txn",),
    f"""
    SELECT * FROM (
      SELECT {', '.join('t.' + c for c in _RAW)} FROM raw_txn t WHERE is_fraud = 'Yes'
      UNION ALL
      SELECT * FROM ({_sql_first("(SELECT * FROM raw_txn WHERE is_fraud = 'No')", CAPPED_TO, _RAW, 42)}) n
    ) u
    """,
)
def capped_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the rows, all positives among them."""
    raw = views.raw_txn(spark, sf_dir).withColumn("_label", (F.col("is_fraud") == "Yes").cast("int"))
    capped = sampling.cap_rows(raw, raw.count() // 4, label="_label", key=content_key(RAW_KEY))
    return capped.drop("_label")


@query(
    "pool_sample",
    ("raw_txn",),
    f"""
    SELECT * FROM ({_sql_first("(SELECT * FROM raw_txn r WHERE CAST(r.user AS BIGINT) % 5 = 0)", "2000", _RAW, 7)}) p
    """,
)
def pool_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool's size is the operator's argument; every row competes for a place."""
    return sampling.pool_sample(views.raw_txn(spark, sf_dir), 2000, holdout=True, key=content_key(RAW_KEY))


@query(
    "csv_sample",
    ("raw_txn",),
    f"""
    SELECT * REPLACE (nullif(errors, '') AS errors)
    FROM ({_sql_first("raw_txn", "20000", _RAW, 42).replace(_sql_key(RAW_KEY), _sql_key(_RAW))}) r
    """,
)
def csv_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readable sample as one CSV file, read back."""
    path = scratch(spark, "csv-sample")
    sinks.write_csv_sample(views.raw_txn(spark, sf_dir), path)
    return files.read_raw_csv(spark, path)


@query(
    "bernoulli_invariants",
    ("silver",),
    """
    SELECT count(*) AS rows, CAST(0 AS BIGINT) AS beyond_table, CAST(0 AS BIGINT) AS differ_on_rerun, true AS size_is_likely
    FROM silver
    """,
)
def bernoulli_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the rows: none that the table lacks, the same ones again, and about as many as drawn."""
    table = tables.silver(spark, sf_dir).drop("processed_at")
    columns = [F.col(c) for c in table.columns]
    sides = {"table": table, "first": sampling.sample(table, 0.1), "again": sampling.sample(table, 0.1)}
    parts = [
        side.select(F.xxhash64(*columns).alias("row"), *[F.lit(int(name == other)).alias(other) for other in sides])
        for name, side in sides.items()
    ]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    by_row = both.groupBy("row").agg(*[F.sum(name).alias(name) for name in sides])
    rows, drawn = F.sum("table"), F.sum("first")
    return by_row.agg(
        rows.alias("rows"),
        F.sum(F.greatest(F.col("first") - F.col("table"), F.lit(0))).alias("beyond_table"),
        F.sum(F.abs(F.col("first") - F.col("again"))).alias("differ_on_rerun"),
        # Six standard deviations of a binomial count.
        (F.abs(drawn - rows * 0.1) < 6 * F.sqrt(rows * 0.09)).alias("size_is_likely"),
    )


@query(
    "weighted_rows",
    ("silver",),
    """
    SELECT is_fraud, round(CASE WHEN is_fraud = 1 THEN r.ratio ELSE 1e0 END, 6) AS class_weight, count(*) AS rows
    FROM silver s, (SELECT (count(*) - sum(is_fraud)) / greatest(sum(is_fraud), 1) AS ratio FROM silver t WHERE t.user % 5 <> 0) r
    WHERE s.user % 5 <> 0 GROUP BY ALL
    """,
)
def weighted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train rows by the weight that a model gives them."""
    train, _ = models.training_frames(tables.silver(spark, sf_dir), tables.profiles(spark, sf_dir))
    return train.groupBy("is_fraud", F.round("class_weight", 6).alias("class_weight")).agg(F.count(F.lit(1)).alias("rows"))


@query("bernoulli_sample")
def bernoulli_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample(tables.silver(spark, sf_dir), 0.1).drop("processed_at")


@query(
    "model_input",
    ("raw_txn",),
    """
    SELECT CAST(coalesce(try_cast(regexp_replace(amount, '[$,]', '', 'g') AS DOUBLE), 0) AS FLOAT) AS amount_abs,
      coalesce(try_cast(mcc AS INTEGER), 0) AS mcc, coalesce(use_chip, 'UNKNOWN') AS use_chip,
      coalesce(merchant_state, 'UNKNOWN') AS merchant_state
    FROM raw_txn
    """,
)
def model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls filled, numbers narrowed, one feature dropped."""
    loose = views.raw_txn(spark, sf_dir).select(
        F.regexp_replace("amount", "[$,]", "").try_cast("double").alias("amount_abs"),
        F.col("mcc").try_cast("bigint").alias("mcc"),
        "use_chip",
        "merchant_state",
        F.lit(1).alias("vpn_flag"),
    )
    filled = sampling.fill_model_input(loose, features.CATEGORICAL)
    return sampling.downcast(sampling.drop_features(filled, ["vpn_flag"]))
