"""Queries of the cleaning, location and file-reading operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.functions import cleaning as C
from cardrisk.operators import enrich
from cardrisk.operators.clean import clean_rows
from cardrisk.operators.quality import input_manifest
from cardrisk.plans import jobs, tables, views
from cardrisk.plans.registry import query
from cardrisk.schemas import RAW_COLUMNS, silver_columns
from cardrisk.session import materialise, scratch
from cardrisk.sources import files

SILVER_SQL_COLUMNS = ", ".join(c for c in silver_columns() if c != "processed_at")


def comparable_silver(df: DataFrame) -> DataFrame:
    """Silver without its wall-clock column, times as text and logs to 6 decimals."""
    return df.withColumns(
        {
            "txn_timestamp": F.date_format("txn_timestamp", "yyyy-MM-dd HH:mm:ss"),
            "amount_log": F.round("amount_log", 6),
        }
    ).drop("processed_at")


def add_all(raw: DataFrame, columns: dict) -> DataFrame:
    return raw.select(*[c.alias(name) for name, c in columns.items()])


@query("silver", ("silver",), f"SELECT {SILVER_SQL_COLUMNS} FROM silver")
def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_silver(tables.silver_frame(spark, sf_dir))


@query("silver_roundtrip", ("silver",), f"SELECT {SILVER_SQL_COLUMNS} FROM silver")
def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written partitioned by year and month, read back with partition discovery."""
    return comparable_silver(tables.silver(spark, sf_dir)).select(
        *[c for c in silver_columns() if c != "processed_at"]
    )


@query(
    "clean_amounts",
    ("raw_txn", "cleaned"),
    """
    SELECT r.amount AS amount_text, c.amount, abs(c.amount) AS amount_abs,
      round(ln(1 + abs(c.amount)), 6) AS amount_log, CASE WHEN c.amount < 0 THEN 1 ELSE 0 END AS is_refund
    FROM (SELECT amount FROM raw_txn) r,
      LATERAL (SELECT coalesce(try_cast(regexp_replace(trim(r.amount), '[$,]', '', 'g') AS DOUBLE), 0e0) AS amount) c
    """,
)
def clean_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.raw_txn(spark, sf_dir).select(
        F.col("amount").alias("amount_text"), C.clean_amount(F.col("amount")).alias("amount")
    )
    made = raw.withColumns(C.amount_features(F.col("amount")))
    return made.withColumn("amount_log", F.round("amount_log", 6))


@query(
    "clean_labels",
    ("raw_txn",),
    """
    SELECT is_fraud AS label_text,
      CASE WHEN lower(trim(is_fraud)) IN ('yes', '1', 'true') THEN 1 ELSE 0 END AS is_fraud
    FROM raw_txn
    """,
)
def clean_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_all(
        views.raw_txn(spark, sf_dir),
        {"label_text": F.col("is_fraud"), "is_fraud": C.clean_label(F.col("is_fraud"))},
    )


@query(
    "clean_zip",
    ("raw_txn",),
    """
    SELECT zip AS zip_text,
      CASE WHEN zip IS NULL OR trim(zip) = '' THEN '00000'
           ELSE lpad(split_part(trim(zip), '.', 1), 5, '0') END AS zip
    FROM raw_txn
    """,
)
def clean_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_all(
        views.raw_txn(spark, sf_dir), {"zip_text": F.col("zip"), "zip": C.clean_zip(F.col("zip"))}
    )


@query(
    "time_parts",
    ("raw_txn",),
    """
    SELECT t.time AS time_text,
      coalesce(try_cast(split_part(coalesce(t.time, '00:00'), ':', 1) AS INTEGER), 0) AS hour,
      coalesce(try_cast(split_part(coalesce(t.time, '00:00'), ':', 2) AS INTEGER), 0) AS minute
    FROM raw_txn t
    """,
)
def time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour, minute = C.time_parts(F.col("time"))
    return add_all(
        views.raw_txn(spark, sf_dir), {"time_text": F.col("time"), "hour": hour, "minute": minute}
    )


def _typed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean_rows(views.raw_txn(spark, sf_dir)).select("year", "month", "day", "hour", "minute")
    return typed.withColumn("date", C.assemble_date(F.col("year"), F.col("month"), F.col("day")))


@query(
    "assembled_dates",
    ("located",),
    """
    SELECT l.year, l.month, l.day, strftime(txn_date, '%Y-%m-%d') AS txn_date,
      strftime(txn_date, '%Y-%m-%d') || printf(' %02d:%02d:00', l.hour, l.minute) AS txn_timestamp
    FROM located l
    """,
)
def assembled_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = C.assemble_timestamp(F.col("date"), F.col("hour"), F.col("minute"))
    return _typed_dates(spark, sf_dir).select(
        "year", "month", "day",
        F.date_format("date", "yyyy-MM-dd").alias("txn_date"),
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("txn_timestamp"),
    )


@query(
    "calendar_parts",
    ("located",),
    """
    SELECT strftime(txn_date, '%Y-%m-%d') AS txn_date,
      CAST(dayofweek(txn_date) + 1 AS INTEGER) AS day_of_week,
      CASE WHEN dayofweek(txn_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
      CAST(dayofyear(txn_date) AS INTEGER) AS day_of_year
    FROM located
    """,
)
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_dates(spark, sf_dir).select(
        F.date_format("date", "yyyy-MM-dd").alias("txn_date"),
        *[c.alias(name) for name, c in C.calendar_parts(F.col("date")).items()],
    )


@query(
    "device_json",
    ("cleaned",),
    """
    SELECT vpn_flag, device_ip, device_os, geo_lat AS device_lat, geo_lon AS device_lon,
      geo_missing, hw_missing
    FROM cleaned
    """,
)
def device_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = views.raw_txn(spark, sf_dir).select(C.parse_device(F.col("device_metadata")).alias("device"))
    return add_all(parsed, C.device_fields(F.col("device")))


@query(
    "impute_flags",
    ("cleaned",),
    """
    SELECT imputed_city, imputed_state, imputed_zip, merchant_city, merchant_state, use_chip
    FROM cleaned
    """,
)
def impute_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_rows(views.raw_txn(spark, sf_dir)).select(
        "imputed_city", "imputed_state", "imputed_zip", "merchant_city", "merchant_state", "use_chip"
    )


@query("int_sentinels", ("cleaned",), "SELECT user, card, year, month, day, mcc FROM cleaned")
def int_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.raw_txn(spark, sf_dir)
    return add_all(raw, {c: C.int_or(F.col(c), d) for c, d in C.INT_SENTINELS.items()})


@query("error_features", ("cleaned",), "SELECT error_flag, error_type FROM cleaned")
def error_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = F.col("errors")
    return add_all(
        views.raw_txn(spark, sf_dir), {"error_flag": C.error_flag(errors), "error_type": C.error_type(errors)}
    )


@query(
    "outlier_caps",
    ("silver",),
    "SELECT amount, is_outlier, amount_capped FROM silver",
)
def outlier_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = views.raw_txn(spark, sf_dir).select(C.clean_amount(F.col("amount")).alias("amount"))
    return enrich.cap_outliers(amounts, tables.exact_p99(spark, sf_dir))


@query(
    "channel_flags",
    ("silver",),
    "SELECT merchant_city, merchant_state, hour, is_online, is_foreign_or_unknown, is_night FROM silver",
)
def channel_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_rows(views.raw_txn(spark, sf_dir)).select("merchant_city", "merchant_state", "hour")
    return cleaned.withColumns(C.channel_flags(*[F.col(c) for c in cleaned.columns]))


@query(
    "zip_join",
    ("located",),
    "SELECT zip, zip_lat AS merchant_lat, zip_lon AS merchant_lon FROM located",
)
def zip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    zips = views.raw_txn(spark, sf_dir).select(C.clean_zip(F.col("zip")).alias("zip"))
    return enrich.join_zip(zips, views.zip_coords(spark, sf_dir))


@query(
    "zip_join_salted",
    ("located",),
    "SELECT zip, zip_lat AS merchant_lat, zip_lon AS merchant_lon FROM located",
)
def zip_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join with a lookup taken to be too large for a broadcast: hot ZIPs are told by a sketch and spread."""
    zips = views.raw_txn(spark, sf_dir).select(C.clean_zip(F.col("zip")).alias("zip"))
    return enrich.join_zip(zips, views.zip_coords(spark, sf_dir), max_rows=0)


@query(
    "sketched_threshold",
    ("raw_txn",),
    "SELECT count(*) AS rows, true AS within_rank_error FROM raw_txn",
)
def sketched_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outlier threshold from kept sketches of the input files: its rank is off by one in ten thousand at most."""
    raw = files.read_raw_csv(spark, raw_csv_path(spark, sf_dir))
    kept = materialise(enrich.sketch_amounts(raw))
    rows, found = enrich.sketched_quantile(materialise(enrich.refresh_sketches(raw, kept)), 0.99)
    amount = C.clean_amount(F.col("amount"))
    below, upto = F.avg((amount < found).cast("double")), F.avg((amount <= found).cast("double"))
    return raw.agg(
        F.lit(rows).cast("bigint").alias("rows"), ((below <= 0.99 + 1e-4) & (upto >= 0.99 - 1e-4)).alias("within_rank_error")
    )


@query(
    "haversine_distance",
    ("silver",),
    """
    SELECT zip, merchant_lat, merchant_lon, device_lat, device_lon, device_merchant_distance_km
    FROM silver
    """,
)
def haversine_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_rows(views.raw_txn(spark, sf_dir)).select("zip", "device_lat", "device_lon")
    far = enrich.with_distance(enrich.join_zip(cleaned, views.zip_coords(spark, sf_dir)))
    return far.fillna(0.0, subset=["merchant_lat", "merchant_lon", "device_lat", "device_lon"])


_CENTROIDS = ", ".join(f"('{s}', {lat}e0, {lon}e0)" for s, (lat, lon) in enrich.STATE_CENTROIDS.items())
_DEFAULT_LAT, _DEFAULT_LON = enrich.DEFAULT_CENTROID


@query(
    "centroid_lookup",
    ("cleaned",),
    f"""
    SELECT merchant_state, coalesce(lat, {_DEFAULT_LAT}e0) AS centroid_lat,
      coalesce(lon, {_DEFAULT_LON}e0) AS centroid_lon
    FROM cleaned LEFT JOIN (VALUES {_CENTROIDS}) t(state, lat, lon) ON merchant_state = state
    """,
)
def centroid_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = views.raw_txn(spark, sf_dir).select(
        C.impute_category(F.col("merchant_state")).alias("merchant_state")
    )
    return enrich.attach_centroid(states, "merchant_state")


@query(
    "zip_lookup_build",
    ("raw_txn",),
    f"""
    WITH pairs AS (
      SELECT DISTINCT trim(zip) AS raw_zip, coalesce(trim(merchant_state), '') AS raw_state
      FROM raw_txn WHERE zip IS NOT NULL
    ), firsts AS (
      SELECT CASE WHEN length(split_part(raw_zip, '.', 1)) < 5 THEN lpad(split_part(raw_zip, '.', 1), 5, '0')
                  ELSE split_part(raw_zip, '.', 1) END AS zip, upper(raw_state) AS state
      FROM pairs
      QUALIFY row_number() OVER (PARTITION BY zip ORDER BY raw_zip, raw_state) = 1
    )
    SELECT zip, f.state,
      round(coalesce(lat, {_DEFAULT_LAT}e0)
        + (('0x' || substr(md5(zip), 1, 8))::UBIGINT / 4294967295e0 * 2 - 1) * 1.2e0, 6) AS latitude,
      round(coalesce(lon, {_DEFAULT_LON}e0)
        + (('0x' || substr(md5(zip), 9, 8))::UBIGINT / 4294967295e0 * 2 - 1) * 1.2e0, 6) AS longitude
    FROM firsts f LEFT JOIN (VALUES {_CENTROIDS}) t(state, lat, lon) ON f.state = t.state
    """,
)
def zip_lookup_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.build_zip_lookup(views.raw_txn(spark, sf_dir))


# ---- files ---------------------------------------------------------------------------------


def raw_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """The raw view as messy CSV files, each with its header."""

    def build() -> str:
        path = scratch(spark, "raw-csv")
        (
            views.raw_txn(spark, sf_dir)
            .write.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
        return path

    return tables.once(spark, sf_dir, "raw-csv", build)


@query(
    "csv_roundtrip",
    ("raw_txn",),
    f"SELECT {', '.join('t.' + c for c in RAW_COLUMNS)} FROM (SELECT * REPLACE (nullif(errors, '') AS errors) FROM raw_txn) t",
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written and read as CSV, where an empty field and a missing one are the same."""
    return files.read_raw_csv(spark, raw_csv_path(spark, sf_dir))


@query(
    "malformed_rows",
    ("raw_txn",),
    """
    SELECT count(*) + count(*) FILTER (WHERE card = '0') AS rows_read,
      count(*) + count(*) FILTER (WHERE card = '0') AS rows_with_user,
      count(*) FILTER (WHERE card = '0') AS malformed_rows
    FROM raw_txn
    """,
)
def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete files, and files whose rows lack the last field."""
    whole = raw_csv_path(spark, sf_dir)

    def build() -> str:
        short = scratch(spark, "short-csv")
        rows = files.read_raw_csv(spark, whole).filter("card = '0'").select(*RAW_COLUMNS[:-1])
        rows.write.option("header", True).option("escape", '"').csv(short)
        return short

    short = tables.once(spark, sf_dir, "short-csv", build)
    return files.malformed_rows(files.read_raw_csv(spark, [whole, short], with_corrupt=True))


@query(
    "preprocess_report",
    ("raw_txn",),
    """
    SELECT count(*) + count(*) FILTER (WHERE card = '0') AS rows_in, count(*) + count(*) FILTER (WHERE card = '0') AS rows_out,
      'PASS' AS reconciliation, count(*) FILTER (WHERE card = '0') AS malformed_rows,
      count(*) FILTER (WHERE merchant_state IS NULL) + count(*) FILTER (WHERE merchant_state IS NULL AND card = '0') AS null_states,
      count(*) FILTER (WHERE zip IS NULL) + count(*) FILTER (WHERE zip IS NULL AND card = '0') AS null_zips
    FROM raw_txn
    """,
)
def preprocess_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning job over whole and short lines: what its document says of its input."""
    malformed_rows(spark, sf_dir)
    folder, zips = scratch(spark, "preprocess"), scratch(spark, "preprocess-zip")
    views.zip_coords(spark, sf_dir).write.option("header", True).csv(zips)
    source = [raw_csv_path(spark, sf_dir), tables.once(spark, sf_dir, "short-csv", lambda: None)]
    document = jobs.preprocess(spark, source, zips, f"{folder}/silver", sketches=f"{folder}/sketches")
    return document.select(
        "rows_in", "rows_out", "reconciliation", "malformed_rows",
        F.col("input_nulls.merchant_state").alias("null_states"), F.col("input_nulls.zip").alias("null_zips"),
    )


@query(
    "headers_normalised",
    ("raw_txn",),
    """
    SELECT t.user, card, t.year, t.month, t.day, t.time, amount, use_chip, merchant_name, merchant_city,
      merchant_state, zip, mcc, errors, is_fraud
    FROM (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS use_chip) FROM raw_txn) t
    """,
)
def headers_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source-style headers, one optional column absent, back to the declared names."""
    raw = views.raw_txn(spark, sf_dir).drop("device_metadata", "use_chip")
    spoken = {"errors": "Errors?", "is_fraud": "Is Fraud?"}
    styled = raw.toDF(*[spoken.get(c, " " + c.replace("_", " ").title()) for c in raw.columns])
    return files.normalise_columns(styled)


@query(
    "zip_lookup_read",
    ("zip_coords",),
    """
    SELECT zip, min(state) AS state, arg_min(latitude, state) AS latitude, arg_min(longitude, state) AS longitude
    FROM zip_coords GROUP BY zip
    """,
)
def zip_lookup_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> str:
        path = scratch(spark, "zip-csv")
        views.zip_coords(spark, sf_dir).write.option("header", True).csv(path)
        return path

    return enrich.dedupe_lookup(files.read_zip_lookup(spark, tables.once(spark, sf_dir, "zip-csv", build)))


@query(
    "input_manifest",
    (),
    """
    SELECT count(*) AS rows,
      CASE WHEN count(*) FILTER (WHERE o_custkey % 5 = 0) = 0 THEN 'train'
           WHEN count(*) FILTER (WHERE o_custkey % 5 = 0) = count(*) THEN 'holdout' ELSE 'mixed' END AS role,
      'user % 5 == 0 -> holdout, else train' AS split_rule
    FROM orders
    """,
)
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per file of the orders table."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return input_manifest(orders, "o_custkey").select("rows", "role", "split_rule")
