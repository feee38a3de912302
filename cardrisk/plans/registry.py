"""Named queries and, where SQL can say it, the same query for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.plans import views

# Added before rounding to 6 decimals, here and in the SQL texts: an exact half could fall either
# way in two engines.
NUDGE = 1e-9

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The cleaned table in DuckDB's words, column for column.
CLEANED = """
SELECT
  coalesce(try_cast(trunc(try_cast(t.user AS DOUBLE)) AS INTEGER), -1) AS user,
  coalesce(try_cast(trunc(try_cast(card AS DOUBLE)) AS INTEGER), -1) AS card,
  coalesce(try_cast(trunc(try_cast(t.year AS DOUBLE)) AS INTEGER), 2000) AS year,
  coalesce(try_cast(trunc(try_cast(t.month AS DOUBLE)) AS INTEGER), 1) AS month,
  coalesce(try_cast(trunc(try_cast(t.day AS DOUBLE)) AS INTEGER), 1) AS day,
  coalesce(try_cast(split_part(coalesce(t.time, '00:00'), ':', 1) AS INTEGER), 0) AS hour,
  coalesce(try_cast(split_part(coalesce(t.time, '00:00'), ':', 2) AS INTEGER), 0) AS minute,
  coalesce(try_cast(regexp_replace(trim(amount), '[$,]', '', 'g') AS DOUBLE), CAST(0 AS DOUBLE)) AS amount,
  CASE WHEN lower(trim(is_fraud)) IN ('yes', '1', 'true') THEN 1 ELSE 0 END AS is_fraud,
  CASE WHEN merchant_city IS NULL OR trim(merchant_city) = '' THEN 1 ELSE 0 END AS imputed_city,
  CASE WHEN merchant_state IS NULL OR trim(merchant_state) = '' THEN 1 ELSE 0 END AS imputed_state,
  CASE WHEN zip IS NULL OR trim(zip) = '' THEN 1 ELSE 0 END AS imputed_zip,
  CASE WHEN use_chip IS NULL OR trim(use_chip) = '' THEN 'UNKNOWN' ELSE trim(use_chip) END AS use_chip,
  merchant_name,
  CASE WHEN merchant_city IS NULL OR trim(merchant_city) = '' THEN 'UNKNOWN'
       ELSE upper(trim(merchant_city)) END AS merchant_city,
  CASE WHEN merchant_state IS NULL OR trim(merchant_state) = '' THEN 'UNKNOWN'
       ELSE upper(trim(merchant_state)) END AS merchant_state,
  CASE WHEN zip IS NULL OR trim(zip) = '' THEN '00000'
       ELSE lpad(split_part(trim(zip), '.', 1), 5, '0') END AS zip,
  coalesce(try_cast(trunc(try_cast(mcc AS DOUBLE)) AS INTEGER), -1) AS mcc,
  CASE WHEN errors IS NULL OR trim(errors) = '' THEN 0 ELSE 1 END AS error_flag,
  CASE WHEN errors IS NULL OR trim(errors) = '' THEN 'NONE' ELSE trim(errors) END AS error_type,
  CASE WHEN json_extract_string(device_metadata, '$.network.vpn') = 'true' THEN 1 ELSE 0 END AS vpn_flag,
  coalesce(json_extract_string(device_metadata, '$.network.ip'), '0.0.0.0') AS device_ip,
  coalesce(json_extract_string(device_metadata, '$.hardware.os'), 'UNKNOWN') AS device_os,
  CAST(json_extract_string(device_metadata, '$.geo.lat') AS DOUBLE) AS geo_lat,
  CAST(json_extract_string(device_metadata, '$.geo.lon') AS DOUBLE) AS geo_lon,
  CASE WHEN json_extract(device_metadata, '$.geo') IS NULL THEN 1 ELSE 0 END AS geo_missing,
  CASE WHEN json_extract(device_metadata, '$.hardware') IS NULL THEN 1 ELSE 0 END AS hw_missing
FROM raw_txn t
"""

LOCATED = """
SELECT c.*, z.latitude AS zip_lat, z.longitude AS zip_lon,
  sin(radians(z.latitude - geo_lat) / 2) * sin(radians(z.latitude - geo_lat) / 2)
    + cos(radians(geo_lat)) * cos(radians(z.latitude))
      * (sin(radians(z.longitude - geo_lon) / 2) * sin(radians(z.longitude - geo_lon) / 2)) AS chord,
  coalesce(
    CAST(try_strptime(printf('%04d-%02d-%02d', c.year, c.month, c.day), '%Y-%m-%d') AS DATE),
    CAST(try_strptime(printf('%04d-%02d-01', c.year, c.month), '%Y-%m-%d') AS DATE),
    DATE '2000-01-01') AS txn_date
FROM cleaned c
LEFT JOIN (
  SELECT zip, latitude, longitude FROM zip_coords
  QUALIFY row_number() OVER (PARTITION BY zip ORDER BY state, latitude, longitude) = 1
) z USING (zip)
"""

SILVER = """
SELECT
  l.user, card, l.year, l.month, l.day, l.hour, l.minute,
  strftime(txn_date, '%Y-%m-%d') || printf(' %02d:%02d:00', l.hour, l.minute) AS txn_timestamp,
  CAST(dayofweek(txn_date) + 1 AS INTEGER) AS day_of_week,
  CASE WHEN dayofweek(txn_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CAST(dayofyear(txn_date) AS INTEGER) AS day_of_year,
  amount, abs(amount) AS amount_abs, round(ln(1 + abs(amount)), 6) AS amount_log,
  least(abs(amount), p99) AS amount_capped,
  CASE WHEN abs(amount) > p99 THEN 1 ELSE 0 END AS is_outlier,
  CASE WHEN amount < 0 THEN 1 ELSE 0 END AS is_refund,
  use_chip, merchant_name, merchant_city, merchant_state, zip, mcc, error_flag, error_type,
  vpn_flag, device_ip, device_os,
  coalesce(geo_lat, CAST(0 AS DOUBLE)) AS device_lat, coalesce(geo_lon, CAST(0 AS DOUBLE)) AS device_lon,
  geo_missing, hw_missing, imputed_city, imputed_state, imputed_zip,
  coalesce(zip_lat, CAST(0 AS DOUBLE)) AS merchant_lat, coalesce(zip_lon, CAST(0 AS DOUBLE)) AS merchant_lon,
  coalesce(round(CAST(12742 AS DOUBLE) * asin(CASE WHEN chord > 1 THEN CAST(1 AS DOUBLE) ELSE sqrt(chord) END), 2), CAST(-1 AS DOUBLE))
    AS device_merchant_distance_km,
  CASE WHEN merchant_city = 'ONLINE' THEN 1 ELSE 0 END AS is_online,
  CASE WHEN length(merchant_state) <> 2 THEN 1 ELSE 0 END AS is_foreign_or_unknown,
  CASE WHEN l.hour < 6 OR l.hour >= 22 THEN 1 ELSE 0 END AS is_night,
  is_fraud
FROM located l, (SELECT quantile_disc(amount, 0.99) AS p99 FROM cleaned) q
"""

SCORED = """
SELECT s.*, least(0.05e0 + 0.5e0 * vpn_flag + 0.25e0 * is_online + 0.15e0 * is_night, 1e0) AS p
FROM silver s
"""

USERS = """
SELECT user, avg(amount_abs) AS user_amount_mean,
  coalesce(stddev_samp(amount_abs), 0e0) AS user_amount_std, count(*) AS user_txn_count
FROM silver GROUP BY user
"""

MCCS = "SELECT mcc, count(*) AS mcc_frequency FROM silver GROUP BY mcc"

# Live verdicts as a table, with a batch number that does not depend on timing.
VERDICTS = """
SELECT event_id, user, amount, merchant_state, mcc, hour, vpn_flag,
  round(score, 6) AS fraud_probability, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted_fraud,
  is_fraud AS actual_fraud, emitted_at, CAST(event_id % 8 AS BIGINT) AS batch_id
FROM (SELECT *, least(0.05e0 + 0.5e0 * vpn_flag + 0.25e0 * is_online + 0.15e0 * is_night, 1e0) AS score
      FROM event_rows) e
"""

_VIEWS = {
    "raw_txn": views.for_duckdb(views.RAW_TXN),
    "zip_coords": views.for_duckdb(views.ZIP_COORDS),
    "event_rows": views.for_duckdb(views.EVENT_ROWS),
    "cleaned": CLEANED,
    "located": LOCATED,
    "silver": SILVER,
    "scored": SCORED,
    "users": USERS,
    "mccs": MCCS,
    "verdicts": VERDICTS,
}
_NEEDS = {
    "cleaned": ["raw_txn"],
    "located": ["zip_coords", "cleaned"],
    "silver": ["located"],
    "scored": ["silver"],
    "users": ["silver"],
    "mccs": ["silver"],
    "verdicts": ["event_rows"],
}


def rounded(name: str) -> Column:
    """A computed double as it is compared with SQL."""
    return F.round(F.col(name) + NUDGE, 6).alias(name)


def with_views(sql: str, *names: str) -> str:
    """The query behind the definitions of the views it reads, and those they read."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    definitions = ",\n".join(f"{name} AS (\n{_VIEWS[name].strip()}\n)" for name in order)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {definitions},\n{body[5:]}"
    return f"WITH {definitions}\n{body}"


def query(name: str, reads: tuple[str, ...] = (), sql: str | None = None):
    """Registers a query; ``sql`` is its DuckDB twin over the views in ``reads``."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = with_views(sql, *reads) if reads else sql
        return build

    return register
