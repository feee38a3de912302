"""Transaction-shaped views over the star-schema test tables.

Each text is plain SQL that Spark and DuckDB read alike; ``@name`` stands for a table. The
views carry the defects the cleaning operators exist for: currency text, missing values,
padded and foreign places, impossible dates, bad codes and partial JSON.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RAW_TXN = """
SELECT
  CAST(o_custkey AS STRING) AS user,
  CAST(h % 5 AS STRING) AS card,
  CAST(year(l_shipdate) AS STRING) AS year,
  CAST(month(l_shipdate) AS STRING) AS month,
  CASE WHEN h % 211 = 0 THEN '31' ELSE CAST(day(l_shipdate) AS STRING) END AS day,
  CASE WHEN h % 307 = 0 THEN NULL
       ELSE lpad(CAST(h % 24 AS STRING), 2, '0') || ':' || lpad(CAST((h * 11) % 60 AS STRING), 2, '0')
  END AS time,
  CASE WHEN l_returnflag = 'R' AND h % 7 = 0 THEN '-$' ELSE '$' END
    || CASE WHEN dollars >= 1000
            THEN CAST(CAST(floor(dollars / CAST(1000 AS DOUBLE)) AS BIGINT) AS STRING) || ','
                 || lpad(CAST(dollars % 1000 AS STRING), 3, '0')
            ELSE CAST(dollars AS STRING) END
    || '.' || lpad(CAST(cents % 100 AS STRING), 2, '0') AS amount,
  CASE WHEN h % 199 = 0 THEN NULL
       WHEN h % 3 = 0 THEN 'Swipe Transaction'
       WHEN h % 3 = 1 THEN 'Chip Transaction'
       ELSE 'Online Transaction' END AS use_chip,
  'M' || CAST(l_suppkey AS STRING) AS merchant_name,
  CASE WHEN h % 50 = 0 THEN NULL WHEN h % 3 = 2 THEN ' Online ' ELSE n_name END AS merchant_city,
  CASE WHEN h % 3 = 2 OR h % 47 = 0 THEN NULL
       WHEN n_nationkey < 20 THEN lower('S' || chr(65 + n_nationkey))
       ELSE n_name END AS merchant_state,
  CASE WHEN h % 3 = 2 OR h % 53 = 0 THEN NULL
       ELSE CAST(1001 + (l_suppkey * 173) % 98000 AS STRING) || '.0' END AS zip,
  CASE WHEN h % 401 = 0 THEN 'bad' ELSE CAST(4000 + l_partkey % 109 AS STRING) END AS mcc,
  CASE WHEN h % 37 = 0 THEN 'Insufficient Balance'
       WHEN h % 61 = 0 THEN 'Bad PIN'
       WHEN h % 5 = 0 THEN '' ELSE NULL END AS errors,
  CASE WHEN h % 600 = 0 OR (h % 9 = 0 AND h % 251 = 0) THEN 'Yes' ELSE 'No' END AS is_fraud,
  '{"network":{"vpn":' || CASE WHEN h % 9 = 0 THEN 'true' ELSE 'false' END
    || ',"ip":"10.0.' || CAST(h % 250 AS STRING) || '.1"}'
    || CASE WHEN h % 25 = 0 THEN ''
            ELSE ',"geo":{"lat":' || CAST(25 + (l_suppkey * 7) % 24 AS STRING) || '.5,"lon":-'
                 || CAST(70 + (l_suppkey * 11) % 50 AS STRING) || '.25}' END
    || CASE WHEN h % 33 = 0 THEN ''
            ELSE ',"hardware":{"os":"' || CASE WHEN h % 4 = 0 THEN 'iOS' WHEN h % 4 = 1 THEN 'Android'
                                               ELSE 'Windows' END || '"}' END
    || '}' AS device_metadata
FROM (
  SELECT *, CAST(floor(cents / CAST(100 AS DOUBLE)) AS BIGINT) AS dollars
  FROM (
    SELECT
      l.l_suppkey, l.l_partkey, l.l_shipdate, l.l_returnflag, o.o_custkey, n.n_nationkey, n.n_name,
      l.l_orderkey * 7919 + l.l_partkey * 104729 + l.l_suppkey * 1299709 + l.l_linenumber AS h,
      (l.l_partkey * 37 + l.l_orderkey * 101 + CAST(l.l_quantity AS BIGINT) * 1009) % 500000 AS cents
    FROM @lineitem l
    JOIN @orders o ON l.l_orderkey = o.o_orderkey
    JOIN @customer c ON o.o_custkey = c.c_custkey
    JOIN @nation n ON c.c_nationkey = n.n_nationkey
  ) priced
) txn
"""

ZIP_COORDS = """
SELECT
  lpad(CAST(1001 + (s_suppkey * 173) % 98000 AS STRING), 5, '0') AS zip,
  'S' || chr(65 + s_nationkey) AS state,
  25 + ((s_suppkey * 13) % 2400) / CAST(100 AS DOUBLE) AS latitude,
  -(70 + ((s_suppkey * 17) % 5000) / CAST(100 AS DOUBLE)) AS longitude
FROM @supplier
"""

EVENT_ROWS = """
SELECT
  CAST(event_id AS INT) AS event_id,
  CAST(user_id AS INT) AS user,
  value AS amount,
  abs(value) AS amount_abs,
  CASE WHEN k % 7 = 0 THEN 'UNKNOWN' ELSE 'S' || chr(CAST(65 + k % 20 AS INT)) END AS merchant_state,
  CAST(4000 + event_id % 109 AS INT) AS mcc,
  CAST(hour(ts) AS INT) AS hour,
  CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END AS vpn_flag,
  CASE WHEN k % 3 = 2 THEN 1 ELSE 0 END AS is_online,
  CASE WHEN hour(ts) < 6 OR hour(ts) >= 22 THEN 1 ELSE 0 END AS is_night,
  CASE WHEN event_type = 'error' AND k % 20 = 0 THEN 1 ELSE 0 END AS is_fraud,
  replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T') AS emitted_at
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM @events) keyed
"""

# The same inner joins in another order: orders find their customers first, so that the large table
# is shuffled once, not once for each table too large for a broadcast.
_IN_TURN = """FROM @lineitem l
    JOIN @orders o ON l.l_orderkey = o.o_orderkey
    JOIN @customer c ON o.o_custkey = c.c_custkey
    JOIN @nation n ON c.c_nationkey = n.n_nationkey"""
_ORDERS_FIRST = """FROM @lineitem l
    JOIN (@orders o JOIN @customer c ON o.o_custkey = c.c_custkey JOIN @nation n ON c.c_nationkey = n.n_nationkey)
      ON l.l_orderkey = o.o_orderkey"""

TABLE = re.compile(r"@(\w+)")


def for_duckdb(text: str) -> str:
    return TABLE.sub(r"\1", text)


def for_spark(text: str, sf_dir: str) -> str:
    return TABLE.sub(lambda m: f"parquet.`{sf_dir}/{m.group(1)}.parquet`", text)


def raw_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(for_spark(RAW_TXN.replace(_IN_TURN, _ORDERS_FIRST), sf_dir))


def zip_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(for_spark(ZIP_COORDS, sf_dir))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(for_spark(EVENT_ROWS, sf_dir))


def event_stream(spark: SparkSession, sf_dir: str, max_files: int = 1000) -> DataFrame:
    """The same rows as a stream over the table's files."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # The bracket makes it a glob, which the file source takes for one file or a folder alike.
    files = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(f"{sf_dir}/events.parque[t]")
    )
    files.createOrReplaceTempView("cardrisk_event_stream")
    return spark.sql(TABLE.sub("cardrisk_event_stream", EVENT_ROWS))
