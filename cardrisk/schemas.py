"""Declared schemas. Nothing is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: file and message layouts -------------------------------------------
RAW_COLUMNS = [
    "user", "card", "year", "month", "day", "time", "amount", "use_chip",
    "merchant_name", "merchant_city", "merchant_state", "zip", "mcc", "errors",
    "is_fraud", "device_metadata",
]

DEVICE_FIELDS = {
    "network": "vpn boolean, ip string",
    "geo": "lat double, lon double",
    "hardware": "os string",
}

ZIP_DDL = "zip string, state string, latitude double, longitude double"

SILVER_DDL = """
    user int, card int, year int, month int, day int, hour int, minute int,
    txn_timestamp timestamp, day_of_week int, is_weekend int, day_of_year int,
    amount double, amount_abs double, amount_log double, amount_capped double,
    is_outlier int, is_refund int, use_chip string, merchant_name string,
    merchant_city string, merchant_state string, zip string, mcc int,
    error_flag int, error_type string, vpn_flag int, device_ip string,
    device_os string, device_lat double, device_lon double, geo_missing int,
    hw_missing int, imputed_city int, imputed_state int, imputed_zip int,
    merchant_lat double, merchant_lon double, device_merchant_distance_km double,
    is_online int, is_foreign_or_unknown int, is_night int, is_fraud int,
    processed_at timestamp
"""

PARTITION_COLUMNS = ["year", "month"]

VERDICT_DDL = """
    user int, amount double, merchant_state string, mcc int, hour int,
    fraud_probability double, predicted_fraud int, actual_fraud int,
    scored_at timestamp
"""

EVENT_VERDICT_DDL = """
    event_id int, user int, amount double, merchant_state string, mcc int, hour int,
    vpn_flag int, fraud_probability double, predicted_fraud int, actual_fraud int,
    kafka_partition int, kafka_offset bigint, emitted_at string, scored_at timestamp
"""

KAFKA_DDL = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp"
)
# ---------------------------------------------------------------------------------------

CORRUPT_COLUMN = "_corrupt"


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
}


def _struct(columns: str) -> T.StructType:
    """A flat column list as a schema; needs no running session, unlike Spark's DDL parser."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def raw_schema(with_corrupt: bool = False) -> T.StructType:
    names = RAW_COLUMNS + ([CORRUPT_COLUMN] if with_corrupt else [])
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def device_schema() -> T.StructType:
    return T.StructType([T.StructField(name, _struct(body)) for name, body in DEVICE_FIELDS.items()])


def zip_schema() -> T.StructType:
    return _struct(ZIP_DDL)


def silver_schema() -> T.StructType:
    return _struct(SILVER_DDL)


def silver_columns() -> list[str]:
    return silver_schema().fieldNames()


def stream_csv_schema() -> T.StructType:
    """Silver with the partition keys last: CSV under a declared schema binds by position."""
    fields = silver_schema().fields
    body = [f for f in fields if f.name not in PARTITION_COLUMNS]
    tail = [f for f in fields if f.name in PARTITION_COLUMNS]
    return T.StructType(body + tail)


def event_schema() -> T.StructType:
    """JSON message: silver without its two timestamps, plus the event's own identity."""
    body = [f for f in silver_schema().fields if f.name not in ("txn_timestamp", "processed_at")]
    return T.StructType(
        body
        + [T.StructField("event_id", T.IntegerType()), T.StructField("emitted_at", T.StringType())]
    )


def kafka_schema() -> T.StructType:
    return _struct(KAFKA_DDL)


def verdict_schema(event_form: bool = False) -> T.StructType:
    return _struct(EVENT_VERDICT_DDL if event_form else VERDICT_DDL)
