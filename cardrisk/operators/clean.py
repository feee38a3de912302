"""Raw text table to typed columns. No step here removes a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.functions import cleaning as C
from cardrisk.schemas import silver_columns


def clean_rows(raw: DataFrame) -> DataFrame:
    """Typed and imputed columns of every raw row, under their final names.

    Two projections: the JSON struct is parsed in the first and its fields are taken in the
    second, so it is parsed once per row.
    """
    hour, minute = C.time_parts(F.col("time"))
    ints = {c: C.int_or(F.col(c), default) for c, default in C.INT_SENTINELS.items()}
    flags = {
        f"imputed_{short}": C.imputed_flag(F.col(c))
        for short, c in (("city", "merchant_city"), ("state", "merchant_state"), ("zip", "zip"))
    }
    columns = {
        **ints,
        "hour": hour,
        "minute": minute,
        "amount": C.clean_amount(F.col("amount")),
        "is_fraud": C.clean_label(F.col("is_fraud")),
        **flags,
        "use_chip": C.impute_category(F.col("use_chip"), upper=False),
        "merchant_name": F.col("merchant_name"),
        "merchant_city": C.impute_category(F.col("merchant_city")),
        "merchant_state": C.impute_category(F.col("merchant_state")),
        "zip": C.clean_zip(F.col("zip")),
        "error_flag": C.error_flag(F.col("errors")),
        "error_type": C.error_type(F.col("errors")),
        "_device": C.parse_device(F.col("device_metadata")),
    }
    cleaned = raw.select(*[expr.alias(name) for name, expr in columns.items()])
    return cleaned.withColumns(C.device_fields(F.col("_device"))).drop("_device")


def with_dates(df: DataFrame) -> DataFrame:
    """Timestamp and calendar columns from year, month, day, hour and minute."""
    dated = df.withColumn("_date", C.assemble_date(F.col("year"), F.col("month"), F.col("day")))
    date = F.col("_date")
    return dated.withColumns(
        {
            "txn_timestamp": C.assemble_timestamp(date, F.col("hour"), F.col("minute")),
            **C.calendar_parts(date),
        }
    ).drop("_date")


def to_silver(df: DataFrame) -> DataFrame:
    """The 43 published columns in their fixed order."""
    filled = {
        c: F.coalesce(F.col(c), F.lit(0.0))
        for c in ("device_lat", "device_lon", "merchant_lat", "merchant_lon")
    }
    return df.withColumns({**filled, "processed_at": F.current_timestamp()}).select(*silver_columns())
