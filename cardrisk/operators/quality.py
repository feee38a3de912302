"""Row reconciliation, cleanup checks and the data-quality profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.operators.sampling import is_holdout
from cardrisk.schemas import CORRUPT_COLUMN, RAW_COLUMNS

# ---- fixed values: profile counters ------------------------------------------------------
FLAG_SUMS = {
    "imp_city": "imputed_city", "imp_state": "imputed_state", "imp_zip": "imputed_zip",
    "imp_geo": "geo_missing", "imp_hw": "hw_missing", "outliers": "is_outlier",
    "refunds": "is_refund", "online": "is_online", "night": "is_night",
    "weekend": "is_weekend", "errors": "error_flag",
}
DISTINCTS = {"users": "user", "states": "merchant_state", "mccs": "mcc"}
# ------------------------------------------------------------------------------------------


def reconcile(raw: DataFrame, out: DataFrame) -> DataFrame:
    """Rows in, rows out, the difference and whether they agree."""
    zero = F.lit(0).cast("bigint")
    sides = raw.agg(F.count(F.lit(1)).alias("rows_in"), zero.alias("rows_out")).unionByName(
        out.agg(zero.alias("rows_in"), F.count(F.lit(1)).alias("rows_out"))
    )
    both = sides.agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"))
    dropped = F.col("rows_in") - F.col("rows_out")
    return both.select(
        "*",
        dropped.alias("rows_dropped"),
        F.when(dropped == 0, "PASS").otherwise("MISMATCH").alias("reconciliation"),
    )


def distinct_counts(df: DataFrame, columns: dict[str, str], approximate: bool = False) -> DataFrame:
    """One row: how many values other than null each column has, by the name it is given.

    Integers are marked in bitmaps, one of 32,768 values per bucket and task, whose bits are
    counted after they are merged; other columns are counted by group. Each column is read by a
    scan of its own that reads nothing else, so no row is multiplied, as it would be for
    several exact distinct counts in one aggregation. ``approximate`` sketches all in one pass.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(name) for name, c in columns.items()])
    zero = F.lit(None).cast("bigint")
    parts = []
    for name, column in columns.items():
        kind = df.schema[column].dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            value = F.col(column).cast("bigint")
            marked = df.filter(value.isNotNull()).groupBy(F.bitmap_bucket_number(value)).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))
            counted = marked.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))
        else:
            counted = df.filter(F.col(column).isNotNull()).select(column).distinct().agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted.select(*[F.col("n").cast("bigint").alias(c) if c == name else zero.alias(c) for c in columns]))
    return _side_by_side(parts)


def _side_by_side(parts: list[DataFrame]) -> DataFrame:
    """One-row frames with the same columns, each with its own filled, as one row."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first.agg(*[F.max(c).alias(c) for c in first.columns])


def _with_counts(profile: DataFrame, counts: DataFrame) -> DataFrame:
    """A one-row profile and one row of counts as one row."""
    absent = {f.name: f.dataType for f in [*profile.schema, *counts.schema]}
    parts = [
        part.select(*[F.col(c) if c in part.columns else F.lit(None).cast(kind).alias(c) for c, kind in absent.items()])
        for part in (profile, counts)
    ]
    return _side_by_side(parts)


def quality_profile(silver: DataFrame, approximate: bool = False) -> DataFrame:
    """All counters of the profile from one aggregation, and the distinct counts beside it.

    ``approximate`` counts distinct values with sketches.
    """
    counters = silver.agg(
        *[F.sum(c).alias(name) for name, c in FLAG_SUMS.items()],
        F.avg("amount_abs").alias("mean_amount"),
        F.max("amount_abs").alias("max_amount"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )
    both = _with_counts(counters, distinct_counts(silver, DISTINCTS, approximate))
    names = [*FLAG_SUMS, "mean_amount", "max_amount", *DISTINCTS, "first_year", "last_year"]
    return both.select(*names)


def cleanup_checks(silver: DataFrame) -> DataFrame:
    """Four counts that must be zero after cleaning."""
    return silver.agg(
        F.count_if(F.col("amount").isNull()).alias("null_amounts"),
        F.count_if(F.col("merchant_state").isNull()).alias("null_states"),
        F.count_if(F.length("zip") != 5).alias("malformed_zips"),
        F.count_if(F.col("txn_timestamp").isNull()).alias("null_timestamps"),
    )


def observe_input(raw: DataFrame, seen: Observation) -> DataFrame:
    """The raw rows as they are, counted while they pass: all, malformed ones, and nulls by column.

    Needs the column of malformed text. The counts are there once an action has read the rows.
    """
    return raw.observe(
        seen,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("malformed_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in RAW_COLUMNS],
    )


def with_input_counts(document: DataFrame, counts: dict) -> DataFrame:
    """The profile with what the write counted of its input."""
    nulls = F.struct(*[F.lit(counts[f"null_{c}"]).cast("bigint").alias(c) for c in RAW_COLUMNS])
    return document.withColumns(
        {"malformed_rows": F.lit(counts["malformed_rows"]).cast("bigint"), "input_nulls": nulls}
    )


def profile_document(silver: DataFrame, rows_in: int, p99: float, source: str, target: str) -> DataFrame:
    """The whole profile as one nested row."""
    counters = silver.agg(
        F.count(F.lit(1)).alias("rows_out"),
        F.sum("is_fraud").alias("fraud_rows"),
        F.struct(
            F.count_if(F.col("amount").isNull()).alias("null_amounts"),
            F.count_if(F.col("merchant_state").isNull()).alias("null_states"),
            F.count_if(F.length("zip") != 5).alias("malformed_zips"),
            F.count_if(F.col("txn_timestamp").isNull()).alias("null_timestamps"),
        ).alias("cleanup_checks"),
        F.struct(
            F.sum("imputed_city").alias("merchant_city"),
            F.sum("imputed_state").alias("merchant_state"),
            F.sum("imputed_zip").alias("zip"),
            F.sum("geo_missing").alias("device_geo"),
            F.sum("hw_missing").alias("device_hardware"),
        ).alias("imputation_counts"),
        F.struct(
            F.sum("is_outlier").alias("amount_outliers"),
            F.sum("is_refund").alias("refunds"),
            F.sum("is_online").alias("online"),
            F.sum("is_night").alias("night"),
            F.sum("is_weekend").alias("weekend"),
            F.sum("error_flag").alias("with_errors"),
        ).alias("derived_flags"),
        F.round(F.avg("amount_abs"), 2).alias("mean_amount"),
        F.round(F.max("amount_abs"), 2).alias("max_amount"),
        F.array(F.min("year"), F.max("year")).alias("year_range"),
    )
    distinct = {"distinct_users": "user", "distinct_states": "merchant_state", "distinct_mcc": "mcc"}
    both = _with_counts(counters, distinct_counts(silver, distinct))
    dropped = F.lit(rows_in) - F.col("rows_out")
    return both.select(
        F.lit(source).alias("input"),
        F.lit(target).alias("output"),
        F.lit(rows_in).cast("bigint").alias("rows_in"),
        "rows_out",
        dropped.alias("rows_dropped"),
        F.when(dropped == 0, "PASS").otherwise("MISMATCH").alias("reconciliation"),
        "fraud_rows",
        F.round(F.lit(100.0) * F.col("fraud_rows") / F.col("rows_out"), 4).alias("fraud_rate_pct"),
        F.round(F.lit(float(p99)), 2).alias("amount_p99_threshold"),
        "cleanup_checks",
        "imputation_counts",
        "derived_flags",
        F.struct("mean_amount", "max_amount", *distinct, "year_range").alias("distributions"),
    )


def input_manifest(df: DataFrame, user: str = "user") -> DataFrame:
    """Rows, bytes and split role of every input file; ``df`` must come straight from a scan."""
    held = is_holdout(F.col(user).try_cast("bigint"))
    return (
        df.groupBy(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("bytes"),
        )
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(held).alias("_held"))
        .select(
            "file_path",
            "rows",
            "bytes",
            F.round(F.col("bytes") / F.lit(float(1024**3)), 3).alias("gb"),
            F.when(F.col("_held") == 0, "train")
            .when(F.col("_held") == F.col("rows"), "holdout")
            .otherwise("mixed")
            .alias("role"),
            F.lit("user % 5 == 0 -> holdout, else train").alias("split_rule"),
        )
    )
