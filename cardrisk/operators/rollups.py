"""Fraud-rate rollups and the dashboard's aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.functions import cleaning as C
from cardrisk.functions.risk import amount_bucket, amount_bucket_order, amount_labels, percent, rate_severity
from cardrisk.session import materialise

# ---- fixed values: what the dashboard reads and where it cuts ------------------------------
DASHBOARD_COLUMNS = [
    "merchant_state", "mcc", "hour", "device_os", "vpn_flag", "amount_abs", "is_online",
    "is_night", "error_flag", "is_foreign_or_unknown", "year", "is_fraud",
]
FLAG_ROLLUPS = {
    "vpn": "vpn_flag", "online": "is_online", "night": "is_night", "had_error": "error_flag",
    "foreign": "is_foreign_or_unknown",
}
STATE_MIN_ROWS, STATE_LIMIT = 1000, 60
MCC_MIN_ROWS, MCC_LIMIT = 5000, 40
OS_MIN_ROWS = 1000
HIGH_RATE_MIN_ROWS = 100_000
# --------------------------------------------------------------------------------------------


def _measures(df: DataFrame, *keys: Column | str, label: str = "is_fraud") -> DataFrame:
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_txns"), F.sum(label).alias("fraud_txns")
    )
    return grouped.withColumn("fraud_rate_pct", percent(F.col("fraud_txns"), F.col("total_txns")))


def rate_by(
    df: DataFrame,
    key: str,
    alias: str | None = None,
    min_rows: int = 1000,
    limit: int | None = None,
    order_desc: bool = True,
) -> DataFrame:
    """Count, positives and rate by key, largest groups (or smallest keys) first."""
    name = alias or key
    rows = _measures(df, F.col(key).alias(name)).filter(F.col("total_txns") >= min_rows)
    order = [F.desc("total_txns"), F.asc(name)] if order_desc else [F.asc(name)]
    ordered = rows.orderBy(*order)
    return ordered.limit(limit) if limit else ordered


def rate_by_state_raw(raw: DataFrame) -> DataFrame:
    """The same rollup straight from raw text: reads two of the sixteen columns."""
    slim = raw.select(
        C.impute_category(F.col("merchant_state")).alias("merchant_state"),
        C.clean_label(F.col("is_fraud")).alias("is_fraud"),
    )
    return _measures(slim, "merchant_state").orderBy(F.desc("total_txns"), "merchant_state")


def overall(groups: DataFrame) -> DataFrame:
    """Totals over a rollup, to hold against the row count of its input."""
    return groups.agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.sum("total_txns").alias("total_txns"),
        F.sum("fraud_txns").alias("fraud_txns"),
    ).withColumn("fraud_rate_pct", percent(F.col("fraud_txns"), F.col("total_txns")))


def agg_summary(groups: DataFrame, job: str = "fraud_rate_by_state") -> DataFrame:
    """Job header joined by value to every key's row, largest first.

    Kept as rows, not as one array: the key is free text and its values are not bounded.
    """
    totals = overall(groups).select(
        F.lit("spark").alias("engine"),
        F.lit(job).alias("job"),
        F.col("distinct_keys").alias("distinct_states"),
        F.col("total_txns").alias("total_transactions"),
        F.col("fraud_txns").alias("fraud_transactions"),
        F.col("fraud_rate_pct").alias("overall_fraud_rate_pct"),
        F.lit(1).alias("_one"),
    )
    # One row, so the broadcast cannot grow.
    return groups.withColumn("_one", F.lit(1)).join(F.broadcast(totals), "_one").drop("_one")


def dashboard_columns(silver: DataFrame) -> DataFrame:
    return silver.select(*DASHBOARD_COLUMNS)


def by_state(silver: DataFrame, min_rows: int = STATE_MIN_ROWS, limit: int = STATE_LIMIT) -> DataFrame:
    return rate_by(silver, "merchant_state", "state", min_rows, limit)


def by_mcc(silver: DataFrame, min_rows: int = MCC_MIN_ROWS, limit: int = MCC_LIMIT) -> DataFrame:
    return rate_by(silver, "mcc", "mcc", min_rows, limit)


def by_hour(silver: DataFrame) -> DataFrame:
    return rate_by(silver, "hour", "hour", 1, order_desc=False)


def by_os(silver: DataFrame, min_rows: int = OS_MIN_ROWS) -> DataFrame:
    return rate_by(silver, "device_os", "os", min_rows)


def by_flags(silver: DataFrame) -> DataFrame:
    """The five flag rollups in long form from one scan.

    Rows are counted per combination of flags first, at most 32 groups, and only those are
    expanded into the five groupings.
    """
    names = list(FLAG_ROLLUPS)
    combined = silver.groupBy(*[F.col(c).alias(name) for name, c in FLAG_ROLLUPS.items()]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_fraud").alias("f")
    )
    grouped = combined.groupingSets([[name] for name in names], *names).agg(
        *[F.grouping(name).alias(f"_{name}") for name in names],
        F.sum("n").alias("total_txns"),
        F.sum("f").alias("fraud_txns"),
    )
    which = F.coalesce(*[F.when(F.col(f"_{name}") == 0, F.lit(name)) for name in names])
    value = F.coalesce(*[F.when(F.col(f"_{name}") == 0, F.col(name)) for name in names])
    return grouped.select(
        which.alias("flag"),
        value.alias("value"),
        "total_txns",
        "fraud_txns",
        percent(F.col("fraud_txns"), F.col("total_txns")).alias("fraud_rate_pct"),
    ).orderBy("flag", F.desc("total_txns"), "value")


def amount_distribution(silver: DataFrame) -> DataFrame:
    amount = F.col("amount_abs")
    rows = _measures(
        silver, amount_bucket_order(amount).alias("bucket_order"), amount_bucket(amount).alias("bucket")
    )
    return rows.orderBy("bucket_order")


SUMMARY_MEASURES = {
    "n": F.count, "f": F.sum, "amount": F.sum, "top_amount": F.max, "low_year": F.min, "high_year": F.max,
}


def _summary_counts() -> list[Column]:
    """What a dataset summary needs of every group."""
    inputs = [F.lit(1), "is_fraud", "amount_abs", "amount_abs", "year", "year"]
    return [make(c).alias(name) for (name, make), c in zip(SUMMARY_MEASURES.items(), inputs)]


def _summary_of(groups: DataFrame, median: DataFrame) -> DataFrame:
    """Summary of counts per (state, mcc), with a one-row median beside it."""
    totals = groups.agg(
        F.lit(1).alias("_one"),
        F.sum("n").alias("total_transactions"),
        F.sum("f").alias("fraud_transactions"),
        F.round(F.sum("amount") / F.sum("n"), 2).alias("mean_amount"),
        F.round(F.max("top_amount"), 2).alias("max_amount"),
        F.count_distinct("merchant_state").alias("distinct_states"),
        F.count_distinct("mcc").alias("distinct_mcc"),
        F.min("low_year").alias("first_year"),
        F.max("high_year").alias("last_year"),
    )
    middle = median.select(F.lit(1).alias("_one"), F.round("median_amount", 2).alias("median_amount"))
    rate = percent(F.col("fraud_transactions"), F.col("total_transactions"))
    # Two rows in all, so the broadcast cannot grow.
    return totals.join(F.broadcast(middle), "_one").drop("_one").withColumn("fraud_rate_pct", rate)


def sketched_median(silver: DataFrame) -> DataFrame:
    return silver.agg(F.percentile_approx("amount_abs", 0.5).alias("median_amount"))


def dataset_summary(silver: DataFrame, median: DataFrame | None = None) -> DataFrame:
    """One row. The distinct counts come from rows counted per (state, mcc), which spares the
    copy of every row per distinct count that a direct aggregation makes. The median is
    sketched unless a frame with it is given."""
    groups = silver.groupBy("merchant_state", "mcc").agg(*_summary_counts())
    return _summary_of(groups, sketched_median(silver) if median is None else median)


def top_by_volume(groups: DataFrame, n: int = 15, key: str = "merchant_state") -> DataFrame:
    return groups.orderBy(F.desc("total_txns"), key).limit(n)


def highest_rates(
    groups: DataFrame, min_rows: int = HIGH_RATE_MIN_ROWS, n: int = 10, key: str = "merchant_state"
) -> DataFrame:
    """Highest rates among groups of more than ``min_rows`` rows."""
    large = groups.filter(F.col("total_txns") > min_rows)
    return large.orderBy(F.desc("fraud_rate_pct"), F.desc("total_txns"), key).limit(n)


def known_states(states: DataFrame, n: int = 12) -> DataFrame:
    known = states.filter(F.col("state") != C.UNKNOWN)
    return known.orderBy(F.desc("total_txns"), "state").limit(n)


def with_severity(groups: DataFrame) -> DataFrame:
    return groups.withColumn("severity", rate_severity(F.col("fraud_rate_pct")))


def dashboard_aggregates(silver: DataFrame) -> dict[str, DataFrame]:
    """Every dashboard frame from one grouped pass and one quantile pass.

    The pass counts rows per combination in three groupings of few groups each; every frame
    is then a second, tiny aggregation of those counts. Ten rollups cost three hash updates
    per row instead of ten scans.
    """
    slim = dashboard_columns(silver).withColumn("bucket_order", amount_bucket_order(F.col("amount_abs")))
    small = ["hour", *FLAG_ROLLUPS.values(), "bucket_order"]
    groupings = [small, ["merchant_state", "mcc"], ["device_os"]]
    keys = [key for group in groupings for key in group]
    counted = materialise(
        slim.groupingSets(groupings, *keys).agg(
            *[F.grouping(group[0]).alias(f"_no_{group[0]}") for group in groupings],
            *_summary_counts(),
        )
    )

    def part(key: str) -> DataFrame:
        """The counts of the grouping that holds the key."""
        lead = next(group[0] for group in groupings if key in group)
        return counted.filter(F.col(f"_no_{lead}") == 0)

    def one(key: str, name: str, min_rows: int = 1) -> DataFrame:
        rows = part(key).groupBy(F.col(key).alias(name)).agg(
            F.sum("n").alias("total_txns"), F.sum("f").alias("fraud_txns")
        )
        rated = rows.withColumn("fraud_rate_pct", percent(F.col("fraud_txns"), F.col("total_txns")))
        return rated.filter(F.col("total_txns") >= min_rows)

    def largest(frame: DataFrame, name: str) -> DataFrame:
        return frame.orderBy(F.desc("total_txns"), name)

    device = one("device_os", "value", OS_MIN_ROWS).withColumn("flag", F.lit("os"))
    for name, key in FLAG_ROLLUPS.items():
        flagged = one(key, "value").withColumn("value", F.col("value").cast("string"))
        device = device.unionByName(flagged.withColumn("flag", F.lit(name)))
    labels = F.array(*[F.lit(label) for label in amount_labels()])
    return {
        "fraud_by_state": largest(one("merchant_state", "state", STATE_MIN_ROWS), "state").limit(STATE_LIMIT),
        "fraud_by_mcc": largest(one("mcc", "mcc", MCC_MIN_ROWS), "mcc").limit(MCC_LIMIT),
        "fraud_by_hour": one("hour", "hour").orderBy("hour"),
        "fraud_by_device": device.orderBy("flag", F.desc("total_txns"), "value"),
        "amount_distribution": one("bucket_order", "bucket_order")
        .withColumn("bucket", F.get(labels, F.col("bucket_order")))
        .orderBy("bucket_order"),
        "dataset_summary": _summary_of(part("mcc"), sketched_median(slim)),
    }
