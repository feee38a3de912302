"""Live views over the verdict table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.functions.risk import HISTOGRAM_BANDS, histogram_band

TOP_STATES = 12
RECENT_LIMIT = 25
TOP_RISK = 25


def stream_kpis(verdicts: DataFrame) -> DataFrame:
    counted = verdicts.agg(
        F.count(F.lit(1)).alias("scored"),
        F.coalesce(F.sum("predicted_fraud"), F.lit(0)).alias("flagged"),
        F.coalesce(F.sum("actual_fraud"), F.lit(0)).alias("labelled_fraud"),
        F.count_distinct("batch_id").alias("batches"),
        F.max("fraud_probability").alias("peak_risk"),
    )
    rate = F.try_divide(F.lit(100.0) * F.col("flagged"), F.col("scored"))
    return counted.withColumn("flag_rate_pct", F.round(F.coalesce(rate, F.lit(0.0)), 4))


def risk_histogram(verdicts: DataFrame) -> DataFrame:
    """Rows per band, all five bands present even when empty."""
    band = histogram_band(F.col("fraud_probability"))
    counted = verdicts.agg(*[F.count_if(band == name).alias(name) for name in HISTOGRAM_BANDS])
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("band_order"), F.lit(name).alias("band"), F.col(name).alias("n"))
            for i, name in enumerate(HISTOGRAM_BANDS)
        ]
    )
    return counted.select(F.inline(rows))


def throughput_by_batch(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("batch_id").agg(F.count(F.lit(1)).alias("events")).orderBy("batch_id")


def flag_rate_by_state(verdicts: DataFrame, n: int = TOP_STATES) -> DataFrame:
    grouped = verdicts.groupBy("merchant_state").agg(
        F.count(F.lit(1)).alias("events"), F.sum("predicted_fraud").alias("flagged")
    )
    rated = grouped.withColumn(
        "flag_rate_pct", F.round(F.lit(100.0) * F.col("flagged") / F.col("events"), 2)
    )
    return rated.orderBy(F.desc("events"), "merchant_state").limit(n)


def recent_verdicts(verdicts: DataFrame, n: int = RECENT_LIMIT, tie: str = "event_id") -> DataFrame:
    return verdicts.orderBy(F.desc("scored_at"), F.desc("batch_id"), F.desc(tie)).limit(n)


def top_risk(verdicts: DataFrame, n: int = TOP_RISK, tie: str = "event_id") -> DataFrame:
    return verdicts.orderBy(F.desc("fraud_probability"), tie).limit(n)
