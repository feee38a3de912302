"""Scores to verdicts. A scorer is a fitted pipeline or a column giving the probability."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.functions import risk

VERDICT_FIELDS = ["user", "amount", "merchant_state", "mcc", "hour"]


def rule_score() -> Column:
    """A fixed score of three flags, for runs that need no trained model."""
    total = (
        0.05
        + 0.5 * F.col("vpn_flag")
        + 0.25 * F.col("is_online")
        + 0.15 * F.col("is_night")
    )
    return F.when(total > 1, F.lit(1.0)).otherwise(total)


def score(df: DataFrame, scorer) -> DataFrame:
    """Adds ``p`` (probability of fraud) and ``prediction``."""
    if isinstance(scorer, Column):
        scored = df.withColumn("p", scorer)
        return scored.withColumn("prediction", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0))
    scored = scorer.transform(df)
    return scored.withColumn("p", vector_to_array("probability")[1])


def to_verdicts(scored: DataFrame, event_form: bool = False) -> DataFrame:
    """The published verdict columns; the event form adds message identity and offsets."""
    outcome = [
        F.round("p", 6).alias("fraud_probability"),
        F.col("prediction").cast("int").alias("predicted_fraud"),
        F.col("is_fraud").alias("actual_fraud"),
    ]
    stamp = F.current_timestamp().alias("scored_at")
    if not event_form:
        return scored.select(*VERDICT_FIELDS, *outcome, stamp)
    return scored.select(
        "event_id", *VERDICT_FIELDS, "vpn_flag", *outcome,
        "kafka_partition", "kafka_offset", "emitted_at", stamp,
    )


def assess(df: DataFrame, base_rate: float, p: str = "p", threshold_lift: float = risk.DEFAULT_THRESHOLD_LIFT) -> DataFrame:
    """Everything a scoring answer holds: calibrated probability, lift, band and verdict."""
    calibrated = df.withColumn("_calibrated", risk.calibrate(F.col(p), base_rate))
    q = F.col("_calibrated")
    return calibrated.select(
        *df.columns,
        F.round(q, 8).alias("fraud_probability"),
        F.round(p, 6).alias("raw_model_score"),
        F.round(risk.lift(q, base_rate), 2).alias("lift_vs_base_rate"),
        F.round(F.lit(float(base_rate)), 6).alias("base_rate"),
        F.round(F.lit(float(base_rate) * threshold_lift), 8).alias("threshold"),
        risk.risk_band(q, base_rate).alias("risk_band"),
        risk.verdict(q, base_rate, threshold_lift).alias("verdict"),
    )
