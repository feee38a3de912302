"""Queries of the evaluation, calibration and verdict operators, on a fixed rule score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.functions import risk
from cardrisk.operators import evaluate, features, scoring
from cardrisk.plans import tables, views
from cardrisk.plans.registry import query
from cardrisk.session import materialise, scratch
from cardrisk.sources import sinks


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows with the rule's probability and prediction, label alongside."""
    rows = scoring.score(tables.silver(spark, sf_dir), scoring.rule_score())
    return rows.withColumn("label", F.col("is_fraud"))


def wide_score(middle: float = 1.0) -> Column:
    """A score over the whole range, so that every band has rows."""
    return F.col("amount_abs") / (F.col("amount_abs") + middle)


def base_rate(spark: SparkSession, sf_dir: str) -> float:
    def build() -> float:
        return tables.silver(spark, sf_dir).agg(F.avg("is_fraud")).first()[0]

    return tables.once(spark, sf_dir, "base-rate", build)


CELLS = """
SELECT count(*) FILTER (WHERE is_fraud = 1 AND p >= 0.5e0) AS tp,
  count(*) FILTER (WHERE is_fraud = 0 AND p >= 0.5e0) AS fp,
  count(*) FILTER (WHERE is_fraud = 1 AND p < 0.5e0) AS fn,
  count(*) FILTER (WHERE is_fraud = 0 AND p < 0.5e0) AS tn
FROM scored
"""


@query(
    "confusion_metrics",
    ("scored",),
    f"""
    SELECT tp, fp, fn, tn, round(pr, 6) AS precision, round(re, 6) AS recall,
      round(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END, 6) AS f1,
      round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy
    FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS pr,
                 CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS re FROM ({CELLS}) c) r
    """,
)
def confusion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(scored(spark, sf_dir))


@query(
    "threshold_sweep",
    ("scored",),
    """
    SELECT threshold,
      round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
      round(CASE WHEN positives > 0 THEN tp / positives ELSE 0 END, 6) AS recall, tp + fp AS flagged
    FROM (
      SELECT threshold, count(*) FILTER (WHERE is_fraud = 1 AND p >= threshold) AS tp,
        count(*) FILTER (WHERE is_fraud = 0 AND p >= threshold) AS fp,
        count(*) FILTER (WHERE is_fraud = 1) AS positives
      FROM scored, (VALUES (0.1e0), (0.2e0), (0.3e0), (0.4e0), (0.5e0), (0.6e0), (0.7e0), (0.8e0), (0.9e0)) t(threshold)
      GROUP BY threshold
    ) c
    """,
)
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.threshold_sweep(scored(spark, sf_dir))


def _auc_sql(score: str, model: str | None = None) -> str:
    """Areas over every distinct value of ``score``, tied scores taken together."""
    name = f"'{model}' AS model, " if model else ""
    return f"""
    SELECT {name}round(sum(pos * (tp / (tp + fp))) / sum(pos), 6) AS pr_auc,
      round(sum(neg * (tp - pos / 2e0)) / (sum(pos) * sum(neg)), 6) AS roc_auc,
      CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
      (SELECT count(*) FILTER (WHERE coalesce(isnan({score}), true)) FROM scored) AS skipped
    FROM (
      SELECT pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp
      FROM (SELECT {score} AS s, count(*) FILTER (WHERE is_fraud = 1) AS pos,
              count(*) FILTER (WHERE is_fraud = 0) AS neg FROM scored t
            WHERE NOT coalesce(isnan({score}), true) GROUP BY 1) g
    ) r
    """


@query("exact_auc", ("scored",), _auc_sql("p"))
def exact_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.exact_auc(scored(spark, sf_dir))


# Scores as a model with gaps gives them: null for some rows, not a number for others.
PARTIAL_SCORE = "CASE WHEN amount_abs < 20 THEN NULL WHEN amount_abs > 900 THEN CAST('NaN' AS DOUBLE) ELSE p END"


@query("exact_auc_partial", ("scored",), _auc_sql(PARTIAL_SCORE))
def exact_auc_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir)
    return evaluate.exact_auc(rows.select("label", F.expr(PARTIAL_SCORE).alias("p")))


@query("brier", ("scored",), "SELECT round(avg((p - is_fraud) * (p - is_fraud)), 6) AS brier_score FROM scored")
def brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.brier(scored(spark, sf_dir))


@query(
    "pr_lift",
    ("scored",),
    f"""
    SELECT pr_auc, round(positives / (positives + negatives), 6) AS base_rate,
      round(pr_auc / (positives / (positives + negatives)), 2) AS pr_lift
    FROM ({_auc_sql("p")}) a
    """,
)
def pr_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.pr_lift(evaluate.exact_auc(scored(spark, sf_dir)))


# Three scorers of the same rows stand in for models; the amount has very many distinct values.
SCORERS = {
    "rule": "p",
    "amount": "amount_abs / (amount_abs + 100e0)",
    "distance": "device_merchant_distance_km / 20000e0",
}


def _scorer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        rows = scored(spark, sf_dir)
        parts = [
            evaluate.exact_auc(rows.select("label", F.expr(score).alias("p"))).select(
                F.lit(name).alias("model"), "*"
            )
            for name, score in SCORERS.items()
        ]
        first, *rest = parts
        for part in rest:
            first = first.unionByName(part)
        return materialise(first)

    return tables.once(spark, sf_dir, "scorer-metrics", build)


_ALL_SCORERS = " UNION ALL ".join(f"SELECT * FROM ({_auc_sql(s, m)}) {m}" for m, s in SCORERS.items())


@query("rank_models", ("scored",), f"SELECT * FROM ({_ALL_SCORERS}) u ORDER BY pr_auc DESC, model")
def rank_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.rank_models(_scorer_metrics(spark, sf_dir))


@query(
    "best_model",
    ("scored",),
    f"SELECT model AS name, pr_auc FROM ({_ALL_SCORERS}) u ORDER BY pr_auc DESC, model DESC LIMIT 1",
)
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.best_model(_scorer_metrics(spark, sf_dir))


@query("metrics_log", ("scored",), _ALL_SCORERS)
def metrics_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each scorer's row written on its own, one of them twice, then the log read whole."""
    path = scratch(spark, "metrics")
    metrics = _scorer_metrics(spark, sf_dir)
    for name in [*SCORERS, *list(SCORERS)[:1]]:
        sinks.write_metrics(metrics.filter(F.col("model") == name), f"{path}/{name}")
    return spark.read.schema(metrics.schema).parquet(f"{path}/*")


# ---- reading a score -----------------------------------------------------------------------

CALIBRATED = """
calibrated AS (
  SELECT s.*, base, odds / (1 + odds) AS q, odds / (1 + odds) / base AS lifted
  FROM (
    SELECT s.*, base, greatest(least(p, 1e0 - 1e-9), 1e-9) / (1 - greatest(least(p, 1e0 - 1e-9), 1e-9))
      * (base / (1 - base)) AS odds
    FROM (SELECT * REPLACE (amount_abs / (amount_abs + 1e0) AS p) FROM scored) s,
      (SELECT avg(is_fraud) AS base FROM scored) b
  ) s
)
"""
BAND = """CASE WHEN lifted >= 100 THEN 'critical' WHEN lifted >= 30 THEN 'high'
  WHEN lifted >= 10 THEN 'elevated' WHEN lifted >= 3 THEN 'low' ELSE 'minimal' END"""


@query(
    "calibrated_scores",
    ("scored",),
    f"""
    WITH {CALIBRATED}
    SELECT s.user, amount, p, round(q, 8) AS fraud_probability, round(p, 6) AS raw_model_score,
      round(lifted, 2) AS lift_vs_base_rate, round(base, 6) AS base_rate, round(base * 30, 8) AS threshold,
      {BAND} AS risk_band, CASE WHEN q >= base * 30 THEN 'REVIEW' ELSE 'CLEAR' END AS verdict
    FROM calibrated s
    """,
)
def calibrated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.silver(spark, sf_dir).select("user", "amount", wide_score().alias("p"))
    return scoring.assess(rows, base_rate(spark, sf_dir))


@query(
    "risk_bands",
    ("scored",),
    f"""
    WITH {CALIBRATED}
    SELECT {BAND} AS risk_band, CASE WHEN q >= base * 5 THEN 'REVIEW' ELSE 'CLEAR' END AS verdict,
      count(*) AS n, round(min(lifted), 4) AS least_lift, round(max(lifted), 4) AS most_lift
    FROM calibrated GROUP BY ALL
    """,
)
def risk_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = base_rate(spark, sf_dir)
    rows = tables.silver(spark, sf_dir).select(risk.calibrate(wide_score(), base).alias("q"))
    q = F.col("q")
    return (
        rows.groupBy(risk.risk_band(q, base).alias("risk_band"), risk.verdict(q, base, 5).alias("verdict"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.min(risk.lift(q, base)), 4).alias("least_lift"),
            F.round(F.max(risk.lift(q, base)), 4).alias("most_lift"),
        )
    )


@query(
    "absolute_bands",
    ("silver",),
    """
    SELECT p, CASE WHEN p >= 0.9e0 THEN 'critical' WHEN p >= 0.7e0 THEN 'high' WHEN p >= 0.4e0 THEN 'elevated'
                   WHEN p >= 0.15e0 THEN 'low' ELSE 'minimal' END AS band
    FROM (SELECT amount_abs, amount_abs / (amount_abs + 100e0) AS p FROM silver) s
    """,
)
def absolute_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.silver(spark, sf_dir).select(wide_score(100.0).alias("p"))
    return rows.select("p", risk.absolute_risk_band(F.col("p")).alias("band"))


@query(
    "verdicts",
    ("scored",),
    """
    SELECT s.user, amount, merchant_state, mcc, s.hour, round(p, 6) AS fraud_probability,
      CASE WHEN p >= 0.5e0 THEN 1 ELSE 0 END AS predicted_fraud, is_fraud AS actual_fraud
    FROM scored s
    """,
)
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.to_verdicts(scored(spark, sf_dir)).drop("scored_at")


@query(
    "filled_features",
    ("event_rows",),
    """
    SELECT event_id, e.hour, 15 AS day, 6 AS month, 0 AS minute, coalesce(code, 5411) AS mcc,
      upper(coalesce(place, 'CA')) AS merchant_state, 'Chip Transaction' AS use_chip, 'Android' AS device_os,
      'NONE' AS error_type, vpn_flag, is_online, 5e0 AS device_merchant_distance_km, abs(amount) AS amount_abs,
      round(ln(1 + abs(amount)), 6) AS amount_log, CASE WHEN amount < 0 THEN 1 ELSE 0 END AS is_refund,
      0 AS error_flag, 0 AS geo_missing, 0 AS hw_missing,
      CASE WHEN length(trim(coalesce(place, 'CA'))) <> 2 THEN 1 ELSE 0 END AS is_foreign_or_unknown,
      CASE WHEN e.hour < 6 OR e.hour >= 22 THEN 1 ELSE 0 END AS is_night, 0 AS merchant_age
    FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE mcc END AS code,
                 CASE WHEN event_id % 4 = 0 THEN NULL ELSE merchant_state END AS place FROM event_rows) e
    """,
)
def filled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse requests, some fields null or absent, to the model's whole feature row."""
    sent = views.event_rows(spark, sf_dir).select(
        "event_id", "amount", "hour", "vpn_flag", "is_online",
        F.when(F.col("event_id") % 3 != 0, F.col("mcc")).alias("mcc"),
        F.when(F.col("event_id") % 4 != 0, F.col("merchant_state")).alias("merchant_state"),
    )
    wanted = [
        "hour", "day", "month", "minute", "mcc", "merchant_state", "use_chip", "device_os", "error_type",
        "vpn_flag", "is_online", "device_merchant_distance_km", "amount_abs", "amount_log", "is_refund",
        "error_flag", "geo_missing", "hw_missing", "is_foreign_or_unknown", "is_night", "merchant_age",
    ]
    filled = features.fill_missing_features(features.request_features(sent), wanted)
    return filled.select("event_id", *wanted).withColumn("amount_log", F.round("amount_log", 6))
