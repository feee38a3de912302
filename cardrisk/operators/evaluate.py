"""Metrics of a scored frame with columns ``label`` (0/1), ``p`` and, where needed, ``prediction``."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.operators.sizing import running_totals
from cardrisk.session import materialise

# ---- fixed values --------------------------------------------------------------------------
THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
# --------------------------------------------------------------------------------------------


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, hit = F.col(label), F.col(prediction)
    cells = df.agg(
        F.count_if((y == 1) & (hit == 1)).alias("tp"),
        F.count_if((y == 0) & (hit == 1)).alias("fp"),
        F.count_if((y == 1) & (hit == 0)).alias("fn"),
        F.count_if((y == 0) & (hit == 0)).alias("tn"),
    )
    return confusion_rates(cells)


def confusion_rates(cells: DataFrame) -> DataFrame:
    """Rates of a row of cell counts, 0 where there is nothing to divide by."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rated = cells.withColumns({"_precision": _ratio(tp, tp + fp), "_recall": _ratio(tp, tp + fn)})
    precision, recall = F.col("_precision"), F.col("_recall")
    return rated.select(
        "tp", "fp", "fn", "tn",
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(_ratio(2 * precision * recall, precision + recall), 6).alias("f1"),
        F.round(_ratio(tp + tn, tp + fp + fn + tn), 6).alias("accuracy"),
    )


def threshold_sweep(
    df: DataFrame, thresholds: Sequence[float] = THRESHOLDS, label: str = "label", p: str = "p"
) -> DataFrame:
    """Precision, recall and flagged rows at every cutoff: one pass, one row per cutoff."""
    counters = []
    for i, cut in enumerate(thresholds):
        over = F.col(p) >= cut
        counters += [
            F.count_if(over & (F.col(label) == 1)).alias(f"_tp{i}"),
            F.count_if(over & (F.col(label) == 0)).alias(f"_fp{i}"),
        ]
    counted = df.agg(F.count_if(F.col(label) == 1).alias("positives"), *counters)
    rows = F.array(
        *[
            F.struct(F.lit(float(cut)).alias("threshold"), F.col(f"_tp{i}").alias("tp"), F.col(f"_fp{i}").alias("fp"))
            for i, cut in enumerate(thresholds)
        ]
    )
    swept = counted.select("positives", F.inline(rows))
    flagged = F.col("tp") + F.col("fp")
    return swept.select(
        "threshold",
        F.round(_ratio(F.col("tp"), flagged), 6).alias("precision"),
        F.round(_ratio(F.col("tp"), F.col("positives")), 6).alias("recall"),
        flagged.alias("flagged"),
    )


def exact_auc(df: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """Average precision and area under the ROC curve over every distinct score.

    Rows are first counted per score, so ties and repeated scores cost one row; the running
    counts down the ranking are then exact at any number of scores. Rows whose score is null or
    not a number are not ranked; ``skipped`` counts them, as one more group of the same pass.
    Infinite scores rank first and last.
    """
    value = F.col(p).cast("double")
    greatest = F.lit(sys.float_info.max)
    place = F.greatest(-greatest, F.least(greatest, -value))
    scored = df.select(F.when(value.isNotNull() & ~F.isnan(value), place).alias("_neg"), F.col(label).alias("_y"))
    counted = materialise(
        scored.groupBy("_neg").agg(
            F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    skipped = counted.filter("_neg IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranked = running_totals(counted.filter("_neg IS NOT NULL").drop("n"), "_neg", ["pos", "neg"])
    tp, fp = F.col("pos_upto"), F.col("neg_upto")
    areas = ranked.agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.sum(F.col("pos") * (tp / (tp + fp))).alias("_precision_area"),
        F.sum(F.col("neg") * (tp - F.col("pos") / 2.0)).alias("_roc_area"),
    )
    positives, negatives = F.coalesce("positives", F.lit(0)), F.coalesce("negatives", F.lit(0))
    return areas.select(
        F.round(_ratio(F.col("_precision_area"), positives), 6).alias("pr_auc"),
        F.round(_ratio(F.col("_roc_area"), positives * negatives), 6).alias("roc_auc"),
        "positives",
        "negatives",
        F.lit(skipped).cast("bigint").alias("skipped"),
    )


def mllib_auc(scored: DataFrame, label: str = "is_fraud", raw: str = "rawPrediction") -> dict[str, float]:
    """Spark's own binned areas of a model's output."""

    def area(metric: str) -> float:
        return BinaryClassificationEvaluator(
            labelCol=label, rawPredictionCol=raw, metricName=metric
        ).evaluate(scored)

    return {"pr_auc": area("areaUnderPR"), "roc_auc": area("areaUnderROC")}


def brier(df: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    gap = F.col(p) - F.col(label)
    return df.agg(F.round(F.avg(gap * gap), 6).alias("brier_score"))


def pr_lift(areas: DataFrame) -> DataFrame:
    """How far average precision is above that of a random ranking, the base rate."""
    base = _ratio(F.col("positives"), F.col("positives") + F.col("negatives"))
    return areas.select(
        "pr_auc",
        F.round(base, 6).alias("base_rate"),
        F.round(_ratio(F.col("pr_auc"), base), 2).alias("pr_lift"),
    )


def rank_models(metrics: DataFrame) -> DataFrame:
    """One row per model, best average precision first."""
    return metrics.orderBy(F.desc_nulls_last("pr_auc"), "model")


def best_model(metrics: DataFrame) -> DataFrame:
    scored = metrics.filter(F.col("pr_auc").isNotNull())
    return scored.agg(
        F.max_by("model", F.struct("pr_auc", "model")).alias("name"), F.max("pr_auc").alias("pr_auc")
    )
