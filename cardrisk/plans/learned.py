"""Queries of the model operators. Fits depend on Spark's own numerics, so most have no SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.operators import evaluate, explain, models, scoring
from cardrisk.plans import live, tables
from cardrisk.plans.registry import query
from cardrisk.session import materialise, scratch
from cardrisk.sources import sinks, streams
from cardrisk.streaming import scorer


def frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return models.training_frames(tables.silver(spark, sf_dir), tables.profiles(spark, sf_dir))


def holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir)[1]


@query("train_lr")
def train_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.trained(spark, sf_dir, "lr")[2]


@query("train_rf")
def train_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.trained(spark, sf_dir, "rf")[2]


@query("train_gbt")
def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.trained(spark, sf_dir, "gbt")[2]


@query("feature_importances")
def feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, _ = tables.trained(spark, sf_dir, "gbt")
    return models.top_features(models.feature_importances(model, spark))


@query("model_roundtrip")
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the saved model after loading it again."""
    _, path, _ = tables.trained(spark, sf_dir, "gbt")
    loaded = scoring.score(holdout(spark, sf_dir), sinks.load_model(path))
    return scoring.to_verdicts(loaded).drop("scored_at")


@query("model_threshold_sweep")
def model_threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, _ = tables.trained(spark, sf_dir, "gbt")
    return evaluate.threshold_sweep(scoring.score(holdout(spark, sf_dir), model), label=models.LABEL)


def serving(spark: SparkSession, sf_dir: str, drop: tuple[str, ...] = ()):
    def build():
        return models.train_serving_model(tables.silver(spark, sf_dir), drop=drop)

    return tables.once(spark, sf_dir, f"serving-{'-'.join(drop)}", build)


def _serving_metrics(spark: SparkSession, sf_dir: str, drop: tuple[str, ...] = ()) -> DataFrame:
    model, scored, _ = serving(spark, sf_dir, drop)
    return models.serving_metrics(model, scored, {})


@query("serving_model_metrics")
def serving_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _serving_metrics(spark, sf_dir)


@query("dropped_features_model")
def dropped_features_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving model without the synthetic VPN feature."""
    return _serving_metrics(spark, sf_dir, ("vpn_flag",))


def linear_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, _ = tables.trained(spark, sf_dir, "lr")
    train, rows = frames(spark, sf_dir)
    return explain.linear_contributions(model, rows, train, ["user", "mcc", "amount", models.LABEL])


@query("linear_contributions")
def linear_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each holdout row's margin put together from its contributions."""
    total = F.expr("aggregate(contributions, 0D, (a, c) -> a + c.contribution)")
    return linear_rows(spark, sf_dir).select(
        "user", "mcc", "amount", F.round("base_value", 6).alias("base_value"),
        F.size("contributions").alias("features"), F.round(F.col("base_value") + total, 6).alias("margin"),
    )


def tree_rows(spark: SparkSession, sf_dir: str, highest: bool = False) -> DataFrame:
    """The holdout's contributions; with ``highest`` those of its highest score alone."""
    model, path, _ = tables.trained(spark, sf_dir, "gbt")
    held = holdout(spark, sf_dir)
    rows = scoring.score(held, model).select(*held.columns, "p")
    if highest:
        rows = explain.highest_scored(rows)
    keep = ["user", "mcc", "amount", models.LABEL, "p"]
    return explain.tree_contributions(model, path, rows, models.features.tree_feature_names(), keep)


@query("tree_contributions")
def tree_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each holdout row's boosted probability, and the same rebuilt from its contributions."""
    total = F.expr("aggregate(contributions, 0D, (a, c) -> a + c.contribution)")
    margin = F.col("base_value") + total
    return tree_rows(spark, sf_dir).select(
        "user", "mcc", "amount", F.round("p", 6).alias("p"),
        F.round(1 / (1 + F.exp(-2 * margin)), 6).alias("rebuilt_p"),
    )


# ---- what must hold whatever the fit is, so SQL can say it --------------------------------------

HELD = "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS mismatched FROM silver s WHERE s.user % 5 = 0"
ALL = "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS mismatched FROM silver"
TOLERANCE = 1e-6


def _gaps(rows: DataFrame, left: Column, right: Column) -> DataFrame:
    close = F.coalesce(F.abs(left - right) < TOLERANCE, F.lit(False))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~close).alias("mismatched"))


def _disagreements(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Rows of the first frame, and how many rows either frame has beyond the other."""
    columns = ours.columns
    counted = ours.withColumn("_side", F.lit(1)).unionByName(theirs.withColumn("_side", F.lit(-1)))
    balance = counted.groupBy(*columns).agg(
        F.sum("_side").alias("_gap"), F.count_if(F.col("_side") == 1).alias("_ours")
    )
    return balance.agg(
        F.sum("_ours").alias("rows"), F.sum(F.abs(F.col("_gap"))).cast("bigint").alias("mismatched")
    )


@query("tree_additivity", ("silver",), HELD)
def tree_additivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contributions of the boosted trees rebuild every holdout row's probability."""
    total = F.expr("base_value + aggregate(contributions, 0D, (a, c) -> a + c.contribution)")
    return _gaps(tree_rows(spark, sf_dir), F.col("p"), 1 / (1 + F.exp(-2 * total)))


@query("linear_additivity", ("silver",), HELD)
def linear_additivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, _ = tables.trained(spark, sf_dir, "lr")
    train, rows = frames(spark, sf_dir)
    scored = scoring.score(rows, model).select(*rows.columns, "p")
    total = F.expr("base_value + aggregate(contributions, 0D, (a, c) -> a + c.contribution)")
    explained = explain.linear_contributions(model, scored, train, ["p"])
    return _gaps(explained, F.col("p"), 1 / (1 + F.exp(-total)))


@query("model_roundtrip_agreement", ("silver",), HELD)
def model_roundtrip_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the fitted model and of the same model saved and loaded."""
    model, path, _ = tables.trained(spark, sf_dir, "gbt")
    rows = holdout(spark, sf_dir)
    fitted, loaded = (
        scoring.to_verdicts(scoring.score(rows, m)).drop("scored_at") for m in (model, sinks.load_model(path))
    )
    return _disagreements(fitted, loaded)


@query("stream_model_agreement", ("silver",), ALL)
def stream_model_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the model over the stream and over the table."""
    model, _, _ = tables.trained(spark, sf_dir, "gbt")
    featured = models.features.build_features(tables.silver(spark, sf_dir), *tables.profiles(spark, sf_dir))
    batch = scoring.to_verdicts(scoring.score(featured, model)).drop("scored_at")
    return _disagreements(stream_model_verdicts(spark, sf_dir).select(*batch.columns), batch)


@query(
    "model_label_totals",
    ("silver",),
    """
    SELECT model, count(*) FILTER (WHERE is_fraud = 1) AS positives, count(*) FILTER (WHERE is_fraud = 0) AS negatives
    FROM silver s, (VALUES ('logistic_regression'), ('random_forest'), ('gbt')) m(model)
    WHERE s.user % 5 = 0 GROUP BY model
    """,
)
def model_label_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each model's confusion cells add up to the holdout's labels."""
    first, *rest = [metrics for _, _, metrics in tables.trained_kinds(spark, sf_dir, ["lr", "rf", "gbt"])]
    for part in rest:
        first = first.unionByName(part)
    return first.select(
        "model", (F.col("tp") + F.col("fn")).alias("positives"), (F.col("fp") + F.col("tn")).alias("negatives")
    )


@query("global_attribution")
def global_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.global_attribution(tree_rows(spark, sf_dir))


@query("synthetic_feature_warning")
def synthetic_feature_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = explain.global_attribution(tree_rows(spark, sf_dir))
    return models.synthetic_warning(ranked, "mean_abs_contribution")


@query("top_drivers")
def top_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    driven = explain.top_drivers(tree_rows(spark, sf_dir), 5)
    return driven.select("user", "mcc", "amount", "p", F.inline("drivers"))


@query("highest_risk_example")
def highest_risk_example(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.highest_risk_example(tree_rows(spark, sf_dir, highest=True))


@query("stream_model_verdicts")
def stream_model_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved boosted model over the cleaned rows as a file stream."""
    def build() -> str:
        folder = scratch(spark, "model-stream")
        names = streams.stream_csv_schema().fieldNames()
        tables.silver(spark, sf_dir).select(*names).write.option("header", True).csv(folder)
        _, path, _ = tables.trained(spark, sf_dir, "gbt")
        users, mccs = tables.profiles(spark, sf_dir)
        stream = streams.stream_csv(spark, folder, live.FILES_PER_BATCH)
        scored = scorer.file_verdicts(stream, users, mccs, sinks.load_model(path))
        return live.drain(scored, spark, "model-stream-out", scorer.FILE_TOP_K)

    out = tables.once(spark, sf_dir, "model-stream", build)
    return spark.read.parquet(f"{out}/verdicts").drop("scored_at", "batch_id")


# ---- invariants of written model output ------------------------------------------------------------

_FEATURES = ", ".join(f"'{name}'" for name in models.features.tree_feature_names())


def contribution_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per holdout row and feature, as a job would write it."""

    def build() -> DataFrame:
        rows = tree_rows(spark, sf_dir).withColumn("row", F.monotonically_increasing_id())
        return materialise(rows.select("row", "user", "p", F.inline("contributions")))

    return tables.once(spark, sf_dir, "contribution-table", build)


@query(
    "contribution_rows",
    ("silver",),
    f"""
    SELECT unnest([{_FEATURES}]) AS feature, rows, CAST(0 AS BIGINT) AS missing
    FROM (SELECT count(*) AS rows FROM silver s WHERE s.user % 5 = 0) h
    """,
)
def contribution_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every holdout row has a contribution of every feature."""
    return contribution_table(spark, sf_dir).groupBy("feature").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("contribution").isNull() | F.isnan("contribution")).alias("missing"),
    )


@query(
    "attribution_invariants",
    ("silver",),
    f"""
    SELECT len([{_FEATURES}]) AS features, CAST(0 AS BIGINT) AS mismatched, true AS warning_fits_rank, true AS importances_add_up,
      15 AS top_listed
    FROM (SELECT count(*) AS rows FROM silver) s
    """,
)
def attribution_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked attributions against means over the written contributions, the warning against the ranking, importances against one."""
    table = contribution_table(spark, sf_dir)
    ranked = explain.global_attribution(tree_rows(spark, sf_dir))
    means = table.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean"))
    gaps = ranked.join(means, "feature", "full").agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if(~F.coalesce(F.abs(F.col("mean") - F.col("mean_abs_contribution")) < 1e-5, F.lit(False))).alias("mismatched"),
    ).first()
    first = [r.feature for r in means.orderBy(F.desc(F.round("mean", 6)), "feature").limit(3).collect()]
    warned = models.synthetic_warning(ranked, "mean_abs_contribution").first().in_top
    model, _, _ = tables.trained(spark, sf_dir, "gbt")
    importances = models.feature_importances(model, spark)
    total = importances.agg(F.sum("importance")).first()[0]
    return models.top_features(importances).agg(
        F.lit(gaps.features).cast("bigint").alias("features"), F.lit(gaps.mismatched).cast("bigint").alias("mismatched"),
        F.lit(warned == ("vpn_flag" in first)).alias("warning_fits_rank"),
        F.lit(abs(total - 1) < 1e-4).alias("importances_add_up"), F.count(F.lit(1)).cast("int").alias("top_listed"),
    )


@query("driver_invariants", ("silver",), HELD)
def driver_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's five drivers are its strongest contributions, strongest first, and point the way of their sign."""
    rows = tree_rows(spark, sf_dir)
    strength = F.transform("contributions", lambda c: F.abs(F.round(c["contribution"], 6)))
    strongest = F.slice(F.sort_array(strength, asc=False), 1, 5)
    shown = F.transform("drivers", lambda d: F.abs(d["contribution"]))
    signed = F.forall("drivers", lambda d: (d["contribution"] == 0) | (
        (d["contribution"] > 0) == (d["direction"] == "increases risk")))
    driven = explain.top_drivers(rows, 5)
    return driven.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~((strongest == shown) & signed)).alias("mismatched"))


@query("sweep_invariants", ("silver",), HELD)
def sweep_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep's flagged rows against written scores, cutoff by cutoff, and the highest example against the top score."""
    model, _, _ = tables.trained(spark, sf_dir, "gbt")
    written = materialise(scoring.score(holdout(spark, sf_dir), model).select("p", models.LABEL))
    swept = evaluate.threshold_sweep(written, label=models.LABEL).collect()
    counted = written.agg(F.count(F.lit(1)).alias("rows"), F.max("p").alias("top"),
                          *[F.count_if(F.col("p") >= r.threshold).alias(f"n{i}") for i, r in enumerate(swept)]).first()
    example = explain.highest_risk_example(tree_rows(spark, sf_dir, highest=True)).select("p").first()[0]
    wrong = sum(counted[f"n{i}"] != r.flagged for i, r in enumerate(swept)) + (abs(example - counted.top) > TOLERANCE)
    return written.agg(F.count(F.lit(1)).alias("rows"), F.lit(int(wrong)).cast("bigint").alias("mismatched"))


@query(
    "serving_invariants",
    ("silver",),
    """
    SELECT count(*) FILTER (WHERE is_fraud = 1) AS positives, true AS areas_in_range, true AS early_stop_in_range
    FROM silver s WHERE s.user % 5 = 0
    """,
)
def serving_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All positives of the holdout users are judged; areas and Brier score lie in [0, 1], rounds within their limit."""
    in_range = F.lit(True)
    for name in ("pr_auc", "roc_auc", "brier_score", "precision", "recall", "f1", "accuracy"):
        in_range = in_range & F.col(name).between(0, 1)
    return _serving_metrics(spark, sf_dir).select(
        (F.col("tp") + F.col("fn")).alias("positives"), in_range.alias("areas_in_range"),
        F.col("rounds_used").between(1, models.SERVING["maxIter"]).alias("early_stop_in_range"),
    )
