"""Class-weighted MLlib models: training, metrics, importances and ranking."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.operators import evaluate, features, sampling, scoring
from cardrisk.session import materialise

# ---- fixed values: estimator settings ------------------------------------------------------
LABEL = "is_fraud"
LINEAR = {"maxIter": 20, "regParam": 0.01, "elasticNetParam": 0.0}
TREES = {"maxDepth": 6, "seed": 42}
LEAST_BINS = 256
FOREST_TREES = 30
BOOST_ROUNDS = 15
SERVING = {"maxIter": 600, "maxDepth": 6, "stepSize": 0.08, "seed": 42}
MODEL_NAMES = {"lr": "logistic_regression", "rf": "random_forest", "gbt": "gbt"}
# --------------------------------------------------------------------------------------------


def training_frames(
    silver: DataFrame, profiles: tuple[DataFrame, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Weighted train frame and holdout frame, split by user, profiles joined.

    Only the columns that models and verdicts need, since both frames get stored for the fits.
    """
    users, mccs = profiles or (
        materialise(features.user_stats(silver)), materialise(features.mcc_frequency(silver))
    )
    computed = set(features.PROFILE_FEATURES)
    needed = dict.fromkeys(["user", "amount", LABEL, *features.NUMERIC, *features.CATEGORICAL])
    slim = silver.select(*[c for c in needed if c not in computed])
    featured = features.build_features(slim, users, mccs)
    train, holdout = sampling.user_split(featured)
    ratio = sampling.class_ratio(sampling.user_split(silver.select("user", LABEL))[0]).first().class_ratio
    return features.class_weighted(train, ratio), holdout


def fit_indexers(
    train: DataFrame, categorical: list[str] = features.CATEGORICAL, most: int = features.MAX_LABELS
) -> tuple[list, int]:
    """The label indexes, and the bins a tree needs: one for each label and one for all others."""
    indexed = features.bounded_indexers(train, categorical, most)
    return indexed, max([LEAST_BINS, *[len(index.labels) + 1 for index in indexed]])


def pipeline(
    kind: str,
    numeric: list[str] = features.NUMERIC,
    categorical: list[str] = features.CATEGORICAL,
    indexed: tuple[list, int] | None = None,
    **overrides,
) -> Pipeline:
    """``indexed`` is what ``fit_indexers`` gave; several kinds can share it."""
    stages, bins = indexed or (features.indexers(categorical), LEAST_BINS)
    common = {"featuresCol": "features", "labelCol": LABEL, "weightCol": "class_weight"}
    if kind == "lr":
        estimator = LogisticRegression(**common, **{**LINEAR, **overrides})
        prepare = features.linear_stages(numeric, categorical)
    elif kind == "rf":
        estimator = RandomForestClassifier(**common, **{"numTrees": FOREST_TREES, "maxBins": bins, **TREES, **overrides})
        prepare = features.tree_stages(numeric, categorical)
    elif kind == "gbt":
        estimator = GBTClassifier(**common, **{"maxIter": BOOST_ROUNDS, "maxBins": bins, **TREES, **overrides})
        prepare = features.tree_stages(numeric, categorical)
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    return Pipeline(stages=[*stages, *prepare, estimator])


def scored_holdout(model: PipelineModel, holdout: DataFrame) -> DataFrame:
    """Written once: several evaluations follow, and scoring is the costly part."""
    return materialise(scoring.score(holdout, model).select(LABEL, "rawPrediction", "prediction", "p"))


def model_metrics(name: str, scored: DataFrame) -> DataFrame:
    """One row: Spark's areas and the confusion metrics of the scored holdout."""
    areas = evaluate.mllib_auc(scored)
    return evaluate.confusion(scored, label=LABEL).select(
        F.lit(name).alias("model"),
        *[F.lit(round(v, 6)).alias(k) for k, v in areas.items()],
        "*",
        F.lit(None).cast("string").alias("error"),
    )


def _failure(spark: SparkSession, name: str, error: Exception, like: DataFrame | None) -> DataFrame:
    row = spark.range(1).select(F.lit(name).alias("model"), F.lit(str(error)).alias("error"))
    if like is None:
        return row
    return row.select(
        *[F.col(c) if c in row.columns else F.lit(None).cast(t).alias(c) for c, t in like.dtypes]
    )


def train_models(
    silver: DataFrame,
    kinds: Iterable[str] = ("lr", "rf", "gbt"),
    skip: Iterable[str] = (),
    on_model=None,
    profiles: tuple[DataFrame, DataFrame] | None = None,
    **overrides,
) -> tuple[dict[str, PipelineModel], DataFrame | None]:
    """Fits each kind; a kind that fails is reported in the metrics and does not stop the rest.

    ``on_model(name, model, metrics, scored)`` runs after each fit, for saving results as they come.
    The frames are kept on disk: a fit reads them a few times, but its own binned rows dozens of
    times, and those need the memory. The holdout is kept only where several kinds read it.
    """
    skipped = set(skip)
    kinds = [kind for kind in kinds if kind not in skipped]
    train, holdout = training_frames(silver, profiles)
    train = train.persist(StorageLevel.DISK_ONLY)
    if len(kinds) > 1:
        holdout = holdout.persist(StorageLevel.DISK_ONLY)
    models, rows = {}, None
    try:
        indexed = fit_indexers(train)
        for kind in kinds:
            name = MODEL_NAMES[kind]
            started, scored = time.time(), None
            try:
                models[name] = pipeline(kind, indexed=indexed, **overrides.get(kind, {})).fit(train)
                seconds = round(time.time() - started, 1)
                scored = scored_holdout(models[name], holdout)
                row = materialise(model_metrics(name, scored).withColumn("train_seconds", F.lit(seconds)))
            except Exception as error:  # one model's failure must not lose the others
                row = _failure(silver.sparkSession, name, error, rows)
            rows = row if rows is None else rows.unionByName(row, allowMissingColumns=True)
            if on_model:
                on_model(name, models.get(name), row, scored)
    finally:
        train.unpersist()
        holdout.unpersist()
    return models, rows


def feature_importances(model: PipelineModel, spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """Importances by name; by position when the vector is not as wide as the name list."""
    values = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    names = names or features.tree_feature_names()
    if len(names) != len(values):
        names = [f"f{i}" for i in range(len(values))]
    return spark.createDataFrame(list(zip(names, values)), "feature string, importance double").withColumn(
        "importance", F.round("importance", 6)
    )


def slot_names_of(model: PipelineModel) -> list[str]:
    """Inputs of the pipeline's assembler, one per slot in the tree pipelines."""
    assemblers = [stage for stage in model.stages if isinstance(stage, VectorAssembler)]
    return assemblers[-1].getInputCols()


def top_features(importances: DataFrame, n: int = 15, value: str = "importance") -> DataFrame:
    return importances.orderBy(F.desc(value), "feature").limit(n)


def synthetic_warning(ranked: DataFrame, value: str, feature: str = "vpn_flag", top: int = 3) -> DataFrame:
    """One row telling whether the synthetic feature is among the first ``top``."""
    first = top_features(ranked, top, value)
    return first.agg(
        F.lit(feature).alias("feature"),
        F.coalesce(F.bool_or(F.col("feature") == feature), F.lit(False)).alias("in_top"),
        F.lit(top).alias("top"),
    )


def train_serving_model(
    silver: DataFrame,
    negatives_per_positive: float = sampling.NEGATIVES_PER_POSITIVE,
    max_train_rows: int = 3_000_000,
    drop: Iterable[str] = (),
    row_id: str | None = None,
    seed: int = 42,
    report: dict | None = None,
    **overrides,
) -> tuple[PipelineModel, DataFrame, list[str]]:
    """Boosted trees on the stratified sample, stopped early on the holdout users.

    ``row_id`` names a column unique per row, with which drawing the sample needs no shuffle.
    The bound of the fit: of the sampled train rows at most ``max_train_rows``, drawn by hash, are learned from.
    Returns the model, the scored holdout rows of the sample and the feature names; ``report``
    is filled with the rows and positives of both sides and the class ratio.
    """
    columns = [*sampling.SERVING_COLUMNS, *([row_id] if row_id else [])]
    sampled = materialise(
        sampling.stratified_sample(silver.select(*columns), negatives_per_positive, key=row_id, seed=seed)
    )
    filled = sampling.drop_features(sampling.fill_model_input(sampled, features.CATEGORICAL), list(drop))
    train, holdout = sampling.user_split(filled)
    train = sampling.cap_rows(train, max_train_rows, key=F.col(row_id) if row_id else None, seed=seed)
    sides = {name: sampling.class_ratio(side).first() for name, side in (("train", train), ("test", holdout))}
    ratio = sides["train"].class_ratio
    if report is not None:
        for name, side in sides.items():
            report |= {f"{name}_rows": side.total_rows, f"{name}_fraud": side.positives}
        report["scale_pos_weight"] = ratio
    both = train.withColumn("is_validation", F.lit(False)).unionByName(
        holdout.withColumn("is_validation", F.lit(True))
    )
    # The sample's columns fix the feature order.
    used = [c for c in sampling.SERVING_COLUMNS if c not in {"user", LABEL, *drop}]
    categorical = [c for c in used if c in features.CATEGORICAL]
    numeric = [c for c in used if c not in categorical]
    settings = {**SERVING, "validationIndicatorCol": "is_validation", **overrides}
    weighted = features.class_weighted(both, ratio).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = pipeline("gbt", numeric, categorical, fit_indexers(weighted, categorical), **settings).fit(weighted)
    finally:
        weighted.unpersist()
    return model, scoring.score(holdout, model), features.tree_feature_names(numeric, categorical)


def serving_metrics(model: PipelineModel, scored: DataFrame, report: dict) -> DataFrame:
    """One row: confusion cells and rates, exact areas, Brier score, rounds kept, and the report of the fit."""
    areas = evaluate.exact_auc(scored, label=LABEL).first()
    brier = evaluate.brier(scored, label=LABEL).first().brier_score
    return evaluate.confusion(scored, label=LABEL).select(
        "*",
        F.lit(areas.pr_auc).alias("pr_auc"),
        F.lit(areas.roc_auc).alias("roc_auc"),
        F.lit(brier).alias("brier_score"),
        F.lit(model.stages[-1].getNumTrees).alias("rounds_used"),
        *[F.lit(value).alias(name) for name, value in report.items()],
    )
