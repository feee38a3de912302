"""Tables and models that several queries share, built once per session in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.functions import cleaning as C
from cardrisk.operators import enrich, features, models
from cardrisk.operators.sizing import exact_quantile
from cardrisk.plans import views
from cardrisk.session import materialise, scratch
from cardrisk.sources import sinks
from cardrisk.sources.files import read_silver

_built: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def exact_p99(spark: SparkSession, sf_dir: str) -> float:
    """Exact, so that outlier columns can be held against SQL; jobs use the sketch."""

    def build() -> float:
        amounts = views.raw_txn(spark, sf_dir).select(C.clean_amount(F.col("amount")).alias("amount"))
        found = exact_quantile(amounts, "amount", 0.99).first()[0]
        return enrich.DEFAULT_P99 if found is None else found

    return once(spark, sf_dir, "p99", build)




def silver_frame(spark: SparkSession, sf_dir: str, gather: bool = False) -> DataFrame:
    """Cleaned rows, computed from the raw view."""
    return enrich.build_silver(
        views.raw_txn(spark, sf_dir), views.zip_coords(spark, sf_dir), exact_p99(spark, sf_dir), gather
    )


def silver_path(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        path = scratch(spark, "silver")
        sinks.write_silver(silver_frame(spark, sf_dir, gather=True), path, gathered=True)
        return path

    return once(spark, sf_dir, "silver", build)


def silver(spark: SparkSession, sf_dir: str, row_id: bool = False) -> DataFrame:
    """The cleaned table as written: partitioned Parquet."""
    return read_silver(spark, silver_path(spark, sf_dir), row_id)


def profiles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    def build():
        table = silver(spark, sf_dir)
        return materialise(features.user_stats(table)), materialise(features.mcc_frequency(table))

    return once(spark, sf_dir, "profiles", build)


def trained_kinds(spark: SparkSession, sf_dir: str, kinds: list[str]) -> list[tuple[PipelineModel, str, DataFrame]]:
    """Of each kind the fitted model, the path it is saved at, and its metrics row; those not there yet share their frames."""
    app = spark.sparkContext.applicationId
    missing = [kind for kind in kinds if (app, sf_dir, f"model-{kind}") not in _built]
    if missing:
        paths = {models.MODEL_NAMES[kind]: scratch(spark, f"model-{kind}") for kind in missing}
        saved = {}

        def keep(name, model, metrics, scored):
            if model is not None:
                sinks.save_model(model, paths[name])
            saved[name] = metrics

        fitted, _ = models.train_models(
            silver(spark, sf_dir), kinds=missing, on_model=keep, profiles=profiles(spark, sf_dir)
        )
        for kind in missing:
            name = models.MODEL_NAMES[kind]
            if name in fitted:
                _built[app, sf_dir, f"model-{kind}"] = (fitted[name], paths[name], saved[name])
    return [_built[app, sf_dir, f"model-{kind}"] for kind in kinds]


def trained(spark: SparkSession, sf_dir: str, kind: str) -> tuple[PipelineModel, str, DataFrame]:
    """Fitted model, the path it is saved at, and its metrics row."""
    return trained_kinds(spark, sf_dir, [kind])[0]
