"""The model and streaming jobs, end to end over the cleaned test table."""

import time

import pytest
from pyspark.sql import functions as F

from cardrisk import session
from cardrisk.operators import scoring
from cardrisk.plans import jobs, tables, views
from cardrisk.schemas import stream_csv_schema
from cardrisk.sources import files, sinks


def test_train_score_and_tune(spark, sf_dir, silver, tmp_path):
    path = tables.silver_path(spark, sf_dir)
    out = str(tmp_path / "train")
    ranked = jobs.train(spark, path, out, skip=["rf"], lr={"maxIter": 2}, gbt={"maxIter": 2, "maxDepth": 2})
    assert {r.model for r in ranked.collect()} == {"logistic_regression", "gbt"}
    assert spark.read.json(f"{out}/top_features/gbt").count() == 15
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{out}/metrics").count() == 2
    assert spark.read.json(f"{out}/threshold_sweep/gbt").count() == 9
    sides = {r.split: r.total_rows for r in spark.read.json(f"{out}/split").collect()}
    assert sum(sides.values()) == silver.count() and set(sides) == {"train", "holdout"}

    folder = str(tmp_path / "arriving")
    silver.select(*stream_csv_schema().fieldNames()).coalesce(1).write.option("header", True).csv(folder)
    totals = jobs.score_files(
        spark, path, f"{out}/models/gbt", folder, str(tmp_path / "verdicts"), str(tmp_path / "log"), trigger=None
    ).first()
    assert totals.rows == silver.count()
    jobs.live_views(spark, str(tmp_path / "verdicts"), str(tmp_path / "live"))
    assert files.read_aggregate(spark, str(tmp_path / "live"), "kpis", "scored long").first().scored == silver.count()
    assert files.read_aggregate(spark, str(tmp_path / "live"), "top_risk", "user int").count() == 25

    zips = str(tmp_path / "zips")
    sinks.write_single_csv(views.zip_coords(spark, sf_dir), zips)
    timings = jobs.tune(spark, path, zips, str(tmp_path / "timings"))
    assert {r.comparison for r in timings.collect()} == {"caching", "join_strategy", "partition_pruning"}


def test_serving_model_and_requests(spark, sf_dir, tmp_path):
    path = tables.silver_path(spark, sf_dir)
    out = str(tmp_path / "serving")
    metrics = jobs.train_serving(spark, path, out, maxIter=2, maxDepth=2).first()
    ranked = spark.read.json(f"{out}/attribution")
    assert ranked.count() == 20 and metrics.tp + metrics.fn > 0
    stored = spark.read.json(f"{out}/metrics").first().asDict()
    assert {"pr_auc", "roc_auc", "brier_score", "rounds_used", "scale_pos_weight", "train_rows", "test_fraud"} <= set(stored)
    assert stored["test_fraud"] == metrics.tp + metrics.fn
    assert spark.read.json(f"{out}/warning").first().feature == "vpn_flag"
    assert spark.read.json(f"{out}/example").count() == 5

    requests = str(tmp_path / "requests")
    views.event_rows(spark, sf_dir).select("event_id", "amount", "hour", "vpn_flag").write.json(requests)
    answers = str(tmp_path / "answers")
    jobs.aggregates(spark, path, str(tmp_path / "agg"))
    schema = "event_id int, amount double, hour int, vpn_flag int"
    jobs.assess(spark, requests, schema, f"{out}/model", answers, aggregates=str(tmp_path / "agg"))
    got = spark.read.json(answers)
    base = tables.silver(spark, sf_dir).agg(F.avg("is_fraud")).first()[0]
    assert abs(got.first().base_rate - base) < 1e-6
    assert got.filter("size(drivers) <> 5").isEmpty()
    assert set(got.first().drivers[0].asDict()) == {"feature", "value", "contribution", "direction"}
    with pytest.raises(ValueError, match="base_rate"):
        jobs.assess(spark, requests, schema, f"{out}/model", answers)
    assert got.count() == views.event_rows(spark, sf_dir).count()
    assert got.filter(~F.col("verdict").isin("REVIEW", "CLEAR")).isEmpty()
    assert {"risk_band", "lift_vs_base_rate", "raw_model_score"} <= set(got.columns)


def test_rule_score_without_flags_is_missing(spark):
    row = spark.createDataFrame([(None, 0, 0)], "vpn_flag int, is_online int, is_night int")
    assert row.select(scoring.rule_score()).first()[0] is None


def test_shuffle_files_go_once_a_table_is_written(spark):
    """Written twice without a garbage collection of the driver between; waits for the deletion, which is not awaited by Spark."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: sum(f.name().startswith("shuffle_") for f in _each(manager.getAllBlocks().iterator()))
    keyed = spark.range(100_000).withColumn("k", F.col("id") % 5_000)
    before = shuffled()
    for _ in range(2):
        table = session.materialise(keyed.repartition(4, "k").groupBy("k").agg(F.sum("id").alias("n")).repartition(3, "n"))
        assert len(table.collect()) == 5_000
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    assert spark.conf.get(session.RELEASE, "false") == "false"


def _each(iterator):
    while iterator.hasNext():
        yield iterator.next()
