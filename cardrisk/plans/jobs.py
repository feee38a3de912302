"""The end-to-end jobs, each a function over paths; ``python -m cardrisk <job>`` runs them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardrisk.operators import (
    enrich,
    evaluate,
    explain,
    features,
    layout,
    models,
    quality,
    rollups,
    sampling,
    scoring,
)
from cardrisk.schemas import CORRUPT_COLUMN
from cardrisk.session import materialise, observing_session
from cardrisk.sources import files, sinks, streams
from cardrisk.streaming import liveops, scorer


def build_lookup(spark: SparkSession, raw_csv: str, out: str) -> None:
    """ZIP coordinates from the raw transactions' own (zip, state) pairs."""
    sinks.write_csv(enrich.build_zip_lookup(files.read_raw_csv(spark, raw_csv)), out)


def preprocess(
    spark: SparkSession,
    raw_csv: str | list[str],
    zip_csv: str,
    out: str,
    profile: str | None = None,
    sample: str | None = None,
    sample_rows: int = 20000,
    sketches: str | None = None,
) -> DataFrame:
    """Raw CSV to the cleaned table; returns the one-row reconciliation and profile.

    Two scans of the raw files: one of the amounts alone for the outlier threshold, one for the
    table itself, which counts its input, malformed rows and nulls while it is written. The
    rest is read from the table. With ``sketches``, a folder, the amounts of files that an
    earlier run has seen are not read again: their quantile sketches are kept there.
    """
    if sketches:
        kept = sinks.read_if_there(spark, sketches)
        found = materialise(enrich.refresh_sketches(files.read_raw_csv(spark, raw_csv), kept))
        found.write.mode("overwrite").parquet(sketches)
        _, p99 = enrich.sketched_quantile(found)
    else:
        _, p99 = enrich.amount_overview(files.read_raw_csv(spark, raw_csv))
    seen, own = Observation("preprocess"), observing_session(spark)
    raw = quality.observe_input(files.read_raw_csv(own, raw_csv, with_corrupt=True), seen).drop(CORRUPT_COLUMN)
    sinks.write_silver(enrich.build_silver(raw, files.read_zip_lookup(own, zip_csv), p99, gather=True), out, gathered=True)
    counts = seen.get
    silver = files.read_silver(spark, out)
    source = raw_csv if isinstance(raw_csv, str) else ", ".join(raw_csv)
    profiled = quality.profile_document(silver, counts["rows_in"], p99, source, out)
    document = materialise(quality.with_input_counts(profiled, counts))
    if profile:
        sinks.write_profile(document, profile)
    if sample:
        sinks.write_csv_sample(silver, sample, sample_rows)
    return document


def raw_rates(spark: SparkSession, raw_csv: str, out: str) -> DataFrame:
    """Fraud rate by state straight from the raw files, with the summary beside it."""
    groups = materialise(rollups.rate_by_state_raw(files.read_raw_csv(spark, raw_csv)))
    sinks.write_single_csv(groups, f"{out}/fraud_by_state", [F.desc("total_txns"), "merchant_state"])
    sinks.write_json(rollups.agg_summary(groups), f"{out}/summary")
    return groups


def aggregates(spark: SparkSession, silver: str, out: str) -> DataFrame:
    return sinks.write_aggregates(
        rollups.dashboard_aggregates(files.read_silver(spark, silver)), out, silver
    )


def train(
    spark: SparkSession,
    silver: str,
    out: str,
    fraction: float = 1.0,
    skip: Iterable[str] = (),
    **overrides,
) -> DataFrame:
    """Fits the three models, saving each with its metrics and threshold sweep as soon as it is done."""
    table = files.read_silver(spark, silver)
    if fraction < 1.0:
        table = sampling.sample(table, fraction)
    sinks.write_single_json(sampling.split_report(table.select("user", models.LABEL)), f"{out}/split", ["split"])

    def keep(name, model, metrics, scored):
        sinks.write_metrics(metrics, f"{out}/metrics/{name}")
        if model is None:
            return
        sinks.write_single_json(evaluate.threshold_sweep(scored, label=models.LABEL), f"{out}/threshold_sweep/{name}", ["threshold"])
        sinks.save_model(model, f"{out}/models/{name}")
        if hasattr(model.stages[-1], "featureImportances"):
            names = models.slot_names_of(model)
            top = models.top_features(models.feature_importances(model, spark, names))
            sinks.write_single_json(top, f"{out}/top_features/{name}", [F.desc("importance"), "feature"])

    _, metrics = models.train_models(table, skip=skip, on_model=keep, **overrides)
    ranked = evaluate.rank_models(metrics)
    sinks.write_single_json(ranked, f"{out}/ranking", [F.desc_nulls_last("pr_auc"), "model"])
    return ranked


def export_sample(
    spark: SparkSession, silver: str, out: str, negatives_per_positive: float = sampling.NEGATIVES_PER_POSITIVE
) -> DataFrame:
    """Stratified sample as train and test files; one pass without a shuffle.

    A row's identity is its place in the files, so exact copies are sampled one by one.
    """
    table = files.read_silver(spark, silver, row_id=True).select(*sampling.SERVING_COLUMNS, "row_id")
    sampled = materialise(
        sampling.stratified_sample(table, negatives_per_positive, key="row_id").drop("row_id")
    )
    for name, side in zip(("train", "test"), sampling.user_split(sampled)):
        side.drop("user").write.mode("overwrite").option("header", True).csv(f"{out}/{name}")
    metadata = sampling.sample_metadata(table, sampled, negatives_per_positive)
    sinks.write_json(metadata, f"{out}/metadata")
    return metadata


def train_serving(spark: SparkSession, silver: str, out: str, drop: Iterable[str] = (), **overrides) -> DataFrame:
    """The explained serving model: fit, metrics, threshold sweep and attributions.

    The metrics hold the confusion row, exact areas, the Brier score, the rounds that early
    stopping kept, the class ratio of the train side and the rows and positives of both sides.
    """
    table = files.read_silver(spark, silver, row_id=True)
    report = {}
    model, scored, names = models.train_serving_model(table, drop=drop, row_id="row_id", report=report, **overrides)
    path = f"{out}/model"
    sinks.save_model(model, path)
    scored = materialise(scored.select(*[c for c in scored.columns if c not in ("features", "rawPrediction", "probability")]))
    sinks.write_json(evaluate.threshold_sweep(scored, label=models.LABEL), f"{out}/threshold_sweep")
    plain = scored.drop(*[c for c in scored.columns if c.endswith("_idx")])
    explained = materialise(explain.tree_contributions(model, path, plain, names, ["user", models.LABEL, "p"]))
    ranked = materialise(explain.global_attribution(explained))
    sinks.write_single_json(ranked, f"{out}/attribution", [F.desc("mean_abs_contribution"), "feature"])
    sinks.write_json(models.synthetic_warning(ranked, "mean_abs_contribution"), f"{out}/warning")
    sinks.write_json(explain.highest_risk_example(explained), f"{out}/example")
    metrics = materialise(models.serving_metrics(model, scored, report))
    sinks.write_json(metrics, f"{out}/metrics")
    return metrics


def assess(
    spark: SparkSession, requests_json: str, schema: str, model: str, out: str,
    base_rate: float = 0.0, aggregates: str | None = None, top: int = 5,
) -> None:
    """Scores a table of sparse requests: calibrated probability, band, verdict and strongest drivers of each.

    The base rate is that of the dataset summary in ``aggregates``, unless it is given.
    """
    if not base_rate:
        if aggregates is None:
            raise ValueError("assess needs base_rate or the folder of the aggregates")
        base_rate = files.base_rate(spark, aggregates)
    loaded = sinks.load_model(model)
    wanted = [c for c in sampling.SERVING_COLUMNS if c not in ("user", models.LABEL)]
    requests = features.request_features(spark.read.schema(schema).json(requests_json))
    scored = scoring.score(features.fill_missing_features(requests, wanted), loaded)
    kept = [c for c in scored.columns if c in requests.columns] + ["p"]
    names = models.slot_names_of(loaded)
    indexed = [c for c in names if c.endswith("_idx")]
    plain = scored.select(*[c for c in scored.columns if c not in ("features", "rawPrediction", "probability", *indexed)])
    explained = explain.tree_contributions(loaded, model, plain, names, kept)
    answers = scoring.assess(explain.top_drivers(explained, top).drop("contributions", "base_value"), base_rate)
    sinks.write_json(answers, out)


def live_views(spark: SparkSession, verdicts: str, out: str) -> None:
    """All live views over a folder of verdicts, a scorer's own output or JSON lines, as files."""
    table = materialise(files.read_written_verdicts(spark, verdicts))
    tie = "event_id" if "event_id" in table.columns else "user"
    views = {
        "kpis": liveops.stream_kpis(table),
        "risk_histogram": liveops.risk_histogram(table),
        "throughput": liveops.throughput_by_batch(table),
        "flag_rate_by_state": liveops.flag_rate_by_state(table),
        "recent": liveops.recent_verdicts(table, tie=tie),
        "top_risk": liveops.top_risk(table, tie=tie),
    }
    sinks.write_aggregates(views, out, verdicts)


def _profiles(spark: SparkSession, silver: str) -> tuple[DataFrame, DataFrame]:
    table = files.read_silver(spark, silver)
    # Written, because every micro-batch reads them anew, and so that their size is known.
    return materialise(features.user_stats(table)), materialise(features.mcc_frequency(table))


def score_files(
    spark: SparkSession, silver: str, model: str, source: str, out: str, checkpoint: str,
    run_seconds: int = scorer.FILE_RUN_SECONDS, trigger: str | None = scorer.FILE_TRIGGER,
    max_files: int | None = None,
) -> DataFrame:
    """Scores a folder of CSV files as they arrive; ``trigger=None`` takes what is there and stops.

    ``max_files`` bounds a micro-batch; by default a batch takes all new files.
    """
    users, mccs = _profiles(spark, silver)
    rows = streams.stream_csv(spark, source, max_files)
    prepare = scorer.file_scorer(users, mccs, sinks.load_model(model))
    scorer.run_bounded(scorer.start_scoring(rows, out, checkpoint, trigger, prepare=prepare), run_seconds)
    return scorer.written_counters(spark, out)


def score_events(
    spark: SparkSession, silver: str, model: str, servers: str, topic: str, verdict_topic: str,
    out: str, checkpoint: str, run_seconds: int = scorer.EVENT_RUN_SECONDS,
    trigger: str | None = scorer.EVENT_TRIGGER, max_offsets: int | None = None,
) -> DataFrame:
    """Scores a Kafka topic and publishes the verdicts to another; options as in ``score_files``."""
    users, mccs = _profiles(spark, silver)
    events = streams.decode_events(streams.stream_kafka(spark, servers, topic, max_offsets=max_offsets))
    query = scorer.start_scoring(
        events, out, checkpoint, trigger, scorer.EVENT_TOP_K,
        scorer.kafka_publisher(servers, verdict_topic),
        scorer.event_scorer(users, mccs, sinks.load_model(model)),
    )
    scorer.run_bounded(query, run_seconds)
    return scorer.written_counters(spark, out)


def tune(spark: SparkSession, silver: str, zip_csv: str, out: str) -> DataFrame:
    timings = layout.compare_layouts(files.read_silver(spark, silver), files.read_zip_lookup(spark, zip_csv))
    sinks.write_single_json(timings, out, ["comparison", "label"])
    return timings
