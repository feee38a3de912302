"""Batch writers."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.functions.sampling_hash import content_key
from cardrisk.operators.sampling import take_by_hash
from cardrisk.schemas import PARTITION_COLUMNS
from cardrisk.session import RELEASE, materialise, setting


def write_silver(
    df: DataFrame, path: str, files: int | None = None, task_bytes: str = "64m", gathered: bool = False
) -> None:
    """Parquet partitioned by year and month.

    The rebalance hint gathers each month into few files, cut at ``task_bytes`` of shuffled
    data, and lets adaptive execution split a month that is far larger than the rest;
    ``files`` asks for a fixed number of writers instead. A writer sorts its rows by month, so
    what it gets must fit its memory several times over, or the sort spills. ``gathered`` says
    that ``build_silver`` has set the hint already. Shuffle files are deleted once the table is written.
    """
    keys = [F.col(c) for c in PARTITION_COLUMNS]
    if files:
        arranged = df.repartition(files, *keys)
    else:
        arranged = df if gathered else df.hint("rebalance", *keys)
    spark = df.sparkSession
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", task_bytes), setting(spark, RELEASE, "true"):
        arranged.write.mode("overwrite").partitionBy(*PARTITION_COLUMNS).parquet(path)


def write_single_csv(df: DataFrame, path: str, order: Sequence[Column | str] = ()) -> None:
    """One readable file; meant for results of bounded size.

    The rows go to the one writer when they are finished: a mere ``coalesce`` would make it
    work out the last aggregation as well.
    """
    _write_csv(_in_one(df, order), path)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of files, for results without a bound."""
    _write_csv(df, path)


def _in_one(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    gathered = df.repartition(1)
    return gathered.sortWithinPartitions(*order) if order else gathered


def _write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_csv_sample(df: DataFrame, path: str, n: int = 20000, seed: int = 42) -> None:
    """A repeatable sample of ``n`` rows as one CSV file with a header."""
    write_single_csv(take_by_hash(df, n, content_key(df.columns), seed), path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_single_json(df: DataFrame, path: str, order: Sequence[Column | str] = ()) -> None:
    """One JSON-lines file of a result of bounded size."""
    write_json(_in_one(df, order), path)


def write_aggregates(frames: dict[str, DataFrame], path: str, source: str) -> DataFrame:
    """All aggregates as JSON lines, a folder each, and a manifest of them.

    The frames become one long result of (file, place, JSON text), worked out by one job. Once
    finished it is dealt out by file, so every aggregate is one file in its own order, and its
    rows and bytes are counted from the same result.
    """
    started = time.time()
    long = materialise(long_form(frames))
    ordered = long.repartition("file").sortWithinPartitions("file", "place")
    ordered.select("file", "value").write.mode("overwrite").partitionBy("file").text(path)
    written = {
        r.file: (r.rows, round(r.bytes / 1024.0, 1))
        for r in long.groupBy("file").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("value") + 1).alias("bytes")
        ).collect()
    }
    rows = [(name, *written.get(name, (0, 0.0))) for name in sorted(frames)]
    manifest = long.sparkSession.createDataFrame(rows, "file string, rows long, size_kb double").select(
        "*",
        F.lit(source).alias("source"),
        F.lit(round(time.time() - started, 1)).alias("elapsed_seconds"),
        F.current_timestamp().alias("generated_at"),
    )
    write_single_json(manifest, f"{path}/file=index", ["file"])
    return manifest


def long_form(frames: dict[str, DataFrame]) -> DataFrame:
    """Frames of any columns as rows of (file, place in the frame's order, JSON text)."""
    parts = [
        frame.select(
            F.lit(name).alias("file"), F.monotonically_increasing_id().alias("place"), F.to_json(F.struct("*")).alias("value")
        )
        for name, frame in frames.items()
    ]
    long, *rest = parts
    for part in rest:
        long = long.unionByName(part)
    return long


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A table that an earlier run may have written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_profile(profile: DataFrame, path: str) -> None:
    profile.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).write.mode(
        "overwrite"
    ).text(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Written after each model to a folder of its own, which a rerun overwrites."""
    metrics.write.mode("overwrite").parquet(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
