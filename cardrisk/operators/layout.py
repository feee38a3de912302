"""Comparisons of physical choices: caching, join strategy and partition pruning."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.operators.enrich import dedupe_lookup
from cardrisk.operators.sizing import fits_broadcast
from cardrisk.session import materialise

COMPARED_YEAR = 2018
COMPARED_HOUR = 13


def rate_pass(df: DataFrame) -> DataFrame:
    return df.groupBy("merchant_state").agg(F.count(F.lit(1)).alias("n"), F.sum("is_fraud").alias("f"))


def places_of(lookup: DataFrame) -> DataFrame:
    """The lookup's ZIPs, written once, so that a comparison times the join alone."""
    return materialise(dedupe_lookup(lookup).select("zip", F.col("latitude").alias("lat")))


def join_count(silver: DataFrame, places: DataFrame, broadcast: bool) -> DataFrame:
    """Matching rows by ZIP: one side broadcast when its size allows, or a shuffle join.

    In the shuffle form the facts are counted per ZIP first. The ZIP of all rows without one
    can be a third of the table; counted, it is one row and cannot crowd a task.
    """
    if broadcast and fits_broadcast(places):
        joined = silver.select("zip", "amount_abs").join(F.broadcast(places), "zip")
        return joined.agg(F.count(F.lit(1)).alias("matched_rows"))
    counted = silver.groupBy("zip").agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(places.hint("merge"), "zip")
    return joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("matched_rows"))


def row_shuffle_join(silver: DataFrame, places: DataFrame) -> DataFrame:
    """Every fact row through a sort-merge join; adaptive execution splits an oversized ZIP."""
    joined = silver.select("zip", "amount_abs").join(places.hint("merge"), "zip")
    return joined.agg(F.count(F.lit(1)).alias("matched_rows"))


def year_count(silver: DataFrame, year: int = COMPARED_YEAR) -> DataFrame:
    return silver.filter(F.col("year") == year).agg(F.count(F.lit(1)).alias("n"))


def hour_count(silver: DataFrame, hour: int = COMPARED_HOUR) -> DataFrame:
    return silver.filter(F.col("hour") == hour).agg(F.count(F.lit(1)).alias("n"))


def seconds(df: DataFrame) -> float:
    """Time to compute every row, without moving any to the driver."""
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def timing_table(spark: SparkSession, runs: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """Label, seconds and speed-up over the first run."""
    timed = [(label, seconds(make())) for label, make in runs.items()]
    slowest = timed[0][1]
    rows = [(label, round(s, 3), round(slowest / s, 2) if s else 0.0) for label, s in timed]
    return spark.createDataFrame(rows, "label string, seconds double, speedup double")


def comparisons(
    silver: DataFrame, slim: DataFrame, lookup: DataFrame, year: int = COMPARED_YEAR, hour: int = COMPARED_HOUR
) -> dict[str, dict[str, Callable[[], DataFrame]]]:
    """The runs of all three comparisons. Hints fix the join strategies; adaptive execution stays on."""
    places = places_of(lookup)
    return {
        "caching": {
            "uncached_first": lambda: rate_pass(silver),
            "uncached_again": lambda: rate_pass(silver),
            "cached_first": lambda: rate_pass(slim),
            "cached_again": lambda: rate_pass(slim),
        },
        "join_strategy": {
            "shuffle": lambda: row_shuffle_join(silver, places),
            "broadcast": lambda: join_count(silver, places, broadcast=True),
        },
        "partition_pruning": {
            "full_scan": lambda: hour_count(silver, hour),
            "pruned": lambda: year_count(silver, year),
        },
    }


def compare_layouts(silver: DataFrame, lookup: DataFrame, year: int = COMPARED_YEAR, hour: int = COMPARED_HOUR) -> DataFrame:
    """All three comparisons timed; ``silver`` must be read from its partitioned files."""
    slim = silver.select("merchant_state", "is_fraud").persist()
    try:
        parts = [
            timing_table(silver.sparkSession, runs).select(F.lit(name).alias("comparison"), "*")
            for name, runs in comparisons(silver, slim, lookup, year, hour).items()
        ]
    finally:
        slim.unpersist()
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
