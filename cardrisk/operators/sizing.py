"""Size-checked joins and exact running totals: the two places where scale needs care."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardrisk.session import materialise

# A dimension row here is at most some hundred bytes, so this stays far below the 8 GB limit
# of a broadcast and within an executor's memory.
MAX_BROADCAST_ROWS = 500_000
# What a dimension of numbers alone may take as a broadcast; its rows are a few dozen bytes.
MAX_BROADCAST_BYTES = 256 << 20
HOT_SHARE = 0.001
SALTS = 64
SKETCHED_PER_KEY = 10
MAX_SLICES = 1000


def fits_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether the dimension has at most ``max_rows`` rows; hand in a materialised one."""
    return dim.count() <= max_rows


def narrow_rows(dim: DataFrame) -> int:
    """How many rows of a dimension with nothing but numbers a broadcast may have: eight bytes a column, and the key's place."""
    return max(MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES // (24 + 8 * len(dim.columns)))


def heavy_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> dict:
    """The keys with more than ``share`` of all rows, and how many rows each has; nulls apart.

    One scan with a frequent-items sketch, merged from the tasks, names every candidate (a key
    beyond the share can't be missed while the sketch tracks some times ``1 / share`` keys),
    a second counts the candidates, so at most ``1 / share`` keys reach the driver.
    """
    most = int(1 / share)
    top = F.call_function("approx_top_k", F.col(key), F.lit(most), F.lit(SKETCHED_PER_KEY * most))
    row = df.agg(F.count(F.lit(1)).alias("rows"), top.alias("top")).first()
    least = row.rows * share
    # The sketch's counts are estimates from above by no more than its error, one part in what it tracks.
    slack = row.rows / (SKETCHED_PER_KEY * most * 0.75)
    candidates = [item.item for item in row.top if item.item is not None and item["count"] > least - slack]
    if not candidates:
        return {}
    counted = df.filter(F.col(key).isin(candidates)).groupBy(key).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[0]: r.n for r in counted if r.n > least}


def _salt(df: DataFrame, spread: Column) -> DataFrame:
    """A salt of its own for each of the rows to spread, in turn; all others share one."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    return df.withColumn("_salt", F.when(spread, salt).otherwise(F.lit(-1)))


def spread_rows(df: DataFrame, key: str, hot: Sequence) -> DataFrame:
    """Rows of the hot keys, and those without a key, under many salts."""
    return _salt(df, F.col(key).isin(list(hot)) | F.col(key).isNull())


def left_join_dim(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    weight: str | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    narrow: bool = False,
) -> DataFrame:
    """Left join to a dimension that is unique on ``on``, by broadcast while it is small.

    When the dimension has outgrown a broadcast the hot keys (more than ``HOT_SHARE`` of the
    facts, so at most ``1 / HOT_SHARE`` of them) are told apart: their dimension rows are
    broadcast, and their fact rows, like those without a key, are spread over salts for the
    shuffle that joins all other keys, so no key fills one task. ``weight`` names the
    dimension's column holding how many fact rows each key has; without one a sketch of the
    facts' keys finds the hot ones, those that the dimension lacks among them. Of a ``narrow``
    dimension, with a few numbers a key, each task of the shuffle hashes its part, so that the
    facts, which are wider and more, are not sorted: sorting them spilled.
    """
    if fits_broadcast(dim, max_rows):
        return df.join(F.broadcast(dim), on, "left")
    payload = [c for c in dim.columns if c != on]
    kept = [F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in payload]]
    if weight is not None:
        total = dim.agg(F.sum(weight)).first()[0]
        is_hot = F.col(weight) > total * HOT_SHARE
        hot, cold = dim.filter(is_hot).select(on, *kept), dim.filter(~is_hot)
    else:
        found = list(heavy_keys(df.select(on), on))
        keys = df.sparkSession.createDataFrame([(k,) for k in found], dim.select(on).schema)
        is_hot = F.col(on).isin(found) if found else F.lit(False)
        hot = keys.join(dim.filter(is_hot), on, "left").select(on, *kept)
        cold = dim.filter(~is_hot)
    salted = _salt(df.join(F.broadcast(hot), on, "left"), F.col("_hot") | F.col(on).isNull())
    cold = cold.withColumn("_salt", F.lit(-1)).hint("shuffle_hash" if narrow else "merge")
    joined = salted.join(cold, [on, "_salt"], "left")
    keep = [c for c in df.columns if c not in payload]
    return joined.select(*keep, *[F.coalesce(f"_hot_{c}", c).alias(c) for c in payload])


def running_totals(
    groups: DataFrame,
    by: str,
    measures: Sequence[str],
    then_by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Adds ``<measure>_upto``: the exact sum over all rows ordered up to and including this one.

    A window without a partition key would put every row in one task. Here rows are cut into
    slices at approximate quantiles of ``by``; sums inside a slice come from a partitioned
    window, sums of the slices before it from a window over the slice totals, which are as
    many rows as there are slices. The cuts only balance the work: the result does not depend
    on them. ``by`` must be a finite double, a null raises; rows equal on it share a slice.
    ``groups`` is read three times, so hand in a materialised frame.
    """
    spark = groups.sparkSession
    absent = F.raise_error(F.lit(f"running totals by {by} need a value in every row")).cast("double")
    groups = groups.withColumn(by, F.coalesce(F.col(by), absent))
    slices = slices or min(MAX_SLICES, max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    at = [i / slices for i in range(1, slices)]
    cuts = sorted(set(groups.approxQuantile(by, at, 1.0 / (4 * slices))))
    splits = [float("-inf"), *(cuts or [0.0]), float("inf")]
    sliced = Bucketizer(splits=splits, inputCol=by, outputCol="_slice").transform(groups)

    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select(
            "_slice",
            *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_{m}_before") for m in measures],
        )
    )
    inside = Window.partitionBy("_slice").orderBy(by, *then_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .select(
            *groups.columns,
            *[(F.col(f"_{m}_before") + F.sum(m).over(inside)).alias(f"{m}_upto") for m in measures],
        )
    )


def exact_quantile(df: DataFrame, value: str, p: float) -> DataFrame:
    """One row, one column: the smallest value that at least ``p`` of the rows do not exceed."""
    present = df.select(F.col(value).cast("double").alias("value")).filter("value IS NOT NULL")
    groups = materialise(present.groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    total = groups.agg(F.sum("n")).first()[0] or 0
    ranked = running_totals(groups, "value", ["n"])
    return ranked.filter(F.col("n_upto") >= p * total).agg(F.min("value").alias(value))
