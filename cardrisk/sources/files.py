"""Batch readers. All schemas are declared; unreadable fields become null, never errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.schemas import (
    CORRUPT_COLUMN,
    RAW_COLUMNS,
    raw_schema,
    verdict_schema,
    zip_schema,
)

CSV_DIALECT = {"header": True, "quote": '"', "escape": '"', "multiLine": False, "mode": "PERMISSIVE"}


def read_raw_csv(
    spark: SparkSession, path: str | Sequence[str], with_corrupt: bool = False
) -> DataFrame:
    """Raw transactions as 16 text columns; each file carries its own header line."""
    reader = spark.read.schema(raw_schema(with_corrupt)).options(**CSV_DIALECT)
    if with_corrupt:
        # A pruned parser would not look at the fields nobody asked for and miss short rows.
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("columnPruning", False)
    return reader.csv(path if isinstance(path, str) else list(path))


def malformed_rows(raw: DataFrame) -> DataFrame:
    """Rows read, rows with a user, and rows without the declared number of fields.

    Spark refuses to count the corrupt column alone, hence the count beside it.
    """
    return raw.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count(RAW_COLUMNS[0]).alias("rows_with_user"),
        F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("malformed_rows"),
    )


def read_zip_lookup(spark: SparkSession, path: str) -> DataFrame:
    lookup = spark.read.schema(zip_schema()).option("header", True).csv(path)
    return lookup.withColumn("zip", F.lpad("zip", 5, "0"))


def read_silver(spark: SparkSession, path: str, row_id: bool = False) -> DataFrame:
    """Cleaned table. ``row_id`` adds file and row position: unique even among exact copies."""
    silver = spark.read.parquet(path)
    if not row_id:
        return silver
    place = F.concat_ws(":", "_metadata.file_path", F.col("_metadata.row_index").cast("string"))
    return silver.select("*", place.alias("row_id"))


def normalise_columns(df: DataFrame, columns: Sequence[str] = RAW_COLUMNS[:-1]) -> DataFrame:
    """Snake-case the headers, add absent columns as null and fix the order."""
    tidy = [name.strip().lower().replace("?", "").replace(" ", "_") for name in df.columns]
    renamed = df.toDF(*tidy)
    return renamed.select(
        *[F.col(c) if c in tidy else F.lit(None).cast("string").alias(c) for c in columns]
    )


def read_verdicts(spark: SparkSession, path: str, event_form: bool = True) -> DataFrame:
    """Verdict JSON lines; lines that do not parse are skipped."""
    return (
        spark.read.schema(verdict_schema(event_form).add("batch_id", T.LongType()))
        .option("mode", "DROPMALFORMED")
        .option("recursiveFileLookup", True)
        .option("ignoreCorruptFiles", True)
        .json(path)
    )


def read_aggregate(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """One of the aggregates that ``write_aggregates`` has written; ``index`` is their manifest."""
    return spark.read.schema(schema).json(f"{root}/file={name}")


def base_rate(spark: SparkSession, root: str) -> float:
    """Share of positives among all transactions, from the dataset summary."""
    schema = "total_transactions bigint, fraud_transactions bigint"
    found = read_aggregate(spark, root, "dataset_summary", schema).first()
    if found is None or not found.total_transactions:
        raise ValueError(f"no dataset summary in {root}")
    return found.fraud_transactions / found.total_transactions


def read_written_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """Verdicts as a scorer leaves them: its Parquet folders by batch, or JSON lines."""
    try:
        table = spark.read.parquet(f"{path}/verdicts")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_verdicts(spark, path)
    return table.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def metrics_bundle(frames: dict[str, DataFrame]) -> DataFrame:
    """Every metrics frame as (section, metric document) rows of one frame."""
    parts = [
        frame.select(F.lit(section).alias("section"), F.to_json(F.struct("*")).alias("document"))
        for section, frame in frames.items()
    ]
    bundle, *rest = parts
    for part in rest:
        bundle = bundle.unionByName(part)
    return bundle
