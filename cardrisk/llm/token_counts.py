"""Token totals by source, language and tokenizer version, kept by signed deltas.

A batch of changes is held against the ledger of what was counted before; each document that it changes takes away its
old count and adds its new one, and only the sums of these go into the totals. A batch is a folder that a repeated try
overwrites, and counts once its commit record stands; a committed batch is never applied again, and a change that is not
newer than the ledger changes nothing, so neither replays nor late copies count twice.
"""

from __future__ import annotations

import hashlib
import os

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.llm.tokens import encoder

GROUP = ["source", "lang", "tokenizer"]
#: What an event holds; ``op`` is insert, revise or delete, ``version`` orders the events of a document.
EVENT = "doc_id long, tokenizer string, version long, op string, source string, lang string, tokens long"


def count_tokens(text: Column, vocabulary_file: str) -> Column:
    """Ids of each whole text; a null or empty one has none."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        encode = encoder(vocabulary_file).encode
        return pa.array([len(encode(t)) // 4 for t in texts.to_pylist()], pa.int64())

    return count(text)


def tokenizer_version(vocabulary_file: str) -> str:
    """The tokenizer's name with the first 12 digits of its file's SHA-256, so that a changed vocabulary has totals of its own."""
    with open(vocabulary_file, "rb") as held:
        return f"{os.path.splitext(os.path.basename(vocabulary_file))[0]}@{hashlib.file_digest(held, 'sha256').hexdigest()[:12]}"


class TokenRollup:
    """The rollup in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, part: str, schema: str) -> DataFrame:
        """The committed batches of a part of the state."""
        batches = self.committed()
        if not batches:
            return self.spark.createDataFrame([], f"{schema}, batch string")
        paths = [f"{self.root}/{part}/batch={b}" for b in batches]
        return self.spark.read.schema(f"{schema}, batch string").option("basePath", f"{self.root}/{part}").parquet(*paths)

    def committed(self) -> list[str]:
        """Names of the batches that count, in the order of their names."""
        try:
            return sorted(r["name"] for r in self.spark.read.schema("name string").parquet(f"{self.root}/commits").distinct().collect())
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def apply(self, batch: str, events: DataFrame) -> bool:
        """Commit a batch of events (columns of ``EVENT``; others are not read); False if it is committed already.

        A document is known by id and tokenizer; null ids are one document. Of its events in a batch the newest counts,
        of equally new ones the greatest by content, a delete first; so repeated events count once. A delete of an
        unknown document is remembered and counts nothing; a revision of one counts as an insert. Null token counts are
        zero; null sources and languages are groups of their own. Another ``op`` than the three is an error.
        """
        if "/" in batch or "=" in batch or not batch:
            raise ValueError("a batch needs a name that can be a folder's")
        if batch in self.committed():
            return False
        op = F.when(F.col("op").isin("insert", "revise"), True).when(F.col("op") == "delete", False)
        checked = F.coalesce(op, F.raise_error(F.lit("op must be insert, revise or delete")).cast("boolean"))
        content = F.struct(F.col("version").cast("long").alias("version"), (~checked).alias("gone"),
                           F.coalesce(F.col("tokens").cast("long"), F.lit(0).cast("long")).alias("tokens"), "source", "lang")
        newest = events.groupBy("doc_id", "tokenizer").agg(F.max(content).alias("new"))
        ledger = self._read("changes", f"{EVENT.replace('op string', 'gone boolean')}, old_source string, old_lang string, old_tokens long, counted boolean")
        before = ledger.select(F.col("doc_id").alias("_id"), F.col("tokenizer").alias("_tok"), F.struct("version", "gone", "tokens", "source", "lang").alias("old"))
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("tokenizer").eqNullSafe(F.col("_tok"))
        # Ledger rows of documents that the batch doesn't touch are not aggregated.
        before = before.join(newest.select("doc_id", "tokenizer"), same, "left_semi").groupBy("_id", "_tok").agg(F.max("old").alias("old"))
        changed = newest.join(before, same, "left") if self.committed() else newest.withColumn("old", F.lit(None).cast("struct<version:bigint,gone:boolean,tokens:bigint,source:string,lang:string>"))
        changed = changed.filter(F.col("old").isNull() | (F.col("new.version") > F.col("old.version")))
        path = f"{self.root}/changes/batch={batch}"
        changed.select("doc_id", "tokenizer", "new.version", "new.gone", "new.source", "new.lang", "new.tokens",
                       F.col("old.source").alias("old_source"), F.col("old.lang").alias("old_lang"), F.col("old.tokens").alias("old_tokens"),
                       F.coalesce(~F.col("old.gone"), F.lit(False)).alias("counted")).write.mode("overwrite").parquet(path)
        written = self.spark.read.parquet(path)
        plus = written.filter("not gone").select(*GROUP, F.lit(1).alias("docs"), "tokens")
        minus = written.filter("counted").select(F.col("old_source").alias("source"), F.col("old_lang").alias("lang"), "tokenizer", F.lit(-1).alias("docs"), (-F.col("old_tokens")).alias("tokens"))
        deltas = plus.unionByName(minus).groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        deltas.write.mode("overwrite").parquet(f"{self.root}/deltas/batch={batch}")
        self.spark.createDataFrame([(batch,)], "name string").write.mode("overwrite").parquet(f"{self.root}/commits/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs and tokens over all committed batches, without groups that hold no document."""
        deltas = self._read("deltas", "source string, lang string, tokenizer string, docs long, tokens long")
        return deltas.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 or tokens <> 0")
