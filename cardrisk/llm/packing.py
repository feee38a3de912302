"""Packing by power-of-two decomposition.

A document's ids, closed by an end id, are cut into pieces whose lengths are powers of two: as many of the full sequence
length as fit, then the binary digits of the rest, longest first. Each piece is a sequence of its own, so none crosses
documents and none is padded; ``length`` is the bucket from which a trainer draws batches of equal shape.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.llm.tokens import encoder

#: Sequences numbered by one task before the next task's range begins.
TASK_RANGE = 1 << 40
#: Bytes of ids gathered before a batch leaves the worker.
BATCH_BYTES = 8 << 20


def binary_pieces(tokens: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of so many tokens."""
    pieces = [(start, longest) for start in range(0, tokens - longest + 1, longest)]
    start = len(pieces) * longest
    length = longest
    while start < tokens:
        length //= 2
        if tokens - start >= length:
            pieces.append((start, length))
            start += length
    return pieces


def pack(docs: DataFrame, vocabulary_file: str, seq_len: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    ``seq_len`` must be a power of two. A null or empty text is one piece with the end id alone. Repeated rows and null
    ids are packed like any other row; other columns are not read. Sequence ids are unique within a run: a task numbers
    its own pieces inside a range of its own, so no count of all pieces is needed and a task that is run again
    replaces its whole range. An empty table gives no rows.
    """
    if seq_len < 1 or seq_len & (seq_len - 1):
        raise ValueError("seq_len must be a power of two")
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    end = end_id.to_bytes(4, "little")

    def batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        place, start, length, total, sequence, packed = zip(*rows, strict=True)
        columns = [ids.take(pa.array(place, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                   pa.array(total, pa.int64()), pa.array(sequence, pa.int64()), pa.array([0] * len(rows), pa.int64()),
                   pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary_file).encode
        sequence = TaskContext.get().partitionId() * TASK_RANGE
        for read in batches:
            ids, texts = read.column(0), read.column(1)
            rows, held = [], 0
            for place in range(len(texts)):
                packed = encode(texts[place].as_py()) + end
                tokens = len(packed) // 4
                for start, length in binary_pieces(tokens, seq_len):
                    rows.append((place, start, length, tokens, sequence, packed[4 * start : 4 * (start + length)]))
                    sequence += 1
                held += len(packed)
                if held >= BATCH_BYTES:
                    yield batch(ids, rows)
                    rows, held = [], 0
            if rows:
                yield batch(ids, rows)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def piece_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The pieces in a folder for each length, from which batches of equal shape are drawn without padding.

    Pieces are dealt out by length and document, so a length's pieces, however many, are written by many tasks.
    """
    spread = pieces.withColumn("_spread", F.pmod(F.xxhash64("doc_id", "start"), F.lit(64)))
    dealt = spread.hint("rebalance", F.col("length"), F.col("_spread")).drop("_spread")
    dealt.write.mode("overwrite").partitionBy("length").parquet(path)


def read_bucket(spark: SparkSession, path: str, length: int) -> DataFrame:
    """All pieces of one length; no other folder is read."""
    return spark.read.parquet(path).filter(F.col("length") == length)
