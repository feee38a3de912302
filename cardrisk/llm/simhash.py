"""SimHash near-duplicates: fingerprints as per-segment bit counts, a grid range-join, exact verification.

A fingerprint of 64 bits is cut into 32 segments of two bits; their bit counts are a point whose Manhattan distance from
another point is never above the Hamming distance. Of two points at distance 3 or less, one half of the coordinates
differs by 1 at most. So each half is a grid with cells of side one: a fingerprint stands in its own cell and is also
sent to the cells one count higher, which finds every pair whose halves differ by 1 at most. Pairs that meet are held
against the whole Manhattan distance and then the exact Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.llm.components import components
from cardrisk.llm.rows import ID, ROW, drop_rows, row_hash
from cardrisk.session import materialise

SEED = 42
SHINGLE = 3
#: Shingles whose bits are unpacked at once.
CHUNK = 1 << 16
#: The low bit of each two-bit segment.
LOW = 0x5555555555555555


def fingerprint(text: str | None) -> int:
    """Majority bits of the shingles' hashes, unsigned; zero for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(SHINGLE)], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[i : i + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed 64-bit number) of every row; a null text counts as empty."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for read in batches:
            found = np.array([fingerprint(t.as_py()) for t in read.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([read.column(0), pa.array(found, pa.int64())], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def _counts(fp: Column) -> Column:
    """Bit counts of all 32 segments, two bits each, in one number; at most 2 in a segment, so none overflows."""
    low = F.lit(LOW)
    a, b = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    # a + b without carries between segments: the sum's low bit is a XOR b, its high bit a AND b.
    return a.bitwiseXOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))


def _manhattan(x: Column, y: Column) -> Column:
    """Distance of two packed count points: for each segment the difference of values 0, 1, 2."""
    low = F.lit(LOW)
    x0, x1 = x.bitwiseAND(low), F.shiftrightunsigned(x, 1).bitwiseAND(low)
    y0, y1 = y.bitwiseAND(low), F.shiftrightunsigned(y, 1).bitwiseAND(low)
    odd = x0.bitwiseXOR(y0)
    two = x1.bitwiseXOR(y1).bitwiseAND(F.bitwise_not(odd))
    return F.bit_count(odd) + 2 * F.bit_count(two)


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs a < b of different fingerprints that differ in so many bits at most (3 or fewer).

    ``prints`` has distinct 64-bit ``fp``. The cells of a fingerprint are its own and those with one segment one count
    higher, in either half; the first kind of two equal cells or one of each kind make a candidate pair.
    """
    if not 0 <= distance <= 3:
        raise ValueError("halves differ by 1 at most only for distances up to 3")
    points = prints.select("fp", _counts(F.col("fp")).alias("c"))
    halves = F.array(*[F.struct(F.lit(h).alias("half"), F.shiftrightunsigned(F.col("c"), 32 * h).bitwiseAND(F.lit(0xFFFFFFFF)).alias("cell")) for h in (0, 1)])
    own = points.select("fp", "c", F.inline(halves))
    # One count higher in a segment holding 0 or 1 is plus one at its place: 0 -> 1 and 1 -> 2, without a carry.
    steps = F.array(*[F.lit(1 << (2 * s)).cast("long") for s in range(16)])
    up = own.select("fp", "c", "half", "cell", F.explode(steps).alias("step"))
    up = up.filter(F.col("cell").bitwiseAND(F.col("step") * 2) == 0).select("fp", "c", "half", (F.col("cell") + F.col("step")).alias("cell"))
    left = own.select("half", "cell", F.col("fp").alias("a"), F.col("c").alias("ca"))
    right = own.withColumn("same", F.lit(True)).unionByName(up.withColumn("same", F.lit(False)))
    right = right.select("half", "cell", F.col("fp").alias("b"), F.col("c").alias("cb"), "same")
    near = left.join(right, ["half", "cell"]).filter(~F.col("same") | (F.col("a") < F.col("b")))
    near = near.filter(_manhattan(F.col("ca"), F.col("cb")) <= distance)
    near = near.filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _components(docs: DataFrame, distance: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every row's doc_id and fp, and every fingerprint's component (a number of no meaning) and links, as tables."""
    marked = materialise(fingerprints(docs, id_col, text_col))
    prints = materialise(marked.select("fp").distinct())
    pairs = materialise(links(prints, distance))
    degree = pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("links"))
    # Fingerprints of close texts are close numbers; hashed, they are spread as the contraction wants them.
    roots = components(pairs.select(F.xxhash64("a").alias("ka"), F.xxhash64("b").alias("kb")), "ka", "kb")
    nodes = prints.withColumn("node", F.xxhash64("fp")).join(roots, "node", "left").join(degree, "fp", "left")
    return marked, materialise(nodes.select(
        F.col("fp").alias("_fp"), F.coalesce("root", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links")))


def near_duplicates(docs: DataFrame, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id and links of every row.

    Rows with one fingerprint are one node from the start, so copies are never paired; ``links`` counts the other
    fingerprints that a row's own is linked to. The component is named by its smallest id; null ids take part and a
    component of null ids alone is null. Texts without words have fingerprint zero and link like any other. Repeated
    rows give repeated rows, an empty table gives none; only the two named columns are read.
    """
    marked, named = _components(docs, distance, id_col, text_col)
    firsts = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    ids = named.join(firsts, F.col("_fp") == F.col("fp")).groupBy("component").agg(F.min("first").alias("component_id"))
    named = materialise(named.join(ids, "component").select("_fp", "component_id", "links"))
    return marked.join(named, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "links")


def keep_first(docs: DataFrame, distance: int = 3) -> DataFrame:
    """One row, with all its columns, of each component: the one with the smallest id.

    Of different rows that share that id the one with the smallest content hash stays, and one of rows repeated exactly.
    A row without an id stays only where its component has no other.
    """
    keyed = docs.select(F.struct(F.col("doc_id").alias(ID), row_hash(docs).alias(ROW)).alias("doc_id"), "text")
    marked, named = _components(keyed, distance)
    rows = marked.groupBy("doc_id", "fp").agg(F.count("*").alias("n"))
    rows = materialise(rows.join(named, F.col("fp") == F.col("_fp")).select("doc_id.*", "n", "component"))
    order = F.struct(F.col(ID).isNull().alias("none"), F.col(ID).alias("id"), F.col(ROW).alias("row"))
    first = materialise(rows.groupBy("component").agg(F.min(order).alias("first")).select("component", "first"))
    judged = rows.join(first, "component").withColumn("stays", F.col("first.id").eqNullSafe(F.col(ID)) & (F.col("first.row") == F.col(ROW)))
    judged = materialise(judged.select(ID, ROW, "n", "stays"))
    return drop_rows(docs, judged.filter("not stays").select(ID, ROW), judged.filter("stays and n > 1").select(ID, ROW))
