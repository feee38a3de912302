"""Quality by compression: dictionaries of good and bad text, and the difference of what they save.

Two zstandard dictionaries are built from blocks of labelled text. A whole text is compressed block by block with each;
the difference of the two sizes, divided by the text's bytes, says which dictionary knows it better. A logistic
calibration, fitted on labelled rows that gave no dictionary, turns the difference into a probability. It also sees the
smaller compressed size and the length, since a difference means less in a text of one repeated word or of ten words.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.llm.tokens import forget
from cardrisk.session import materialise

BLOCK = 2048
LEVEL = 3


def blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False,
                                    write_dict_id=False)


def features(text: str | None, good: bytes, bad: bytes) -> tuple[float, float, float]:
    """Size difference per byte, smaller size per byte, logarithm of the bytes; zeros for an empty text."""
    data = (text or "").encode()
    if not data:
        return 0.0, 0.0, 0.0
    by_good, by_bad = _compressor(good), _compressor(bad)
    with_good = with_bad = least = 0
    for block in blocks(data):
        a, b = len(by_good.compress(block)), len(by_bad.compress(block))
        with_good, with_bad, least = with_good + a, with_bad + b, least + min(a, b)
    return (with_bad - with_good) / len(data), least / len(data), float(np.log1p(len(data)))


def _terms(x: np.ndarray) -> np.ndarray:
    """Constant, the features, their squares and products, for columns of about unit size."""
    z = x * np.array([10.0, 2.0, 0.2])
    pairs = [z[:, i] * z[:, j] for i in range(3) for j in range(i, 3)]
    return np.column_stack([np.ones(len(z)), z, *pairs])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 100) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps, each halved until the loss falls; the constant is free."""
    terms = _terms(x)
    penalty = np.full(terms.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(w: np.ndarray) -> float:
        z = terms @ w
        return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(penalty * w * w))

    w = np.zeros(terms.shape[1])
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(terms @ w, -30, 30)))
        slope = terms.T @ (p - y) + penalty * w
        curve = (terms * (p * (1 - p))[:, None]).T @ terms + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-6 and (then := loss(w - size * step)) >= now:
            size /= 2
        if size <= 1e-6:
            break
        w, done = w - size * step, now - then < 1e-9 * max(1.0, now)
        now = then
        if done:
            break
    return w


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and calibration; without both labels, ``constant`` is every text's score."""

    good: bytes = b""
    bad: bytes = b""
    weights: tuple[float, ...] = ()
    constant: float | None = None

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x = np.array([features(t, self.good, self.bad) for t in texts], dtype=float).reshape(-1, 3)
        return 1 / (1 + np.exp(-np.clip(_terms(x) @ np.array(self.weights), -30, 30)))

    def column(self, text: Column) -> Column:
        """The score of each whole text, as an Arrow function."""

        @F.arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            forget()
            return pa.array(self.scores(texts.to_pylist()), pa.float64())

        return score(text)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 16_000, max_blocks: int = 6_000,
        dictionary_bytes: int = 112_640) -> QualityModel:
    """Learn from labelled rows: ``labels`` has doc_id and quality, 1 good and 0 bad; other values are passed over.

    The bound of the fit: the ``max_rows`` labels that come first by a hash of the id (ties included by the sort's
    order), of these half for the dictionaries, with at most ``max_blocks`` blocks of each label from anywhere in the
    texts, and half for the calibration. Only these blocks and three numbers for each row reach the driver. With one
    label missing the score is the share of label 1, or 0.5 without any label.
    """
    known = labels.filter("doc_id is not null and quality in (0, 1)").select(
        F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_good"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id", "_good").limit(max_rows)
    sample = materialise(
        docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .select("_id", "_good", F.coalesce("text", F.lit("")).alias("_text"), (F.xxhash64("_id", F.lit("half")) % 2 == 0).alias("_first"))
    )

    @F.arrow_udf("array<binary>")
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([blocks((t or "").encode()) for t in texts.to_pylist()], pa.list_(pa.binary()))

    pieces = sample.filter("_first").select("_good", F.explode(cut("_text")).alias("_block"))
    dictionaries = []
    for label in (1, 0):
        held = pieces.filter(F.col("_good") == label).orderBy(F.xxhash64("_block"), "_block").limit(max_blocks).collect()
        dictionaries.append(_dictionary([bytes(r["_block"]) for r in held], dictionary_bytes))
    good, bad = dictionaries
    rest = sample.filter("not _first")
    if not good or not bad:
        share = sample.agg(F.avg("_good")).first()[0]
        return QualityModel(constant=0.5 if share is None else float(share))

    @F.arrow_udf("array<double>")
    def measure(texts: pa.Array) -> pa.Array:
        return pa.array([list(features(t, good, bad)) for t in texts.to_pylist()], pa.list_(pa.float64()))

    rows = rest.select("_good", measure("_text").alias("x")).collect()
    if not rows:
        return QualityModel(constant=0.5)
    x, y = np.array([r["x"] for r in rows], dtype=float), np.array([r["_good"] for r in rows], dtype=float)
    return QualityModel(good, bad, tuple(_logistic(x, y)))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; where samples are too few to train on, the samples themselves."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: the checksum of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Labels of held-out ids are never read. A null text counts as empty; empty texts get the score that the calibration
    gives to no bytes. Repeated rows and null ids are scored row by row; only doc_id and text are read.
    """
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows, with all their columns, whose text scores at least the threshold."""
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    return docs.filter(model.column(F.col("text")) >= threshold)
