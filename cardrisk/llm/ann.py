"""Approximate nearest neighbours by inner product over balanced posting lists.

A bounded sample of the vectors is halved again and again at the median of its widest direction, which gives lists of
equal size; their means are the centroids. Inner products become distances by one more coordinate that brings every
vector to one length. A vector goes to its nearest list and, near a boundary, to every other list whose centroid is
within a ratio of that distance. A query walks a neighbour graph of the centroids, held in memory by each task, and
reads the lists within its own ratio; that ratio is the smallest that reaches the asked recall on some queries whose
exact neighbours among all rows are found first, in one pass.

A query reads its nearest list first, then ever more at a time. After each turn the last score that still counts bounds
what later lists need to answer, and a list is passed over if its centroid and radius keep all its vectors below that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardrisk.session import discard, materialise

#: Distinct vectors, or queries, that one task holds of a list at a time.
BLOCK = 2_048
#: How many times as many lists each turn of a search has read after it than before.
TURN = 4


@dataclass
class ListIndex:
    """Centroids, their neighbour graph, the greatest norm, and the two distance ratios."""

    centroids: np.ndarray
    graph: np.ndarray
    norm: float
    copy_ratio: float
    read_ratio: float
    most_copies: int

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Unit-scaled vectors with the coordinate that makes distances order inner products; 0 for queries."""
        x = np.asarray(x, dtype=np.float64)
        if query:
            return np.hstack([x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300), np.zeros((len(x), 1))])
        x = x / self.norm
        return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))])

    def nearest(self, x: np.ndarray, ratio: float, least: int = 1, most: int | None = None, block: int = 256) -> list[np.ndarray]:
        """Lists of each lifted vector, nearest first: all that the walk meets within the ratio, ``least`` in any case."""
        return [found for i in range(0, len(x), block) for found in self._walk(x[i : i + block], ratio, least, most)]

    def _walk(self, x: np.ndarray, ratio: float, least: int, most: int | None) -> list[np.ndarray]:
        """Best-first search of the graph for some vectors at once.

        Each opens the neighbours of the nearest centroid that it has met, and of all within the ratio, until none is left.
        """
        square = (x * x).sum(axis=1)
        own = (self.centroids**2).sum(axis=1)
        distance = np.full((len(x), len(self.centroids)), np.inf)
        opened = np.zeros(distance.shape, dtype=bool)
        first = np.linspace(0, len(self.centroids) - 1, min(16, len(self.centroids))).astype(np.int64)
        distance[:, first] = square[:, None] + own[first] - 2 * x @ self.centroids[first].T
        while True:
            best = distance.min(axis=1)
            rows, nodes = np.nonzero(~opened & (distance <= best[:, None] * ratio**2))
            if not len(rows):
                break
            opened[rows, nodes] = True
            fresh = np.zeros(distance.shape, dtype=bool)
            fresh[np.repeat(rows, self.graph.shape[1]), self.graph[nodes].ravel()] = True
            rows, nodes = np.nonzero(fresh & np.isinf(distance))
            met = square[rows] + own[nodes] - 2 * np.einsum("ij,ij->i", x[rows], self.centroids[nodes])
            distance[rows, nodes] = np.maximum(met, 0)
        best = distance.min(axis=1)
        within = (distance <= best[:, None] * ratio**2).sum(axis=1)
        order = np.argsort(distance, axis=1, kind="stable")
        counts = np.minimum(np.maximum(within, least), np.isfinite(distance).sum(axis=1))
        return [row[:n][:most] for row, n in zip(order, counts.tolist(), strict=True)]


def _halve(x: np.ndarray, rows: np.ndarray, target: int, rng: np.random.Generator, out: list[np.ndarray]) -> None:
    """Rows cut at the median along a direction between two spread means, until parts are small enough."""
    if len(rows) <= target:
        out.append(rows)
        return
    part = x[rows]
    a, b = part[rng.choice(len(part), 2, replace=False)]
    for _ in range(8):
        near = ((part - a) ** 2).sum(1) < ((part - b) ** 2).sum(1)
        if near.all() or not near.any():
            break
        a, b = part[near].mean(0), part[~near].mean(0)
    order = np.argsort(part @ (a - b), kind="stable")
    middle = len(order) // 2
    _halve(x, rows[order[:middle]], target, rng, out)
    _halve(x, rows[order[middle:]], target, rng, out)


def fit(sample: np.ndarray, rows: int, list_rows: int = 256, most_lists: int = 2_048, copy_ratio: float = 1.02,
        most_copies: int = 3, neighbours: int = 16, norm: float = 1.0, seed: int = 3) -> ListIndex:
    """An index for ``rows`` vectors from a sample of them; ``norm`` is the greatest norm of all vectors.

    Lists have about ``list_rows`` vectors, but at least eight of the sample, and there are about ``most_lists`` at most.
    Its reading ratio is yet to be set.
    """
    rng = np.random.default_rng(seed)
    index = ListIndex(np.zeros((1, 1)), np.zeros((1, 0), np.int64), max(norm, 1e-300), copy_ratio, 1.0, most_copies)
    lifted = index.lift(sample)
    lists = int(np.clip(-(-rows // list_rows), 1, most_lists))
    parts: list[np.ndarray] = []
    _halve(lifted, np.arange(len(lifted)), max(8, -(-len(lifted) // lists)), rng, parts)
    index.centroids = np.array([lifted[p].mean(axis=0) for p in parts])
    square = (index.centroids**2).sum(1)
    gaps = square[:, None] + square[None, :] - 2 * index.centroids @ index.centroids.T
    np.fill_diagonal(gaps, np.inf)
    count = min(neighbours, len(parts) - 1)
    near = np.argsort(gaps, axis=1)[:, :count]
    # A ring through all lists keeps the graph in one piece.
    ring = (np.arange(len(parts)) + 1) % len(parts)
    index.graph = np.hstack([near, ring[:, None], np.argsort(ring)[:, None]])
    return index


def read_ratio(index: ListIndex, queries: np.ndarray, held: list[tuple[int, list[int]]], recall: float) -> float:
    """The smallest ratio at which so large a share of (query, lists of one of its neighbours) is read."""
    x = index.lift(queries, query=True)
    square = (x * x).sum(1)[:, None] + (index.centroids**2).sum(1) - 2 * x @ index.centroids.T
    distance = np.sqrt(np.maximum(square, 1e-24))
    needed = np.sort([distance[q, lists].min() / distance[q].min() for q, lists in held])
    # Distances are met again in another order of sums.
    return float(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) * (1 + 1e-9) if len(needed) else 1.0


def _true_neighbours(postings: DataFrame, index: ListIndex, keys: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, list[int]]]:
    """(query, lists) of the k nearest other vectors of each of some queries, over all postings.

    Each task keeps its best ``k`` for every query, so that its output is bounded however many rows it reads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros((len(queries), 0)), np.zeros((len(queries), 0), np.int64)]
        kept: dict[int, np.ndarray] = {}
        for read in batches:
            own = read.column(0).to_numpy()
            x = read.column(1).flatten().to_numpy().reshape(len(own), -1)
            scores = queries @ x.T
            scores[keys[:, None] == own[None, :]] = -np.inf
            most = min(k, len(own))
            top = np.argpartition(-scores, most - 1, axis=1)[:, :most]
            kept |= {int(own[j]): x[j] for j in np.unique(top)}
            scores = np.hstack([best[0], np.take_along_axis(scores, top, 1)])
            named = np.hstack([best[1], own[top]])
            top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            best = [np.take_along_axis(scores, top, 1), np.take_along_axis(named, top, 1)]
            wanted = set(best[1].ravel().tolist())
            kept = {key: v for key, v in kept.items() if key in wanted}
        names = list(kept)
        if names:
            lists = index.nearest(index.lift(np.stack([kept[n] for n in names])), index.copy_ratio, most=index.most_copies)
            place = {n: x.tolist() for n, x in zip(names, lists, strict=True)}
            rows, columns = np.nonzero(np.isfinite(best[0]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows.astype(np.int32)), pa.array(best[0][rows, columns]), pa.array(best[1][rows, columns]),
                 pa.array([place[n] for n in best[1][rows, columns].tolist()], pa.list_(pa.int64()))], names=["q", "score", "key", "lists"])

    found = postings.select("key", "v").mapInArrow(run, "q int, score double, key long, lists array<long>")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "key")
    found = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)
    return [(r["q"], list(r["lists"])) for r in found.select("q", "lists").collect()]


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (array of doubles): vectors that are not null, empty or zero and hold finite numbers only."""
    v = F.col("v")
    plain = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & v.isNotNull() & plain)


def _postings(usable: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The ids with the key of their vector; and key, v and ids of each distinct vector, as written tables.

    Of a vector's ids the k + 1 smallest are kept, which are all that a result can name. They are found in steps over
    ever fewer salts, so that no task holds a vector's every row, and without the vectors themselves.
    """
    keyed = usable.select("id", "v", F.xxhash64("v").alias("key"))
    ids = materialise(keyed.groupBy("id").agg(F.min("key").alias("key")))
    salted = ids.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(512)))
    for salts in (512, 16, 1):
        salted = salted.withColumn("salt", F.pmod("salt", F.lit(salts)))
        order = Window.partitionBy("key", "salt").orderBy("id")
        salted = salted.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1).drop("_n")
    first = salted.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    vectors = keyed.groupBy("key").agg(F.min("v").alias("v"))
    return ids, materialise(vectors.join(first, "key"))


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", fit_rows: int = 16_384,
           tuned: int = 256, recall: float = 0.95, **options) -> DataFrame:
    """query_id, rank, vec_id and score: of each query its k nearest other rows by inner product.

    ``is_query`` is a condition on ``id``. The index is fitted on at most about ``fit_rows`` distinct vectors drawn by
    hash and holds every row; ``tuned`` query vectors, first by hash, are held against all rows to set the reading ratio
    for ``recall``. These and ``most_lists`` bound what each task gets in memory. Rows with one vector are one posting
    with their smallest ids; queries with one vector are searched once. Lists are read in blocks, however long. Null ids
    and vectors that are null, zero or not finite take part on neither side; of rows that repeat an id one vector counts,
    that with the least hash. Ties go to the smaller id. Vectors of different widths are an error (ValueError). Only the
    two named columns are read.
    """
    ids, postings = _postings(_usable(vectors, id_col, vector_col), k)
    total, norm, narrow, width = postings.agg(
        F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))), F.min(F.size("v")), F.max(F.size("v"))).first()
    asked = materialise(ids.filter(is_query))
    queries = materialise(postings.join(asked.select("key").distinct(), "key", "left_semi").select("key", "v"))
    tuning = queries.orderBy(F.xxhash64("key", F.lit("tune")), "key").limit(tuned).toArrow()
    if not len(tuning):
        return asked.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    if narrow != width:
        raise ValueError("vectors have different numbers of components")
    part = min(1.0, fit_rows / total)
    drawn = postings.filter(F.pmod(F.xxhash64("key", F.lit("fit")), F.lit(1_000_000)) < F.lit(part * 1_000_000)).select("v").toArrow()["v"].combine_chunks().flatten()
    sample = (drawn.to_numpy() if len(drawn) else np.array(postings.first()["v"])).reshape(-1, width)
    index = fit(sample, total, norm=norm, **options)
    tuning = tuning["key"].to_numpy(), tuning["v"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    index.read_ratio = read_ratio(index, tuning[1], _true_neighbours(postings, index, *tuning, k), recall)

    def place(query: bool):
        """Lists of each vector, nearest first, and for each how far its centroid is: the distance, or a query's product with it."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for read in batches:
                v = read.column(1).flatten().to_numpy().reshape(len(read), -1)
                x = index.lift(v, query)
                lists = index.nearest(x, index.read_ratio) if query else index.nearest(x, index.copy_ratio, most=index.most_copies)
                if query:
                    scale = np.linalg.norm(v, axis=1) * index.norm
                    far = [(index.centroids[y] @ x[i]) * scale[i] for i, y in enumerate(lists)]
                else:
                    scale = np.ones(len(v))
                    far = [np.linalg.norm(index.centroids[y] - x[i], axis=1) for i, y in enumerate(lists)]
                told = [[{"list": int(n), "far": float(d)} for n, d in zip(y, z, strict=True)] for y, z in zip(lists, far, strict=True)]
                yield pa.RecordBatch.from_arrays([read.column(0), pa.array(scale), pa.array(told, pa.list_(at))], names=["key", "scale", "lists"])

        at = pa.struct([("list", pa.int64()), ("far", pa.float64())])
        return run

    shape = "key long, scale double, lists array<struct<list: long, far: double>>"
    told = materialise(postings.select("key", "v").mapInArrow(place(False), shape).select("key", F.inline("lists")))
    reads = materialise(queries.mapInArrow(place(True), shape).select("key", "scale", F.posexplode("lists").alias("at", "x")).select("key", "scale", "at", "x.*"))
    # Lists in blocks: as many as keep a block near BLOCK rows, dealt by hash.
    deal = lambda name: F.greatest(F.lit(1), F.ceil(F.col(name) / BLOCK)).cast("int")
    sizes = told.groupBy("list").agg(F.count("*").alias("np"), F.max("far").alias("radius")).join(reads.groupBy("list").agg(F.count("*").alias("nq")), "list")
    sizes = F.broadcast(materialise(sizes.select("list", "radius", deal("np").alias("p"), deal("nq").alias("q"))))
    side = lambda rows, own, other: rows.join(sizes, "list").select(
        "key", "list", F.pmod(F.xxhash64("key"), F.col(own)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other))
    held = side(told.select("key", "list"), "p", "q").join(postings.select("key", "v", "ids"), "key")

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"q": np.zeros(0, np.int64), "ids": pd.Series([], dtype=object), "score": np.zeros(0)})
        x, y = np.stack(left["v"].to_list()), np.stack(right["v"].to_list())
        products = x @ y.T
        most = min(k + 1, len(y))
        # All at the last kept score stay, so that a tie is settled by ids later on.
        least = np.maximum(np.partition(products, len(y) - most, axis=1)[:, len(y) - most], left["bound"].to_numpy())
        # Matrix products round by the block's shape; the scores told are summed row by row.
        rows, columns = np.nonzero(products >= least[:, None] - 1e-9 * np.abs(products).max())
        exact = (x[rows] * y[columns]).sum(axis=1)
        return pd.DataFrame({"q": left["key"].to_numpy()[rows], "ids": pd.Series([right["ids"].iat[j].tolist() for j in columns], dtype=object), "score": exact})

    def found(lists: DataFrame, asking: DataFrame) -> DataFrame:
        """key, score and vec_id of what the lists hold for their queries, above each query's bound."""
        want = side(lists, "q", "p").join(asking, "key")
        near = want.groupBy("list", "p", "q").cogroup(held.groupBy("list", "p", "q")).applyInPandas(score, "q long, ids array<long>, score double")
        return near.select(F.col("q").alias("key"), "score", F.explode("ids").alias("vec_id"))

    # The nearest list gives each query a bound; each turn reads TURN times as many lists as before, and tightens it.
    deepest = reads.agg(F.max("at")).first()[0]
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    start, stop, near = 0, 1, None
    while start <= deepest:
        bounds = queries.withColumn("bound", F.lit(float("-inf")))
        if near is not None:
            last = near.filter(F.col("n") == k + 1).select("key", F.col("score").alias("bound"))
            bounds = queries.join(last, "key", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
        turn = reads.filter(F.col("at").between(start, stop - 1)).join(sizes.select("list", "radius"), "list").join(bounds.select("key", "bound"), "key")
        # No vector of a list has a product above its centroid's and the radius together; the rest is room for rounding.
        turn = turn.filter(F.col("far") + F.col("scale") * (F.col("radius") + 1e-9) >= F.col("bound"))
        fresh = found(turn.select("key", "list"), bounds)
        fresh = fresh if near is None else near.select("key", "score", "vec_id").unionByName(fresh)
        once = fresh.groupBy("key", "vec_id").agg(F.max("score").alias("score"))
        best = materialise(once.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1))
        if near is not None:
            discard(near)
        near = best
        start, stop = stop, stop * TURN
    lists = near.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("found"))
    others = asked.join(lists, "key").select("id", F.filter("found", lambda x: x["vec_id"] != F.col("id")).alias("found"))
    return others.select(F.col("id").alias("query_id"), F.posexplode(F.slice("found", 1, k)).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
