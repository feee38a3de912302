"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into passages of words; their TF-IDF matrix over hashed words is reduced by a randomised SVD whose
products run in tasks. In the whitened latent space a passage's vector is a sum over its words, so windows of any length
are sums of block sums. Windows whose cosine to a benchmark item reaches a threshold are candidates, which the longest
common subsequence of words confirms: most of the item in order, or a good part of it together with its answer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.session import discard, materialise

#: Words of one block; windows start at blocks.
BLOCK = 8
#: Words of a passage, the row of the TF-IDF matrix.
PASSAGE = 32
#: Window lengths in blocks. Longer items are cut into pieces of the longest.
SHORTEST, LONGEST = 1, 8
#: Hashed words of the latent space; the last row of its table, beyond them, is zero and pads.
TERMS = 1 << 15
#: Words whose latent rows are gathered at once.
CHUNK = 1 << 14
#: Passages cut, projected and summed up by words at once, and the words of one part of a product.
PASSAGES_AT_ONCE, PROJECTED_AT_ONCE, SUMMED_AT_ONCE, TERMS_OF_BLOCK = 2048, 64, 1 << 15, 1024

#: ASCII punctuation and control characters to spaces.
_APART = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of a whole text's words: lower case, parted by white space and ASCII punctuation."""
    words = (text or "").lower().encode().translate(_APART).split()
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))


@dataclass(frozen=True)
class LeakRule:
    """When a passage leaks an item: so much of its words in order, or less of them with its answer."""

    copied: float = 0.8
    paraphrased: float = 0.6
    #: The answer is the item's ``answer`` column where there is one, else its last words, so many of them.
    answer_words: int = 5
    answer_kept: float = 0.8


@dataclass
class Piece:
    """A benchmark item, or a piece of a long one, with bit masks of its words' places."""

    item: int
    words: list[int]
    answer: list[int]
    blocks: int
    masks: dict[int, int]
    answer_masks: dict[int, int]


def _masks(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for place, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << place
    return masks


def common_words(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence, one step of whole-number bit operations for each word."""
    full = (1 << size) - 1
    row = full
    for word in words:
        hit = row & masks.get(word, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def pieces_of(items: list[tuple[str | None, str | None]], rule: LeakRule) -> list[Piece]:
    """The pieces of (text, answer) pairs; items without words have none and are never found."""
    found = []
    for item, (text, answer) in enumerate(items):
        words = word_hashes(text).tolist()
        told = word_hashes(answer).tolist() or words[-rule.answer_words :]
        count = -(-len(words) // (BLOCK * LONGEST))
        for k in range(count):
            part = words[k * len(words) // count : (k + 1) * len(words) // count]
            blocks = min(LONGEST, max(SHORTEST, round(len(part) / BLOCK)))
            found.append(Piece(item, part, told, blocks, _masks(part), _masks(told)))
    return found


def _passages(docs: DataFrame) -> DataFrame:
    """All passages of all documents, as arrays of hashed words."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: list[np.ndarray]) -> pa.RecordBatch:
            sizes = np.array([len(terms) for terms in held], dtype=np.int64)
            # Where passages start: every PASSAGE words of a text, and at its end.
            ends = np.concatenate([np.append(np.arange(PASSAGE, n, PASSAGE), n) + before for n, before in zip(sizes, np.cumsum(sizes) - sizes, strict=True)])
            flat = (np.concatenate(held) % TERMS).astype(np.int32)
            terms = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat))
            return pa.RecordBatch.from_arrays([terms], names=["terms"])

        held, size = [], 0
        for read in batches:
            for text in read.column(0):
                hashes = word_hashes(text.as_py())
                if len(hashes):
                    held.append(hashes)
                    size += len(hashes)
                if size >= PASSAGES_AT_ONCE * PASSAGE:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    return docs.select(F.col("text").cast("string")).mapInArrow(cut, "terms array<int>")


def _sorted_passages(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[np.ndarray]:
    """The words of about so many passages at a time, a row for each, sorted; short rows end with the pad's number."""
    held, size = [], 0
    for read in batches:
        for part in (read.column(0).slice(i, most) for i in range(0, read.num_rows, most)):
            sizes = np.asarray(part.value_lengths())
            terms = np.full((len(sizes), PASSAGE), TERMS, dtype=np.int32)
            terms[np.arange(PASSAGE) < sizes[:, None]] = part.flatten().to_numpy()
            terms.sort(axis=1)
            held.append(terms)
            size += len(terms)
            if size >= most:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _distinct(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct word of each sorted passage, among all places, and how often it is there."""
    starts = np.ones(terms.shape, dtype=bool)
    starts[:, 1:] = terms[:, 1:] != terms[:, :-1]
    starts = np.flatnonzero(starts)
    return starts, np.diff(np.append(starts, terms.size))


def _word_statistics(docs: DataFrame, passages: DataFrame | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """In how many passages of all documents each hashed word occurs, how often it does, and how many passages there are.

    ``passages`` are the documents' own, where they are already cut.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, told, cut = np.zeros(TERMS + 1, dtype=np.int64), np.zeros(TERMS + 1, dtype=np.int64), 0
        for terms in _sorted_passages(batches, PASSAGES_AT_ONCE):
            seen += np.bincount(terms.ravel()[_distinct(terms)[0]], minlength=TERMS + 1)
            told += np.bincount(terms.ravel(), minlength=TERMS + 1)
            cut += len(terms)
        terms = np.flatnonzero(seen[:TERMS])
        columns = [pa.array([-1, *terms], pa.int32()), pa.array([cut, *seen[terms]], pa.int64()), pa.array([0, *told[terms]], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "n", "words"])

    counted = (_passages(docs) if passages is None else passages).mapInArrow(count, "term int, n long, words long")
    rows = counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect()
    frequencies, occurrences, number = np.zeros(TERMS), np.zeros(TERMS), 0
    for row in rows:
        if row["term"] >= 0:
            frequencies[row["term"]], occurrences[row["term"]] = row["n"], row["words"]
        else:
            number = int(row["n"])
    return frequencies, occurrences, number


def _projected(terms: np.ndarray, weights: np.ndarray, weighted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted passages times the weighted basis, and the squared lengths of their rows; both tables end with the pad's zeros."""
    rows = np.empty((len(terms), weighted.shape[1]), dtype=np.float32)
    for i in range(0, len(terms), PROJECTED_AT_ONCE):
        part = terms[i : i + PROJECTED_AT_ONCE]
        np.add.reduce(np.take(weighted, part.ravel(), axis=0).reshape(*part.shape, -1), axis=1, out=rows[i : i + PROJECTED_AT_ONCE])
    starts, counts = _distinct(terms)
    values = counts * weights[terms.ravel()[starts]]
    return rows, np.maximum(np.bincount(starts // PASSAGE, values * values, minlength=len(terms)), 1e-18)


def _summed(passages: DataFrame, multiply, height: int, wide: int) -> np.ndarray:
    """The sum of the tasks' matrices of this size, by blocks of rows in a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = multiply(batches)
        blocks = [total[i : i + TERMS_OF_BLOCK].astype(np.float32).tobytes() for i in range(0, height, TERMS_OF_BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], names=["block", "m"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(m.as_py(), dtype=np.float32).astype(np.float64) for m in table.column("m"))
        return pa.table({"block": table.column("block").slice(0, 1), "m": pa.array([total.tobytes()], pa.binary())})

    result = np.zeros((height, wide))
    # A task's part is as large as the whole result, so there is one for each core, however many files there are.
    dealt = passages.coalesce(passages.sparkSession.sparkContext.defaultParallelism)
    for row in dealt.mapInArrow(run, "block int, m binary").groupBy("block").applyInArrow(add, "block int, m binary").collect():
        at = row["block"] * TERMS_OF_BLOCK
        result[at : at + TERMS_OF_BLOCK] = np.frombuffer(row["m"], dtype=np.float64).reshape(-1, wide)
    return result


def _tables(weights: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.append(weights, 0.0), np.vstack([basis * weights[:, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)


def _gram_product(passages: DataFrame, weights: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'A times the basis, A being the passages' TF-IDF matrix with rows of unit length, summed by blocks of words."""
    wide = basis.shape[1]
    padded, weighted = _tables(weights, basis)

    def multiply(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((TERMS + 1, wide), dtype=np.float64)
        for terms in _sorted_passages(batches, SUMMED_AT_ONCE):
            rows, squares = _projected(terms, padded, weighted)
            rows /= squares[:, None].astype(np.float32)
            # The rows of each word's passages are summed word by word.
            flat = terms.ravel().astype(np.uint16)
            order = np.argsort(flat, kind="stable")
            ordered, place = flat[order], order // PASSAGE
            first = np.flatnonzero(np.diff(ordered, prepend=-1))
            for term, start, end in zip(ordered[first].tolist(), first.tolist(), [*first[1:].tolist(), len(ordered)], strict=True):
                if term < TERMS:
                    total[term] += np.add.reduce(np.take(rows, place[start:end], axis=0), axis=0)
        return total[:TERMS] * weights[:, None]

    return _summed(passages, multiply, TERMS, wide)


def _gram_within(passages: DataFrame, weights: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The basis' transpose times A'A times the basis: the products of the projected passages, one small matrix a task."""
    wide = basis.shape[1]
    padded, weighted = _tables(weights, basis)

    def multiply(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((wide, wide), dtype=np.float64)
        for terms in _sorted_passages(batches, PASSAGES_AT_ONCE):
            rows, squares = _projected(terms, padded, weighted)
            rows /= np.sqrt(squares)[:, None].astype(np.float32)
            total += rows.T @ rows
        return total

    return _summed(passages, multiply, wide, wide)


def fit_space(docs: DataFrame, rank: int = 96, rounds: int = 0, common: float = 0.01, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The latent table (a row for each hashed word, then a row of zeros) and how often each hashed word occurs.

    Both cover all passages of all documents; words in more than a share ``common`` of the passages weigh a tenth. The
    passages make the matrix of the randomised SVD; its range finder, ``rounds`` power iterations and the projection
    each run as one distributed product. A word's whitened row is brought to unit length and weighted by its inverse
    frequency, so that rare words, which a low rank keeps least of, still tell passages apart. Only one table of hashed
    words by rank reaches the driver for each product.
    """
    passages = materialise(_passages(docs))
    frequencies, occurrences, count = _word_statistics(docs, passages)
    weights = np.log((count + 1) / (frequencies + 1)) * np.where(frequencies > common * count, 0.1, 1)
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.normal(size=(TERMS, rank)))[0]
    for _ in range(rounds + 1):
        basis = np.linalg.qr(_gram_product(passages, weights, basis))[0]
    values, vectors = np.linalg.eigh(_gram_within(passages, weights, basis))
    discard(passages)
    latent = basis @ vectors / np.sqrt(np.maximum(values, max(values[-1], 1e-9) * 1e-9))
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    return np.vstack([latent * weights[:, None], np.zeros((1, rank))]).astype(np.float32), occurrences


@dataclass
class LeakFinder:
    """The latent table, the items' pieces by window length, and the cosine that makes a candidate."""

    table: np.ndarray
    pieces: list[Piece]
    cosine: dict[int, float]
    rule: LeakRule

    def __post_init__(self):
        vectors = np.array([self.table[np.array(p.words, dtype=np.int64) % TERMS].sum(axis=0) for p in self.pieces], dtype=np.float32)
        norms = np.linalg.norm(vectors, axis=1, keepdims=True) if len(vectors) else vectors
        self._by_blocks = {}
        for blocks in range(SHORTEST, LONGEST + 1):
            which = [i for i, p in enumerate(self.pieces) if p.blocks == blocks]
            if which:
                self._by_blocks[blocks] = (np.array(which), (vectors[which] / np.maximum(norms[which], 1e-9)).T.copy())

    def search(self, texts: list[str | None]) -> list[list[dict]]:
        """For each whole text the items that it leaks, each at its best window."""
        found: list[dict[int, dict]] = [{} for _ in texts]
        held, size = [], 0
        for place, text in enumerate(texts):
            words = word_hashes(text)
            # A long text goes in chunks that overlap by the longest window.
            for start in range(0, max(len(words), 1), CHUNK):
                part = words[start : start + CHUNK + BLOCK * LONGEST]
                if len(part):
                    held.append((place, start, words, part))
                    size += len(part) + BLOCK * LONGEST
                if size >= CHUNK:
                    self._chunk(held, found)
                    held, size = [], 0
        if held:
            self._chunk(held, found)
        return [sorted(x.values(), key=lambda r: r["item"]) for x in found]

    def _chunk(self, held: list[tuple], found: list[dict[int, dict]]) -> None:
        """Candidates of some texts' chunks: zero blocks after each let windows run past its end."""
        terms, owner, base = [], [], []
        for k, (_, _, _, part) in enumerate(held):
            blocks = -(-len(part) // BLOCK) + LONGEST
            padded = np.full(blocks * BLOCK, TERMS, dtype=np.int64)
            padded[: len(part)] = part % TERMS
            terms.append(padded)
            base.append(len(owner))
            owner += [k] * blocks
        flat = np.concatenate(terms)
        sums = np.take(self.table, flat, axis=0).reshape(len(owner), BLOCK, -1).sum(axis=1)
        window = np.zeros_like(sums)
        for blocks in range(1, max(self._by_blocks, default=0) + 1):
            # A longer window starts at the same block and takes in one more.
            window = window[: len(sums) - blocks + 1] + sums[blocks - 1 :]
            if blocks not in self._by_blocks:
                continue
            which, vectors = self._by_blocks[blocks]
            norms = np.maximum(np.sqrt(np.einsum("ij,ij->i", window, window)), np.float32(1e-6))
            products = window @ vectors
            hits = np.flatnonzero(products >= (norms * np.float32(self.cosine.get(blocks, 0.5)))[:, None])
            at, columns = np.divmod(hits, len(which))
            for j in np.unique(columns):
                piece = self.pieces[which[j]]
                for block in self._plausible(piece, flat, at[columns == j]):
                    place, start, words, _ = held[owner[block]]
                    self._verify(found[place], piece, words, start + (block - base[owner[block]]) * BLOCK, float(products[block, j] / norms[block]))

    def _room(self, piece: Piece) -> int:
        return BLOCK + len(piece.words) // 4

    def _need(self, piece: Piece) -> float:
        return min(self.rule.copied, self.rule.paraphrased) * len(piece.words)

    def _plausible(self, piece: Piece, flat: np.ndarray, at: np.ndarray) -> list[int]:
        """Of the windows starting at some blocks those with enough words that the piece has too, in any order."""
        own = np.zeros(TERMS + 1, dtype=np.int32)
        own[np.array(piece.words, dtype=np.int64) % TERMS] = 1
        seen = np.concatenate([[0], np.cumsum(own[flat])])
        low = np.maximum(0, at * BLOCK - self._room(piece))
        high = np.minimum(len(flat), (at + piece.blocks) * BLOCK + self._room(piece))
        return at[seen[high] - seen[low] >= self._need(piece)].tolist()

    def _verify(self, kept: dict[int, dict], piece: Piece, words: np.ndarray, start: int, cosine: float) -> None:
        size = len(piece.words)
        low = max(0, start - self._room(piece))
        region = words[low : start + piece.blocks * BLOCK + self._room(piece)].tolist()
        if sum(w in piece.masks for w in region) < self._need(piece):
            return
        share = common_words(piece.masks, size, region) / size
        kind = "copy" if share >= self.rule.copied else None
        if kind is None and share >= self.rule.paraphrased and piece.answer:
            told = len(piece.answer)
            if common_words(piece.answer_masks, told, region) >= self.rule.answer_kept * told:
                kind = "paraphrase"
        if kind and (piece.item not in kept or kept[piece.item]["share"] < share):
            kept[piece.item] = {"item": piece.item, "kind": kind, "share": share, "cosine": cosine, "start": start}

    def column(self, text: Column) -> Column:
        """The leaks of each whole text: array of item (place in the block of items), kind, share, cosine, start."""
        kind = pa.list_(pa.struct([("item", pa.int32()), ("kind", pa.string()), ("share", pa.float64()), ("cosine", pa.float64()), ("start", pa.int64())]))

        @F.arrow_udf("array<struct<item:int,kind:string,share:double,cosine:double,start:bigint>>")
        def leaks(texts: pa.Array) -> pa.Array:
            return pa.array(self.search(texts.to_pylist()), kind)

        return leaks(text)


def calibrate(finder: LeakFinder, occurrences: np.ndarray, recall: float = 0.95, replaced: float = 0.2, turns: int = 8, seed: int = 5) -> dict[int, float]:
    """For each window length the cosine that so many planted windows reach.

    A planted window is an item moved by up to half a block into random words, some of its words replaced; random words
    come as often as all documents have them. A passage falls into several windows, so a document's chance is better than one window's.
    """
    rng = np.random.default_rng(seed)
    upto = np.cumsum(occurrences)
    told = upto[-1]

    def draw(n: int) -> np.ndarray:
        return np.searchsorted(upto, rng.random(n) * told, side="right")

    found = {}
    for blocks, (which, _) in finder._by_blocks.items():
        reached = []
        for piece in (finder.pieces[i] for i in which):
            own = np.array(piece.words, dtype=np.int64) % TERMS
            target = finder.table[own].sum(axis=0)
            for _ in range(turns if told else 0):
                changed = own.copy()
                swap = rng.random(len(own)) < replaced
                changed[swap] = draw(swap.sum())
                window = np.concatenate([draw(rng.integers(0, BLOCK // 2 + 1)), changed])[: blocks * BLOCK]
                window = np.concatenate([window, draw(blocks * BLOCK - len(window))])
                vector = finder.table[window].sum(axis=0)
                reached.append(float(vector @ target / max(1e-9, np.linalg.norm(vector) * np.linalg.norm(target))))
        found[blocks] = float(np.clip(np.quantile(reached, 1 - recall), 0.25, 0.9)) if reached else 0.5
    return found


def leak_finders(docs: DataFrame, benchmark: DataFrame, rule: LeakRule = LeakRule(), max_items: int = 10_000, **fit) -> list[tuple[list, LeakFinder]]:
    """For each block of at most about ``max_items`` items, by a hash of their text: their ids and the finder."""
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None)
    rows = benchmark.select("item_id", "text", answer.cast("string").alias("answer"))
    blocks = max(1, -(-rows.count() // max_items))
    table, occurrences = fit_space(docs, **fit)
    found = []
    for block in range(blocks):
        held = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        finder = LeakFinder(table, pieces_of([(r["text"], r["answer"]) for r in held], rule), {}, rule)
        finder.cosine = calibrate(finder, occurrences)
        found.append(([r["item_id"] for r in held], finder))
    return found


def find_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, kind, share, cosine and start (word number) of each document's leaks, its best window per item.

    Null and empty texts leak nothing, on either side; repeated rows give repeated results; null ids are kept. An empty
    benchmark or table gives no rows. Only the named columns are read, and nothing is shuffled but word counts.
    """
    found = None
    for ids, finder in leak_finders(docs, benchmark, **options):
        rows = docs.select("doc_id", F.explode(finder.column(F.col("text"))).alias("leak"))
        # Ids of one block, at most max_items of them, looked up by place.
        names = docs.sparkSession.createDataFrame([(i, x) for i, x in enumerate(ids)], f"_place int, item_id {benchmark.schema['item_id'].dataType.simpleString()}")
        rows = rows.join(F.broadcast(names), F.col("leak.item") == F.col("_place")).select("doc_id", "item_id", "leak.kind", "leak.share", "leak.cosine", "leak.start")
        found = rows if found is None else found.unionByName(rows)
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows, with all their columns, that leak no item."""
    for _, finder in leak_finders(docs, benchmark, **options):
        docs = docs.filter(F.size(finder.column(F.col("text"))) == 0)
    return docs
