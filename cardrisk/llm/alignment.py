"""Alignment of two tokenizers' ids over the same bytes, each distinct text once.

Documents are shuffled by their full text; a distinct text is tokenised and aligned once and carries its number of copies.
Byte offsets at which a token of either vocabulary ends cut a text into groups, and the tokens of a group are linked. How
many documents hold a pair of ids linked is a sum over distinct texts weighted by copies; measures of a text, taken from
those counts, are joined back to every document that has it.

Inside a text the work is done by unit: a cut between a character that isn't white space and a following space or line
feed. No pre-token of a byte-level vocabulary spans such a place, and no piece of the other vocabulary does (checked when
it is loaded), so ids and groups of a text are those of its units in a row. Workers remember the units they have aligned.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.llm.tokens import Encoder, byte_alphabet
from cardrisk.operators.sizing import left_join_dim
from cardrisk.session import materialise

#: Units remembered by one worker before it lets the rarer ones go.
CACHE_UNITS = 300_000
#: Characters of texts whose new units are aligned in one go.
LEARN_CHARS = 2_000_000
#: Links of a group up to which its ids are paired as they come.
SMALL_GROUP = 256
#: Distinct pairs gathered by a counting task before it hands them on.
FLUSH_PAIRS = 1 << 20
#: The most frequent pairs, at most so many, are sent to all tasks; all others meet their counts in a shuffle.
TOP_PAIRS = 1 << 18
#: Ids of the second vocabulary stay below this, so that a pair is one number.
WIDTH = 1 << 24

MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


class Pair:
    """The two vocabularies, and what their ids stand for in bytes.

    A unit's text is that of the whole with its space in front. Cuts before line feeds need a vocabulary in which no piece
    goes on across one, cuts before spaces one in which none goes on across a space; without the latter a text is one unit.
    """

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece

        self._encoder = Encoder(byte_file, special=False)
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        number = {c: i for i, c in enumerate(byte_alphabet())}
        tokens = self._encoder.vocabulary()
        self.a_bytes = {i: bytes([number[c] for c in token]) for token, i in tokens.items() if all(c in number for c in token)}
        self._a_len = np.zeros(max(self.a_bytes) + 1, np.int64)
        self._a_len[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        count = self._pieces.vocab_size()
        self.b_bytes = [self._piece_bytes(i) for i in range(count)]
        self._b_len = np.asarray([len(x) for x in self.b_bytes])
        held = [self._pieces.id_to_piece(i) for i in range(count) if not self._pieces.is_byte(i)]
        self._by_space = not any(re.search(r"[^▁]▁", piece) for piece in held)
        self._by_line = self._by_space and not any("\n" in piece for piece in held)
        self._added = len(self._pieces.encode("\n")) - 1

    def _piece_bytes(self, i: int) -> bytes:
        piece = self._pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def units(self, text: str) -> list[str]:
        """The parts of a space and the text: cut where a space or line feed follows what isn't white space.

        A space in front of a unit is left away; a unit that begins with more than one mark of white space is written
        behind a zero character, which no cut leaves in front.
        """
        if not self._by_space:
            return ["\0 " + text]
        parts = (text.replace("\n", " \n") if self._by_line else text).split(" ")
        if not _OPEN(text):
            return parts
        joined, held = [], ""
        for part in parts:
            raw = held + (part if part.startswith("\n") and self._by_line else " " + part)
            if not raw or raw[-1].isspace() or raw[-1] in _UNSURE:
                held = raw
                continue
            joined.append("\0" + raw if held or raw[1:2].isspace() or raw[1:2] == "\0" else part)
            held = ""
        return [*joined, "\0" + held] if held else joined

    def raw(self, unit: str) -> str:
        return unit[1:] if unit.startswith("\0") else unit if unit.startswith("\n") and self._by_line else " " + unit

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids in both vocabularies of a text that begins with its space, which the second model adds by itself."""
        a = np.frombuffer(self._encoder.encode(text), "<u4").astype(np.int64)
        b = self._pieces.encode(text[1:]) if len(text) > 1 else self._pieces.encode("\n")[: self._added]
        return a, np.asarray(b, np.int64)

    def align(self, units: list[str]) -> Groups | None:
        """Groups of the units' texts in a row; none where either vocabulary doesn't give their bytes back.

        Every unit but the last must end with what isn't white space.
        """
        raw = [self.raw(u) for u in units]
        # A unit of its own in front, so that the added space is never one of theirs.
        whole = " a" + "".join(raw)
        a, b = self.ids(whole)
        if b"".join([self.b_bytes[x] for x in b.tolist()]) != whole.encode() or b"".join([self.a_bytes[x] for x in a.tolist()]) != whole.encode():
            return None
        ends_a, ends_b = np.cumsum(self._a_len[a]), np.cumsum(self._b_len[b])
        cuts = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
        ends = 2 + np.cumsum([len(x.encode()) for x in raw])
        if cuts[0] != 2 or not np.isin(ends, cuts).all():
            return None
        upto_a, upto_b = np.searchsorted(ends_a, cuts, "right"), np.searchsorted(ends_b, cuts, "right")
        return Groups(a[upto_a[0]:], b[upto_b[0]:], np.diff(upto_a), np.diff(upto_b), np.searchsorted(ends, cuts[1:]))


#: White space before a space or line feed, or a character on whose kind pattern engines differ.
_OPEN = re.compile(r"\s[ \n]|^\s|\s$|^$|\0|\u180e").search
_UNSURE = "\u180e"


class Groups(NamedTuple):
    """Ids of both vocabularies, how many of each every group has, and the unit of every group."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    unit: np.ndarray

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit, pair and number of links. Ids that repeat in a large group are counted before they are paired."""
        number = self.n_a * self.n_b
        from_a, from_b = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        small = np.flatnonzero(number <= SMALL_GROUP)
        n = number[small]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(self.n_b[small], n)
        first = self.a[np.repeat(from_a[small], n) + step // wide]
        units, pairs = [np.repeat(self.unit[small], n)], [first * WIDTH + self.b[np.repeat(from_b[small], n) + step % wide]]
        often = [np.ones(len(step), np.int64)]
        for g in np.flatnonzero(number > SMALL_GROUP):
            x, k = np.unique(self.a[from_a[g] : from_a[g] + self.n_a[g]], return_counts=True)
            y, m = np.unique(self.b[from_b[g] : from_b[g] + self.n_b[g]], return_counts=True)
            pairs.append((x[:, None] * WIDTH + y).ravel())
            often.append((k[:, None] * m).ravel())
            units.append(np.full(len(x) * len(y), self.unit[g]))
        unit, pair_, times = np.concatenate(units), np.concatenate(pairs), np.concatenate(often)
        order = np.argsort(unit, kind="stable")
        return unit[order], pair_[order], times[order]

    def shown(self, count: int) -> list[str]:
        """Each unit's groups as text, every group closed by a semicolon."""
        before_b = np.repeat(np.cumsum(self.n_b) - self.n_b, self.n_a)
        upto_a = np.repeat(np.cumsum(self.n_a), self.n_b)
        text = np.empty(len(self.a) + len(self.b), object)
        for ids, sizes, place, close in ((self.a, self.n_a, before_b, "|"), (self.b, self.n_b, upto_a, ";")):
            written = _written(close, int(ids.max(initial=0)).bit_length())
            last = np.zeros(len(ids), np.int64)
            last[np.cumsum(sizes) - 1] = 1
            text[np.arange(len(ids)) + place] = written[last, ids]
        ends = np.searchsorted(self.unit, np.arange(count), "right")
        tokens = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])[ends].tolist()
        return ["".join(text[x:y]) for x, y in zip([0, *tokens], tokens)]


@lru_cache(maxsize=8)
def _written(close: str, bits: int) -> np.ndarray:
    """Every id of so many bits with a comma behind it, and with the mark that ends its part of a group."""
    return np.array([[f"{i}{mark}" for i in range(1 << bits)] for mark in (",", close)], object)


class Aligner:
    """Texts to their measures and distinct pairs, by remembered units."""

    def __init__(self, vocabularies: Pair):
        self._of = vocabularies
        self._keep(np.empty(0, np.int64))

    def _keep(self, places: np.ndarray) -> None:
        """Remembers these units alone."""
        if len(places):
            start, count = self._slices(places)
            at = _ranges(start, count)
            self._pairs, self._often = (array("q", np.frombuffer(x, np.int64)[at].tobytes()) for x in (self._pairs, self._often))
            self._start = array("q", np.concatenate([[0], np.cumsum(count)]).tobytes())
            self._sizes = array("q", np.frombuffer(self._sizes, np.int64).reshape(-1, 4)[places].tobytes())
            self._shown = [self._shown[p] for p in places.tolist()]
            named = {p: u for u, p in self._known.items()}
            self._known = {named[p]: i for i, p in enumerate(places.tolist())}
        else:
            self._known: dict[str, int] = {}
            self._shown: list[str] = []
            self._sizes, self._pairs, self._often, self._start = array("q"), array("q"), array("q"), array("q", [0])
        self._used = np.zeros(2 * CACHE_UNITS, np.int32)

    def _slices(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = np.frombuffer(self._start, np.int64)
        return start[places], start[places + 1] - start[places]

    def _make_room(self) -> None:
        """Keeps of the remembered units those met most often, at most half."""
        used = self._used[: len(self._shown)]
        least = 2
        while (used >= least).sum() > CACHE_UNITS // 2:
            least *= 2
        self._keep(np.flatnonzero(used >= least))

    def _learn(self, units: list[str]) -> None:
        """Aligns units in one go; one that isn't given back, or ends in white space, goes by itself."""
        groups = self._of.align(units)
        if groups is None:
            if len(units) == 1:
                self._known[units[0]] = -1
                return
            half = len(units) // 2
            self._learn(units[:half])
            self._learn(units[half:])
            return
        count, base = len(units), len(self._shown)
        unit, pairs, often = groups.links()
        sizes = [np.bincount(groups.unit, x, count) for x in (groups.n_a, groups.n_b, None)] + [np.bincount(unit, often, count)]
        self._sizes.frombytes(np.stack(sizes, 1).astype(np.int64).tobytes())
        self._pairs.frombytes(pairs.tobytes())
        self._often.frombytes(often.tobytes())
        self._start.frombytes((self._start[-1] + np.cumsum(np.bincount(unit, minlength=count))).astype(np.int64).tobytes())
        self._shown += groups.shown(count)
        self._known.update(zip(units, range(base, base + count)))

    def measure(self, texts: list[str]) -> Iterator[tuple[list[int], str, np.ndarray, np.ndarray] | None]:
        """(n_a, n_b, n_groups, n_links), hash of the groups, distinct pairs in order, how often each is linked."""
        done = 0
        while done < len(texts):
            cut, room, size = [], CACHE_UNITS, 0
            while done + len(cut) < len(texts) and size < LEARN_CHARS:
                size += len(texts[done + len(cut)])
                cut.append(self._of.units(texts[done + len(cut)]))
            done += len(cut)
            new = [u for u in dict.fromkeys(chain.from_iterable(cut)) if u not in self._known]
            if len(self._shown) + len(new) > room and self._shown:
                self._make_room()
                new = [u for u in dict.fromkeys(chain.from_iterable(cut)) if u not in self._known]
            if len(self._shown) + len(new) > len(self._used):
                self._used = np.concatenate([self._used, np.zeros(len(new), np.int32)])
            open_end = [u for u in new if u[-1:].isspace() or u[-1:] in _UNSURE]
            if open_end:
                new = [u for u in new if u not in set(open_end)]
            if new:
                self._learn(new)
            for unit in open_end:
                self._learn([unit])
            for units in cut:
                places = [self._known[u] for u in units]
                yield None if -1 in places else self._summed(places)
            if len(self._shown) > CACHE_UNITS or len(self._pairs) > 64 * CACHE_UNITS:
                self._make_room()
                if len(self._pairs) > 32 * CACHE_UNITS:
                    self._keep(np.empty(0, np.int64))

    def _summed(self, places: list[int]) -> tuple[list[int], str, np.ndarray, np.ndarray]:
        shown = self._shown
        digest = hashlib.sha256("".join([shown[p] for p in places])[:-1].encode()).hexdigest()
        which, times = np.unique(np.asarray(places), return_counts=True)
        self._used[which] += times
        sizes = times @ np.frombuffer(self._sizes, np.int64).reshape(-1, 4)[which]
        start, count = self._slices(which)
        at = _ranges(start, count)
        often = np.frombuffer(self._often, np.int64)[at] * np.repeat(times, count)
        pairs = np.frombuffer(self._pairs, np.int64)[at]
        order = np.argsort(pairs, kind="stable")
        pairs, often = pairs[order], often[order]
        new = np.flatnonzero(np.diff(pairs, prepend=-1))
        return sizes.tolist(), digest, pairs[new], np.add.reduceat(often, new)


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of each range, one range after the other."""
    return np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)


@lru_cache(maxsize=1)
def aligner(byte_file: str, piece_file: str) -> Aligner:
    """One for all tasks of a worker."""
    return Aligner(Pair(byte_file, piece_file))


def _packed(pairs: np.ndarray, often: np.ndarray, press: zstandard.ZstdCompressor) -> bytes:
    steps = np.diff(pairs, prepend=0)
    planes = np.concatenate([steps.view(np.uint8).reshape(-1, 8).T.ravel(), often.view(np.uint8).reshape(-1, 8).T.ravel()])
    return press.compress(planes.tobytes())


def _unpacked(packed: bytes, press: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(press.decompress(packed), np.uint8).reshape(2, 8, -1).transpose(0, 2, 1)
    steps, often = np.ascontiguousarray(planes).reshape(2, -1).view(np.int64)
    return np.cumsum(steps), often


def align(docs: DataFrame, byte_file: str, piece_file: str, text_col: str = "text") -> DataFrame:
    """One row per distinct text that isn't null or empty: its SHA-256, copies, sizes, hash of groups and packed pairs.

    ``packed`` is null for a text whose joined token bytes differ from a space and the text.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text <> ''")
    distinct = texts.groupBy("text").agg(F.count("*").alias("copies"))
    schema = "digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, packed binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure, press = aligner(byte_file, piece_file).measure, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            sizes, shown, packed = [], [], []
            for found in measure(batch.column(2).to_pylist()):
                sizes.append(found[0] if found else [0, 0, 0, 0])
                shown.append(found[1] if found else "")
                packed.append(_packed(found[2], found[3], press) if found else None)
            columns = np.asarray(sizes, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, columns), pa.array(shown, pa.string()), pa.array(packed, pa.binary())],
                names=["digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "packed"])

    return distinct.select(F.unhex(F.sha2("text", 256)).alias("digest"), "copies", "text").mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked) and best (no pair of its first id has a larger n), for every pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        keys, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            found = [_unpacked(x.as_py(), press)[0] for x in batch.column(1)]
            if not found:
                continue
            weights = np.repeat(np.asarray(batch.column(0)), [len(x) for x in found])
            keys, back = np.unique(np.concatenate([keys, *found]), return_inverse=True)
            sums = np.bincount(back, np.concatenate([sums, weights]), len(keys)).astype(np.int64)
            if len(keys) >= FLUSH_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["pair", "n"])
                keys, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["pair", "n"])

    partial = aligned.filter("packed is not null").select("copies", "packed").mapInArrow(run, "pair long, n long")
    counts = materialise(partial.groupBy("pair").agg(F.sum("n").alias("n")))
    first = F.expr(f"pair div {WIDTH}")
    # An id has at most as many pairs as the other vocabulary has ids, and its largest count is a partial aggregate.
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", first).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _top(counts: DataFrame, at_most: int) -> int:
    """The least count such that no more than ``at_most`` pairs have it or a larger one, to an eighth of a power of two."""
    level = F.floor(F.log2("n") * 8)
    held = sorted(((r.level, r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    least, room = float("inf"), at_most
    for at, number in held:
        room -= number
        if room < 0:
            break
        least = at
    return least


def score(aligned: DataFrame, counts: DataFrame, top_pairs: int = TOP_PAIRS) -> DataFrame:
    """digest, copies and all measures of each distinct text; both tables should be written ones.

    The most frequent pairs, whose number has a bound, are looked up in the tasks. Those are also the pairs that many texts
    share, so the shuffle in which the others meet their counts has no hot key.
    """
    spark = aligned.sparkSession
    level = F.floor(F.log2("n") * 8)
    least = _top(counts, top_pairs)
    frequent = counts.filter(level >= F.lit(least)).toArrow() if least != float("inf") else counts.limit(0).toArrow()
    order = np.argsort(np.asarray(frequent["pair"]))
    shared = spark.sparkContext.broadcast(tuple(np.asarray(frequent[c])[order] for c in ("pair", "n", "best")))
    schema = "digest binary, n_best long, count_sum long, rest array<struct<pair: long, often: long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, (keys, numbers, best) = zstandard.ZstdDecompressor(), shared.value
        rest_type = pa.list_(pa.struct([("pair", pa.int64()), ("often", pa.int64())]))
        for batch in batches:
            n_best, total, left, ends = [], [], [], [0]
            for packed in batch.column(1):
                pairs, often = _unpacked(packed.as_py(), press)
                at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1) if len(keys) else None
                hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
                if hit.any():
                    n_best.append(int(often[hit] @ best[at[hit]]))
                    total.append(int(often[hit] @ numbers[at[hit]]))
                else:
                    n_best.append(0)
                    total.append(0)
                left.append((pairs[~hit], often[~hit]))
                ends.append(ends[-1] + int((~hit).sum()))
            parts = [np.concatenate([x[k] for x in left]) if left else np.empty(0, np.int64) for k in (0, 1)]
            inner = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in parts], names=["pair", "often"])
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner).cast(rest_type)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), rest],
                                             names=["digest", "n_best", "count_sum", "rest"])

    known = materialise(aligned.filter("packed is not null").select("digest", "packed").mapInArrow(run, schema))
    others = (
        known.select("digest", F.inline("rest")).join(counts.filter(level < F.lit(least)), "pair")
        .groupBy("digest").agg(F.sum(F.when(F.col("best"), F.col("often")).otherwise(0)).alias("n_best"),
                               F.sum(F.col("often") * F.col("n")).alias("count_sum"))
    )
    sums = known.select("digest", "n_best", "count_sum").unionByName(others).groupBy("digest").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.drop("packed").join(sums, "digest", "left").select(
        "digest", "copies", *[F.coalesce(c, zero).alias(c) for c in MEASURES], "groups_sha256")


def measures(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text",
             top_pairs: int = TOP_PAIRS) -> DataFrame:
    """doc_id, the measures and ``groups_sha256`` of every row of the documents.

    Null and empty texts, and texts that either vocabulary doesn't give back byte for byte, have zeros and an empty hash.
    Repeated rows count as documents of their own and keep a row each, as do null ids; other columns are not read. An
    empty table gives no rows. Texts with more than a thousandth of all rows are joined back by broadcast (at most a
    thousand rows), the rest by shuffle.
    """
    aligned = materialise(align(docs, byte_file, piece_file, text_col))
    scored = materialise(score(aligned, materialise(pair_counts(aligned)), top_pairs))
    text = F.nullif(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))
    # Rows without a text have no digest to meet on, so they are spread over the tasks of the join.
    empty = F.coalesce("digest", F.unhex(F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 224)))
    joined = left_join_dim(keyed.withColumn("digest", empty), scored, "digest", weight="copies", max_rows=1_000)
    zero = F.lit(0).cast("long")
    return joined.select("doc_id", *[F.coalesce(c, zero).alias(c) for c in MEASURES],
                         F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
