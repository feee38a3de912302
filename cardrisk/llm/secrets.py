"""Secret scan: three base patterns, and a character convolutional network over every other candidate.

A candidate is a maximal run of token characters, or what base findings leave of one. The network reads every character
of it, in overlapping fields of 32 with the text around them; the best field decides. It starts from a bounded sample
and then learns from every labelled finding and every clean candidate, in shards whose networks are averaged, what keys
look like rather than what the patterns say: of a finding it sees the key alone, without keyword, often without context, at times written anew in another alphabet or standing in a path
of common words; of clean candidates also paths and compound names made of them, and capitals. Scores are calibrated on
a held-out part, and the threshold is the highest that keeps the asked recall there. Base spans always stay; the network
adds the fields that reach the threshold, joined where they overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.session import discard, materialise

#: The base kinds in order, their patterns, the group whose length counts, and the least length.
BASE = [
    ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]
KINDS = [kind for kind, *_ in BASE]
#: The kind of the spans that the network adds.
LEARNED = "model"

_ASSIGN, _ACCESS = re.compile(BASE[0][1]), re.compile(BASE[1][1])
#: Runs too short to count are left out by the pattern itself: maximal runs of one class cannot overlap.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
#: The least length of a candidate.
LEAST = 12
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % LEAST)

#: Characters of the network's window: before the field, the field, after it; and how far one field is from the next.
LEFT, FIELD, RIGHT = 24, 32, 8
STEP = 16
WIDTH = LEFT + FIELD + RIGHT
#: Window regions that are pooled apart.
REGIONS = [(0, LEFT), (LEFT, LEFT + FIELD), (LEFT + FIELD, WIDTH)]
TAPS, FILTERS, HIDDEN = 5, 24, 16
#: Codes: 0 nothing, 1 white space, 2 any other character outside ASCII, then printable ASCII.
CODES = 3 + 95


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base findings by start, then kind; code points, end exclusive."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= BASE[0][3]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= BASE[1][3]]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def keys(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start of the finding, key start, key end): the part of each base finding that is secret, each key once."""
    found, last = [], -1
    for start, kind, end in base:
        own = _ASSIGN.match(text, start, end).start(2) if kind == 0 else start
        if end > last:
            found.append((start, own, end))
            last = end
    return found


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of the candidates: runs of token characters without what base findings cover, long enough each."""
    spans, at = [], 0
    ends = np.maximum.accumulate([end for *_, end in base]).tolist() if base else []
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(base) and ends[at] <= start:
            at += 1
        i = at
        while i < len(base) and base[i][0] < end:
            if base[i][0] - start >= LEAST:
                spans.append((start, base[i][0]))
            start = max(start, base[i][2])
            i += 1
        if end - start >= LEAST:
            spans.append((start, end))
    return spans


def fields(start: int, end: int) -> list[tuple[int, int]]:
    """The candidate in overlapping fields that hold each of its characters."""
    if end - start <= FIELD:
        return [(start, end)]
    return [(i, i + FIELD) for i in range(start, end - FIELD, STEP)] + [(end - FIELD, end)]


_TABLE = np.full(128, 1, dtype=np.uint8)
_TABLE[32:127] = np.arange(3, 3 + 95)
_TABLE[32] = 1


def window(text: str, start: int, end: int) -> str:
    """A field and the text around it: NUL where there is nothing."""
    return text[max(0, start - LEFT) : start].rjust(LEFT, "\0") + text[start:end].ljust(FIELD, "\0") + text[end : end + RIGHT].ljust(RIGHT, "\0")


def encode(windows: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(windows).encode("utf-32-le"), dtype="<u4").reshape(-1, WIDTH)
    codes = np.full(points.shape, 2, dtype=np.int64)
    plain = points < 128
    codes[plain] = _TABLE[points[plain]]
    codes[points == 0] = 0
    return codes


#: What training changes, in order.
WEIGHTS = ["taps", "bias", "w1", "b1", "w2", "b2"]


@dataclass
class CharConv:
    """One convolution, maximum over each region, one hidden layer; ``a`` and ``b`` calibrate its output."""

    taps: np.ndarray
    bias: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    a: float = 1.0
    b: float = 0.0
    threshold: float = 1.1

    @classmethod
    def start(cls, rng: np.random.Generator) -> CharConv:
        wide = FILTERS * len(REGIONS)
        return cls(rng.normal(0, 0.2, (TAPS, CODES, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                   rng.normal(0, wide**-0.5, (wide, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
                   rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32), 0.0)

    def _forward(self, codes: np.ndarray):
        places = WIDTH - TAPS + 1
        out = self.taps[0][codes[:, :places]]
        for k in range(1, TAPS):
            out += self.taps[k][codes[:, k : k + places]]
        peaks, pooled = [], []
        for low, high in REGIONS:
            part = out[:, low : max(low + 1, high - TAPS + 1)]
            peak = part.argmax(axis=1)
            peaks.append(peak + low)
            pooled.append(np.take_along_axis(part, peak[:, None], axis=1)[:, 0])
        raw = np.concatenate(pooled, axis=1) + np.tile(self.bias, len(REGIONS))
        features = np.maximum(raw, 0)
        hidden = np.maximum(features @ self.w1 + self.b1, 0)
        return peaks, raw, features, hidden, hidden @ self.w2 + self.b2

    def logits(self, codes: np.ndarray, block: int = 2048) -> np.ndarray:
        parts = [self._forward(codes[i : i + block])[-1] for i in range(0, len(codes), block)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * self.logits(codes) + self.b, -30, 30)))

    def train(self, codes: np.ndarray, labels: np.ndarray, rng: np.random.Generator, rounds: int, batch: int = 256,
              rate: float = 3e-3) -> None:
        """Adam on the logistic loss with both labels weighing the same."""
        names = WEIGHTS
        mean = {n: np.zeros_like(getattr(self, n)) for n in names}
        square = {n: np.zeros_like(getattr(self, n)) for n in names}
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(codes))
            for i in range(0, len(order), batch):
                rows = order[i : i + batch]
                x = codes[rows].copy()
                blank = rng.random(len(rows)) < 0.5
                x[blank, :LEFT] = 0
                x[blank, WIDTH - RIGHT :] = 0
                peaks, raw, features, hidden, logit = self._forward(x)
                d = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
                d_hidden = np.outer(d, self.w2) * (hidden > 0)
                d_raw = (d_hidden @ self.w1.T) * (raw > 0)
                d_taps = np.zeros_like(self.taps)
                filters = np.arange(FILTERS)[None, :]
                for r, peak in enumerate(peaks):
                    part = d_raw[:, r * FILTERS : (r + 1) * FILTERS]
                    for k in range(TAPS):
                        np.add.at(d_taps[k], (np.take_along_axis(x, peak + k, axis=1), filters), part)
                slopes = {"taps": d_taps, "bias": d_raw.reshape(len(rows), len(REGIONS), FILTERS).sum((0, 1)),
                          "w1": features.T @ d_hidden, "b1": d_hidden.sum(0), "w2": hidden.T @ d, "b2": d.sum()}
                step += 1
                for n, slope in slopes.items():
                    mean[n] = 0.9 * mean[n] + 0.1 * slope
                    square[n] = 0.999 * square[n] + 0.001 * slope * slope
                    change = rate * (mean[n] / (1 - 0.9**step)) / (np.sqrt(square[n] / (1 - 0.999**step)) + 1e-8)
                    setattr(self, n, (getattr(self, n) - change).astype(np.float32) if n != "b2" else float(self.b2 - change))

    def calibrate(self, codes: np.ndarray, labels: np.ndarray, recall: float) -> None:
        """Platt scaling on rows not trained on, then the highest threshold that keeps the recall on them."""
        self.scale(self.logits(codes).astype(float), labels, np.ones(len(codes)), recall)

    def scale(self, z: np.ndarray, labels: np.ndarray, times: np.ndarray, recall: float) -> None:
        """The calibration from outputs, each of which counts ``times``."""
        high, low = times[labels == 1].sum(), times[labels == 0].sum()
        target = np.where(labels == 1, (high + 1) / (high + 2), 1 / (low + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            v = np.maximum(p * (1 - p), 1e-9) * times
            off = (p - target) * times
            slope = np.array([(off * z).sum(), off.sum()])
            curve = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-3]])
            change = np.linalg.solve(curve, slope)
            a, b = a - np.clip(change[0], -0.5, 0.5), b - np.clip(change[1], -0.5, 0.5)
        self.a, self.b = float(max(a, 1e-3)), float(b)
        order = np.argsort(z[labels == 1], kind="stable")
        reached = np.cumsum(times[labels == 1][order])
        least = z[labels == 1][order][np.searchsorted(reached, np.floor((1 - recall) * high), side="right")]
        self.threshold = float(1 / (1 + np.exp(-np.clip(self.a * least + self.b, -30, 30))))

    def weights(self) -> np.ndarray:
        """All that training changes, one after the other."""
        return np.concatenate([np.ravel(getattr(self, n)) for n in WEIGHTS]).astype(np.float64)

    def with_weights(self, values: np.ndarray) -> CharConv:
        parts, at = {}, 0
        for n in WEIGHTS:
            old = np.asarray(getattr(self, n))
            parts[n] = values[at : at + old.size].reshape(old.shape).astype(np.float32) if old.size > 1 else float(values[at])
            at += old.size
        return replace(self, **parts)


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets in which a key is written anew.
ALPHABETS = [_DIGITS + "ABCDEF", _DIGITS + _LOWER, _DIGITS + _UPPER, _DIGITS + _LOWER + _UPPER, _DIGITS + _LOWER + _UPPER + "+/", _DIGITS + _LOWER + _UPPER + "-_"]


def anew(key: str, rng: np.random.Generator) -> str:
    """The key in another alphabet: as long, or cut to 16 to 48 characters if it is longer, its pattern hidden."""
    letters = ALPHABETS[rng.integers(len(ALPHABETS))]
    size = min(len(key), int(rng.integers(16, 49)))
    start = int(rng.integers(len(key) - size + 1))
    shift = rng.integers(0, len(letters), size)
    return "".join(letters[(ord(c) + int(d)) % len(letters)] for c, d in zip(key[start : start + size], shift, strict=True))


def compound(words: list[str], rng: np.random.Generator) -> str:
    """Common words in one run, as in a path, a name or a version: joined, at times with a short number."""
    sign = str(rng.choice(["/", ".", "-", "_", "=", ""]))
    parts = []
    for i in rng.integers(0, len(words), int(rng.integers(2, 6))):
        word = words[i][: int(rng.integers(2, 13))]
        parts.append(word.capitalize() if not sign else word)
        if sign and rng.random() < 0.25:
            parts.append(str(rng.choice(["v", "", "page", "id"])) + str(int(rng.integers(0, 3000))))
    return sign.join(parts)


def examples(rows: list[tuple[str, str, str]], label: int, words: list[str], rng: np.random.Generator, both: bool = True) -> list[str]:
    """Windows to learn from: for each (before, run, after) one as it stands, one in another guise; or one of ``both`` by chance.

    A field of a longer run lies anywhere in it; one of a key in a path has at least ``LEAST`` of the key's characters.
    """
    found = []
    for before, run, after in rows:
        for other in (False, True) if both else (bool(rng.random() < 0.5),):
            left, own, right = before, run, after
            if other and label:
                own = anew(own, rng)
                if words and rng.random() < 0.4:
                    left, right = left + compound(words, rng) + "/", "/" + compound(words, rng) + right
            elif other and words:
                own = compound(words, rng) if rng.random() < 0.6 else own
                own = own.upper() if rng.random() < 0.4 else own
            inside = len(left) > len(before)
            text, start, end = left + own + right, len(left), len(left) + len(own)
            if inside:
                start, end = max(len(before), start - FIELD + LEAST), min(len(text) - len(after), end + FIELD - LEAST)
            if end - start > FIELD:
                start = int(rng.integers(start, end - FIELD + 1))
                end = start + FIELD
            found.append(window(text, start, end))
    return found


def learn(findings: list[tuple[str, str, str]], clean: list[tuple[str, str, str]], recall: float = 0.99, rounds: int = 16, seed: int = 7) -> CharConv:
    """The network from (before, key, after) of findings and (before, run, after) of clean candidates.

    Three quarters train, one quarter calibrates; both as they stand and in other guises.
    """
    rng = np.random.default_rng(seed)
    words = common_words(clean)
    codes, labels = [], []
    for held in (False, True):
        parts = [examples([r for i, r in enumerate(rows) if (i % 4 == 0) == held], label, words, rng) for label, rows in ((0, clean), (1, findings))]
        codes.append(encode(parts[0] + parts[1]))
        labels.append(np.repeat([0.0, 1.0], [len(x) for x in parts]))
    net = CharConv.start(rng)
    net.train(codes[0], labels[0], rng, rounds)
    net.calibrate(codes[1], labels[1], recall)
    return net


def common_words(clean: list[tuple[str, str, str]]) -> list[str]:
    return sorted({w for _, run, _ in clean for w in re.findall(r"[A-Za-z]{2,}", run)})


#: About so many candidates make a shard; findings that one should have at least; steps of the network's output that
#: calibration tells apart, a unit.
SHARD, OWN_FINDINGS, STEPS = 16_384, 100, 1024


def learn_shard(net: CharConv, findings: list[tuple[str, str, str]], clean: list[tuple[str, str, str]], spare: list[tuple[str, str, str]],
                words: list[str], rng: np.random.Generator) -> CharConv:
    """The network after one pass over all rows of a shard. Findings come in new guises until they are a quarter of the rows.

    A shard with few findings borrows the ``spare`` ones.
    """
    own = findings if len(findings) >= OWN_FINDINGS else findings + spare
    turns = max(1, -(-len(clean) // (3 * len(own))))
    windows = examples(clean, 0, words, rng, both=False)
    labels = np.zeros(len(windows))
    for _ in range(turns):
        windows += examples(own, 1, words, rng, both=False)
    labels = np.concatenate([labels, np.ones(len(windows) - len(labels))])
    net = replace(net)
    if 0 < labels.mean() < 1:
        net.train(encode(windows), labels, rng, 1, rate=1e-3)
    return net


def fit(docs: DataFrame, max_findings: int = 6_000, sample_docs: int = 20_000, recall: float = 0.99, rounds: int = 16,
        seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> CharConv | None:
    """The trained network, or None where one of the labels has fewer than ten candidates in the whole table.

    Every candidate of every document takes part: one in four, by hash, calibrates, the others train. The start is
    learned on the driver: of the candidates of each label that train at most ``max_findings``, those first by a hash of
    document and content, clean ones from about ``sample_docs`` documents (from all where these hold fewer than ten).
    From there each shard of all that train makes a network of its own, and these are averaged by their rows. The
    outputs for all that calibrate are counted by value. Of a run at most 64 characters (from a place by hash) and the
    text around them are learned from. The driver gets that sample, one average and counts of at most some hundred
    thousand values, whatever the size of the table. Rows repeated exactly count once.
    """
    rows = docs.count()
    part = min(1.0, sample_docs / max(rows, 1))
    every = docs.select(F.col(id_col).cast("string").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    every = every.withColumn("_key", F.xxhash64("_id", "_text"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for read in batches:
            own, names, kinds = [], [], []
            for text, key in zip(read.column(0), read.column(1), strict=True):
                text, key = text.as_py(), key.as_py()
                base = base_spans(text)
                spans = [(1, *x) for x in keys(text, base)] + [(0, start, start, end) for start, end in candidates(text, base)]
                for kind, said, start, end in spans:
                    at = start + (key + start) % max(1, end - start - 2 * FIELD + 1)
                    stop = min(end, at + 2 * FIELD)
                    before = text[max(0, said - LEFT) : said] if at == start else text[max(start, at - LEFT) : at]
                    own.append((before, text[at:stop], text[stop : stop + RIGHT]))
                    names.append(key)
                    kinds.append(kind)
            columns = [pa.array([x[i] for x in own], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.int64()), pa.array(kinds, pa.int32())], names=["before", "run", "after", "k", "label"])

    found = every.select("_text", "_key").mapInArrow(label, "before string, run string, after string, k long, label int").distinct()
    found = found.withColumn("order", F.xxhash64("k", "before", "run", "after", "label"))
    found = materialise(found.withColumn("held", F.pmod("order", F.lit(4)) == 0))
    there = {(r["label"], r["held"]): r["count"] for r in found.groupBy("label", "held").count().collect()}
    counts = [there.get((kind, False), 0) + there.get((kind, True), 0) for kind in (0, 1)]
    if min(counts) < 10:
        discard(found)
        return None

    def first(from_: DataFrame) -> list[tuple[str, str, str]]:
        # Hashes below a bound are about as many as wanted, so that no task sends all it has.
        share = min(1.0, 1.1 * max_findings / max(from_.count(), 1))
        near = from_.filter(F.shiftrightunsigned("order", 2) <= F.lit(int(share * (1 << 62))))
        return [(r["before"], r["run"], r["after"]) for r in near.orderBy("order", "before", "run", "after").limit(max_findings).collect()]

    pick = lambda kind: found.filter((F.col("label") == kind) & (~F.col("held") if there.get((kind, False), 0) >= 5 else F.lit(True)))
    findings = first(pick(1))
    clean = first(pick(0).filter(F.pmod("k", F.lit(1_000_000)) < int(part * 1_000_000)))
    if len(clean) < 10:
        clean = first(pick(0))
    start = learn(findings, clean, recall, rounds, seed)
    words = common_words(clean)
    shards = -(-sum(counts) // SHARD)
    dealt = found.withColumn("shard", F.pmod(F.shiftright("order", 2), F.lit(shards)))

    def rows_of(table: pa.Table) -> tuple[int, list[list[tuple[str, str, str]]]]:
        """The shard's number and its clean rows and findings, in an order of their own."""
        read = sorted(zip(*(table.column(c).to_pylist() for c in ("order", "before", "run", "after", "label")), strict=True))
        return table.column("shard")[0].as_py(), [[x[1:4] for x in read if x[4] == kind] for kind in (0, 1)]

    def trained(table: pa.Table) -> pa.Table:
        shard, (none, some) = rows_of(table)
        net = learn_shard(start, some, none, findings, words, np.random.default_rng([seed, shard]))
        return pa.table({"n": pa.array([len(none) + len(some)], pa.int64()), "w": pa.array([net.weights().tolist()], pa.list_(pa.float64()))})

    def judged(table: pa.Table) -> pa.Table:
        shard, parts = rows_of(table)
        rng, out = np.random.default_rng([seed, shard, 1]), []
        for kind, own in enumerate(parts):
            at, times = np.unique(np.floor(net.logits(encode(examples(own, kind, words, rng))) * STEPS), return_counts=True) if own else ([], [])
            out += [(kind, int(x), int(n)) for x, n in zip(at, times, strict=True)]
        return pa.table({c: pa.array([x[i] for x in out], pa.int64()) for i, c in enumerate(("label", "z", "times"))})

    # Whole numbers, whose sums are the same in any order.
    made = dealt.filter("not held").groupBy("shard").applyInArrow(trained, "n long, w array<double>")
    each = made.select("n", F.posexplode("w").alias("i", "value")).withColumn("value", F.round(F.col("value") * (1 << 24)).cast("long"))
    mean = each.groupBy("i").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n") / (1 << 24)).alias("value")).collect()
    net = start.with_weights(np.array([r["value"] for r in sorted(mean, key=lambda r: r["i"])])) if mean else start
    if there.get((0, True), 0) and there.get((1, True), 0):
        told = dealt.filter("held").groupBy("shard").applyInArrow(judged, "label long, z long, times long")
        told = told.groupBy("label", "z").agg(F.sum("times").alias("times")).orderBy("label", "z").toPandas()
        net.scale(told["z"].to_numpy() / STEPS, told["label"].to_numpy(), told["times"].to_numpy().astype(float), recall)
    discard(found)
    return net


def scan(docs: DataFrame, model: CharConv | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and findings of every row: an array of kind, start, end, score by start, then kind.

    A null text is empty and has none. Base findings have score 1; the network's have the kind ``model`` and their
    calibrated score, and never overlap a base finding; of a run longer than 32 characters they are the fields found,
    joined. Repeated rows and null ids are scanned row by row; only two columns are read. A document's findings stay in
    its row, so nothing is shuffled.
    """
    names = [*KINDS, LEARNED]
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType),
        T.StructField("findings", T.ArrayType(T.StructType([
            T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))),
    ])
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for read in batches:
            every = []
            pending: list[tuple[int, int, int, int]] = []
            windows: list[str] = []

            def judge() -> None:
                """Adds the fields that reach the threshold, joined with the one before where they overlap in a candidate."""
                scores = model.probabilities(encode(windows))
                for j in np.flatnonzero(scores >= model.threshold).tolist():
                    place, run, start, end = pending[j]
                    hits = added[place]
                    if hits and hits[-1][0] == run and hits[-1][2] >= start:
                        hits[-1] = (run, hits[-1][1], max(end, hits[-1][2]), max(hits[-1][3], float(scores[j])))
                    else:
                        hits.append((run, start, end, float(scores[j])))
                pending.clear()
                windows.clear()

            added: list[list[tuple[int, int, int, float]]] = [[] for _ in range(len(read))]
            for place, text in enumerate(read.column(1)):
                text = text.as_py() or ""
                base = base_spans(text)
                every.append([(start, kind, end, 1.0) for start, kind, end in base])
                for span in candidates(text, base) if model is not None else ():
                    for start, end in fields(*span):
                        pending.append((place, span[0], start, end))
                        windows.append(window(text, start, end))
                        if len(windows) == 4096:
                            judge()
            if windows:
                judge()
            for own, hits in zip(every, added, strict=True):
                own += [(start, len(KINDS), end, score) for _, start, end, score in hits]
            found = [[{"kind": names[k], "start": s, "end": e, "score": p} for s, k, e, p in sorted(x)] for x in every]
            yield pa.RecordBatch.from_arrays([read.column(0), pa.array(found, pa.list_(item))], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, the SHA-256 of the base spans as text, and all spans as text."""
    told = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    joined = lambda xs: F.array_join(F.transform(xs, told), ",")
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("findings", lambda x: x["kind"] != LEARNED)
    return found.select("doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))

