"""Operators over groups of rows: near duplicates, lines, neighbours, conversations, URLs, token totals, components."""

import collections
import gc
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_text_operators import DOC, LONG, odd_documents

from cardrisk import session
from cardrisk.llm import ann, bloom, chat, linededup, queries, simhash, token_counts, urls
from cardrisk.llm.components import components
from cardrisk.session import scratch


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def hashed(x):
    return int.from_bytes(hashlib.sha256(str(x).encode()).digest()[:8], "big", signed=True)


def test_components_of_paths_stars_and_cliques(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(i, j) for i in range(200, 210) for j in range(200, i)] + [(300, 300)]
    rows = [(hashed(a), hashed(b)) for a, b in pairs] + [(None, 1)]
    found = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long"), "a", "b").collect()}
    union = Union()
    for a, b in rows[:-2]:
        union.join(a, b)
    groups = collections.defaultdict(set)
    for node, root in found.items():
        groups[root].add(node)
    want = collections.defaultdict(set)
    for node in list(union.parent):
        want[union.find(node)].add(node)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_bloom_never_loses_a_key(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    rows = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("key")).unionByName(spark.createDataFrame([(None,)], "key string"))
    held = bloom.probe(rows, F.col("key"), bloom.build(keys, "key", 5000), "maybe")
    got = {r.key: r.maybe for r in held.collect()}
    assert all(got[f"k{i}"] for i in range(5000)) and got[None] is False
    assert sum(got[f"k{i}"] for i in range(5000, 20_000)) < 300


def test_simhash_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: simhash.fingerprint(r.text) for r in docs.collect()}
    union, ids = Union(), sorted(rows)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (rows[a] ^ rows[b]).bit_count() <= 3:
                union.join(a, b)
    found = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {i: (f"{rows[i]:016x}", union.find(i)) for i in ids}
    assert sorted(r.doc_id for r in simhash.keep_first(docs).collect()) == sorted({union.find(i) for i in ids})


def test_grid_join_finds_every_close_pair(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(1 << 63), 1 << 63, 40, dtype=np.int64).tolist()
    prints = set(base)
    for x in base:
        for _ in range(12):
            y = x
            for bit in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                y ^= (1 << int(bit)) if bit < 63 else -(1 << 63)
            prints.add(y)
    prints = sorted(prints)
    want = {(a, b) for i, b in enumerate(prints) for a in prints[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    found = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()
    assert {(r.a, r.b) for r in found} == want and len(found) == len(want)


def test_simhash_odd_rows(spark):
    docs = odd_documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 7 and by[1].fingerprint == by[2].fingerprint == by[3].fingerprint == "0" * 16
    assert by[3].component_id == 1 and by[None].component_id is None
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 4), (False, 5), (True, 0)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_first(docs.limit(0)).count() == 0


def lines_by_brute_force(rows, rule):
    """Occurrences that go, from all pairs of lines that share a shingle."""
    places = collections.defaultdict(list)
    for doc_id, text in rows:
        for no, line in enumerate(text.split("\n")):
            if len(line.strip(" ")) >= rule.min_chars:
                places[line.strip(" ")].append((doc_id, no))
    sets = {x: {x[i : i + rule.shingle] for i in range(len(x) - rule.shingle + 1)} for x in places}
    union, holders = Union(), collections.defaultdict(list)
    for line, own in sets.items():
        seen = collections.Counter(other for s in own for other in holders[s])
        for other, same in seen.items():
            if same / (len(own) + len(sets[other]) - same) >= rule.similarity:
                union.join(line, other)
        for s in own:
            holders[s].append(line)
    groups = collections.defaultdict(list)
    for line, found in places.items():
        groups[union.find(line)] += found
    return {p for found in groups.values() for p in sorted(found)[1:]}


def test_line_dedup_against_brute_force(spark):
    rng = np.random.default_rng(9)
    pool = ["".join(rng.choice(list("abcdefgh "), int(rng.integers(12, 300)))) for _ in range(150)]
    hot = "this very line stands in a third of all the documents of the table, word for word"
    template = "".join(rng.choice(list("klmnopqrst "), 250))
    rows = []
    for i in range(240):
        chosen = [pool[int(j)] for j in rng.integers(0, 150, 3)]
        edited = list(template)
        edited[int(rng.integers(0, len(edited)))] = "#"
        rows.append((i, "\n".join([*chosen, hot if i % 3 == 0 else "short", "".join(edited), ""])))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOC)
    rule = linededup.LineRule()
    gone = lines_by_brute_force(rows, rule)
    cleaned = linededup.dedup(docs, rule).collect()
    assert {(r.doc_id, no) for r in cleaned for no in r.dropped} == gone
    texts = dict(rows)
    for r in cleaned:
        assert r.text == "\n".join(x for no, x in enumerate(texts[r.doc_id].split("\n")) if (r.doc_id, no) not in gone)
        assert r.n_chars == len(r.text)
    assert linededup.digest(linededup.dedup(docs, rule)).count() == 240


def linked_share(spark, pairs):
    """Share of pairs of lines, each pair a document, of which one line goes."""
    docs = spark.createDataFrame([(i, f"{a}\n{b}") for i, (a, b) in enumerate(pairs)], "doc_id long, text string")
    rows = linededup.dedup(docs).select(F.sum(F.size("dropped")).alias("n")).first()
    return rows.n / len(pairs)


def test_short_lines_with_four_of_five_shingles_shared_meet(spark):
    rng = np.random.default_rng(21)
    longer = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 11)) for _ in range(600)]
    assert linked_share(spark, [(x, x[:-1]) for x in longer]) > 0.96
    longer = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 16)) for _ in range(600)]
    assert linked_share(spark, [(x, x[1:-1]) for x in longer]) > 0.96


def test_long_lines_meet_short_ones_of_the_same_shingles(spark):
    rng = np.random.default_rng(22)
    chars = list("abcdefghijklmnopqrstuvwxyz")
    pairs = [("-" * 100, "-" * 260)]
    for _ in range(60):
        unit = "".join(rng.choice(chars, 20))
        pairs.append((unit * 5, unit * 40))
    assert linked_share(spark, pairs) == 1


def test_line_pairs_are_ruled_out_by_bitmaps_without_python(spark):
    rule, rng = linededup.LineRule(), np.random.default_rng(23)
    letters = list("abcdefghijklmnopqrstuvwxyzäß€😀")
    base = "".join(rng.choice(letters, 300))
    tails = [base[:cut] + "".join(rng.choice(letters, 300 - cut)) for cut in (280, 240, 200, 0)]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate([base, *tails])], "doc_id long, text string")
    lines = linededup._lines(docs, rule).withColumnRenamed("__id__", "i").cache()
    sides = linededup._bitmaps(lines, rule).join(linededup._signatures(lines, rule), "k1")
    a, b = lines.filter("i = 0").select(F.col("k1").alias("a"), F.col("line").alias("l")), lines.filter("i > 0").select(F.col("k1").alias("b"), F.col("line").alias("r"), "i")
    pairs = a.crossJoin(b).join(linededup._side(sides, "a", rule), "a").join(linededup._side(sides, "b", rule), "b")
    judged = pairs.select("i", linededup._alike(rule).alias("alike"), linededup.similar(rule, F.col("l"), F.col("r")).alias("similar"))
    assert not re.search("Python|Arrow", judged._jdf.queryExecution().executedPlan().toString())
    assert [(r.alike, r.similar) for r in judged.orderBy("i").collect()] == [(True, True), (False, False), (False, False), (False, False)]
    lines.unpersist()


def judged_pairs(spark, pairs: list[tuple[str, str]]):
    """Each pair's place i, all columns of both sides, and whether the sides are alike and similar."""
    rule = linededup.LineRule()
    docs = spark.createDataFrame([(2 * i + j, x) for i, pair in enumerate(pairs) for j, x in enumerate(pair)], "doc_id long, text string")
    lines = session.materialise(linededup._lines(docs, rule))
    sides = session.materialise(linededup._bitmaps(lines, rule).join(linededup._signatures(lines, rule), "k1"))
    ends = [lines.filter(F.col("__id__") % 2 == j).select((F.col("__id__") / 2).cast("int").alias("i"), F.col("k1").alias(end), F.col("line").alias(text))
            for j, end, text in ((0, "a", "l"), (1, "b", "r"))]
    known = [linededup._side(sides, end, rule) for end in "ab"]
    joined = session.materialise(ends[0].join(ends[1], "i").join(known[0], "a").join(known[1], "b"))
    return joined.withColumn("alike", linededup._alike(rule)).withColumn("similar", linededup.similar(rule, F.col("l"), F.col("r")))


def test_long_lines_are_ruled_out_though_their_bitmaps_are_nearly_full(spark):
    rng, letters = np.random.default_rng(31), list("abcdefghijklmnopqrstuvwxyz ")
    text = lambda n: "".join(rng.choice(letters, n))
    pairs = []
    for size, share in [(1300, 0.9)] * 60 + [(600, 0.9)] * 60 + [(1300, 0.72)] * 30 + [(1000, 0.75)] * 30:
        base = text(size)
        pairs.append((base, base[: int(size * share)] + text(size - int(size * share))))
    found = judged_pairs(spark, pairs).select("i", "alike", "similar").orderBy("i").collect()
    assert all(r.similar and r.alike for r in found[:120])
    assert not any(r.similar or r.alike for r in found[120:])


def test_a_pair_is_met_in_the_first_band_that_it_shares(spark):
    rule, rng = linededup.LineRule(), np.random.default_rng(37)
    pairs = []
    for _ in range(40):
        base = "".join(rng.choice(list("abcdefghij"), 120))
        pairs.append((base, base[:100] + "".join(rng.choice(list("abcdefghij"), 20))))
    sides = judged_pairs(spark, pairs)
    packs = linededup._packs(rule)
    bands = lambda end: linededup._bands(rule, lambda p: F.col(f"{p}_{end}"))
    shared = sides.select("i", *[f"{p}_{end}" for p in packs for end in "ab"], F.arrays_zip(bands("a").alias("x"), bands("b").alias("y")).alias("z"))
    each = shared.select("*", F.posexplode("z").alias("band", "pair")).filter("pair.x = pair.y")
    told = each.groupBy("i").agg(F.count("*").alias("n"), F.count_if(~linededup._shared_before(rule, F.col("band"))).alias("new")).collect()
    assert len(told) > 30 and max(r.n for r in told) > 3 and all(r.new == 1 for r in told)


def test_written_tables_are_not_held_by_the_driver(spark):
    before = len(session._written)
    frame = session.materialise(spark.range(3))
    assert len(session._written) == before + 1 and frame.count() == 3
    del frame
    gc.collect()
    assert len(session._written) <= before


def test_line_dedup_odd_rows(spark):
    docs = odd_documents(spark)
    rows = linededup.dedup(docs)
    assert rows.columns == [*docs.columns, "dropped"]
    got = rows.collect()
    assert len(got) == 7 and all(not r.dropped for r in got)
    lone = [(1, "the same line of some length"), (2, "the same line of some length\n\nthe same line of some length\n  the same line of some length  "), (None, "the same line of some length")]
    found = {r.doc_id: (r.text, r.dropped) for r in linededup.dedup(spark.createDataFrame(lone, "doc_id long, text string")).collect()}
    assert found == {1: (lone[0][1], []), 2: ("", [0, 2, 3]), None: ("", [0])}
    assert linededup.dedup(docs.limit(0)).count() == 0


def test_neighbours_against_brute_force(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, dtype=float) for r in vectors.collect()}
    ids, matrix = np.array(sorted(rows)), np.stack([rows[i] for i in sorted(rows)])
    found = collections.defaultdict(list)
    for r in sorted(ann.search(vectors, F.col("id") % 20 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(found[r.query_id]) + 1
        assert r.score == pytest.approx(float(rows[r.query_id] @ rows[r.vec_id]), abs=1e-9)
        found[r.query_id].append(r.vec_id)
    hits = 0
    for q in ids[ids % 20 == 0]:
        order = sorted(((-float(rows[q] @ x), i) for i, x in zip(ids.tolist(), matrix, strict=True) if i != q))[:20]
        hits += len({i for _, i in order} & set(found[q]))
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()


def test_neighbours_read_few_of_many_lists(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    matrix = (centres[rng.integers(0, 40, 6000)] + 0.35 * rng.normal(size=(6000, 16))) * rng.uniform(0.5, 2, (6000, 1))
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(matrix)], "vec_id long, embedding array<double>")
    found = collections.defaultdict(set)
    for r in ann.search(vectors, F.col("id") % 20 == 0, list_rows=64).collect():
        found[r.query_id].add(r.vec_id)
    scores = matrix[::20] @ matrix.T
    scores[np.arange(300), np.arange(300) * 20] = -np.inf
    best = np.argpartition(-scores, 19, axis=1)[:, :20]
    assert np.mean([len(set(best[i].tolist()) & found[20 * i]) for i in range(300)]) >= 0.9 * 20
    index = ann.fit(matrix, 6000, list_rows=64, norm=np.linalg.norm(matrix, axis=1).max())
    place = [x.tolist() for x in index.nearest(index.lift(matrix), index.copy_ratio, most=index.most_copies)]
    assert 1 < np.mean([len(x) for x in place]) <= 3 and len(index.centroids) >= 50
    index.read_ratio = ann.read_ratio(index, matrix[::20], [(i, place[j]) for i in range(300) for j in best[i]], 0.95)
    assert np.mean([len(x) for x in index.nearest(index.lift(matrix[::20], query=True), index.read_ratio)]) < 0.5 * len(index.centroids)


def test_neighbours_of_an_id_with_two_vectors_and_of_mixed_widths(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.search(vectors, F.col("id") % 20 == 0).collect()
    assert [(r.query_id, r.rank) for r in sorted(found, key=lambda r: r.rank)] == [(20, 1), (20, 2)]
    with pytest.raises(ValueError, match="different numbers"):
        ann.search(vectors.unionByName(spark.createDataFrame([(3, [1.0])], "vec_id long, embedding array<double>")), F.col("id") % 20 == 0)


def test_neighbours_ties_copies_and_odd_vectors(spark):
    nan = float("nan")
    rows = [(i, [1.0, 0.0], 1) for i in range(0, 60)] + [(100, [0.0, 1.0], 1), (101, [0.0, 0.0], 1), (102, None, 1), (120, [nan, 1.0], 1), (140, [1.0, None], 1), (None, [1.0, 1.0], 1), (160, [], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, key int").withColumn("list", F.lit("x"))
    found = collections.defaultdict(list)
    for r in sorted(ann.search(vectors, F.col("id") % 20 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append(r.vec_id)
    assert set(found) == {0, 20, 40, 100}
    assert found[0] == list(range(1, 21)) and found[20] == list(range(0, 20)) and found[40] == list(range(0, 20))
    assert found[100] == list(range(0, 20))
    assert ann.search(vectors.limit(0), F.col("id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(20, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert ann.search(alone, F.col("id") % 20 == 0).count() == 0


def test_chat_collapse_and_rendering(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"),
            (4, 0, "user", "hi"), (4, 1, "assistant", "no"), (5, 0, None, None), (5, 0, None, None), (None, 0, "user", "hi"), (6, None, "user", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(9)).withColumn("n", F.lit(9))
    got = {r.conv_id: r for r in chat.render(turns).collect()}
    assert set(got) == {2, 4, 5, 6} and got[2].copies == 2 and got[2].n_turns == 2
    assert got[2].text == "<|user|>\nhi<|end|>\n<|assistant|>\nyo<|end|>\n"
    assert got[5].text == "<|unknown|>\n<|end|>\n" and got[5].n_turns == 1
    assert chat.render(turns.limit(0)).count() == 0


def test_long_conversations_go_on_in_parts(spark):
    turns = spark.range(600).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    start = turns.filter("turn < 300").withColumn("conv_id", F.lit(2).cast("long"))
    rows = sorted(chat.render(turns.unionByName(start)).collect(), key=lambda r: r.part)
    assert [(r.conv_id, r.part, r.n_turns) for r in rows] == [(1, 0, 600), (1, 1, 600), (1, 2, 600)]
    assert "".join(r.text for r in rows) == "".join(f"<|user|>\n{i}<|end|>\n" for i in range(600))


@pytest.mark.parametrize(("first", "count", "parts"), [(1, 256, 1), (0, 257, 2), (-300, 600, 3), (250, 20, 1)])
def test_parts_count_rows_and_not_turn_numbers(spark, first, count, parts):
    schema = "conv_id long, turn long, role string, text string"
    turns = spark.createDataFrame([(1, first + i, "user", str(i)) for i in range(count)], schema)
    rows = sorted(chat.render(turns).collect(), key=lambda r: r.part)
    assert [r.part for r in rows] == list(range(parts))
    assert "".join(r.text for r in rows) == "".join(f"<|user|>\n{i}<|end|>\n" for i in range(count))


def test_null_and_shared_turns_stand_in_one_order(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "b"), (1, None, "user", "a"), (1, 1, "assistant", "d"), (1, 0, "user", "c"), (1, None, None, "z"), (1, -5, "user", "neg"), (1, 0, "user", "b")]
    got = chat.render(spark.createDataFrame(rows, schema)).collect()
    assert [(r.conv_id, r.part, r.n_turns) for r in got] == [(1, 0, 6)]
    assert got[0].text == "<|unknown|>\nz<|end|>\n<|user|>\na<|end|>\n<|user|>\nneg<|end|>\n<|user|>\nb<|end|>\n<|user|>\nc<|end|>\n<|assistant|>\nd<|end|>\n"
    many = spark.createDataFrame([(2, 0, "user", f"{i:04}") for i in range(600)], schema)
    parts = sorted(chat.render(many).collect(), key=lambda r: r.part)
    assert [(r.part, r.text.count("<|user|>")) for r in parts] == [(0, 256), (1, 256), (2, 88)]


def test_url_rules_and_list(spark):
    cases = [("http://a.org/x", "allow", "org/"), ("http://www.EXAMPLE.org/es/1", "block", "example.org/es/"), ("https://example.org/en/17?q", "block", "example.org/en/1"),
             ("http://x.com/fr/1", "allow", "com/fr/"), ("http://x.com/de/", "block", "com/de/"), ("http://org", "allow", None), (None, "allow", None), ("no scheme", "allow", None),
             ("http://www.bad.net/p/?x#y", "block", None), ("http://bad.net/p", "block", None), ("http://bad.net/p2", "allow", None), ("http://?a://b/c", "allow", None)]
    pages = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(cases)], "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("listed", F.lit(1))
    listed = spark.createDataFrame([("bad.net/p",), ("bad.net/p",), (None,)], "canonical string")
    got = {r.page_id: r for r in urls.judge(pages, listed, queries.URL_RULES).collect()}
    assert [(got[i].verdict, got[i].rule) for i in range(len(cases))] == [(v, r) for _, v, r in cases]
    assert (got[1].host, got[1].path) == ("www.example.org", "/es/1") and (got[6].host, got[6].path) == ("", "")
    assert urls.judge(pages.limit(0), listed, queries.URL_RULES).count() == 0
    assert {r.listed for r in urls.judge(pages, listed.limit(0), queries.URL_RULES).collect()} == {False}


def test_token_rollup_deltas_and_replays(spark):
    rollup = token_counts.TokenRollup(spark, scratch(spark, "rollup-test"))
    def batch(*rows):
        return spark.createDataFrame(rows, token_counts.EVENT).withColumn("old", F.lit(1))
    def totals():
        return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()}
    assert totals() == {}
    first = batch((1, "v1", 1, "insert", "a", "en", 10), (1, "v1", 1, "insert", "a", "en", 10), (2, "v1", 1, "insert", None, None, None), (None, "v1", 1, "insert", "a", "en", 5))
    assert rollup.apply("one", first) and not rollup.apply("one", first)
    assert totals() == {("a", "en", "v1"): (2, 15), (None, None, "v1"): (1, 0)}
    assert rollup.apply("two", batch((1, "v1", 2, "revise", "b", "en", 12), (2, "v1", 2, "delete", None, None, None), (9, "v1", 2, "delete", None, None, None), (3, "v2", 2, "revise", "a", "en", 4)))
    want = {("a", "en", "v1"): (1, 5), ("b", "en", "v1"): (1, 12), ("a", "en", "v2"): (1, 4)}
    assert totals() == want
    assert rollup.apply("late", first) and totals() == want
    assert rollup.apply("none", batch((1, "v1", 1, "insert", "a", "en", 1)).limit(0)) and totals() == want
    with pytest.raises(Exception, match="op must be"):
        rollup.apply("wrong", batch((7, "v1", 1, "upsert", "a", "en", 1)))
    assert rollup.committed() == ["late", "none", "one", "two"]


def test_token_rollup_query(spark, sf_dir):
    from cardrisk.llm.tokens import Encoder, vocabulary

    encoder = Encoder(vocabulary("byte_bpe_50k.json"))
    with open(vocabulary("byte_bpe_50k.json"), "rb") as held:
        version = "byte_bpe_50k@" + hashlib.sha256(held.read()).hexdigest()[:12]
    gone = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.toxic == 1}
    want = collections.defaultdict(lambda: [0, 0])
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        for name, size in ((version, len(encoder.whole(r.text)) // 4), ("utf8_bytes", len(r.text.encode()))):
            if r.doc_id not in gone:
                want[r.source, r.lang, name][0] += 1
                want[r.source, r.lang, name][1] += size
    got = {(r.source, r.lang, r.tokenizer): [r.docs, r.tokens] for r in queries.op1_token_counts(spark, sf_dir).collect()}
    assert got == dict(want) and LONG
