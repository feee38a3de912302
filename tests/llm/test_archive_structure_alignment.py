"""Conversation repair, the WARC archive and tokenizer alignment, against brute force and on rows of every odd kind."""

import base64
import collections
import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_text_operators import LONG, odd_documents

from cardrisk.llm import alignment, queries, structure, warc
from cardrisk.llm.tokens import vocabulary
from cardrisk.session import scratch

# ---- conversation repair ---------------------------------------------------------------------

WANTED = {"": "u", "s": "u", "u": "a", "a": "u"}
WHITE = " \t\n\x0b\x0c\r"


def cheapest(turns):
    """(cost, audit) by trying every edit at every turn; ``turns`` are (initial, must go, cut off)."""

    @lru_cache(None)
    def best(at, last, put_in):
        found = [(0, "")] if at == len(turns) and last in ("", "a") else []
        if put_in < 3:
            cost, audit = best(at, WANTED[last], put_in + 1)
            found.append((cost + 5, "I" + audit))
        if at < len(turns):
            initial, gone, cut_off = turns[at]
            cost, audit = best(at + 1, last, 0)
            found.append((cost + 2, "D" + audit))
            if not gone:
                extra = 5 if cut_off else 0
                if initial == WANTED[last] or (initial == "s" and last == ""):
                    cost, audit = best(at + 1, initial, 0)
                    found.append((cost + extra, "K" + audit))
                cost, audit = best(at + 1, WANTED[last], 0)
                found.append((cost + extra + 1, "R" + audit))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def repaired(rows):
    """The digest columns of one conversation's rows (turn, role, text), nulls for spaces already."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:128].encode(), hashlib.sha256(r[2].encode()).digest()))
    seen, marked, counts = set(), [], collections.Counter()
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        counts[fault] += 1
        marked.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = cheapest(tuple(marked))
    out, at, last = [], 0, ""
    for letter in audit:
        if letter == "I":
            last = WANTED[last]
            out.append({"u": "user", "a": "assistant"}[last] + ":")
            continue
        _, role, text = rows[at]
        at += 1
        if letter == "R":
            last = WANTED[last]
            out.append({"u": "user", "a": "assistant"}[last] + ":" + text)
        elif letter == "K":
            last = role[0]
            out.append(role + ":" + text)
    numbers = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, counts["blank"], counts["duplicate"], counts["truncated"],
            sum(a + b not in ("su", "ua", "au") or not a or not b for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def by_brute_force(rows, hurt):
    groups = {row[0]: [] for row in rows}
    for conv, *rest in hurt:
        groups[conv].append(tuple(rest))
    return {conv: repaired(turns) for conv, turns in groups.items()}


def found(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


CONV = "conv_id long, turn long, role string, text string"


def odd_turns():
    rows = [(1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, 0, "assistant", None), (1, 5, None, "What?"), (1, 5, "", "x."),
            (2, None, None, None), (None, 1, "system", "Be kind."), (None, 2, "assistant", "Yes"), (None, 2, "user", "Yes"),
            (3, 0, "system", "A."), (3, 1, "system", "B."), (3, 2, "user", LONG), (3, 3, "assistant", LONG + "!"), (4, 7, "tool", "42"),
            (5, -(1 << 63), "user", "far."), (5, (1 << 63) - 1, "assistant", "away. \n\t")]
    return rows + [(6, i // 3, "usa"[i % 3 - 1] + "x", f"t{i % 7}{'.' * (i % 4 > 0)}") for i in range(90)]


def test_repair_of_whole_table_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op11_structure(spark, sf_dir)) == by_brute_force(rows, damage(rows))


@pytest.mark.parametrize("chunk", [(16_384, 4_000_000), (5, 4_000_000), (1, 10)])
def test_repair_of_odd_rows_in_chunks_of_any_size(spark, chunk):
    rows = odd_turns()
    turns = spark.createDataFrame(rows, CONV).withColumns({"chunk": F.lit("x"), "edits": F.lit(1), "first": F.lit(2)})
    want = by_brute_force(rows, [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    want[5] = ((1 << 63) - 1, *want[5][1:])
    got = structure.repair(turns, *chunk)
    assert chunk[0] > 100 or got.filter("conv_id = 6 and split").count() > 10
    assert found(structure.digest(turns, got)) == want
    kept = structure.repaired_turns(got).filter("conv_id = 4").collect()
    assert [(r.edit, r.role, r.text) for r in kept] == []
    if chunk[0] > 100:
        assert structure.repair(turns.limit(0)).count() == 0 and structure.digest(turns.limit(0), got.limit(0)).count() == 0


def test_split_conversations_are_put_together(spark):
    """Chunks of every size give what one run over all turns gives, edits, states and costs alike."""
    table, rng = structure.tables(), np.random.default_rng(5)
    for size in (1, 2, 3, 4, 7, 50):
        symbols = bytes(rng.integers(1, structure.SYMBOLS, 200).astype(np.uint8))
        letters, state, front, off = table.trace(symbols, 0, structure.START)
        parts = [symbols[i : i + size] for i in range(0, len(symbols), size)]
        behind, total = [0], 0
        for part in reversed(parts):
            before, taken, _ = table.summary(part)
            total += taken[behind[-1]]
            behind.append(before[behind[-1]])
        assert (behind.pop(), total) == (front, off)
        at, pieces = structure.START, ""
        for part, vector in zip(parts, reversed(behind)):
            exits = table.summary(part)[2]
            found_, to, _, _ = table.trace(part, vector, at)
            assert to == exits[vector * structure.STATES + at]
            pieces, at = pieces + found_, to
        assert (pieces, at) == (letters, state)


def test_tables_equal_every_edit_tried(spark):
    rng = np.random.default_rng(7)
    table = structure.tables()
    for _ in range(400):
        symbols = rng.integers(1, structure.SYMBOLS, rng.integers(0, 11)).astype(np.uint8)
        letters, state, front, off = table.trace(bytes(symbols), 0, structure.START)
        turns = tuple(("suao"[(s - 2) % 4] if s > 1 else "u", s == 1, s >= 6) for s in symbols.tolist())
        assert (off + table.vectors[front][structure.START], letters + table.ending(state)) == cheapest(turns)


def test_many_copies_of_one_turn_are_one_row_until_they_are_deleted(spark):
    turns = spark.range(3000).select(F.lit(1).alias("conv_id"), F.lit(4).alias("turn"), F.lit("user").alias("role"), F.lit("Hi.").alias("text"))
    assert structure._rows(turns).count() == 1
    row = structure.digest(turns, structure.repair(turns)).first()
    assert (row.duplicate, row.illegal, row.cost, row.audit) == (2999, 2999, 6000, "D" * 3000)


# ---- WARC ------------------------------------------------------------------------------------

PAGE = "page_id long, url string, html string"


def archive_of(spark, pages):
    path = scratch(spark, "warc-test")
    warc.write(pages, path)
    return path


def test_archive_keeps_each_payload_once_and_gives_records_back(spark):
    rows = [(i, f"http://a.example/{i}", f"<p>{i % 7}é</p>") for i in range(60)] + [(100 + i, None, "hot") for i in range(200)]
    rows += [(None, None, None), (500, "http://b.example/a b\r\nWARC-Type: x", ""), (501, "http://b.example", "y"), (501, "http://b.example", "y"),
             (501, "http://b.example/2", "y"), (502, "", LONG), (503, "http://c.example/ WARC-Type: z", LONG)]
    pages = spark.createDataFrame(rows, PAGE).withColumns({"digest": F.lit("x"), "header": F.lit(1), "id": F.lit(2), "bytes": F.lit(3)})
    path = archive_of(spark, pages.repartition(5))
    assert spark.read.parquet(f"{path}/payloads").count() == len({r[2] or "" for r in rows})
    got = warc.digest(warc.read(spark, path)).collect()
    newest = collections.defaultdict(lambda: None)
    for page, _, html in rows:
        newest[html or ""] = max(newest[html or ""] if newest[html or ""] is not None else -1, -1 if page is None else page)
    want = collections.Counter()
    once = set()
    for page, url, html in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True):
        data = (html or "").encode()
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = data not in once
        once.add(data)
        want[(page, len(data), sha, "response" if first else "revisit", None if first or newest[html or ""] < 0 else newest[html or ""])] += 1
    assert collections.Counter(tuple(r) for r in got) == want


def test_records_are_warc(spark):
    pages = spark.createDataFrame([(1, "http://a.example/", "same"), (2, "http://a.example/2", "same")], PAGE)
    records = {r.record_id: bytes(r.record) for r in warc.record_bytes(warc.read(spark, archive_of(spark, pages))).collect()}
    assert len(records) == 2
    for name, record in records.items():
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert record.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n") and fields["WARC-Record-ID"] == name
        assert len(rest) - 4 == int(fields["Content-Length"])
        assert rest.startswith(b"HTTP/1.1 200 OK\r\n")
        if fields["WARC-Type"] == "revisit":
            assert fields["WARC-Refers-To"] in records and fields["WARC-Refers-To"] != name and b"same" not in rest
        else:
            assert rest.endswith(b"\r\n\r\nsame\r\n\r\n")


def test_a_changed_payload_is_found(spark):
    path = archive_of(spark, spark.createDataFrame([(1, "http://a.example/", "true")], PAGE))
    spark.createDataFrame([(hashlib.sha256(b"true").hexdigest(), bytearray(b"fals"))], "digest string, payload binary").write.mode(
        "overwrite").parquet(f"{path}/payloads")
    with pytest.raises(PySparkException, match="payload is not what its digest says"):
        warc.read(spark, path).collect()
    spark.createDataFrame([], "digest string, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(PySparkException, match="does not match its payload"):
        warc.read(spark, path).collect()


def test_an_empty_archive(spark):
    assert warc.read(spark, archive_of(spark, spark.createDataFrame([], PAGE))).count() == 0


# ---- alignment -------------------------------------------------------------------------------

FILES = (vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@lru_cache(None)
def whole_models():
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(FILES[0])
    a_model.encode_special_tokens = True
    return a_model, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def tokens_by_brute_force(text):
    """(A ids, B ids) of each group, by encoding the whole text and comparing the ends of all tokens."""
    a_model, b_model = whole_models()
    number = {c: i for i, c in enumerate(alignment.byte_alphabet())}
    a = a_model.encode(" " + text, add_special_tokens=False).ids
    b = b_model.encode(text)
    a_bytes = [bytes(number[c] for c in a_model.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(cut) + 1, ends_b.index(cut) + 1
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    return groups


def measures_by_brute_force(rows):
    groups = {t: tokens_by_brute_force(t) if t else None for _, t in rows}
    linked = {t: collections.Counter((x, y) for a, b in g for x in a for y in b) for t, g in groups.items() if g}
    counts = collections.Counter(pair for _, t in rows if t in linked for pair in linked[t])
    most = collections.Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = collections.Counter()
    for doc, t in rows:
        if t not in linked:
            out[(doc, 0, 0, 0, 0, 0, 0, "")] += 1
            continue
        g, found_ = groups[t], linked[t]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out[(doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(found_.values()),
             sum(n for p, n in found_.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in found_.items()),
             hashlib.sha256(shown.encode()).hexdigest())] += 1
    return out


ODD_TEXTS = ["é ﬁ １２ x▁y  a\xa0 b　c d é", "<s> </s> <unk> <0x41>", "\x00a\x01", " lead", "trail  ", "\t\n", "😀👍🏽", " ", "\n", " \n x\n\n  y \n",
             "a<|endoftext|>b", "x\r\ny \r z;\r\n", "日本語テキスト 中文", "a b c\x85d\x1ce", "a" * 900, "x\0y \0z  \0", "\n\nfoo  bar\n", "a᠎ b", "\0", "  ", "\n "]


@pytest.mark.parametrize("top_pairs", [alignment.TOP_PAIRS, 40, 0])
def test_alignment_equals_brute_force(spark, sf_dir, top_pairs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(40).select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(1, "same here"), (1, "same here"), (None, "same here"), (2000, None), (2001, ""), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"digest": F.lit("x"), "copies": F.lit(1), "n_a": F.lit(2)})
    got = alignment.measures(table.repartition(3), *FILES, top_pairs=top_pairs)
    assert collections.Counter(tuple(r) for r in got.collect()) == measures_by_brute_force(rows)


def test_alignment_of_odd_documents_and_nothing(spark):
    docs = odd_documents(spark)
    got = alignment.measures(docs, *FILES)
    assert got.count() == docs.count()
    assert got.filter("n_a = 0").count() == 2
    assert alignment.measures(docs.limit(0), *FILES).count() == 0


def test_units_are_forgotten_without_other_results(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_UNITS", 20)
    monkeypatch.setattr(alignment, "LEARN_CHARS", 50)
    texts = [f"word{i} some other{i % 3} words, and {i % 5}." for i in range(60)] + ODD_TEXTS
    few, all_ = alignment.Aligner(alignment.Pair(*FILES)), alignment.Aligner(alignment.Pair(*FILES))
    small = list(few.measure(texts * 2))
    monkeypatch.setattr(alignment, "CACHE_UNITS", 10_000)
    for x, y in zip(small, all_.measure(texts * 2), strict=True):
        assert (x is None) == (y is None)
        assert x is None or (x[:2] == y[:2] and (x[2] == y[2]).all() and (x[3] == y[3]).all())


def test_large_groups_are_counted_before_they_are_paired():
    a, b = np.asarray([1, 1, 2] * 200), np.asarray([7, 8] * 300)
    groups = alignment.Groups(a, b, np.asarray([600]), np.asarray([600]), np.asarray([0]))
    _, pairs, often = groups.links()
    assert dict(zip(pairs.tolist(), often.tolist())) == {x * alignment.WIDTH + y: (400 if x == 1 else 200) * 300 for x in (1, 2) for y in (7, 8)}
