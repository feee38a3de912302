"""Each stage of the pipeline on what the one before it keeps, and on rows of every odd kind."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_group_operators import lines_by_brute_force
from test_text_operators import odd_documents

from cardrisk.llm import linededup, simhash, tokens
from cardrisk.session import materialise

FILTERS = dict(corpus_pipeline.STAGES[:-1])


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The documents before the first stage and after each."""
    found = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        found.append(materialise(stage(spark, found[-1], sf_dir)))
    return found


def test_stage_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "packing"]
    assert all(x.columns == stages[0].columns for x in stages[:-1])


def test_quality_stage_drops_bad_and_keeps_good(spark):
    larger = "/root/testdata/sf0.01"  # the smallest table has eleven bad labels, too few to learn from
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.keep_quality(spark, docs, larger).collect()}
    labels = spark.read.parquet(f"{larger}/labels.parquet").collect()
    assert sum(r.doc_id in kept for r in labels if r.quality == 1) >= 0.97 * sum(r.quality == 1 for r in labels)
    assert sum(r.doc_id in kept for r in labels if r.quality == 0) <= 0.1 * sum(r.quality == 0 for r in labels)


def test_line_stage_equals_brute_force(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1].collect())
    gone = lines_by_brute_force(rows, linededup.LineRule())
    want = {i: "\n".join(x for no, x in enumerate(t.split("\n")) if (i, no) not in gone) for i, t in rows}
    assert {r.doc_id: r.text for r in stages[2].collect()} == want


def test_near_copy_stage_keeps_one_of_each_group(stages):
    rows = {r.doc_id: simhash.fingerprint(r.text) for r in stages[2].collect()}
    kept = {r.doc_id for r in stages[3].collect()}
    assert all(any((rows[i] ^ rows[k]).bit_count() <= 3 for k in rows if k < i) for i in set(rows) - kept)
    assert not any((rows[a] ^ rows[b]).bit_count() <= 3 for a in kept for b in kept if a < b)


def test_last_stages(spark, sf_dir, stages):
    kept = {r.doc_id for r in stages[4].collect()}
    assert kept <= {r.doc_id for r in stages[3].collect()}
    assert {r.doc_id for r in stages[5].collect()} == kept
    assert corpus_pipeline.run(spark, sf_dir).count() == stages[5].count()


@pytest.mark.parametrize("name", FILTERS)
def test_stages_take_odd_rows_and_empty_tables(spark, sf_dir, name):
    docs = odd_documents(spark).withColumn("dropped", F.lit(1))
    assert FILTERS[name](spark, docs, sf_dir).columns == docs.columns
    assert FILTERS[name](spark, docs, sf_dir).count() <= 7
    assert FILTERS[name](spark, docs.limit(0), sf_dir).count() == 0


def test_workers_forget_encoders_for_operators_of_other_kinds():
    encode = tokens.encoder(tokens.vocabulary("byte_bpe_50k.json"))
    assert encode.encode("some words") and encode is tokens.encoder(tokens.vocabulary("byte_bpe_50k.json"))
    tokens.forget()
    assert tokens.encoder.cache_info().currsize == 0
