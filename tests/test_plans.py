"""Physical plans: what must reach the scan, and which strategies must be chosen."""

import contextlib
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from cardrisk.functions import cleaning as C
from cardrisk.functions.sampling_hash import content_key
from cardrisk.operators import enrich, features, layout, quality, rollups, sampling, sizing
from cardrisk.plans import tables, views
from cardrisk.plans.catalog import ORACLES, QUERIES
from cardrisk.plans.cleaning import raw_csv_path
from cardrisk.schemas import RAW_COLUMNS
from cardrisk.session import setting, shared_dir
from cardrisk.sources import files, sinks


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_year_filter_prunes_partitions(silver):
    text = plan(layout.year_count(silver, 1998))
    assert "PartitionFilters: [isnotnull(year" in text
    assert "ReadSchema: struct<>" in text


def test_hour_filter_is_pushed_and_reads_one_column(silver):
    text = plan(layout.hour_count(silver))
    assert "PushedFilters: [IsNotNull(hour), EqualTo(hour,13)]" in text
    assert "ReadSchema: struct<hour:int>" in text


def test_rollup_reads_two_columns_and_aggregates_before_the_shuffle(silver):
    text = plan(rollups.by_state(silver))
    assert "ReadSchema: struct<merchant_state:string,is_fraud:int>" in text
    assert "partial_count" in text and "TakeOrderedAndProject" in text


def test_raw_rollup_parses_two_of_sixteen_columns(spark, sf_dir):
    text = plan(rollups.rate_by_state_raw(files.read_raw_csv(spark, raw_csv_path(spark, sf_dir))))
    assert "ReadSchema: struct<merchant_state:string,is_fraud:string>" in text


def test_join_strategies(spark, sf_dir, silver):
    places = layout.places_of(views.zip_coords(spark, sf_dir))
    assert "BroadcastHashJoin" in plan(layout.join_count(silver, places, broadcast=True))
    assert "SortMergeJoin" in plan(layout.row_shuffle_join(silver, places))
    counted = plan(layout.join_count(silver, places, broadcast=False))
    assert "SortMergeJoin" in counted and "partial_count" in counted


def test_silver_is_one_narrow_pass_with_one_json_parse(spark, sf_dir):
    raw = files.read_raw_csv(spark, raw_csv_path(spark, sf_dir))
    text = plan(enrich.build_silver(raw, views.zip_coords(spark, sf_dir), 10.0))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert text.count("from_json") == 1
    assert "hashpartitioning" not in text


def test_flag_rollups_scan_once(silver):
    assert plan(rollups.by_flags(silver)).count("Scan parquet") <= 2  # tree line and its detail


def test_samples_are_filters(spark, sf_dir, silver):
    """No exchange carries a row of the table, and no copy of it is written."""
    raw = files.read_raw_csv(spark, raw_csv_path(spark, sf_dir))
    before = set(os.listdir(f"{shared_dir(spark)}/cardrisk".removeprefix("file:")))
    taken = sampling.take_by_hash(raw, 500)
    capped = sampling.cap_rows(raw.withColumn("label", (F.col("is_fraud") == "Yes").cast("int")), 2000, label="label", key=content_key(RAW_COLUMNS))
    pooled = sampling.pool_sample(raw, 300, holdout=True)
    drawn = sampling.stratified_sample(silver.drop("processed_at"))
    for frame in (taken, capped, pooled, drawn):
        assert "Exchange" not in plan(frame)
    assert set(os.listdir(f"{shared_dir(spark)}/cardrisk".removeprefix("file:"))) == before
    assert taken.count() == 500 and pooled.count() == 300


def test_boundary_is_searched_on_digests_alone(spark, monkeypatch):
    seen = []
    inner = sampling._boundary

    def watched(digests, n):
        seen.append(digests.columns)
        return inner(digests, n)

    monkeypatch.setattr(sampling, "_boundary", watched)
    sampling.take_by_hash(spark.range(100).withColumn("text", F.lit("x")), 10).count()
    assert seen == [["digest"]]


def test_profile_multiplies_no_row(silver):
    for frame in (quality.quality_profile(silver), quality.profile_document(silver, 6000, 1.0, "a", "b")):
        text = plan(frame)
        assert "Expand" not in text
        assert "ReadSchema: struct<user:int>" in text and "ReadSchema: struct<merchant_state:string>" in text


def test_hot_zip_is_spread(spark, sf_dir):
    """The ZIP of all rows without one joins by broadcast; its rows go to the shuffle under many salts."""
    zips = views.raw_txn(spark, sf_dir).select(C.clean_zip(F.col("zip")).alias("zip"))
    assert zips.filter("zip = '00000'").count() > 1500
    assert "00000" in sizing.heavy_keys(zips, "zip")
    joined = enrich.join_zip(zips, views.zip_coords(spark, sf_dir), max_rows=0)
    text = plan(joined)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" in text
    salts = sizing.spread_rows(zips, "zip", ["00000"]).filter("zip = '00000'").select("_salt").distinct().count()
    assert salts == sizing.SALTS


def test_profiles_are_pruned_by_the_batch_and_not_shuffled(spark, sf_dir, silver):
    users, mccs = tables.profiles(spark, sf_dir)
    batch = silver.select("user", "mcc", "amount_abs").limit(50).persist()
    text = plan(features.join_profiles_batch(batch, users, mccs, max_rows=0))
    assert "LeftSemi" in text and "SortMergeJoin" not in text
    tree = text.split("\n\n\n")[0]
    scans = [line for line in tree.splitlines() if "Scan parquet" in line]
    assert len(scans) >= 2
    # Exchanges only gather the batch's keys and the pruned profiles for their broadcasts.
    for block in text.split("\n\n"):
        if "Exchange" in block and "hashpartitioning" in block:
            assert "user_amount_mean" not in block and "mcc_frequency" not in block
    batch.unpersist()


def test_dashboard_is_written_by_one_job(spark, silver, tmp_path):
    frames = {"a": rollups.by_state(silver, min_rows=1), "b": rollups.by_hour(silver), "none": rollups.by_hour(silver).limit(0)}
    manifest = sinks.write_aggregates(frames, str(tmp_path / "agg"), "silver")
    rows = {r.file: (r.rows, r.size_kb) for r in manifest.collect()}
    for name, frame in frames.items():
        folder = tmp_path / "agg" / f"file={name}"
        written = sorted(folder.glob("*.txt")) if folder.exists() else []
        assert len(written) == (1 if rows[name][0] else 0)
        lines = [json.loads(line) for f in written for line in f.read_text().splitlines()]
        assert [tuple(line.values()) for line in lines] == [tuple(r) for r in frame.collect()]
        assert rows[name] == (len(lines), round(sum(f.stat().st_size for f in written) / 1024, 1))
    assert spark.read.json(str(tmp_path / "agg" / "file=index")).count() == 3


def test_single_writer_does_not_aggregate(spark, silver):
    text = plan(sinks._in_one(rollups.by_os(silver, 1), ["os"]))
    assert "Exchange SinglePartition, REPARTITION_BY_NUM" in text or "RoundRobinPartitioning(1)" in text or "SinglePartition" in text


def test_every_query_is_callable_and_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 90
    assert all(callable(q) for q in QUERIES.values())


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["merchant_state", "total_txns", "fraud_txns", "fraud_rate_pct"]
    assert contract.entry(spark).agg(F.sum("total_txns")).first()[0] == 6000
    assert set(contract.oracle_sql()) <= set(contract.queries())


class FakeSession:
    """Only what the folder lookup asks for."""

    def __init__(self, named, master):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "fake"})


def test_shared_dir_comes_from_the_session():
    assert shared_dir(FakeSession("hdfs://x/ck/", "yarn")) == "hdfs://x/ck"
    local = FakeSession(None, "local[2]")
    assert shared_dir(local) == shared_dir(local) != ""
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession(None, "yarn"))


def test_tables_are_written_to_the_shared_dir(spark, sf_dir):
    assert tables.silver_path(spark, sf_dir).startswith(shared_dir(spark))


def test_months_are_gathered_before_columns_are_added(spark, sf_dir):
    raw, lookup = views.raw_txn(spark, sf_dir), views.zip_coords(spark, sf_dir)
    gathered = enrich.build_silver(raw, lookup, 10.0, gather=True)
    with setting(spark, "spark.sql.debug.maxToStringFields", "200"):
        text = gathered._jdf.queryExecution().optimizedPlan().toString()
    above, below = text.split("RebalancePartitions")
    for derived in ("txn_timestamp", "amount_log", "device_merchant_distance_km", "is_weekend"):
        assert f"AS {derived}#" in above and derived not in below
    plain = enrich.build_silver(raw, lookup, 10.0)
    assert gathered.drop("processed_at").exceptAll(plain.drop("processed_at")).isEmpty() and gathered.count() == plain.count()


def test_the_large_table_takes_part_in_one_join(spark, sf_dir):
    raw = views.raw_txn(spark, sf_dir)
    text = raw._jdf.queryExecution().optimizedPlan().toString()
    lines = text.splitlines()
    depth = {i: len(line) - len(line.lstrip(" :+-")) for i, line in enumerate(lines)}
    at = next(i for i, line in enumerate(lines) if "l_shipdate" in line and "Relation" in line)
    joins, level = 0, depth[at]
    for i in range(at, -1, -1):
        if depth[i] < level:
            level, joins = depth[i], joins + lines[i].lstrip(" :+-").startswith("Join")
    assert joins == 1
    in_turn = spark.sql(views.for_spark(views.RAW_TXN, sf_dir))
    assert raw.exceptAll(in_turn).isEmpty() and in_turn.exceptAll(raw).isEmpty()
