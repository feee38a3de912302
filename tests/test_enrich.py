import json

import pytest
from pyspark.sql import functions as F

from cardrisk.operators import enrich, quality, rollups
from cardrisk.plans import jobs, views
from cardrisk.schemas import RAW_COLUMNS, raw_schema, silver_columns, silver_schema
from cardrisk.sources import files, sinks

HEADER = ",".join(RAW_COLUMNS)


def raw_frame(spark, *rows):
    filled = [{**dict.fromkeys(RAW_COLUMNS), **row} for row in rows]
    return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in filled], raw_schema())


def lookup_frame(spark, *rows):
    return spark.createDataFrame(list(rows), "zip string, state string, latitude double, longitude double")


def test_silver_has_the_declared_shape(silver):
    assert sorted(silver.columns) == sorted(silver_columns()) and len(silver.columns) == 43
    kinds = dict(silver.dtypes)
    assert all(kinds[f.name] == f.dataType.simpleString() for f in silver_schema().fields)


def test_cleaning_loses_no_row(spark, sf_dir, silver):
    got = quality.reconcile(views.raw_txn(spark, sf_dir), silver).first()
    assert got.rows_dropped == 0 and got.reconciliation == "PASS"
    assert set(quality.cleanup_checks(silver).first()) == {0}


def test_row_of_nothing_but_nulls(spark):
    row = enrich.build_silver(raw_frame(spark, {}), lookup_frame(spark, ("00001", "NY", 1.0, 2.0)), 10.0).first()
    assert (row.user, row.year, row.month, row.day, row.mcc) == (-1, 2000, 1, 1, -1)
    assert (row.amount, row.zip, row.error_type, row.device_ip) == (0.0, "00000", "NONE", "0.0.0.0")
    assert (row.merchant_lat, row.device_lat, row.device_merchant_distance_km) == (0.0, 0.0, -1.0)
    assert (row.imputed_city, row.imputed_state, row.imputed_zip, row.geo_missing) == (1, 1, 1, 1)


def test_same_rows_under_any_layout(spark, sf_dir):
    raw, lookup = views.raw_txn(spark, sf_dir), views.zip_coords(spark, sf_dir)
    one = enrich.build_silver(raw, lookup, 100.0).drop("processed_at")
    many = enrich.build_silver(raw.repartition(6), lookup, 100.0).drop("processed_at")
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_zip_with_two_states_takes_the_smaller(spark):
    lookup = lookup_frame(spark, ("00501", "NY", 2.0, 2.0), ("00501", "CT", 1.0, 1.0))
    got = enrich.dedupe_lookup(lookup).collect()
    assert [tuple(r) for r in got] == [("00501", "CT", 1.0, 1.0)]


def test_centroids_and_default(spark):
    rows = spark.createDataFrame([("ca",), ("ZZ",), (None,)], "state string")
    got = [(r.centroid_lat, r.centroid_lon) for r in enrich.attach_centroid(rows).collect()]
    assert got == [enrich.STATE_CENTROIDS["CA"], enrich.DEFAULT_CENTROID, enrich.DEFAULT_CENTROID]


def test_zip_lookup_is_near_its_state(spark):
    raw = raw_frame(spark, {"zip": "91750.0", "merchant_state": "ca"}, {"zip": "91750", "merchant_state": "NV"}, {"zip": "7"})
    got = {r.zip: r for r in enrich.build_zip_lookup(raw).collect()}
    assert set(got) == {"91750", "00007"}
    assert got["91750"].state == "NV"  # '91750' sorts before '91750.0'
    lat, lon = enrich.STATE_CENTROIDS["NV"]
    assert abs(got["91750"].latitude - lat) <= 1.2 and abs(got["91750"].longitude - lon) <= 1.2


def test_rates_by_key(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), ("b", 0), ("c", 1)], "k string, is_fraud int")
    got = [tuple(r) for r in rollups.rate_by(rows, "k", "key", min_rows=2).collect()]
    assert got == [("a", 2, 1, 50.0), ("b", 2, 0, 0.0)]
    assert [r.key for r in rollups.rate_by(rows, "k", "key", 1, order_desc=False, limit=2).collect()] == ["a", "b"]
    assert tuple(rollups.overall(rollups.rate_by(rows, "k", min_rows=1)).first()) == (3, 5, 2, 40.0)


def test_dashboard_frames_equal_single_rollups(silver):
    frames = rollups.dashboard_aggregates(silver)
    assert frames["fraud_by_hour"].collect() == rollups.by_hour(silver).collect()
    assert frames["fraud_by_state"].collect() == rollups.by_state(silver).collect()
    single = rollups.amount_distribution(silver).select("bucket", "total_txns", "fraud_txns").collect()
    assert frames["amount_distribution"].select("bucket", "total_txns", "fraud_txns").collect() == single
    summary = frames["dataset_summary"].first().asDict()
    assert summary == rollups.dataset_summary(silver).first().asDict()
    flags = {(r.flag, int(r.value)): r.total_txns for r in frames["fraud_by_device"].filter("flag <> 'os'").collect()}
    assert flags == {(r.flag, r.value): r.total_txns for r in rollups.by_flags(silver).collect()}


# ---- files -----------------------------------------------------------------------------------


def test_csv_reader_takes_quotes_headers_and_short_rows(spark, tmp_path):
    device = '"{""network"":{""vpn"":true,""ip"":""1.1.1.1""}}"'
    full = f'1,2,2019,3,4,05:06,"$1,204.55",Chip,M1,X,NY,501.0,4000,,No,{device}'
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{full}\n")
    (tmp_path / "b.csv").write_text(f"{HEADER}\n{full}\n9,2,2019\n")
    raw = files.read_raw_csv(spark, str(tmp_path), with_corrupt=True)
    assert tuple(files.malformed_rows(raw).first()) == (3, 3, 1)
    rows = files.read_raw_csv(spark, str(tmp_path)).orderBy("user").collect()
    assert [r.user for r in rows] == ["1", "1", "9"]
    assert rows[0].amount == "$1,204.55" and json.loads(rows[0].device_metadata)["network"]["vpn"] is True
    assert rows[2].device_metadata is None


def test_manifest_tells_files_and_roles(spark, tmp_path):
    for name, users in (("train", (1, 2)), ("holdout", (5, 10)), ("both", (5, 6))):
        body = "".join(f"{u}{',' * 15}\n" for u in users)
        (tmp_path / f"{name}.csv").write_text(f"{HEADER}\n{body}")
    got = quality.input_manifest(files.read_raw_csv(spark, str(tmp_path))).collect()
    roles = {r.file_path.rsplit("/", 1)[1]: (r.rows, r.role) for r in got}
    assert roles == {"train.csv": (2, "train"), "holdout.csv": (2, "holdout"), "both.csv": (2, "mixed")}
    assert all(r.bytes > 0 for r in got)


def test_headers(spark):
    rows = spark.createDataFrame([("1", "Yes")], ["User", " Is Fraud? "])
    got = files.normalise_columns(rows)
    assert got.columns == RAW_COLUMNS[:-1]
    assert (got.first().user, got.first().is_fraud, got.first().zip) == ("1", "Yes", None)


def test_preprocess_job_end_to_end(spark, sf_dir, tmp_path):
    from cardrisk.plans.cleaning import raw_csv_path

    zips = str(tmp_path / "zips")
    sinks.write_single_csv(views.zip_coords(spark, sf_dir), zips)
    out, profile, sample = (str(tmp_path / n) for n in ("silver", "profile", "sample"))
    kept = str(tmp_path / "sketches")
    document = jobs.preprocess(spark, raw_csv_path(spark, sf_dir), zips, out, profile, sample, 100, kept).first()
    assert document.reconciliation == "PASS" and document.rows_in == 6000
    assert document.malformed_rows == 0 and document.input_nulls.merchant_state > 0
    sketched = spark.read.parquet(kept)
    assert sketched.agg(F.sum("rows")).first()[0] == 6000
    assert enrich.refresh_sketches(files.read_raw_csv(spark, raw_csv_path(spark, sf_dir)), sketched).count() == sketched.count()
    assert set(document.cleanup_checks) == {0}
    assert spark.read.json(profile).first().rows_out == 6000
    assert spark.read.option("header", True).csv(sample).count() == 100
    manifest = jobs.aggregates(spark, out, str(tmp_path / "agg"))
    assert {r.file for r in manifest.collect()} >= {"fraud_by_state", "dataset_summary"}
    meta = jobs.export_sample(spark, out, str(tmp_path / "export")).first()
    assert meta.full_rows == 6000 and meta.train_fraud + meta.test_fraud == meta.full_fraud
    summary = jobs.raw_rates(spark, raw_csv_path(spark, sf_dir), str(tmp_path / "rates"))
    assert summary.agg(F.sum("total_txns")).first()[0] == 6000


def test_command_line_parsing():
    from cardrisk.__main__ import parse

    got = parse(jobs.train, ["--silver", "s", "--out", "o", "--fraction", "0.5", "--skip", "lr,rf"])
    assert got == {"silver": "s", "out": "o", "fraction": 0.5, "skip": ["lr", "rf"]}
    with pytest.raises(SystemExit):
        parse(jobs.train, ["--nope", "1"])
