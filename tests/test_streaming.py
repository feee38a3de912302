import time

import pytest
from pyspark.sql import functions as F

from cardrisk.operators import features, scoring
from cardrisk.plans import live, tables, views
from cardrisk.schemas import event_schema, stream_csv_schema
from cardrisk.session import materialise
from cardrisk.sources import files, streams
from cardrisk.streaming import liveops, scorer


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def csv_folder(spark, silver, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stream") / "csv")
    slim = silver.select(*stream_csv_schema().fieldNames())
    slim.repartition(4, "user").write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def profiles(spark, silver):
    return materialise(features.user_stats(silver)), materialise(features.mcc_frequency(silver))


def scored_stream(spark, folder, profiles, max_files=1):
    return scorer.file_verdicts(streams.stream_csv(spark, folder, max_files), *profiles, scoring.rule_score())


def expected_verdicts(silver):
    return scoring.to_verdicts(scoring.score(silver, scoring.rule_score())).drop("scored_at")


def test_stream_equals_batch(spark, silver, csv_folder, profiles, tmp_path):
    out = str(tmp_path / "out")
    query = scorer.start_scoring(scored_stream(spark, csv_folder, profiles), out, str(tmp_path / "log"), trigger=None)
    scorer.run_bounded(query)
    got = spark.read.parquet(f"{out}/verdicts")
    assert rows_of(got.drop("scored_at", "batch_id")) == rows_of(expected_verdicts(silver))
    totals = scorer.running_counters(spark.read.parquet(f"{out}/metrics")).first()
    assert (totals.batches, totals.rows) == (4, silver.count())
    assert totals.flagged == got.agg(F.sum("predicted_fraud")).first()[0]
    top = spark.read.json(f"{out}/top/*")
    assert top.groupBy("batch_id").count().filter("count <> 25").isEmpty() and top.count() == 100


def test_profiles_of_any_size_score_alike(spark, silver, csv_folder, profiles, tmp_path):
    """Profiles taken as too large for a broadcast, cut down to each batch's keys."""
    out = str(tmp_path / "out")
    rows = streams.stream_csv(spark, csv_folder, 1)
    prepare = scorer.file_scorer(*profiles, scoring.rule_score(), max_rows=0)
    totals = scorer.run_bounded(scorer.start_scoring(rows, out, str(tmp_path / "log"), trigger=None, prepare=prepare))
    got = spark.read.parquet(f"{out}/verdicts")
    assert rows_of(got.drop("scored_at", "batch_id")) == rows_of(expected_verdicts(silver))
    assert (totals.batches, totals.rows) == (4, silver.count())


def test_more_keys_than_a_broadcast_holds(spark, silver, profiles, monkeypatch):
    monkeypatch.setattr(features, "MAX_BROADCAST_ROWS", 5)
    small = features.join_profiles_batch(silver.select("user", "mcc", "amount_abs"), *profiles, max_rows=5)
    monkeypatch.setattr(features, "MAX_BROADCAST_ROWS", 500_000)
    whole = features.join_profiles_batch(silver.select("user", "mcc", "amount_abs"), *profiles)
    assert rows_of(small.select(*whole.columns)) == rows_of(whole)


def test_the_clock_ends_a_paced_run(spark, csv_folder, profiles, tmp_path):
    out, started = str(tmp_path / "out"), time.monotonic()
    query = scorer.start_scoring(scored_stream(spark, csv_folder, profiles), out, str(tmp_path / "log"), trigger="1 second")
    totals = scorer.run_bounded(query, run_seconds=6, poll_seconds=0.5)
    assert 5 < time.monotonic() - started < 60 and not query.isActive
    written = scorer.written_counters(spark, out).first()
    assert totals.batches <= written.batches <= 4


def test_connector_is_told_what_the_caller_wants():
    assert streams.kafka_options("a:1,b:2", "txn", max_offsets=200) == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "txn", "startingOffsets": "latest", "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "200",
    }
    assert "maxOffsetsPerTrigger" not in streams.kafka_options("a:1", "txn")
    assert scorer.publish_options("a:1", "verdicts") == {"kafka.bootstrap.servers": "a:1", "topic": "verdicts"}


def test_every_record_has_a_key_and_a_readable_body(spark, silver):
    verdicts = scoring.to_verdicts(scoring.score(silver, scoring.rule_score()))
    records = scorer.to_kafka_records(verdicts)
    assert dict(records.dtypes) == {"key": "string", "value": "string"}
    fields = ", ".join(f"{n} {t}" for n, t in verdicts.dtypes)
    back = records.select("key", F.from_json("value", fields).alias("v"))
    assert back.filter("v.user IS NULL OR key <> CAST(v.user AS STRING)").isEmpty()
    assert back.count() == silver.count()


def test_restart_continues_and_replay_overwrites(spark, silver, csv_folder, profiles, tmp_path):
    """A sink that fails once after writing: the replayed batch must not leave its rows twice."""
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    failed = []

    def flaky(records):
        if not failed:
            failed.append(records.count())
            raise RuntimeError("lost broker")

    verdicts = scored_stream(spark, csv_folder, profiles)
    query = scorer.start_scoring(verdicts, out, log, trigger=None, publish=flaky)
    with pytest.raises(Exception, match="lost broker"):
        scorer.run_bounded(query)
    again = scorer.start_scoring(scored_stream(spark, csv_folder, profiles), out, log, trigger=None, publish=flaky)
    scorer.run_bounded(again)
    got = spark.read.parquet(f"{out}/verdicts").drop("scored_at", "batch_id")
    assert failed and rows_of(got) == rows_of(expected_verdicts(silver))


def test_empty_batch_writes_nothing(spark, profiles, tmp_path):
    empty = spark.createDataFrame([], scoring.to_verdicts(
        spark.createDataFrame([], "user int, amount double, merchant_state string, mcc int, hour int, p double, prediction double, is_fraud int")
    ).schema)
    scorer.batch_writer(str(tmp_path / "out"), 5)(empty, 0)
    assert not (tmp_path / "out").exists()


def test_unseen_user_and_mcc_score_as_zero_features(spark, profiles):
    row = spark.createDataFrame([(-77, -77, 10.0)], "user int, mcc int, amount_abs double")
    got = features.build_features(row, *profiles).first()
    assert (got.amount_vs_user_mean, got.amount_zscore, got.user_txn_count, got.mcc_frequency) == (0.0, 0.0, 0, 0)


def test_single_transaction_user_has_zero_deviation(spark):
    row = spark.createDataFrame([(1, 10.0)], "user int, amount_abs double")
    assert features.user_stats(row).first().user_amount_std == 0.0


def test_decode_drops_broken_and_keeps_offsets(spark):
    rows = spark.createDataFrame(
        [('{"user":3,"event_id":9,"amount":1.5,"emitted_at":"x"}', 1, 7), ("{bad", 1, 8), ('{"amount":2}', 1, 9), (None, 1, 10)],
        "body string, partition int, offset long",
    ).select(F.col("body").cast("binary").alias("value"), "partition", "offset", F.current_timestamp().alias("timestamp"))
    got = streams.decode_events(rows).collect()
    assert [(r.user, r.event_id, r.amount, r.kafka_partition, r.kafka_offset) for r in got] == [(3, 9, 1.5, 1, 7)]


def test_event_schema_has_43_fields():
    names = event_schema().fieldNames()
    assert len(names) == 43 and names[-2:] == ["event_id", "emitted_at"]
    assert {"txn_timestamp", "processed_at"}.isdisjoint(names)


def test_published_record_keeps_null_fields(spark):
    row = spark.createDataFrame([(7, None)], "user int, amount double")
    assert tuple(scorer.to_kafka_records(row).first()) == ("7", '{"user":7,"amount":null}')


def test_event_round_trip(spark, sf_dir):
    sent = live.messages(views.event_rows(spark, sf_dir))
    got = streams.decode_events(sent).select("event_id", "user", "amount")
    kept = views.event_rows(spark, sf_dir).filter(f"NOT ({live.BROKEN})").select("event_id", "user", "amount")
    assert rows_of(got) == rows_of(kept)


def test_coerce_covers_all_message_fields(spark, silver):
    text = silver.select(*[F.col(c).cast("string").alias(c) for c in silver.columns])
    got = scorer.coerce_event(text.drop("txn_timestamp", "processed_at"))
    assert sorted(got.columns) == sorted(set(event_schema().fieldNames()) - {"event_id", "emitted_at"})
    typed = dict(got.dtypes)
    assert all(typed[f.name] == f.dataType.simpleString() for f in event_schema().fields if f.name in typed)


def test_read_verdicts_skips_broken_lines(spark, tmp_path):
    (tmp_path / "kafka_batch_1.json").write_text('{"event_id":1,"user":2,"batch_id":1}\n{"event_id":\n\n{"event_id":3,"user":4}\n')
    got = files.read_verdicts(spark, str(tmp_path))
    assert sorted(r.event_id for r in got.select("event_id", "user").collect()) == [1, 3]


def test_live_views(spark):
    rows = spark.createDataFrame(
        [(1, 0, 0.15, 0, 0, "A"), (2, 0, 0.95, 1, 1, "A"), (3, 1, 0.7, 1, 0, "B")],
        "event_id int, batch_id long, fraud_probability double, predicted_fraud int, actual_fraud int, merchant_state string",
    )
    kpis = liveops.stream_kpis(rows).first()
    assert (kpis.scored, kpis.flagged, kpis.labelled_fraud, kpis.batches, kpis.peak_risk) == (3, 2, 1, 2, 0.95)
    bands = {r.band: r.n for r in liveops.risk_histogram(rows).collect()}
    assert bands == {"minimal": 1, "low": 0, "elevated": 1, "high": 0, "critical": 1}
    assert [tuple(r) for r in liveops.flag_rate_by_state(rows).collect()] == [("A", 2, 1, 50.0), ("B", 1, 1, 100.0)]
    assert [r.event_id for r in liveops.top_risk(rows, 2).collect()] == [2, 3]
    empty = liveops.stream_kpis(rows.limit(0)).first()
    assert (empty.scored, empty.flagged, empty.flag_rate_pct) == (0, 0, 0.0)


def test_idle_stream_has_zero_counters(spark, tmp_path):
    got = scorer.written_counters(spark, str(tmp_path / "never")).first()
    assert (got.batches, got.rows, got.flagged) == (0, 0, 0)
