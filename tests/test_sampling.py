import pytest
from pyspark.sql import functions as F

from cardrisk.operators import features, sampling, sizing
from cardrisk.sources.files import read_silver


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows are copies of one row; 1 in 50 of the rest is positive."""
    plain = spark.range(2000).select(
        F.col("id").cast("int").alias("user"), (F.col("id") % 50 == 0).cast("int").alias("is_fraud"),
        F.concat(F.lit("r"), "id").alias("note"),
    )
    hot = spark.range(1000).select(F.lit(-1).alias("user"), F.lit(0).alias("is_fraud"), F.lit("hot").alias("note"))
    return plain.unionByName(hot).cache()


def test_hash_sample_ignores_layout(skewed):
    first = rows_of(sampling.sample_by_hash(skewed, 0.2))
    assert rows_of(sampling.sample_by_hash(skewed.repartition(7), 0.2)) == first
    assert rows_of(sampling.sample_by_hash(skewed, 0.2, seed=43)) != first


def test_copies_are_sampled_by_count(skewed):
    kept = sampling.sample_by_hash(skewed, 0.2)
    hot = kept.filter("note = 'hot'").count()
    assert hot in (200, 201)
    assert 300 < kept.count() - hot < 500


def test_light_copies_go_together(spark):
    rows = spark.range(4000).select((F.col("id") % 2000).alias("user"), F.lit(0).alias("is_fraud"))
    kept = sampling.sample_by_hash(rows, 0.3)
    assert kept.groupBy("user").count().filter("count <> 2").isEmpty() and 1000 < kept.count() < 1400


def test_boundary_among_copies_and_ties_of_a_key(spark):
    rows = spark.range(600).select((F.col("id") % 3).alias("user"), (F.col("id") % 4).alias("is_fraud"), F.lit("k").alias("key"))
    for n in (1, 49, 50, 51, 275, 599):
        taken = sampling.take_by_hash(rows, n, key=F.col("key"))
        assert taken.count() == n and taken.exceptAll(rows).isEmpty()
    small, large = (sampling.take_by_hash(rows.repartition(p), n, key=F.col("key")) for p, n in ((3, 120), (7, 240)))
    assert small.exceptAll(large).isEmpty()


def test_first_digests_against_a_sort(spark):
    rows = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("digest"))
    ordered = sorted(r.digest for r in rows.collect())
    for n in (1, 17, 1500, 2999):
        last, room, whole = sampling._boundary(rows, n)
        assert whole and [d for d in ordered if d[: len(last)] <= last] == ordered[:n]
    assert sampling._boundary(rows, 3000) == (None, 0, True)
    assert sampling.take_by_hash(rows.limit(0), 5).count() == 0


def test_pool_leaves_amounts_that_are_no_number(spark):
    raw = spark.createDataFrame([("5", "$1.00"), ("5", "NaN"), ("5", "Infinity"), ("5", "-$2"), ("5", "x"), ("x", "1"), ("6", "1")], "user string, amount string")
    assert sorted(r.amount for r in sampling.pool_sample(raw, 10, holdout=True).collect()) == ["$1.00", "-$2"]


def test_heavy_keys_are_all_found(spark):
    rows = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "warm").when(F.col("id") % 7 == 0, None)
                                      .otherwise(F.concat(F.lit("k"), "id")).alias("key"))
    want = {r.key: r["count"] for r in rows.filter("key in ('hot', 'warm')").groupBy("key").count().collect()}
    assert sizing.heavy_keys(rows, "key") == want
    assert sizing.heavy_keys(rows.limit(0), "key") == {} and sizing.heavy_keys(rows.filter("key is null"), "key") == {}


def test_many_copies_are_dealt_out(skewed, monkeypatch):
    monkeypatch.setattr(sampling, "COPIES_PER_TASK_ROW", 64)
    assert sampling.sample_by_hash(skewed, 1.0).groupBy(*skewed.columns).count().exceptAll(
        skewed.groupBy(*skewed.columns).count()
    ).isEmpty()
    assert sampling.sample_by_hash(skewed, 1.0).count() == 3000


@pytest.mark.parametrize("n", [0, 1, 7, 500, 2999, 3000, 9000])
def test_take_is_exact(skewed, n):
    taken = sampling.take_by_hash(skewed, n)
    assert taken.count() == min(n, 3000)
    assert taken.exceptAll(skewed).isEmpty()


def test_take_is_nested_and_repeatable(skewed):
    small, large = sampling.take_by_hash(skewed, 40), sampling.take_by_hash(skewed.repartition(9), 400)
    assert small.exceptAll(large).isEmpty()


def test_stratified_keeps_every_positive(skewed):
    got = sampling.stratified_sample(skewed, negatives_per_positive=10)
    counts = {r.is_fraud: r["count"] for r in got.groupBy("is_fraud").count().collect()}
    assert counts[1] == 40
    assert 300 < counts[0] < 500


def test_the_ratio_holds_among_copies_of_every_row(spark, monkeypatch):
    rows = spark.range(3000).select(
        F.col("id").alias("user"), F.when(F.col("id") % 7 == 0, None).otherwise(F.lit(0.0)).alias("note"),
        F.expr("CASE WHEN id < 100 THEN 7 WHEN id < 200 THEN 2 ELSE 1 END").alias("n"), F.lit(0).alias("is_fraud"),
    )
    rows = rows.selectExpr("user", "note", "n", "is_fraud", "explode(sequence(1, n)) AS _").drop("_")
    kept = sampling.sample_copies_by_hash(rows, 0.4)
    found = {(r.n, r["count"]) for r in kept.groupBy("user", "n").count().collect()}
    assert {c for n, c in found if n == 7} == {2, 3}
    assert {c for n, c in found if n == 2} == {1}
    assert 1000 < kept.filter("n = 1").count() < 1240 and kept.exceptAll(rows).isEmpty()
    monkeypatch.setattr(sampling, "fits_broadcast", lambda frame: False)
    assert rows_of(sampling.sample_copies_by_hash(rows.repartition(5), 0.4)) == rows_of(kept)


def test_stratified_by_row_identity(spark, sf_dir):
    from cardrisk.plans import tables

    table = read_silver(spark, tables.silver_path(spark, sf_dir), row_id=True)
    assert table.select("row_id").distinct().count() == table.count()
    got = sampling.stratified_sample(table, 60, key="row_id")
    assert got.filter("is_fraud = 1").count() == table.filter("is_fraud = 1").count()
    assert rows_of(got.select("row_id")) == rows_of(
        sampling.stratified_sample(table.repartition(3), 60, key="row_id").select("row_id")
    )


def test_cap_rows(skewed):
    got = sampling.cap_rows(skewed, 500, min_negatives=100)
    assert got.count() == 500 and got.filter("is_fraud = 1").count() == 40
    assert sampling.cap_rows(skewed, 5000).count() == 3000
    assert sampling.cap_rows(skewed, 50, min_negatives=100).count() == 140


def test_split_shares_no_user_and_covers_all(silver):
    train, holdout = sampling.user_split(silver)
    assert train.count() + holdout.count() == silver.count()
    assert train.select("user").intersect(holdout.select("user")).isEmpty()


def test_sentinel_user_is_train(spark):
    train, holdout = sampling.user_split(spark.createDataFrame([(-1,), (5,)], "user int"))
    assert [r[0] for r in train.collect()] == [-1] and [r[0] for r in holdout.collect()] == [5]


def test_model_input(spark):
    rows = spark.createDataFrame([(None, None, 1.5)], "device_os string, mcc int, amount_abs double")
    got = sampling.downcast(sampling.fill_model_input(rows, ["device_os"]))
    assert tuple(got.first()) == ("UNKNOWN", 0, 1.5)
    assert dict(got.dtypes)["amount_abs"] == "float"
    assert sampling.drop_features(got, ["mcc", "absent"]).columns == ["device_os", "amount_abs"]


def test_running_totals_against_a_window(spark):
    from pyspark.sql import Window

    rows = spark.range(500).select(((F.col("id") * 7919) % 101).cast("double").alias("k")).groupBy("k").agg(
        F.count(F.lit(1)).alias("n")
    ).cache()
    whole = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    expected = rows.select("k", F.sum("n").over(whole).alias("upto"))
    for slices in (2, 3, 17):
        got = sizing.running_totals(rows, "k", ["n"], slices=slices).select("k", F.col("n_upto").alias("upto"))
        assert rows_of(got) == rows_of(expected)


def test_running_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "k double, n long")
    assert sizing.running_totals(empty, "k", ["n"]).count() == 0


@pytest.mark.parametrize("p", [0.01, 0.5, 0.99, 1.0])
def test_exact_quantile(spark, p):
    values = [float((i * i) % 997) for i in range(1000)] + [5.0] * 500
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(6)
    expected = rows.selectExpr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY v)").first()[0]
    assert sizing.exact_quantile(rows, "v", p).first()[0] == expected


def test_join_beyond_broadcast_splits_hot_keys(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") < 1000, -1).otherwise(F.col("id") % 700).cast("int").alias("user"), "id"
    )
    dim = facts.filter("user <> 13").groupBy("user").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    small = sizing.left_join_dim(facts, dim, "user", weight="n")
    large = sizing.left_join_dim(facts, dim, "user", weight="n", max_rows=10)
    unweighted = sizing.left_join_dim(facts, dim, "user", max_rows=10)
    absent = sizing.left_join_dim(facts, dim.filter("user <> -1"), "user", max_rows=10)
    assert absent.count() == 3000 and absent.filter("user = -1 and n is not null").isEmpty()
    nulls = facts.withColumn("user", F.when(F.col("id") % 2 == 0, F.col("user")))
    assert sizing.left_join_dim(nulls, dim, "user", max_rows=10).count() == 3000
    columns = ["id", "user", "n", "top"]
    assert rows_of(large.select(*columns)) == rows_of(small.select(*columns))
    assert rows_of(unweighted.select(*columns)) == rows_of(small.select(*columns))
    assert large.filter("n IS NULL").count() == facts.filter("user = 13").count()
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()


def test_profiles_of_more_keys_are_broadcast_and_beyond_that_rows_are_not_sorted(spark):
    facts = spark.range(4000).select(
        F.when(F.col("id") < 900, -1).when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 700).cast("int").alias("user"),
        (F.col("id") % 3).cast("int").alias("mcc"), F.col("id").cast("double").alias("amount_abs"),
    )
    users, mccs = features.user_stats(facts.filter("user <> 13")), features.mcc_frequency(facts)
    small, large = features.join_profiles(facts, users, mccs), features.join_profiles(facts, users, mccs, max_rows=10)
    assert rows_of(small) == rows_of(large) and small.count() == 4000
    text = large._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    assert 4_000_000 < sizing.narrow_rows(users) < 6_000_000
    many = spark.range(sizing.MAX_BROADCAST_ROWS + 1).selectExpr("CAST(id AS INT) AS user", "1D AS user_amount_mean", "0D AS user_amount_std", "1L AS user_txn_count")
    text = features.join_profiles(facts, many, mccs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "ShuffledHashJoin" not in text and "SortMergeJoin" not in text
