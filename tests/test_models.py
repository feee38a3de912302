from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardrisk.operators import evaluate, explain, features, models, scoring
from cardrisk.session import scratch
from cardrisk.sources import sinks

NUMERIC = ["a", "b", "c"]
CATEGORICAL = ["kind"]


def brute_force_shares(x, leaves):
    """Textbook Shapley values over all coalitions."""
    width = x.shape[1]

    def worth(row, known):
        total = 0.0
        for leaf in leaves:
            weight = leaf["value"]
            for f, (tests, cover) in leaf["path"].items():
                if f in known:
                    weight *= all(explain.passes(row[[f]], kind, cut)[0] == goes_left for kind, cut, goes_left in tests)
                else:
                    weight *= cover
            total += weight
        return total

    out = np.zeros(x.shape)
    for r, row in enumerate(x):
        worths = {known: worth(row, set(known)) for size in range(width + 1) for known in combinations(range(width), size)}
        for i in range(width):
            for known, before in worths.items():
                if i not in known:
                    weight = factorial(len(known)) * factorial(width - 1 - len(known)) / factorial(width)
                    out[r, i] += weight * (worths[tuple(sorted((*known, i)))] - before)
    return out


@pytest.fixture(scope="module")
def planted(spark):
    """Fraud follows a and kind; b and c are noise."""
    n = F.col("id")
    rows = spark.range(4000).select(
        ((n * 7919) % 1000 / 1000.0).alias("a"),
        ((n * 104729) % 997 / 997.0).alias("b"),
        ((n * 31) % 13).cast("double").alias("c"),
        F.concat(F.lit("k"), (n % 5).cast("string")).alias("kind"),
        n.alias("id"),
    )
    fraud = (F.col("a") > 0.8) & F.col("kind").isin("k1", "k3") | ((F.col("id") * 17) % 101 == 0)
    labelled = rows.withColumn("is_fraud", fraud.cast("int"))
    return features.class_weighted(labelled, 8.0).cache()


def fit(planted, kind, **settings):
    return models.pipeline(kind, NUMERIC, CATEGORICAL, **settings).fit(planted)


@pytest.fixture(scope="module", params=["gbt", "rf"])
def ensemble(request, spark, planted):
    settings = {"gbt": {"maxIter": 4}, "rf": {"numTrees": 4}}[request.param]
    model = fit(planted, request.param, maxDepth=4, maxBins=16, **settings)
    path = scratch(spark, "test-model")
    sinks.save_model(model, path)
    return request.param, model, path


def test_models_beat_the_base_rate(planted, ensemble):
    _, model, _ = ensemble
    scored = scoring.score(planted, model).withColumn("label", F.col("is_fraud"))
    got = evaluate.pr_lift(evaluate.exact_auc(scored)).first()
    assert got.pr_lift > 3


def test_loaded_model_scores_alike(planted, ensemble):
    _, model, path = ensemble
    ours = scoring.score(planted, model).select("id", "p")
    loaded = scoring.score(planted, sinks.load_model(path)).select("id", "p")
    assert ours.exceptAll(loaded).isEmpty()


def test_tree_contributions_add_up(planted, ensemble):
    kind, model, path = ensemble
    names = features.tree_feature_names(NUMERIC, CATEGORICAL)
    rows = scoring.score(planted, model).select(*planted.columns, "p")
    explained = explain.tree_contributions(model, path, rows, names, ["id", "p"])
    total = F.expr("base_value + aggregate(contributions, 0D, (s, c) -> s + c.contribution)")
    rebuilt = 1 / (1 + F.exp(-2 * total)) if kind == "gbt" else total
    worst = explained.agg(F.max(F.abs(rebuilt - F.col("p")))).first()[0]
    assert worst < 1e-9
    ranked = explain.global_attribution(explained).collect()
    assert {ranked[0].feature, ranked[1].feature} == {"a", "kind_idx"}


def test_tree_contributions_against_all_coalitions(spark, planted, ensemble):
    kind, model, path = ensemble
    trees = explain.read_trees(spark, path, margin=kind == "gbt")
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    vectors = PipelineModel(stages=model.stages[:-1]).transform(planted.filter("id % 400 = 0"))
    x = np.array([r[0] for r in vectors.select(vector_to_array("features")).collect()])
    expected = brute_force_shares(x, explain.leaves_of(trees))
    assert np.allclose(explain.tree_shares(x, trees), expected, atol=1e-12)


@pytest.mark.parametrize("height", [0, 1, 3, 30])
def test_parts_of_any_height_give_the_same(monkeypatch, spark, ensemble, height):
    kind, _, path = ensemble
    trees = explain.read_trees(spark, path, margin=kind == "gbt")
    x = np.random.default_rng(5).random((50, 4)) * [1, 1, 13, 5]
    expected = explain.tree_shares(x, trees)
    monkeypatch.setattr(explain, "PART_HEIGHT", height)
    assert np.allclose(explain.tree_shares(x, trees), expected, atol=1e-12)


def test_deep_trees_equal_brute_force():
    """A path longer than any table of outcomes could hold, with features tested again below."""
    edges, tests = [], []
    for level in range(24):
        feature = level % 9
        tests.append((feature, False, (0.9 - 0.03 * level,)))
        parent, ancestor = 2 * (level - 1), 2 * (level - 9) if level >= 9 else -1
        for goes_left in (True, False):
            own = 0.8 if goes_left else 0.2
            share = own * (edges[ancestor][5] if ancestor >= 0 else 1.0)
            leaf = None if goes_left and level < 23 else float(level + 1)
            edges.append((parent if level else -1, ancestor, feature, level, goes_left, share, leaf))
    tree = explain.Tree(tests, edges, 0.0, 24)
    x = np.random.default_rng(3).random((4, 9)) * 0.8
    assert np.allclose(explain.tree_shares(x, [tree]), brute_force_shares(x, explain.leaves_of([tree])), atol=1e-10)
    assert explain.tree_shares(np.zeros((0, 9)), [tree]).shape == (0, 9)


def test_linear_contributions_add_up(planted):
    model = fit(planted, "lr")
    explained = explain.linear_contributions(model, planted, planted, ["id"])
    total = F.expr("base_value + aggregate(contributions, 0D, (s, c) -> s + c.contribution)")
    scored = scoring.score(planted, model).select("id", "p")
    gap = explained.join(scored, "id").agg(F.max(F.abs(1 / (1 + F.exp(-total)) - F.col("p")))).first()[0]
    assert gap < 1e-9
    names = explained.select(F.transform("contributions", lambda c: c["feature"])).first()[0]
    assert names[:3] == NUMERIC and len(names) > 3


def test_drivers(spark):
    rows = spark.createDataFrame(
        [(0.9, [("x", 1.0, -0.5), ("y", 2.0, 2.0), ("z", 0.0, 0.5)]), (0.1, [("x", 1.0, 3.0)])],
        f"p double, contributions {explain.CONTRIBUTION_DDL}",
    )
    first = explain.top_drivers(rows, 2).first().drivers
    assert [(d.feature, d.direction) for d in first] == [("y", "increases risk"), ("x", "decreases risk")]
    best = explain.highest_risk_example(rows, n=1).first()
    assert (best.p, best.feature) == (0.9, "y")


def test_one_failing_model_does_not_stop_the_rest(spark, silver):
    seen = []
    fitted, rows = models.train_models(
        silver, kinds=["rf", "lr"], on_model=lambda name, model, metrics, scored: seen.append((name, model is None)),
        rf={"maxBins": 2}, lr={"maxIter": 2},
    )
    got = {r.model: r for r in rows.collect()}
    assert seen == [("random_forest", True), ("logistic_regression", False)]
    assert got["random_forest"].error and got["logistic_regression"].pr_auc is not None
    assert list(fitted) == ["logistic_regression"]
    assert evaluate.best_model(rows).first().name == "logistic_regression"
    assert evaluate.rank_models(rows).first().model == "logistic_regression"


def test_skipped_models_are_not_fitted(silver):
    assert models.train_models(silver, kinds=["lr"], skip=["lr"]) == ({}, None)


def test_importances_fall_back_to_positions(spark, planted):
    model = fit(planted, "rf", numTrees=2, maxDepth=2, maxBins=16)
    named = models.feature_importances(model, spark, features.tree_feature_names(NUMERIC, CATEGORICAL))
    assert {r.feature for r in named.collect()} == {"a", "b", "c", "kind_idx"}
    assert {r.feature for r in models.feature_importances(model, spark, ["only"]).collect()} == {"f0", "f1", "f2", "f3"}


def test_synthetic_warning(spark):
    ranked = spark.createDataFrame([("a", 3.0), ("vpn_flag", 2.0), ("b", 1.0), ("c", 0.5)], "feature string, v double")
    assert models.synthetic_warning(ranked, "v").first().in_top is True
    assert models.synthetic_warning(ranked, "v", "c").first().in_top is False


def test_serving_model_stops_on_the_holdout(silver):
    model, scored, names = models.train_serving_model(silver, drop=["vpn_flag"], maxIter=3, maxDepth=3)
    assert "vpn_flag" not in names and len(names) == 19
    assert scored.filter("user % 5 <> 0").isEmpty()
    assert model.stages[-1].getNumTrees <= 3


def test_request_defaults(spark):
    sent = spark.createDataFrame([(-12.5, "ny ")], "amount double, merchant_state string")
    row = features.fill_missing_features(features.request_features(sent), ["hour", "mcc", "is_refund", "device_os", "extra"]).first()
    assert (row.hour, row.mcc, row.is_refund, row.device_os, row.extra) == (12, 5411, 1, "Android", 0)
    full = features.request_features(sent).first()
    assert (full.merchant_state, full.is_foreign_or_unknown, full.amount_abs) == ("NY ", 0, 12.5)


def test_tree_bins_follow_the_labels(spark):
    from cardrisk.operators import features, models

    rows = spark.range(1000).selectExpr("CAST(id AS STRING) AS merchant_state", "'a' AS error_type", "'b' AS device_os", "'c' AS use_chip")
    indexed = models.fit_indexers(rows, features.CATEGORICAL)
    assert indexed[1] == 1001
    for kind in ("rf", "gbt"):
        assert models.pipeline(kind, indexed=indexed).getStages()[-1].getMaxBins() == 1001


def test_wide_categoricals_are_bounded(spark):
    """100,000 states: the driver, the model and a tree's bins hold a thousand labels and one for all others."""
    from cardrisk.operators import features, models

    rows = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("S"), F.col("id") % 100)).otherwise(F.concat(F.lit("T"), "id")).alias("merchant_state"),
        F.lit("a").alias("error_type"), F.lit("b").alias("device_os"), F.lit(None).cast("string").alias("use_chip"),
        F.rand(3).alias("amount_abs"), (F.col("id") % 7 == 0).cast("int").alias("is_fraud"), F.lit(1.0).alias("class_weight"),
    )
    assert rows.select("merchant_state").distinct().count() > 100_000
    index, bins = models.fit_indexers(rows, features.CATEGORICAL)
    assert bins == 1001 and [len(x.labels) for x in index] == [0, 1000, 1, 1]
    assert set(index[1].labels[:50]) == {f"S{i}" for i in range(0, 100, 2)}
    seen = index[1].transform(rows)
    assert seen.filter("merchant_state_idx = 1000").count() == 100_000 - 950
    fitted = models.pipeline("rf", ["amount_abs"], features.CATEGORICAL, (index, bins), numTrees=1, maxDepth=2).fit(rows)
    assert fitted.transform(rows.limit(5)).count() == 5


def test_narrow_categoricals_are_indexed_as_before(spark, silver):
    from cardrisk.operators import features

    ours, theirs = features.bounded_indexers(silver), features.indexers()[0].fit(silver)
    assert [tuple(index.labels) for index in ours] == [tuple(labels) for labels in theirs.labelsArray]


def test_requests_without_an_amount_are_refused(spark):
    from cardrisk.operators import features

    with pytest.raises(ValueError, match="amount"):
        features.request_features(spark.createDataFrame([(1,)], "hour int"))


def test_only_the_highest_score_is_explained(spark):
    rows = spark.createDataFrame([(1, 0.2), (2, 0.9), (3, 0.9), (4, None)], "user int, p double")
    assert sorted(r.user for r in explain.highest_scored(rows).collect()) == [2, 3]
    assert [r.user for r in explain.highest_scored(rows.filter("user = 4")).collect()] == [4]
    assert explain.highest_scored(rows.limit(0)).isEmpty()
