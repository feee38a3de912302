import pytest
from pyspark.sql import functions as F

from cardrisk.functions import risk
from cardrisk.operators import evaluate, scoring


def values(spark, given, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v double")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


def test_calibrate_restores_the_prior(spark):
    got = values(spark, [0.5, 0.0, 1.0], lambda p: risk.calibrate(p, 0.00165))
    assert got[0] == pytest.approx(0.00165)
    assert 0 < got[1] < 1e-10 and 0.999 < got[2] < 1


def test_missing_scores_stay_missing(spark):
    assert values(spark, [None], lambda p: risk.calibrate(p, 0.01)) == [None]


def test_calibrate_is_monotone(spark):
    got = values(spark, [i / 50 for i in range(51)], lambda p: risk.calibrate(p, 0.01))
    assert got == sorted(got)


def test_lift_bands_at_their_edges(spark):
    got = values(spark, [2.99, 3.0, 9.99, 10.0, 30.0, 99.0, 100.0], lambda p: risk.risk_band(p, 1.0))
    assert got == ["minimal", "low", "low", "elevated", "high", "high", "critical"]
    assert values(spark, [0.5], lambda p: risk.risk_band(p, 0.0)) == ["minimal"]


def test_absolute_bands_are_left_closed(spark):
    got = values(spark, [0.1499, 0.15, 0.40, 0.70, 0.90], risk.absolute_risk_band)
    assert got == ["minimal", "low", "elevated", "high", "critical"]


def test_histogram_bands_are_right_closed(spark):
    got = values(spark, [0.0, 0.15, 0.1501, 0.40, 0.70, 0.90, 0.91, 1.0, 1.01, None], risk.histogram_band)
    assert got == ["minimal", "minimal", "low", "low", "elevated", "high", "critical", "critical", None, None]


def test_verdict_at_the_cutoff(spark):
    assert values(spark, [0.3, 0.29999], lambda p: risk.verdict(p, 0.01, 30)) == ["REVIEW", "CLEAR"]


def test_rate_severity(spark):
    got = values(spark, [0.31, 0.3, 0.11, 0.1, 0.0], risk.rate_severity)
    assert got == ["critical", "elevated", "elevated", "normal", "normal"]


def test_amount_buckets(spark):
    got = values(spark, [0.0, 9.99, 10.0, 24.99, 250.0, 999.99, 1000.0], risk.amount_bucket)
    assert got == ["0-10", "0-10", "10-25", "10-25", "250-500", "500-1000", "1000+"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, p double").withColumn("prediction", (F.col("p") >= 0.5).cast("double"))


def test_confusion_rates_of_published_cells(spark):
    cells = spark.createDataFrame([(37700, 5498428, 5498, 20958374)], "tp long, fp long, fn long, tn long")
    got = evaluate.confusion_rates(cells).first()
    assert (got.precision, got.recall, got.f1, got.accuracy) == (0.00681, 0.872726, 0.013514, 0.792305)


def test_confusion_without_positives(spark):
    got = evaluate.confusion(frame(spark, [(0, 0.1), (0, 0.2)])).first()
    assert (got.precision, got.recall, got.f1, got.accuracy) == (0.0, 0.0, 0.0, 1.0)


def test_threshold_sweep(spark):
    rows = frame(spark, [(1, 0.9), (1, 0.45), (0, 0.45), (0, 0.05)])
    got = {r.threshold: (r.precision, r.recall, r.flagged) for r in evaluate.threshold_sweep(rows).collect()}
    assert got[0.1] == (0.666667, 1.0, 3)
    assert got[0.5] == (1.0, 0.5, 1)
    assert len(got) == 9


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    ap, seen = 0.0, 0
    for cut in sorted({p for _, p in rows}, reverse=True):
        tp = sum(1 for p in pos if p >= cut)
        flagged = sum(1 for _, p in rows if p >= cut)
        ap += (tp - seen) / len(pos) * tp / flagged
        seen = tp
    return ap, wins / (len(pos) * len(neg))


def test_exact_auc_against_all_pairs(spark):
    import random

    rng = random.Random(3)
    rows = [(int(rng.random() < 0.2), round(rng.random(), 2)) for _ in range(400)]
    ap, roc = brute_auc(rows)
    got = evaluate.exact_auc(frame(spark, rows).repartition(5)).first()
    assert got.pr_auc == pytest.approx(ap, abs=1e-6)
    assert got.roc_auc == pytest.approx(roc, abs=1e-6)


def test_exact_auc_passes_over_missing_scores(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 0.2), (1, None), (1, 0.7), (0, nan), (1, inf), (0, -inf), (0, 0.9)]
    ap, roc = brute_auc([(y, p) for y, p in rows if p is not None and p == p])
    got = evaluate.exact_auc(frame(spark, rows)).first()
    assert (got.pr_auc, got.roc_auc) == (pytest.approx(ap, abs=1e-6), pytest.approx(roc, abs=1e-6))
    assert (got.positives, got.negatives, got.skipped) == (2, 3, 2)
    none = evaluate.exact_auc(frame(spark, [(1, None), (0, None)])).first()
    assert (none.positives, none.negatives, none.skipped) == (None, None, 2)


def test_running_totals_refuse_nulls(spark):
    from cardrisk.operators.sizing import running_totals

    groups = spark.createDataFrame([(1.0, 1), (None, 2)], "v double, n long")
    with pytest.raises(Exception, match="need a value"):
        running_totals(groups, "v", ["n"]).collect()


def test_brier_and_lift(spark):
    rows = frame(spark, [(1, 0.8), (0, 0.4)])
    assert evaluate.brier(rows).first()[0] == pytest.approx(0.1)
    lifted = evaluate.pr_lift(evaluate.exact_auc(rows)).first()
    assert (lifted.pr_auc, lifted.base_rate, lifted.pr_lift) == (1.0, 0.5, 2.0)


def test_assess(spark):
    got = scoring.assess(spark.createDataFrame([(0.99,)], "p double"), 0.00165).first()
    assert got.risk_band == "high" or got.lift_vs_base_rate >= 30
    assert got.threshold == pytest.approx(0.0495)
    assert got.verdict == ("REVIEW" if got.fraud_probability >= got.threshold else "CLEAR")
