import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import evaluate as ev

SCHEMA = "trans_num int, is_fraud boolean, score double, amt double"


def scored(spark, rows):
    return ev.Scored(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA))


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(3)
    truth = rng.random(400) < 0.2
    score = np.round(truth * 0.8 + rng.normal(size=400), 1)  # many ties
    amount = np.round(rng.gamma(2, 40, 400), 2)
    return truth, score, amount, scored(spark, list(zip(truth.tolist(), score.tolist(), amount.tolist())))


def test_ranking_against_definitions(noisy):
    truth, score, _, table = noisy
    row = ev.ranking_metrics(table).first()
    pos, neg = score[truth], score[~truth]
    pairs = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert row["roc_auc"] == pytest.approx(pairs)
    steps, last = 0.0, 0.0
    for t in sorted(set(score), reverse=True):
        hit = score >= t
        recall = (hit & truth).sum() / truth.sum()
        steps += (recall - last) * (hit & truth).sum() / hit.sum()
        last = recall
    assert row["average_precision"] == pytest.approx(steps)


def test_auc_is_unchanged_by_a_monotone_map(noisy):
    table = noisy[3]
    mapped = ev.Scored(table.df.withColumn("score", F.exp("score") * 3))
    assert ev.ranking_metrics(mapped).first()["roc_auc"] == pytest.approx(ev.ranking_metrics(table).first()["roc_auc"])


def test_sweep_equals_one_filter_per_threshold(noisy):
    truth, score, amount, table = noisy
    thresholds = ev.score_thresholds(table, 240)
    want = np.unique(np.append(np.quantile(score, np.linspace(0.001, 0.999, 240)), 0.0))
    assert np.allclose(thresholds, want)
    last = 1.0
    for row in ev.evaluation_report(table).collect():
        hit = score >= row["threshold"]
        tp, fp = (hit & truth).sum(), (hit & ~truth).sum()
        assert (row["true_fraud_captured"], row["fraud_predictions"]) == (tp, tp + fp)
        assert row["recall"] == pytest.approx(tp / truth.sum()) and row["recall"] <= last
        assert row["fraud_loss_capture_rate"] == pytest.approx(amount[hit & truth].sum() / amount[truth].sum())
        last = row["recall"]


def test_threshold_is_inclusive(spark):
    table = scored(spark, [(True, 0.5, 1.0), (False, 0.4, 1.0)])
    row = ev.confusion(table, 0.5).first()
    assert (row["tp"], row["fp"], row["tn"], row["fn"]) == (1, 0, 1, 0)
    assert [r["predicted"] for r in table.predicted(0.5).orderBy("trans_num").collect()] == [True, False]


def test_all_scores_equal(spark):
    table = scored(spark, [(True, 1.0, 5.0), (False, 1.0, 5.0), (False, 1.0, 5.0), (False, 1.0, 5.0)])
    row = ev.ranking_metrics(table).first()
    assert (row["average_precision"], row["roc_auc"]) == (0.25, 0.5)
    assert [r["threshold"] for r in ev.evaluation_report(table).collect()] == [0.0, 1.0]


def test_one_class_only(spark):
    none = scored(spark, [(False, 1.0, 5.0), (False, 2.0, 5.0)])
    row = ev.summary(none, 1.5).collect()
    values = {r["metric"]: r["value"] for r in row}
    assert values["recall"] == values["precision"] == values["f1_score"] == values["fraud_loss_capture_rate"] == 0.0
    assert values["auprc"] == 0.0 and values["roc_auc"] is None
    assert {r["captured_percent"] for r in ev.loss_capture_curve(none).collect()} == {0.0}


def test_curves(spark):
    table = scored(spark, [(True, 0.9, 10.0), (False, 0.8, 9.0), (True, 0.8, 30.0), (False, 0.1, 1.0)])
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in ev.pr_curve(table).collect()}
    assert pr == {0.9: (1.0, 0.5), 0.8: (2 / 3, 1.0), 0.1: (0.5, 1.0), None: (1.0, 0.0)}
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in ev.roc_curve(table).collect()}
    assert roc == {None: (0.0, 0.0), 0.9: (0.0, 0.5), 0.8: (0.5, 1.0), 0.1: (1.0, 1.0)}
    loss = ev.loss_capture_curve(table).orderBy("flagged_percent").collect()
    assert [r["flagged_percent"] for r in loss] == [25.0, 50.0, 75.0, 100.0]
    # equal scores: the larger key first
    assert [r["trans_num"] for r in loss] == [0, 2, 1, 3]
    assert [r["captured_percent"] for r in loss] == [25.0, 100.0, 100.0, 100.0]


REPORT = "threshold double, recall double, false_positive_rate double, precision double, f1 double, average_precision double, roc_auc double"


def test_select_threshold(spark):
    rows = [(0.1, 0.95, 0.30, 0.2, 0.3, 0.5, 0.6), (0.2, 0.85, 0.10, 0.4, 0.5, 0.5, 0.6), (0.3, 0.80, 0.10, 0.5, 0.6, 0.5, 0.6),
            (0.4, 0.70, 0.01, 0.9, 0.8, 0.5, 0.6)]
    assert ev.select_threshold(spark.createDataFrame(rows, REPORT)).first()["threshold"] == 0.3
    assert ev.select_threshold(spark.createDataFrame(rows[3:] + [(0.5, 0.2, 0.0, 1.0, 0.3, 0.5, 0.6)], REPORT)).first()["threshold"] == 0.4


def test_select_operating_threshold(spark):
    names = "threshold double, recall double, false_positive_rate double, precision double, f1_score double, fraud_loss_capture_rate double"
    rows = [(0.1, 0.9, 0.03, 0.9, 0.9, 0.9), (0.2, 0.85, 0.02, 0.5, 0.6, 0.7), (0.3, 0.82, 0.01, 0.5, 0.6, 0.8), (0.4, 0.7, 0.0, 1.0, 0.9, 0.7)]
    assert ev.select_operating_threshold(spark.createDataFrame(rows, names)).first()["threshold"] == 0.3
    assert ev.select_operating_threshold(spark.createDataFrame(rows[3:], names)).first() is None


@pytest.mark.parametrize("score", [None, float("nan")])
def test_rows_without_a_score_fail_instead_of_vanishing(spark, score):
    table = scored(spark, [(True, 0.5, 1.0), (False, 0.4, 1.0), (False, score, 1.0)])
    for report in (ev.confusion(table, 0.5), ev.sweep(table, [0.3, 0.45]), ev.loss_capture_curve(table)):
        with pytest.raises(Exception, match="no score"):
            report.collect()
    with pytest.raises(Exception, match="no score"):
        ev.ranked_scores(table).collect()


def test_a_ranking_can_be_passed_on(noisy):
    table = noisy[3]
    ranked = ev.ranked_scores(table)
    for report in (ev.pr_curve, ev.roc_curve, ev.ranking_metrics):
        assert sorted(map(str, report(table, ranked).collect())) == sorted(map(str, report(table).collect()))
