import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.models import artifact as art
from ledgerlight.models import kernel, linear, tuning
from ledgerlight.models.features import fit_frequency_maps, gamma_scale, prepare_features
from ledgerlight.operators import evaluate as ev
from ledgerlight.plans import detect


@pytest.fixture(scope="module")
def planted(spark):
    """Positives far from the middle: a kernel model sees them, a linear one only half of them."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 3))
    truth = (x[:, 0] > 1.4) | (np.abs(x[:, 1]) > 2.2)
    rows = [(i, bool(t), *map(float, r)) for i, (t, r) in enumerate(zip(truth, x))]
    df = spark.createDataFrame(rows, "trans_num int, is_fraud boolean, a double, b double, c double").repartition(4).cache()
    return tuning.FeatureTable(df, "trans_num", "is_fraud", ("a", "b", "c"))


def auc(table, model):
    scored = table.df.select("trans_num", "is_fraud", model.score().alias("score"), F.lit(1.0).alias("amt"))
    return ev.ranking_metrics(ev.Scored(scored)).first()["roc_auc"]


def test_modified_huber_reaches_its_minimum(planted):
    alpha, weight = 0.001, 20.0
    model = linear.fit_modified_huber(planted.df, planted.columns, "is_fraud", alpha, weight)
    frame = planted.df.toPandas()
    x = np.column_stack([frame[list(planted.columns)], np.ones(len(frame))])
    sign = np.where(frame["is_fraud"], 1.0, -1.0)
    each = np.where(frame["is_fraud"], weight, 1.0)

    def loss(w):
        m = sign * (x @ w)
        terms = np.where(m >= 1, 0.0, np.where(m >= -1, (1 - m) ** 2, -4 * m))
        return (each * terms).mean() + alpha / 2 * (w[:-1] @ w[:-1])

    best = np.array([*model.weights, model.intercept])
    rng = np.random.default_rng(0)
    assert all(loss(best) <= loss(best + rng.normal(scale=s, size=4)) + 1e-7 for s in (1e-3, 1e-2, 0.1) for _ in range(50))
    assert auc(planted, model) > 0.7


def test_log_loss_ranks(planted):
    model = linear.fit_log_loss(planted.df, planted.columns, "is_fraud", 0.001, 20.0)
    assert model.weights[0] > abs(model.weights[2]) and auc(planted, model) > 0.7


def test_fourier_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 3))
    mapping = kernel.FourierMap.draw(["a", "b", "c"], 0.3, 4000)
    z = mapping.z(x)
    exact = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).mean() < 2 / np.sqrt(4000)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    assert np.allclose([r["z"] for r in df.select(mapping.mapped().alias("z")).collect()], z)


def test_kernel_beats_linear(planted):
    gamma = gamma_scale(planted.df, planted.columns)
    frame = planted.df.select(*planted.columns).toPandas().to_numpy()
    assert gamma == pytest.approx(1 / (3 * frame.var()))
    model = kernel.fit_kernel(planted.df, planted.columns, "is_fraud", 1.0, 10.0, gamma)
    plain = linear.fit_log_loss(planted.df, planted.columns, "is_fraud", 0.001, 10.0)
    assert auc(planted, model) > max(0.9, auc(planted, plain))


def test_one_class_flags_nu_of_its_rows(planted):
    normal = planted.normal()
    model = kernel.fit_one_class(normal.df, planted.columns, 0.05, gamma_scale(normal.df, planted.columns))
    flagged = normal.df.agg(F.avg((model.score() >= 0).cast("double"))).first()[0]
    assert flagged == pytest.approx(0.05, abs=2 / normal.df.count())
    assert auc(planted, model) > 0.8


def test_grids_and_groups():
    assert [len(tuning.param_grid(k)) for k in ("linear", "kernel", "oneclass")] == [24, 6, 6]
    assert [len(tuning.param_grid(k, "fast")) for k in ("linear", "kernel", "oneclass")] == [1, 1, 1]
    assert tuning.chosen_models(["oneclass", "both"]) == ["linear", "kernel"]
    assert tuning.chosen_models(["all"]) == ["linear", "kernel", "oneclass"]
    assert tuning.chosen_models(["oneclass", "linear"]) == ["linear", "oneclass"]


def test_selection_prefers_the_recall_goal(spark):
    df = spark.createDataFrame([(0.79, 0.0, 1.0), (0.8, 0.5, 0.1)], "r double, f double, p double")
    rows = df.select(tuning.selection_score(F.col("r"), F.col("f"), F.col("p")).alias("s")).collect()
    assert [round(r["s"], 6) for r in rows] == [0.79, 9.6]


def test_equal_points_keep_the_first(planted):
    point = tuning.param_grid("linear", "fast")[0]
    best, threshold, results = tuning.tune("linear", planted, [{**point, "tag": 1}, {**point, "tag": 2}])
    assert results[0]["selection"] == results[1]["selection"] and best["tag"] == 1
    assert best["fraud_weight"] == 200 and results[0]["threshold"] == threshold
    assert results[0]["fit_rows"] > results[0]["fit_fraud_rows"] > 0
    report = tuning.tuning_report(planted.df.sparkSession, results)
    assert report.columns[:2] == ["loss", "alpha"]


@pytest.mark.parametrize("kind", ["linear", "kernel", "oneclass"])
def test_shared_passes_fit_what_single_fits_do(planted, kind):
    points = tuning.param_grid(kind)[:3]
    together = tuning.fit_all(kind, planted, points)
    for point, model in zip(points, together):
        alone = tuning.fit(kind, planted, point)
        assert np.allclose(alone.weights, model.weights, rtol=1e-6, atol=1e-8) and alone.steps == model.steps
        assert model.converged and model.steps > 0


def test_a_fit_that_is_cut_short_says_so(planted, monkeypatch, spark, tmp_path):
    monkeypatch.setattr(linear, "MAX_NEWTON_STEPS", 1)
    model = linear.fit_log_loss(planted.df, planted.columns, "is_fraud", 0.001, 20.0)
    assert not model.converged
    art.save(spark, art.Artifact(model), str(tmp_path / "m"))
    assert not art.load(spark, str(tmp_path / "m")).model.converged
    assert not kernel.fit_kernel(planted.df, planted.columns, "is_fraud", 1.0, 10.0, 0.3, iterations=2).converged
    assert not kernel.fit_one_class(planted.df, planted.columns, 0.05, 0.3, steps=2).converged


def test_artifact_round_trip(spark, planted, tmp_path):
    fitted = tuning.fit_final("oneclass", planted, {"kernel": "rbf", "nu": 0.05, "gamma": 0.2}, 0.1)
    assert fitted.fit_scope == "non_fraud_only"
    art.save(spark, fitted, str(tmp_path / "m"))
    loaded = art.load(spark, str(tmp_path / "m"))
    assert (loaded.threshold, loaded.params, loaded.columns()) == (0.1, fitted.params, ["a", "b", "c"])
    both = planted.df.select(fitted.score().alias("x"), loaded.score().alias("y")).where("abs(x - y) > 1e-9")
    assert both.count() == 0
    plain = art.bare(fitted.model)
    assert plain.cut == 0.0 and plain.columns() == ["a", "b", "c"]


def test_features_are_numeric_aligned_and_strict(spark):
    train = spark.createDataFrame(
        [(1, "True", "a", "1", 2.0, True), (2, "no", None, "2", 3.0, False)],
        "trans_num int, is_fraud string, job string, zip string, amt double, night boolean",
    )
    maps = fit_frequency_maps(train)
    df, names = prepare_features(train, maps, "trans_num")
    assert names == ["amt", "night", "job_frequency", "zip_frequency"]
    assert {r["trans_num"]: r["is_fraud"] for r in df.collect()} == {1: True, 2: False}
    aligned, names = prepare_features(train, maps, "trans_num", feature_columns=["night", "gone"])
    assert aligned.columns == ["trans_num", "is_fraud", "night", "gone"]
    bad = train.withColumn("extra", F.lit("x"))
    with pytest.raises(Exception, match="not a number"):
        prepare_features(bad, maps, "trans_num")[0].collect()
    with pytest.raises(ValueError, match="needed"):
        detect.feature_table(train.drop("is_fraud"), "trans_num")
