"""Fits against optima that are found in another way."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.models import kernel
from ledgerlight.operators import evaluate as ev


@pytest.fixture(scope="module")
def cloud(spark):
    """Two normal clusters, and positives between and beyond them."""
    rng = np.random.default_rng(8)
    normal = np.concatenate([rng.normal((-2, 0), 0.5, (500, 2)), rng.normal((2, 1), 0.7, (500, 2))])
    odd = np.concatenate([rng.normal((0, 0.5), 0.4, (40, 2)), rng.uniform(-6, 6, (60, 2))])
    x = np.concatenate([normal, odd])
    rows = [(i, i >= len(normal), float(a), float(b)) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "trans_num int, is_fraud boolean, a double, b double").repartition(4).cache(), x, len(normal)


def least(z, nu):
    """The optimum by the dual problem, two weights at a time."""
    n = len(z)
    most, k = 1 / (nu * n), z @ z.T
    alpha = np.zeros(n)
    alpha[: int(nu * n)] = most
    alpha[int(nu * n)] += 1 - alpha.sum()
    slope = k @ alpha
    for _ in range(200_000):
        i = np.where(alpha < most - 1e-15, slope, np.inf).argmin()
        j = np.where(alpha > 1e-15, slope, -np.inf).argmax()
        if slope[j] - slope[i] < 1e-7:
            break
        move = min((slope[j] - slope[i]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12), most - alpha[i], alpha[j])
        alpha[i] += move
        alpha[j] -= move
        slope += move * (k[i] - k[j])
    return -0.5 * alpha @ k @ alpha


def objective(z, nu, w, rho):
    return 0.5 * w @ w - rho + np.maximum(0, rho - z @ w).sum() / (nu * len(z))


def auc(df, model):
    scored = df.select("trans_num", "is_fraud", model.score().alias("score"), F.lit(1.0).alias("amt"))
    return ev.ranking_metrics(ev.Scored(scored)).first()["roc_auc"]


@pytest.mark.parametrize("nu", [0.02, 0.1, 0.5])
def test_one_class_reaches_the_optimum_in_few_passes(cloud, nu, monkeypatch):
    df, x, normal = cloud
    passes, real = [], kernel._hinge_pass
    monkeypatch.setattr(kernel, "_hinge_pass", lambda *a: passes.append(1) or real(*a))
    model = kernel.fit_one_class(df.where("not is_fraud"), ["a", "b"], nu, 0.5)
    z = model.features.z(x[:normal])
    best = least(z, nu)
    value = objective(z, nu, model.weights, -model.intercept)
    assert model.converged and best - 1e-6 <= value <= best + 1.2 * kernel.ONE_CLASS_GAP * abs(best)
    assert len(passes) <= 80 and auc(df, model) > 0.8


def test_fits_of_several_maps_share_their_passes(cloud, monkeypatch):
    df, _, _ = cloud
    normal, nus, gammas = df.where("not is_fraud"), [0.05, 0.1, 0.05], [0.5, 0.5, 0.1]
    passes, real = [], kernel._hinge_pass
    monkeypatch.setattr(kernel, "_hinge_pass", lambda *a: passes.append(1) or real(*a))
    alone = []
    for nu, gamma in zip(nus, gammas):
        passes.clear()
        alone.append((kernel.fit_one_class(normal, ["a", "b"], nu, gamma), len(passes)))
    passes.clear()
    together = kernel.fit_one_class_many(normal, ["a", "b"], nus, gammas)
    # a pass for shorter steps serves only the fits that need it
    assert len(passes) <= sum(n for _, n in alone) and len(passes) <= 2 * max(n for _, n in alone)
    for (one, _), other in zip(alone, together):
        assert np.allclose(one.weights, other.weights, rtol=1e-6, atol=1e-8) and one.steps == other.steps


def test_hinge_reaches_what_smaller_steps_reach(cloud):
    df, x, normal = cloud
    model = kernel.fit_kernel(df, ["a", "b"], "is_fraud", 1.0, 5.0, 0.5)
    z = np.column_stack([model.features.z(x), np.ones(len(x))])
    sign, each = np.where(np.arange(len(x)) >= normal, 1.0, -1.0), np.where(np.arange(len(x)) >= normal, 5.0, 1.0)
    penalty = np.append(np.full(z.shape[1] - 1, 1 / len(x)), 0.0)

    def loss(p):
        gap = 1 - sign * (z @ p)
        near = np.abs(gap) < kernel.ROUNDING
        rounded = np.where(near, (gap + kernel.ROUNDING) ** 2 / (4 * kernel.ROUNDING), np.maximum(gap, 0))
        slope = np.where(near, (gap + kernel.ROUNDING) / (2 * kernel.ROUNDING), gap > 0)
        return each @ rounded / len(x) + 0.5 * penalty @ (p * p), -(each * sign * slope) @ z / len(x) + penalty * p

    found = np.append(model.weights, model.intercept)
    start = p = found.copy()
    for _ in range(3_000):
        p = p - 0.01 * loss(p)[1]
    assert model.converged and loss(start)[0] <= loss(p)[0] * 1.01


def test_members_are_fitted_as_if_alone(cloud):
    df, _, _ = cloud
    flagged = df.withColumn("half", F.col("trans_num") % 2 == 0).withColumn("all", F.lit(True))
    settings, gammas = [(1.0, 5.0), (1.0, 5.0)], [0.5, 0.5]
    both = kernel.fit_kernel_many(flagged, ["a", "b"], "is_fraud", settings, gammas, members=["half", "all"])
    for model, rows in zip(both, (flagged.where("half"), flagged)):
        alone = kernel.fit_kernel(rows, ["a", "b"], "is_fraud", 1.0, 5.0, 0.5)
        assert np.allclose(alone.weights, model.weights, rtol=1e-5, atol=1e-7)


def test_kernel_fits_take_few_passes_and_end_at_the_optimum(cloud, monkeypatch):
    df, x, normal = cloud
    passes, real = [], kernel._hinge_pass
    monkeypatch.setattr(kernel, "_hinge_pass", lambda *a: passes.append(1) or real(*a))
    model = kernel.fit_kernel(df, ["a", "b"], "is_fraud", 1.0, 5.0, 0.5)
    assert model.converged and len(passes) <= 40
    z = np.column_stack([model.features.z(x), np.ones(len(x))])
    sign, each = np.where(np.arange(len(x)) >= normal, 1.0, -1.0), np.where(np.arange(len(x)) >= normal, 5.0, 1.0)
    p = np.append(model.weights, model.intercept)
    gap = 1 - sign * (z @ p)
    slope = np.clip((gap + kernel.ROUNDING) / (2 * kernel.ROUNDING), 0, 1)
    gradient = -(each * sign * slope) @ z / len(x) + np.append(np.full(len(p) - 1, 1 / len(x)), 0.0) * p
    assert np.linalg.norm(gradient) < 1e-6


def test_one_class_fits_take_few_passes(cloud, monkeypatch):
    df, _, _ = cloud
    passes, real = [], kernel._hinge_pass
    monkeypatch.setattr(kernel, "_hinge_pass", lambda *a: passes.append(1) or real(*a))
    models = kernel.fit_one_class_many(df.where("not is_fraud"), ["a", "b"], [0.03, 0.05, 0.08], [0.5, 0.5, 0.5])
    assert all(m.converged for m in models) and len(passes) <= 60


def test_scores_of_several_models_are_those_of_each(cloud):
    df, _, _ = cloud
    models = kernel.fit_one_class_many(df.where("not is_fraud"), ["a", "b"], [0.05, 0.1, 0.1], [0.5, 0.5, 0.1])
    names = ["one", "two", "three"]
    both = kernel.with_scores(df, models, names).select("*", *[m.score().alias(f"own_{n}") for n, m in zip(names, models)])
    assert both.where(" or ".join(f"abs({n} - own_{n}) > 1e-12" for n in names)).count() == 0


def test_one_class_steps_mostly_take_one_pass(cloud, monkeypatch):
    df, _, _ = cloud
    passes, real = [], kernel._hinge_pass
    monkeypatch.setattr(kernel, "_hinge_pass", lambda *a: passes.append(1) or real(*a))
    model = kernel.fit_one_class(df.where("not is_fraud"), ["a", "b"], 0.05, 0.5)
    assert model.converged and len(passes) <= 24


def test_the_next_rounding_is_seen_by_the_last_pass(cloud):
    df, _, _ = cloud
    data = kernel._numbers(df.where("not is_fraud"), ["a", "b"], None, [])
    features = kernel.FourierMap.draw(["a", "b"], 0.5)
    p = np.append(-kernel._means(data, [features])[1][0], 0.4)
    penalty, linear = np.append(np.ones(len(p) - 1), 0.0), np.append(np.zeros(len(p) - 1), -1.0)
    at = [kernel._Fit(features, 0.0, r, 50.0, penalty, linear, p, one_class=True) for r in (0.2, 0.2 / kernel.TIGHTER)]
    kernel._start(data, at, [0, 1])
    kernel._tighten(data, at, [0])
    assert at[0].rounding == at[1].rounding and np.isclose(at[0].loss, at[1].loss, rtol=1e-12)
    assert np.allclose(at[0].gradient, at[1].gradient) and np.allclose(at[0].curvature, at[1].curvature)
    # not moved since, so the next one takes a pass
    kernel._tighten(data, at, [0])
    kernel._tighten(data, at, [1])
    assert at[0].rounding == at[1].rounding and np.isclose(at[0].loss, at[1].loss, rtol=1e-12)


def test_curvature_of_both_roundings_is_that_of_all_rows_near_them(cloud):
    df, x, normal = cloud
    data = kernel._numbers(df.where("not is_fraud"), ["a", "b"], None, [])
    features = kernel.FourierMap.draw(["a", "b"], 0.5)
    z = features.z_single(x[:normal])
    p = np.append(-z[:, :-1].mean(axis=0), 0.4)
    fit = kernel._Fit(features, 0.0, 0.2, 50.0, p, p, p, one_class=True)
    [(sums, hinges, seen)] = kernel._hinge_pass(data, [fit], [p[None]])
    gap = z @ p
    assert np.isclose(hinges, np.maximum(gap, 0).sum()) and np.isclose(sums[0], seen[0][0])
    for r, (loss, slopes, bend) in zip((0.2, 0.2 / kernel.TIGHTER), seen, strict=True):
        near = np.abs(gap) < r
        assert near.any() and np.isclose(loss, kernel._rounded(gap, r).sum())
        assert np.allclose(slopes, np.clip((gap + r) / (2 * r), 0, 1) @ z)
        assert np.allclose(bend, z[near].T @ z[near] / (2 * r))
