"""RBF-kernel models over random Fourier features (Rahimi and Recht, 2007).

z(x) = sqrt(2 / D) * cos(W'x + b) with W ~ N(0, 2 * gamma) has z(x).z(y) close to exp(-gamma |x - y|^2),
so a linear model on z stands in for a kernel machine, whose kernel matrix could not be distributed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.quantiles import exact_quantiles

DIMENSIONS = 256
SCORE_BINS = 1024
ONE_CLASS_STEPS = 200
ONE_CLASS_GAP = 5e-3
ONE_CLASS_ROUNDING = 0.4
# How much narrower the next rounding of a one-class fit is, and what share of the gap it must make up.
TIGHTER = 4
ROUNDING_SHARE = 0.02
KERNEL_ITERATIONS = 200
KERNEL_TOLERANCE = 1e-4
# Shares of the steepest curvature added to the present one: none gives Newton's step, all one that cannot rise.
DAMPING = (0.0, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0)
# A step that gains this share of the best one's gain is taken, as its slope and curvature are there already.
ENOUGH = 0.5
ROUNDING = 0.1
# Wider corners of the hinge, one step each: the way to the first place of the search.
WIDTHS = (2.0, 1.0, 0.5, 0.25)
# Rows mapped at a time, so that their features stay in the processor's cache.
BLOCK_ROWS = 512
# Sums that travel in one row.
CHUNK = 8192


@dataclass(frozen=True)
class FourierMap:
    columns: tuple[str, ...]
    gamma: float
    frequencies: np.ndarray  # features x dimensions
    phases: np.ndarray

    @classmethod
    def draw(cls, columns: Sequence[str], gamma: float, dimensions: int = DIMENSIONS, seed: int = 42) -> FourierMap:
        rng = np.random.default_rng(seed)
        frequencies = rng.normal(0.0, np.sqrt(2.0 * gamma), (len(columns), dimensions))
        return cls(tuple(columns), float(gamma), frequencies, rng.uniform(0.0, 2.0 * np.pi, dimensions))

    def z(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(2.0 / len(self.phases)) * np.cos(x @ self.frequencies + self.phases)

    def z_single(self, x: np.ndarray) -> np.ndarray:
        """(z(x), 1), its cosines in single precision, which take a tenth of the time; only searches use it."""
        turns = (x @ self.frequencies + self.phases).astype(np.float32)
        z = np.ones((len(x), len(self.phases) + 1))
        np.multiply(np.cos(turns, out=turns), np.sqrt(2.0 / len(self.phases)), out=z[:, :-1])
        return z

    def input(self) -> Column:
        return F.struct(*[F.col(f"`{n}`").cast("double").alias(n) for n in self.columns])

    def mapped(self) -> Column:
        """z(x) as array<double>, one Arrow batch at a time."""

        @F.pandas_udf("array<double>")
        def rff(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(list(self.z(rows.to_numpy(dtype=float))))

        return rff(self.input())


@dataclass(frozen=True)
class KernelModel:
    """w.z(x) + intercept. ``sign`` is -1 where a low value means an anomaly."""

    features: FourierMap
    weights: np.ndarray
    intercept: float
    sign: float = 1.0
    converged: bool = True
    steps: int = 0

    def score(self) -> Column:
        """Decision value; z(x) never leaves the task."""

        @F.pandas_udf("double")
        def decision(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(self.sign * (self.features.z(rows.to_numpy(dtype=float)) @ self.weights + self.intercept))

        return decision(self.features.input())


def with_scores(df: DataFrame, models: Sequence[KernelModel], names: Sequence[str]) -> DataFrame:
    """Add every model's decision value, as ``score`` gives it; rows go to Python once, each map is applied once."""
    maps: list[FourierMap] = []
    for m in models:
        if not any(m.features is known for known in maps):
            maps.append(m.features)
    own = [next(i for i, known in enumerate(maps) if m.features is known) for m in models]

    @F.pandas_udf("array<double>")
    def decisions(rows: pd.DataFrame) -> pd.Series:
        x = rows.to_numpy(dtype=float)
        mapped = [features.z(x) for features in maps]
        found = [m.sign * (mapped[i] @ m.weights + m.intercept) for m, i in zip(models, own)]
        return pd.Series(list(np.column_stack(found)))

    every = df.withColumn("_scores", decisions(maps[0].input()))
    return every.withColumns({n: F.col("_scores")[i] for i, n in enumerate(names)}).drop("_scores")


@dataclass
class _Fit:
    """One fit's place, and slope and curvature there.

    What it minimises over p is the mean of weighted rounded hinges max(0, base + a * (p . (z, 1))), plus a quadratic
    penalty and a linear term. a is minus the sign of a row's class, or 1 for a one-class fit.
    """

    features: FourierMap
    base: float
    rounding: float
    divisor: float
    penalty: np.ndarray
    linear: np.ndarray
    p: np.ndarray
    weight: float = 1.0
    one_class: bool = False
    member: str | None = None
    share: float = 1.0  # rows over divisor
    damping: float = 0.0  # the one that was best last time
    tighter: tuple | None = None  # what a pass has found at p for the next rounding
    gradient: np.ndarray = field(default_factory=lambda: np.zeros(0))
    curvature: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    loss: float = np.inf
    steps: int = 0
    still: int = 0

    def reach(self, damping: float = 0.0) -> np.ndarray:
        """Where the quadratic around the present place, its curvature raised, has its minimum."""
        # no row bends the hinge by more than its weight / (2 * rounding) times |(z, 1)|^2, which is at most 3
        steepest = 1.5 * max(self.weight, 1.0) * self.share / self.rounding
        raised = self.penalty + max(damping, 1e-10) * steepest
        return self.p - np.linalg.solve(self.curvature + np.diag(raised), self.gradient)

    def whole(self, points: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """The objective at each point, from the sums of hinges there."""
        return sums / self.divisor + 0.5 * (self.penalty * points * points).sum(axis=1) + points @ self.linear

    def roundings(self) -> list[float]:
        """Those a pass looks at: the present one, and the next one of a fit that goes on to narrower ones."""
        return [self.rounding, self.rounding / TIGHTER] if self.one_class else [self.rounding]

    def look(self, point: np.ndarray, seen: Sequence[tuple]) -> None:
        """Be at a point, with what a pass has found there for each rounding."""
        (loss, slopes, curvature), self.p = seen[0], point
        self.loss = float(self.whole(point[None], np.array([loss]))[0])
        self.gradient = slopes / self.divisor + self.penalty * point + self.linear
        self.curvature = curvature / self.divisor
        self.tighter = seen[1] if len(seen) > 1 else None

    def move(self, point: np.ndarray, seen: Sequence[tuple]) -> None:
        before = self.loss
        self.look(point, seen)
        self.still = self.still + 1 if before - self.loss <= KERNEL_TOLERANCE * abs(self.loss) else 0
        self.steps += 1


def _step_all(data: DataFrame, fits: Sequence[_Fit], moving: Sequence[int]) -> tuple[list[int], dict[int, tuple]]:
    """One step of each moving fit: a pass that tries several dampings, and one more where the expected one, a little
    less than the last, gains too little beside the best.

    Returns the fits that no step improves, and for the others (sum of unrounded hinges, slope-weighted sums of
    (z, 1) for each rounding) at their new places.
    """
    expected = {k: DAMPING[max(DAMPING.index(fits[k].damping) - 1, 0)] for k in moving}
    order = {k: sorted(DAMPING, key=lambda d: d != expected[k]) for k in moving}
    tries = {k: np.stack([fits[k].reach(d) for d in order[k]]) for k in moving}
    short, stuck, exact = {}, [], {}
    for k, (sums, hinges, seen) in zip(moving, _hinge_pass(data, [fits[k] for k in moving], [tries[k] for k in moving])):
        losses, before = fits[k].whole(tries[k], sums), fits[k].loss
        best = int(np.argmin(losses))
        fits[k].damping = order[k][best]
        if not losses[best] < before:
            stuck.append(k)
        elif before - losses[0] >= ENOUGH * (before - losses[best]):
            fits[k].move(tries[k][0], seen)
            exact[k] = hinges, [slopes for _, slopes, _ in seen]
        else:
            short[k] = tries[k][best][None]
    if short:
        for k, (_, hinges, seen) in zip(short, _hinge_pass(data, [fits[k] for k in short], list(short.values()))):
            fits[k].move(short[k][0], seen)
            exact[k] = hinges, [slopes for _, slopes, _ in seen]
    return stuck, exact


def _start(data: DataFrame, fits: Sequence[_Fit], chosen: Sequence[int]) -> dict[int, tuple]:
    """Loss, slope and curvature at the fits' present places."""
    exact = {}
    for k, (_, hinges, seen) in zip(chosen, _hinge_pass(data, [fits[k] for k in chosen], [fits[k].p[None] for k in chosen])):
        fits[k].look(fits[k].p, seen)
        fits[k].still = 0
        exact[k] = hinges, [slopes for _, slopes, _ in seen]
    return exact


def _tighten(data: DataFrame, fits: Sequence[_Fit], chosen: Sequence[int]) -> None:
    """Go on to the next rounding, at the same places. The last pass has seen what is there, but for fits that did not
    move since they did this last.
    """
    unseen = [k for k in chosen if fits[k].tighter is None]
    for k in chosen:
        fits[k].rounding /= TIGHTER
        if fits[k].tighter is not None:
            fits[k].look(fits[k].p, [fits[k].tighter])
            fits[k].still = 0
    if unseen:
        _start(data, fits, unseen)


def _hinge_pass(
    data: DataFrame, fits: Sequence[_Fit], tries: Sequence[np.ndarray],
) -> list[tuple[np.ndarray, float, list[tuple[float, np.ndarray, np.ndarray]]]]:
    """Sums over the rows of each fit: rounded hinges at every try; at the first the hinges as they are, and for each
    rounding the hinges, slope times (z, 1), and curvature times the products of (z, 1) with itself, to which only rows
    near the corner add. Fits with the same map share its z; each has a product of its own, so that what it finds does
    not depend, by rounding, on the fits beside it. Cosines are single, all sums double precision.
    """
    names, size = list(fits[0].features.columns), tries[0].shape[1]
    maps: list[FourierMap] = []
    for f in fits:
        if not any(f.features is m for m in maps):
            maps.append(f.features)
    groups = [[k for k, f in enumerate(fits) if f.features is m] for m in maps]
    products = [np.ascontiguousarray(t.T) for t in tries]
    counts = [len(t) for t in tries]
    upper = np.triu_indices(size)
    roundings = [f.roundings() for f in fits]
    bent = np.cumsum([0, *map(len, roundings)])
    starts = np.concatenate([[0], np.cumsum([c + 1 + len(r) * (1 + size) for c, r in zip(counts, roundings)])])
    settings = [(f.base, f.weight, f.one_class, f.member) for f in fits]

    def sums(batches: Iterator[pd.DataFrame]) -> np.ndarray:
        total, bends = np.zeros(starts[-1]), np.zeros((bent[-1], size, size))
        for batch in batches:
            values, target = batch[names].to_numpy(dtype=float), batch["_target"].to_numpy() > 0
            flags = {m: batch[m].to_numpy(dtype=float) for *_, m in settings if m is not None}
            for start in range(0, len(values), BLOCK_ROWS):
                rows = slice(start, start + BLOCK_ROWS)
                x, positive = values[rows], target[rows]
                for features, group in zip(maps, groups):
                    z = features.z_single(x)
                    for k in group:
                        base, weight, one_class, member = settings[k]
                        a = np.ones(len(x)) if one_class else np.where(positive, -1.0, 1.0)
                        each = np.where(positive, weight, 1.0) if not one_class else np.ones(len(x))
                        if member is not None:
                            each = each * flags[member][rows]
                        gap = base + a[:, None] * (z @ products[k])
                        mine = total[starts[k] : starts[k + 1]]
                        mine[: counts[k]] += each @ _rounded(gap, roundings[k][0])
                        mine[counts[k]] += each @ np.maximum(gap[:, 0], 0.0)
                        for i, rounding in enumerate(roundings[k]):
                            at, first = counts[k] + 1 + i * (1 + size), gap[:, 0]
                            slope = np.clip((first + rounding) / (2 * rounding), 0.0, 1.0)
                            mine[at] += each @ _rounded(first, rounding)
                            mine[at + 1 : at + 1 + size] += (each * a * slope) @ z
                            # rows near a narrower corner, too, are multiplied there and added below
                            near, inner = np.abs(first) < rounding, roundings[k][i + 1 : i + 2]
                            ring = np.flatnonzero(near & (each > 0) & (np.abs(first) >= (inner[0] if inner else 0.0)))
                            corner = z[ring] * np.sqrt(each[ring])[:, None]
                            bends[bent[k] + i] += corner.T @ corner
        return np.concatenate([total, *[b[upper] for b in bends]])

    result = _summed(data, sums, starts[-1] + bent[-1] * len(upper[0]))
    triangles = np.split(result[starts[-1] :], bent[-1])
    found = []
    for k, c in enumerate(counts):
        part, seen, bend = result[starts[k] : starts[k + 1]], [], np.zeros((size, size))
        for i in reversed(range(len(roundings[k]))):
            bend[upper] += triangles[bent[k] + i]
            loss, slopes = np.split(part[c + 1 + i * (1 + size) : c + 1 + (i + 1) * (1 + size)], [1])
            seen.insert(0, (float(loss[0]), slopes, (bend + np.triu(bend, 1).T) / (2 * roundings[k][i])))
        found.append((part[:c], float(part[c]), seen))
    return found


def _rounded(gap: np.ndarray, rounding: float) -> np.ndarray:
    """max(0, gap), rounded off within rounding of its corner."""
    return np.where(np.abs(gap) < rounding, (gap + rounding) ** 2 / (4 * rounding), np.maximum(gap, 0.0))


def _numbers(df: DataFrame, columns: Sequence[str], label: str | None, members: Sequence[str | None]) -> DataFrame:
    kept = [F.col(f"`{m}`").cast("double").alias(m) for m in dict.fromkeys(m for m in members if m is not None)]
    target = F.lit(0.0) if label is None else F.col(label).cast("double")
    return df.select(*[F.col(f"`{n}`").cast("double").alias(n) for n in columns], target.alias("_target"), *kept)


def member_counts(data: DataFrame, members: Sequence[str | None]) -> list[int]:
    """Rows of each member column, all rows for None; one aggregate."""
    distinct = list(dict.fromkeys(members))
    counted = [F.count(F.lit(1)) if m is None else F.count_if(F.col(f"`{m}`") == 1) for m in distinct]
    return [dict(zip(distinct, data.agg(*counted).first()))[m] for m in members]


def fit_kernel(
    df: DataFrame, columns: Sequence[str], label: str, c: float, weight: float, gamma: float,
    dimensions: int = DIMENSIONS, seed: int = 42, iterations: int = KERNEL_ITERATIONS,
) -> KernelModel:
    return fit_kernel_many(df, columns, label, [(c, weight)], [gamma], dimensions, seed, iterations)[0]


def fit_kernel_many(
    df: DataFrame, columns: Sequence[str], label: str, settings: Sequence[tuple[float, float]], gammas: Sequence[float],
    dimensions: int = DIMENSIONS, seed: int = 42, iterations: int = KERNEL_ITERATIONS,
    members: Sequence[str | None] | None = None,
) -> list[KernelModel]:
    """Weighted hinge loss with the L2 penalty 1 / (C * rows) per row, for each (C, weight of positives), its gamma
    and the flag column that says which rows it learns from.

    All fits share their passes. The hinge is rounded off within ROUNDING of its corner, so that Newton steps apply;
    wider corners, one step each, lead to the first place. One pass tries several dampings of every fit and brings slope
    and curvature at the damping that was best before. A fit ends when its loss has gained less than
    KERNEL_TOLERANCE of itself three times running; one that hits the iterations says that it has not converged.
    """
    members = list(members or [None] * len(settings))
    data = _numbers(df, columns, label, members)
    maps = {g: FourierMap.draw(columns, g, dimensions, seed) for g in dict.fromkeys(gammas)}
    fits = []
    for (c, weight), gamma, member, rows in zip(settings, gammas, members, member_counts(data, members)):
        rows = max(rows, 1)
        penalty = np.append(np.full(dimensions, 1.0 / (c * rows)), 0.0)
        zero = np.zeros(dimensions + 1)
        fits.append(_Fit(maps[gamma], 1.0, ROUNDING, rows, penalty, zero, zero, weight, member=member))
    moving = list(range(len(fits)))
    for width in WIDTHS[:iterations]:
        for f in fits:
            f.rounding = width
        _start(data, fits, moving)
        for f in fits:
            f.p, f.steps = f.reach(), f.steps + 1
    for f in fits:
        f.rounding = ROUNDING
    _start(data, fits, moving)
    for _ in range(iterations - len(WIDTHS)):
        stuck, _ = _step_all(data, fits, moving)
        moving = [k for k in moving if k not in stuck and fits[k].still < 3]
        if not moving:
            break
    return [
        KernelModel(f.features, f.p[:-1], float(f.p[-1]), converged=k not in moving, steps=f.steps)
        for k, f in enumerate(fits)
    ]


def fit_one_class(
    normal: DataFrame, columns: Sequence[str], nu: float, gamma: float,
    dimensions: int = DIMENSIONS, seed: int = 42, steps: int = ONE_CLASS_STEPS,
) -> KernelModel:
    return fit_one_class_many(normal, columns, [nu], [gamma], dimensions, seed, steps)[0]


def fit_one_class_many(
    normal: DataFrame, columns: Sequence[str], nus: Sequence[float], gammas: Sequence[float],
    dimensions: int = DIMENSIONS, seed: int = 42, steps: int = ONE_CLASS_STEPS,
) -> list[KernelModel]:
    """One-class SVM on normal rows: min |w|^2 / 2 - rho + sum(max(0, rho - w.z)) / (nu * n), for each (nu, gamma).

    w and rho are sought together by damped Newton steps on the objective whose hinge is rounded off; all fits share
    their passes. They start at the mean of z, the solution for nu = 1 (Schoelkopf et al., 2001), and at its nu-quantile.
    The slopes of the hinges, brought into the bounds of the dual problem, give lower bounds of the optimum. A fit
    ends when its objective, not rounded, is within ONE_CLASS_GAP of the best of them; where a step gains less than
    what is left after it, the rounding shrinks. Each pass looks at the next rounding, too, so this takes none of its
    own. One that hits the limit of steps says so. The final rho is an exact quantile, so that nu of the rows are
    flagged. Scores are rho - w.z: positive for anomalies.
    """
    data = _numbers(normal, columns, None, [])
    maps = {g: FourierMap.draw(columns, g, dimensions, seed) for g in dict.fromkeys(gammas)}
    rows, means = _means(data, list(maps.values()))
    means = dict(zip(maps, means))
    spread = dict(zip(maps, _histograms(data, [(maps[g], means[g]) for g in maps])))
    flip = np.append(-np.ones(dimensions), 1.0)
    fits = []
    for nu, gamma in zip(nus, gammas):
        mean = means[gamma]
        rho = _bin_quantile(spread[gamma], nu, mean)
        fits.append(_Fit(
            maps[gamma], 0.0, ONE_CLASS_ROUNDING * max(float(mean @ mean), 1e-9), nu * rows,
            np.append(np.ones(dimensions), 0.0), np.append(np.zeros(dimensions), -1.0), np.append(-mean, rho),
            one_class=True, share=1.0 / nu, damping=DAMPING[-2],
        ))
    moving = list(range(len(fits)))
    exact = _start(data, fits, moving)
    # the best place a fit has seen, by its objective as it is, and the best bound
    best, bound, rounded = {k: (np.inf, fits[k].p) for k in moving}, {k: -np.inf for k in moving}, {}

    def left(k: int) -> float:
        return best[k][0] - bound[k]

    for step in range(steps + 1):
        for k, (hinges, seen) in exact.items():
            value = _objective(fits[k], hinges)
            rounded[k] = fits[k].loss - value
            if value < best[k][0]:
                best[k] = value, fits[k].p
            bound[k] = max(bound[k], *[_lower(fits[k], nus[k], means[gammas[k]], slopes) for slopes in seen])
        moving = [k for k in moving if left(k) > ONE_CLASS_GAP * abs(best[k][0])]
        if not moving or step == steps:
            break
        if step:
            # what is still to gain lies to a good part in the rounding
            slow = [k for k in moving if before[k] - fits[k].loss <= 0.5 * left(k) and rounded[k] >= ROUNDING_SHARE * left(k)]
            _tighten(data, fits, [k for k in moving if k in stuck or k in slow])
        before = {k: fits[k].loss for k in moving}
        stuck, exact = _step_all(data, fits, moving)
    weights = [(flip * best[k][1])[:-1] for k in range(len(fits))]
    raw = [KernelModel(f.features, w, 0.0) for f, w in zip(fits, weights)]
    values = [f"value{k}" for k in range(len(raw))]
    # the quantiles read them several times
    scored = with_scores(data, raw, values).select(*values).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cuts = exact_quantiles(scored, values, list(dict.fromkeys(nus)))
    finally:
        scored.unpersist()
    place = {nu: i for i, nu in enumerate(dict.fromkeys(nus))}
    return [
        KernelModel(f.features, w, -float(cuts[f"value{k}"][place[nus[k]]]), -1.0, k not in moving, f.steps)
        for k, (f, w) in enumerate(zip(fits, weights))
    ]


def _objective(fit: _Fit, hinges: float) -> float:
    """The one-class objective as it is, from the sum of unrounded hinges."""
    w = fit.p[:-1]
    return 0.5 * float(w @ w) - float(fit.p[-1]) + hinges / fit.divisor


def _lower(fit: _Fit, nu: float, mean: np.ndarray, slopes: np.ndarray) -> float:
    """A lower bound of the one-class optimum.

    The dual problem is min |sum a_i z_i|^2 / 2 over weights of at most 1 / (nu n) that add up to 1. The slopes do not
    quite add up; they are scaled down, or mixed with equal weights as far as the bound allows.
    """
    total = slopes[-1] / fit.divisor
    share = 1.0 / total if total >= 1.0 else (1.0 - nu) / (1.0 - nu * total)
    centre = share * slopes[:-1] / fit.divisor + (1.0 - share * total) * mean
    return -0.5 * float(centre @ centre)


def _span(w: np.ndarray) -> float:
    """Bound on |w.z|, as |z| is at most sqrt(2)."""
    return float(np.linalg.norm(w)) * np.sqrt(2.0) + 1e-12


def _bin_quantile(bins: np.ndarray, nu: float, w: np.ndarray) -> float:
    """nu-quantile of the counted values, read on the scale of w."""
    place = np.searchsorted(np.cumsum(bins), nu * bins.sum())
    return -_span(w) + (place + 0.5) * 2.0 * _span(w) / SCORE_BINS


def _summed(data: DataFrame, work: Callable[[Iterator[pd.DataFrame]], np.ndarray], length: int) -> np.ndarray:
    """The sum over all tasks of the vector that work makes of a task's rows.

    Vectors travel in chunks, and each chunk is added up in a task of its own.
    """
    def each_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = work(batches)
        chunks = {i: c for i, c in enumerate(np.split(total, range(CHUNK, length, CHUNK))) if c.any()}
        yield pd.DataFrame({"i": np.array(list(chunks), dtype=np.int32), "v": [c.tobytes() for c in chunks.values()]})

    def add(same: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v) for v in same["v"]], axis=0)
        return pd.DataFrame({"i": same["i"].iloc[:1], "v": [total.tobytes()]})

    schema, result = "i int, v binary", np.zeros(length)
    for row in data.mapInPandas(each_task, schema).groupBy("i").applyInPandas(add, schema).collect():
        part = np.frombuffer(row["v"])
        result[row["i"] * CHUNK : row["i"] * CHUNK + len(part)] = part
    return result


def _over_rows(work: Callable[[np.ndarray], np.ndarray], length: int) -> Callable[[Iterator[pd.DataFrame]], np.ndarray]:
    """The sum of what work makes of a matrix of rows, block by block."""
    def sums(batches: Iterator[pd.DataFrame]) -> np.ndarray:
        total = np.zeros(length)
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            for start in range(0, len(x), BLOCK_ROWS):
                total += work(x[start : start + BLOCK_ROWS])
        return total

    return sums


def _means(data: DataFrame, maps: Sequence[FourierMap]) -> tuple[int, list[np.ndarray]]:
    """Row count and the mean of z by each map."""
    sizes = [len(m.phases) for m in maps]

    def work(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], *[m.z(x).sum(axis=0) for m in maps]])

    length = 1 + sum(sizes)
    found = _summed(data.select(*maps[0].columns), _over_rows(work, length), length)
    rows = max(int(found[0]), 1)
    return rows, [part / rows for part in np.split(found[1:], np.cumsum(sizes)[:-1])]


def _histograms(data: DataFrame, points: Sequence[tuple[FourierMap, np.ndarray]]) -> list[np.ndarray]:
    """How the values w.z are spread over SCORE_BINS bins, for each map and w."""
    def work(x: np.ndarray) -> np.ndarray:
        counted = []
        for features, w in points:
            place = (features.z(x) @ w + _span(w)) / (2.0 * _span(w)) * SCORE_BINS
            counted.append(np.bincount(np.clip(place.astype(int), 0, SCORE_BINS - 1), minlength=SCORE_BINS))
        return np.concatenate(counted).astype(float)

    length = SCORE_BINS * len(points)
    found = _summed(data.select(*points[0][0].columns), _over_rows(work, length), length)
    return np.split(found, len(points))
