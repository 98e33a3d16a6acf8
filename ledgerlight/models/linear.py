"""Linear decision functions by Newton steps, for several settings in the same passes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_NEWTON_STEPS = 50
STEP_SIZES = (1.0, 0.5, 0.25, 0.1, 0.02)
LOG_LOSS, MODIFIED_HUBER = "log_loss", "modified_huber"


@dataclass(frozen=True)
class LinearModel:
    columns: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float
    converged: bool = True
    steps: int = 0

    def score(self) -> Column:
        """Decision value as one arithmetic expression inside the JVM."""
        total = F.lit(float(self.intercept))
        for name, weight in zip(self.columns, self.weights):
            total = total + F.col(f"`{name}`") * F.lit(float(weight))
        return total


@dataclass(frozen=True)
class Setting:
    """What one fit differs in: the loss, the L2 penalty per row, the weight of positives, and the flag column that
    says which rows it learns from (all rows if none).
    """

    loss: str
    alpha: float
    weight: float
    member: str | None = None


def class_weight(label: str, weight: float) -> Column:
    return F.when(F.col(label), F.lit(float(weight))).otherwise(F.lit(1.0))


def weighted_rows(df: DataFrame, label: str, weight: float) -> tuple[int, float]:
    row = df.agg(F.count("*"), F.sum(class_weight(label, weight))).first()
    return row[0], row[1] or 0.0


def fit_log_loss(df: DataFrame, columns: Sequence[str], label: str, alpha: float, weight: float) -> LinearModel:
    """L2-penalised logistic loss, positives weighted. The penalty is per row, not per unit of weight."""
    return fit_linear(df, columns, label, [Setting(LOG_LOSS, alpha, weight)])[0]


def fit_modified_huber(df: DataFrame, columns: Sequence[str], label: str, alpha: float, weight: float) -> LinearModel:
    """L2-penalised modified Huber loss, positives weighted."""
    return fit_linear(df, columns, label, [Setting(MODIFIED_HUBER, alpha, weight)])[0]


def fit_linear(df: DataFrame, columns: Sequence[str], label: str, settings: Sequence[Setting]) -> list[LinearModel]:
    """One model per setting, by damped Newton steps.

    Each step is two passes for all settings that still move: one for loss, gradient and curvature, one that tries
    several step sizes at once. Tasks return sums only, of the size of the weight vector squared per
    setting. A model that hits MAX_NEWTON_STEPS says that it has not converged.
    """
    columns = list(columns)
    size = len(columns) + 1
    members = list(dict.fromkeys(s.member for s in settings if s.member is not None))
    data = df.select(
        *columns, F.col(label).cast("double").alias("_target"), *[F.col(m).cast("double").alias(m) for m in members],
    )
    counted = data.agg(F.count(F.lit(1)), *[F.sum(m) for m in members]).first()
    sizes = {name: max(int(n or 0), 1) for name, n in zip([None, *members], counted)}
    rows = [sizes[s.member] for s in settings]
    penalties = [np.append(np.full(size - 1, s.alpha), 0.0) for s in settings]
    w = [np.zeros(size) for _ in settings]
    converged, steps = [False] * len(settings), [0] * len(settings)
    moving = list(range(len(settings)))
    for _ in range(MAX_NEWTON_STEPS):
        sums = _derivatives(data, columns, [settings[k] for k in moving], np.stack([w[k] for k in moving], axis=1))
        losses, directions = {}, {}
        for k, part in zip(list(moving), sums):
            losses[k] = part[0] / rows[k] + 0.5 * float(penalties[k] @ (w[k] * w[k]))
            gradient = part[1 : 1 + size] / rows[k] + penalties[k] * w[k]
            hessian = part[1 + size :].reshape(size, size) / rows[k] + np.diag(penalties[k] + 1e-9)
            if np.linalg.norm(gradient) <= 1e-6 * max(1.0, np.linalg.norm(w[k])):
                converged[k] = True
                moving.remove(k)
            else:
                directions[k] = np.linalg.solve(hessian, gradient)
        if not moving:
            break
        tries = {k: np.stack([w[k] - step * directions[k] for step in STEP_SIZES], axis=1) for k in moving}
        repeated = [settings[k] for k in moving for _ in STEP_SIZES]
        tried = _losses(data, columns, repeated, np.concatenate([tries[k] for k in moving], axis=1))
        for place, k in enumerate(list(moving)):
            found = tried[place * len(STEP_SIZES) : (place + 1) * len(STEP_SIZES)] / rows[k]
            found = found + 0.5 * (penalties[k][:, None] * tries[k] * tries[k]).sum(axis=0)
            best = int(np.argmin(found))
            if found[best] >= losses[k] - 1e-10 * abs(losses[k]):
                converged[k] = True
                moving.remove(k)
            else:
                w[k], steps[k] = tries[k][:, best], steps[k] + 1
        if not moving:
            break
    return [
        LinearModel(tuple(columns), tuple(float(v) for v in x[:-1]), float(x[-1]), c, n)
        for x, c, n in zip(w, converged, steps)
    ]


def _terms(loss: str, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, slope and bend at a margin."""
    if loss == LOG_LOSS:
        miss = 1.0 / (1.0 + np.exp(np.clip(margin, -500, 500)))
        return np.logaddexp(0.0, -margin), -miss, miss * (1.0 - miss)
    near = (margin >= -1.0) & (margin < 1.0)
    value = np.where(near, (1.0 - margin) ** 2, np.where(margin < -1.0, -4.0 * margin, 0.0))
    return value, np.where(near, -2.0 * (1.0 - margin), np.where(margin < -1.0, -4.0, 0.0)), 2.0 * near


def _weights(batch: pd.DataFrame, sign: np.ndarray, setting: Setting) -> np.ndarray:
    each = np.where(sign > 0, setting.weight, 1.0)
    return each if setting.member is None else each * batch[setting.member].to_numpy(dtype=float)


def _rows(batch: pd.DataFrame, columns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Values with a column of ones, and the class as a sign."""
    x = np.column_stack([batch[columns].to_numpy(dtype=float), np.ones(len(batch))])
    return x, np.where(batch["_target"].to_numpy() > 0, 1.0, -1.0)


def _derivatives(data: DataFrame, columns: list[str], settings: Sequence[Setting], points: np.ndarray) -> np.ndarray:
    """For each setting at its point the sums over all rows of weighted loss, gradient and curvature."""
    size = len(points)
    length = 1 + size + size * size

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(settings), length))
        for batch in batches:
            x, sign = _rows(batch, columns)
            for k, setting in enumerate(settings):
                each = _weights(batch, sign, setting)
                value, slope, bend = _terms(setting.loss, sign * (x @ points[:, k]))
                total[k, 0] += each @ value
                total[k, 1 : 1 + size] += (each * sign * slope) @ x
                total[k, 1 + size :] += ((x * (each * bend)[:, None]).T @ x).ravel()
        yield pd.DataFrame({"i": np.arange(total.size, dtype=np.int32), "v": total.ravel()})

    return _collected(data, sums, len(settings) * length).reshape(len(settings), length)


def _losses(data: DataFrame, columns: list[str], settings: Sequence[Setting], points: np.ndarray) -> np.ndarray:
    """Sum over all rows of the weighted loss at each point."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(settings))
        for batch in batches:
            x, sign = _rows(batch, columns)
            margins = sign[:, None] * (x @ points)
            for k, setting in enumerate(settings):
                each = _weights(batch, sign, setting)
                total[k] += each @ _terms(setting.loss, margins[:, k])[0]
        yield pd.DataFrame({"i": np.arange(len(total), dtype=np.int32), "v": total})

    return _collected(data, sums, len(settings))


def _collected(data: DataFrame, sums, length: int) -> np.ndarray:
    rows = data.mapInPandas(sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    result = np.zeros(length)
    for row in rows:
        result[row["i"]] = row["v"]
    return result
