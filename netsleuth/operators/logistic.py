"""Ridge logistic models fitted together: one aggregate of the table per Newton step.

Each step sums the loss, gradient and curvature of every model in one pass that combines
map-side; only those sums, a number that the feature lists fix, reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsleuth.functions.columns import sigmoid

RIDGE = 1.0
TOLERANCE = 1e-6
MAX_STEPS = 100


@dataclass
class Logistic:
    """One model: its features, 0/1 label, the rows it is fitted on, and, once fitted, its weights."""

    features: list[str]
    label: str
    rows: Column | None = None
    weights: np.ndarray | None = field(default=None)

    def logit(self, fixed: dict[str, Column] | None = None) -> Column:
        fixed = fixed or {}
        terms = [fixed.get(f, F.col(f)).cast("double") * F.lit(float(w)) for f, w in zip(self.features, self.weights[1:])]
        return sum(terms, F.lit(float(self.weights[0])))

    def probability(self, fixed: dict[str, Column] | None = None) -> Column:
        """Predicted chance of label 1; ``fixed`` replaces features."""
        return sigmoid(self.logit(fixed))

    def used(self) -> Column:
        """Rows that count: inside ``rows``, with every feature and the label."""
        whole = F.lit(True) if self.rows is None else F.coalesce(self.rows, F.lit(False))
        for name in [*self.features, self.label]:
            whole = whole & F.col(name).isNotNull()
        return whole

    def inputs(self) -> list[Column]:
        return [F.lit(1.0), *[F.col(f).cast("double") for f in self.features]]


def _sums(model: Logistic, name: str) -> list[Column]:
    """Summed loss, residual moments and curvature of a model at its present weights."""
    y, z, x, used = F.col(model.label).cast("double"), model.logit(), model.inputs(), model.used()
    p = sigmoid(z)
    # log(1 + e^z) without overflow
    loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - y * z
    total = lambda e: F.coalesce(F.sum(F.when(used, e)), F.lit(0.0))
    out = [F.count_if(used).cast("double"), total(loss)]
    out += [total((p - y) * a) for a in x]
    out += [total(p * (1.0 - p) * x[i] * x[j]) for i in range(len(x)) for j in range(i, len(x))]
    return [e.alias(f"{name}_{i}") for i, e in enumerate(out)]


def _read(row: dict, name: str, k: int, weights: np.ndarray, ridge: float):
    values = [row[f"{name}_{i}"] for i in range(2 + k + k * (k + 1) // 2)]
    penalty = np.r_[0.0, np.full(k - 1, ridge)]
    loss = values[1] + 0.5 * float(penalty @ (weights * weights))
    gradient = np.array(values[2:2 + k]) + penalty * weights
    curvature = np.zeros((k, k))
    curvature[np.triu_indices(k)] = values[2 + k:]
    curvature = curvature + np.triu(curvature, 1).T + np.diag(penalty)
    return values[0], loss, gradient, curvature


def fit(df: DataFrame, models: dict[str, Logistic], ridge: float = RIDGE, tol: float = TOLERANCE,
        max_steps: int = MAX_STEPS) -> dict[str, Logistic]:
    """Fit all ``models`` at once; every penalised gradient ends within ``tol`` per coefficient.

    The loss is summed over rows with a ridge of ``ridge`` on all weights but the
    intercept. A step that raises a model's loss is halved. Beyond ten million rows the
    bar grows with their number, as the rounding of a sum does. Rows with a missing
    feature or label are left out of that model; a model without rows keeps weights of 0.
    """
    names = [f"m{i}" for i in range(len(models))]
    by_name = dict(zip(names, models.values()))
    best, step = {}, {}
    for model in by_name.values():
        model.weights = np.zeros(len(model.features) + 1)
    moving = dict(by_name)
    for _ in range(max_steps):
        sums = df.agg(*[e for name, model in moving.items() for e in _sums(model, name)]).first().asDict()
        for name, model in list(moving.items()):
            n, loss, gradient, curvature = _read(sums, name, len(model.weights), model.weights, ridge)
            if n == 0 or np.abs(gradient).max() <= tol * max(1.0, n / 1e7):
                del moving[name]
            elif name in best and not loss <= best[name][1] + 1e-12 * abs(best[name][1]):
                step[name] = step[name] / 2.0
                model.weights = best[name][0] + step[name]
            else:
                best[name] = (model.weights, loss)
                step[name] = -np.linalg.lstsq(curvature, gradient, rcond=None)[0]
                model.weights = model.weights + step[name]
        if not moving:
            return models
    raise RuntimeError(f"{len(moving)} of {len(models)} logistic models did not converge in {max_steps} steps")


def gradients(df: DataFrame, models: dict[str, Logistic], ridge: float = RIDGE) -> DataFrame:
    """(model, coefficient, n, moment, gradient): the rows used, the sum of label times input, and the
    penalised gradient at the fitted weights, one row per coefficient."""
    parts = []
    for name, model in models.items():
        y, used = F.col(model.label).cast("double"), model.used()
        penalty = [0.0, *[ridge * float(w) for w in model.weights[1:]]]
        for label, x, pull in zip(["intercept", *model.features], model.inputs(), penalty):
            parts.append(F.struct(
                F.lit(name).alias("model"), F.lit(label).alias("coefficient"), F.count_if(used).alias("n"),
                F.coalesce(F.sum(F.when(used, y * x)), F.lit(0.0)).alias("moment"),
                (F.coalesce(F.sum(F.when(used, (model.probability() - y) * x)), F.lit(0.0)) + F.lit(pull)).alias("gradient")))
    return df.agg(F.array(*parts).alias("_parts")).select(F.inline("_parts"))
