"""Linear models from fold-wise moments (M1, E1, E2, E5): one aggregation, any grid.

A table's examples enter through their moments only: per fold, the sums of all products
of two of (1, x_1 .. x_d, y). Training moments of a fold are total minus fold, so every
fold and every grid point is solved from the same few numbers and no row is read again,
not even for the error on the held-out fold, which is a quadratic form of its moments.

The objective is that of ``pyspark.ml``'s ``LinearRegression``: features and label scaled
by their population deviations, half the mean squared error, an elastic net of weight
``reg`` (over the label's deviation), no penalty on the intercept. It is solved by
coordinate descent on the scaled Gram matrix, to convergence.

What reaches the driver are (d + 2) (d + 3) / 2 sums a fold, whatever the rows. Rows
without a label take no part; a feature that is constant gets the coefficient 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """Sums of products of (1, x, y): row and column 0 are the ones, the last the label."""

    sums: np.ndarray

    @property
    def n(self) -> float:
        return float(self.sums[0, 0])

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.sums - other.sums)

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.sums + other.sums)


@dataclass
class Linear:
    coefficients: np.ndarray
    intercept: float
    sweeps: int


def fold_moments(examples: DataFrame, features: str = "features", label: str = "label", fold: str = "fold") -> dict[int, Moments]:
    """Each fold's moments by one aggregation over the products of non-zero entries.

    Zeros give no rows, so one-hot slots cost nothing; products are summed map-side, at
    most one row a fold and pair of features leaves a task.
    """
    kind = examples.schema[features].dataType.simpleString()
    x = vector_to_array(features) if kind == "vector" else F.col(features).cast("array<double>")
    z = F.concat(F.array(F.lit(1.0)), x, F.array(F.col(label).cast("double")))
    known = examples.filter(F.col(label).isNotNull() & F.col(features).isNotNull() & F.col(fold).isNotNull())
    width = known.select(F.size(z).alias("w")).agg(F.max("w")).first()[0]
    if width is None:
        return {}
    entries = F.filter(F.transform(z, lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda e: e["v"] != 0.0)
    rows = known.select(F.col(fold).alias("k"), entries.alias("e"))
    pairs = F.flatten(F.transform("e", lambda a: F.transform(F.filter("e", lambda b: b["i"] >= a["i"]), lambda b: F.struct(
        a["i"].alias("i"), b["i"].alias("j"), (a["v"] * b["v"]).alias("p")))))
    sums = rows.select("k", F.explode(pairs).alias("x")).groupBy("k", "x.i", "x.j").agg(F.sum("x.p").alias("s"))
    out: dict[int, Moments] = {}
    for r in sums.collect():
        m = out.setdefault(r["k"], Moments(np.zeros((width, width)))).sums
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["s"]
    return out


def elastic_net(m: Moments, reg: float = 0.0, net: float = 0.0, intercept: bool = True, tol: float = 1e-12,
                max_sweeps: int = 100_000) -> Linear:
    """The model that minimises the elastic-net objective of the module's text over the moments' rows."""
    mean = m.sums / m.n
    xb, yb = mean[0, 1:-1], mean[0, -1]
    xs = np.sqrt(np.maximum(np.diag(mean)[1:-1] - xb ** 2, 0.0))
    ys = float(np.sqrt(max(mean[-1, -1] - yb ** 2, 0.0))) or abs(float(yb)) or 1.0
    live = xs > 1e-12 * np.sqrt(np.maximum(np.diag(mean)[1:-1], 1e-300))
    inv = np.where(live, 1.0 / np.where(live, xs, 1.0), 0.0)
    gram = mean[1:-1, 1:-1] * np.outer(inv, inv)
    cross = mean[1:-1, -1] * inv / ys
    if intercept:  # the best intercept of any coefficients: products around the means
        gram = gram - np.outer(xb * inv, xb * inv)
        cross = cross - xb * inv * yb / ys
    l1, l2 = reg / ys * net, reg / ys * (1.0 - net)
    w, sweeps = np.zeros(len(inv)), 0
    if l1 == 0.0:
        at = np.flatnonzero(live)
        part = gram[np.ix_(at, at)] + l2 * np.eye(len(at))
        w[at] = np.linalg.solve(part, cross[at]) if l2 else np.linalg.lstsq(part, cross[at], rcond=None)[0]
    else:
        rest = cross.copy()  # cross - gram @ w
        for sweeps in range(1, max_sweeps + 1):
            change = 0.0
            for j in np.flatnonzero(live):
                pull = rest[j] + gram[j, j] * w[j]
                new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (gram[j, j] + l2)
                if new != w[j]:
                    rest -= gram[:, j] * (new - w[j])
                    change = max(change, abs(new - w[j]))
                    w[j] = new
            if change < tol:
                break
    w = w * inv * ys
    return Linear(w, float(yb - xb @ w) if intercept else 0.0, sweeps)


def mean_squared_error(m: Moments, model: Linear) -> float:
    """Mean squared error of a model over the moments' rows: a quadratic form."""
    z = np.concatenate([[model.intercept], model.coefficients, [-1.0]])
    return float(max(z @ m.sums @ z, 0.0) / m.n)


def grid_search(folds: dict[int, Moments], points: Sequence[dict]) -> list[dict]:
    """Per point (``regParam``, ``elasticNetParam``, ``fitIntercept``; others are carried along): the RMSE of every fold
    by the model of the others, and their mean. Folds in order of number."""
    total = sum(list(folds.values())[1:], list(folds.values())[0])
    solved: dict[tuple, list[float]] = {}
    out = []
    for p in points:
        key = (p.get("regParam", 0.0), p.get("elasticNetParam", 0.0), p.get("fitIntercept", True))
        if key not in solved:  # points that differ in other settings, as in the solver's steps, share the optimum
            solved[key] = [mean_squared_error(folds[k], elastic_net(total - folds[k], *key)) ** 0.5 for k in sorted(folds)]
        out.append({**p, "fold_rmse": solved[key], "rmse": float(np.mean(solved[key]))})
    return out
