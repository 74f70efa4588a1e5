"""Log-link Poisson regression with an elastic net, fitted on Spark by proximal Newton steps.

Minimises  mean(exp(x b) - y x b) + alpha * ((1 - l1) / 2 * |b|^2 + l1 * |b|_1)
over the coefficients b, the intercept among them (it is penalised like any
other).  Each step is one pass over the rows: every partition sums its
gradient and its weighted normal equations, Spark adds them up, and what
reaches the driver is (p + 1)^2 numbers for p coefficients, whatever the
number of rows.  The penalised quadratic model is then solved by coordinate
descent; a step that raises the objective is halved.

Edge cases: rows with a null target or input are left out; without any row all
coefficients are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the method.
ALPHA, L1 = 0.1, 0.5
INTERCEPT = "const"
#: Largest linear predictor of a step that is accepted.
MAX_ETA = 300.0


@dataclass(frozen=True)
class PoissonModel:
    cols: tuple[str, ...]
    coefs: tuple[float, ...]           # intercept first
    gradient: tuple[float, ...]        # of the mean deviance part, at the coefficients
    objective: float
    alpha: float
    l1: float

    def mean(self) -> Column:
        eta = F.lit(self.coefs[0])
        for c, b in zip(self.cols, self.coefs[1:], strict=True):
            if b:
                eta = eta + F.col(c) * F.lit(b)
        return F.exp(eta)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.mean())

    def residuals(self) -> list[float]:
        """How far each coefficient is from satisfying its optimality condition."""
        out = []
        for b, g in zip(self.coefs, self.gradient, strict=True):
            g += self.alpha * (1 - self.l1) * b
            out.append(float(abs(g + self.alpha * self.l1 * np.sign(b)) if b else max(0.0, abs(g) - self.alpha * self.l1)))
        return out


def _sums(rows: DataFrame, cols: tuple[str, ...], coefs: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray, float]:
    """(rows, objective, gradient, Hessian, largest predictor) at ``coefs``; sums over all rows."""
    p = len(coefs)
    b = coefs.copy()

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, top = np.zeros(2 + p + p * p), -np.inf
        for pdf in batches:
            x = np.column_stack([np.ones(len(pdf)), pdf[list(cols)].to_numpy(float)])
            y, eta = pdf["_y"].to_numpy(float), x @ b
            if len(eta):
                top = max(top, float(eta.max()))
            mu = np.exp(np.minimum(eta, 700.0))
            total += np.concatenate([[len(pdf), (mu - y * eta).sum()], x.T @ (mu - y), (x.T @ (x * mu[:, None])).ravel()])
        yield pd.DataFrame({"i": np.arange(len(total) + 1), "v": np.append(total, top)})

    cells = rows.select("_y", *cols).mapInPandas(part, "i int, v double").groupBy("i").agg(F.sum("v").alias("s"), F.max("v").alias("m"))
    found = {r["i"]: r for r in cells.collect()}                       # p * p + p + 3 rows
    total = np.array([found[i]["s"] for i in range(2 + p + p * p)])
    return total[0], total[1], total[2:2 + p], total[2 + p:].reshape(p, p), found[2 + p + p * p]["m"]


def coordinate_descent(b: np.ndarray, g: np.ndarray, h: np.ndarray, l1: float, l2: float, sweeps: int = 5000, tol: float = 1e-13) -> np.ndarray:
    """The minimum of g (t - b) + (t - b) h (t - b) / 2 + l2 / 2 |t|^2 + l1 |t|_1."""
    t, q = b.copy(), g.copy()                          # q: gradient of the quadratic part at t
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(t)):
            if h[j, j] + l2 <= 0:
                continue
            z = h[j, j] * t[j] - q[j]
            new = np.sign(z) * max(0.0, abs(z) - l1) / (h[j, j] + l2)
            if new != t[j]:
                moved = max(moved, abs(new - t[j]) * np.sqrt(h[j, j] + l2))
                q += h[:, j] * (new - t[j])
                t[j] = new
        if moved < tol:
            break
    return t


def fit(rows: DataFrame, cols: tuple[str, ...], target: str, alpha: float = ALPHA, l1: float = L1, max_steps: int = 50,
        tol: float = 1e-9) -> PoissonModel:
    """Fit on clip(target, 0); ``rows`` is read once per step, so it should be a written table."""
    data = rows.select(F.greatest(F.col(target).cast("double"), F.lit(0.0)).alias("_y"),
                       *[F.col(c).cast("double").alias(c) for c in cols], F.col(target).alias("_t")).dropna().drop("_t")
    p = len(cols) + 1
    lam1, lam2 = alpha * l1, alpha * (1 - l1)
    pen = lambda v: lam2 / 2 * float(v @ v) + lam1 * float(np.abs(v).sum())
    b = np.zeros(p)
    first = data.agg(F.avg("_y")).first()[0]
    if first is None:
        return PoissonModel(tuple(cols), (0.0,) * p, (0.0,) * p, 0.0, alpha, l1)
    b[0] = np.log(first) if first > 0 else 0.0

    def at(v: np.ndarray):
        n, loss, g, h, top = _sums(data, tuple(cols), v)
        value = loss / n + pen(v) if top <= MAX_ETA else np.inf
        return value, g / n, h / n
    value, g, h = at(b)
    for _ in range(max_steps):
        goal, scale = coordinate_descent(b, g, h, lam1, lam2), 1.0
        step = goal - b
        if np.abs(step * np.sqrt(np.diag(h) + lam2)).max() < tol:
            break
        while True:
            new = goal if scale == 1.0 else b + scale * step
            found = at(new)
            if found[0] <= value + 1e-12 * abs(value) or scale < 1e-6:
                break
            scale /= 2
        b, (value, g, h) = new, found
    return PoissonModel(tuple(cols), tuple(float(x) for x in b), tuple(float(x) for x in g), float(value), alpha, l1)
