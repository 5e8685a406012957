"""Labels for training: all of them or a bounded sample with a part held back, and a logistic fit."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 4
HELD_OUT = 2
MOST_PER_CLASS = 20_000


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % FOLDS


def held_out(key: Column) -> Column:
    return F.coalesce(fold(key) == HELD_OUT, F.lit(False))


def known(labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """(key as text, label) of all labelled rows outside the held-out fold; keys with several labels count as 1 if any is."""
    rows = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    rows = rows.filter("key is not null and label in (0, 1)").filter(~held_out(F.col("key")))
    return rows.groupBy(F.col("key").cast("string").alias("key")).agg(F.max("label").alias("label"))


def sample(labels: DataFrame, label: str, key: str = "doc_id", most: int = MOST_PER_CLASS) -> dict[str, tuple[int, bool]]:
    """{key as text: (label, calibrates)} of at most ``most`` rows of each class, outside the held-out fold.

    The rows are the first by a hash of the key, so the sample does not depend
    on the order of the table. One in four only calibrates.
    """
    rows = known(labels, label, key).withColumn("order", F.xxhash64("key", F.lit(17)))
    out = {}
    for value in (0, 1):
        for row in rows.filter(F.col("label") == value).orderBy("order", "key").limit(most).collect():
            out[row.key] = (row.label, row.order % FOLDS == 0)
    return out


def balanced(role: dict[str, tuple[int, bool]]) -> dict[str, tuple[int, bool]]:
    """Without the rows of the larger class, past the size of the smaller one, that don't calibrate."""
    counts = [sum(1 for v, c in role.values() if v == value and not c) for value in (0, 1)]
    left, out = [min(counts)] * 2, {}
    for key, (value, calibrates) in role.items():
        if calibrates or left[value] > 0:
            out[key] = (value, calibrates)
            left[value] -= not calibrates
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic_sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> tuple[int, float, np.ndarray, np.ndarray]:
    """(rows, loss, slope, curve) of the logistic loss at coefficients ``w``, added up over the rows."""
    z = x @ w
    p = sigmoid(z)
    return len(x), float(weight @ (np.logaddexp(0, z) - y * z)), x.T @ (weight * (p - y)), (x * (weight * p * (1 - p))[:, None]).T @ x


def newton(sums: Callable, size: int, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """``size`` coefficients by Newton's method with step halving; ``sums(w)`` gives ``logistic_sums`` over all rows."""

    def at(w):
        n, loss, slope, curve = sums(w)
        n = max(1, n)
        return loss / n + ridge * w @ w / 2, slope / n + ridge * w, curve / n + ridge * np.eye(size)

    w = np.zeros(size)
    now, slope, curve = at(w)
    for _ in range(rounds):
        step = np.linalg.solve(curve, slope)
        part = 1.0
        # The order of additions moves the last digits.
        while (then := at(w - part * step))[0] > now + 1e-12 and part > 1e-6:
            part /= 2
        if now - then[0] < 1e-12:
            break
        w = w - part * step
        now, slope, curve = then
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Coefficients for rows at hand; ``x`` has its own column of ones if one is wanted."""
    weight = np.ones(len(x)) if weight is None else weight
    return newton(lambda w: logistic_sums(x, y, weight, w), x.shape[1], ridge, rounds)
