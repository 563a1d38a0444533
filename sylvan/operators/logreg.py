"""Standard scaling and full-batch gradient-descent logistic regression.

The training rows cross to Python once, as numpy blocks that stay on the
executors (``blocks.py``).  An epoch is one job over the blocks: each gives its
gradient, bias gradient, loss and row count (``d + 3`` numbers), and these are
summed by levels in tasks, so one vector comes back however many partitions
there are.  Only the weights travel out, inside the task closure.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.operators.blocks import component_moments, kept, numpy_blocks, tree_sum, width


def scaler_fit(df: DataFrame, features: str) -> tuple[list[float], list[float]]:
    """M8 fit: per-dimension mean and population std (zero std -> 1).

    The statistics are ``d`` numbers each, a bound fixed by the feature width.
    """
    m = component_moments(df, F.col(features))
    if m is None:
        return [], []
    sd = np.sqrt(m.m2 / np.maximum(m.n, 1))
    return [float(v) for v in m.mean], [float(v) if v else 1.0 for v in sd]


def scaler_transform(df: DataFrame, features: str, mu, sd, out: str | None = None) -> DataFrame:
    """M8 transform: (x - mu) / sd element-wise, as one array expression."""
    mu_a = F.array(*[F.lit(float(m)) for m in mu])
    sd_a = F.array(*[F.lit(float(s)) for s in sd])
    x = F.col(features).cast("array<double>")
    z = F.transform(x, lambda v, i: (v - F.element_at(mu_a, i + 1)) / F.element_at(sd_a, i + 1))
    return df.withColumn(out or features, z)


def sigmoid_np(z):
    return 1.0 / (1.0 + np.exp(-z))


def _partial_gradient(w: np.ndarray, b: float):
    def run(xy):
        x, y = xy
        z = x @ w + b
        r = sigmoid_np(z) - y
        # stable form of -[y log p + (1-y) log(1-p)]
        loss = np.sum(np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z))))
        return np.concatenate([x.T @ r, [r.sum(), loss, len(y)]])

    return run


@dataclass
class LogisticModel:
    weights: list[float]
    bias: float
    losses: list[tuple[int, float]] = field(default_factory=list)

    def probability(self, df: DataFrame, features: str) -> DataFrame:
        w = F.array(*[F.lit(float(v)) for v in self.weights])
        x = F.col(features).cast("array<double>")
        dot = F.aggregate(F.zip_with(x, w, lambda a, c: a * c), F.lit(0.0), lambda acc, v: acc + v)
        return df.withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-(dot + F.lit(float(self.bias))))))

    def predict(self, df: DataFrame, features: str, out: str = "prediction") -> DataFrame:
        """Class 1 when p > 0.5 (strictly)."""
        return self.probability(df, features).withColumn(
            out, F.when(F.col("probability") > 0.5, 1).otherwise(0)).drop("probability")


def fit_logistic(df: DataFrame, features: str, label: str, learning_rate: float = 0.01, epochs: int = 1000,
                 record_every: int = 100) -> LogisticModel:
    """Zeros init, full-batch gradient, fixed epochs, no regularisation.

    The loss recorded for an epoch is taken before that epoch's update.
    """
    data = kept(numpy_blocks(df, F.col(features), F.col(label)))
    try:
        d = width(data)
        if d is None:
            raise ValueError("empty training frame")
        w, b, losses = np.zeros(d), 0.0, []
        for epoch in range(epochs):
            vec = tree_sum(data, _partial_gradient(w.copy(), b), np.add)
            m = vec[d + 2]
            if epoch % record_every == 0:
                losses.append((epoch, float(vec[d + 1] / m)))
            w = w - learning_rate * (vec[:d] / m)
            b = b - learning_rate * (vec[d] / m)
        return LogisticModel(weights=[float(v) for v in w], bias=float(b), losses=losses)
    finally:
        data.unpersist()
