"""FTRL-proximal training of sparse linear models on a bounded sample, in shards that Spark spreads.

Each shard of the sample is trained by itself (rows in a fixed order, several passes) and the
shards' weights are averaged; the model is what is not zero after that. The sample's size is the
caller's documented bound, so a shard is bounded too. One shard learns rare features better,
several are for larger samples.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARDS = 8


class Ftrl:
    """Follow the regularised leader, per-coordinate rates, elastic net; one weight column per class.

    With one column it is logistic regression, with more softmax. Feature ``dims`` is the bias (not penalised).
    """

    def __init__(self, dims: int, classes: int, alpha: float, beta: float = 1.0, l1: float = 0.0, l2: float = 0.0):
        self.z = np.zeros((dims + 1, classes))
        self.n = np.zeros((dims + 1, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.full(len(z), self.l1)
        l1[-1] = 0.0  # the bias comes last
        l1 = l1[:, None]
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at = np.append(at, len(self.z) - 1)
        x = np.append(x, 1.0)
        w = self.weights(at)
        score = x @ w
        if len(score) == 1:
            g = 1 / (1 + np.exp(-np.clip(score, -35, 35))) - label
        else:
            g = softmax(score)
            g[label] -= 1
        g = x[:, None] * g
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(sample: DataFrame, dims: int, classes: int, passes: int, **options) -> np.ndarray:
    """Weights (dims + 1, classes) from rows ``shard, turn, label, at[, x]``; ``turn`` orders a shard's rows.

    ``at`` are a row's features and ``x`` their values (without it each is 1).
    """
    def one(pdf):
        import pandas as pd
        pdf = pdf.sort_values(["turn", "label"], kind="stable")
        values = pdf["x"] if "x" in pdf else [1.0] * len(pdf)
        rows = list(zip(pdf["at"], values, pdf["label"]))
        model = Ftrl(dims, classes, **options)
        for _ in range(passes):
            for at, x, y in rows:
                model.learn(np.asarray(at, np.int64), np.broadcast_to(np.asarray(x, float), len(at)), int(y))
        w = model.weights()
        i, k = np.nonzero(w)
        return pd.DataFrame({"i": np.append(i, -1), "k": np.append(k, 0), "w": np.append(w[i, k], 1.0)})

    parts = sample.groupBy("shard").applyInPandas(one, "i long, k int, w double")
    rows = parts.groupBy("i", "k").agg(F.sort_array(F.collect_list("w")).alias("w")).toPandas()  # SHARDS values at most in each list
    w = np.zeros((dims + 1, classes))
    if len(rows):
        shards = float(sum(rows.loc[rows["i"] == -1, "w"].iloc[0]))
        rows = rows[rows["i"] >= 0]
        if len(rows):
            w[rows["i"].to_numpy(), rows["k"].to_numpy()] = rows["w"].map(np.sum).to_numpy() / shards
    return w


def share(n: int, most: int) -> float:
    """Part of ``n`` rows that is expected to give ``most`` rows, or all."""
    return min(1.0, most / n) if n else 1.0


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), labels]).mean())

    a, b = np.log(0.02), np.log(50.0)
    ratio = (5 ** 0.5 - 1) / 2
    for _ in range(60):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))
