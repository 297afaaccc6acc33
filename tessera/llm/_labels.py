"""Bounded samples of labelled training rows and calibrated scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % modulus


def training_texts(docs: DataFrame, labels: DataFrame, target: str, usable: Column, most: dict[int, int]) -> DataFrame:
    """doc_id, text, label of up to ``most[label]`` documents per label, those whose hashed id is smallest.

    Only ids and labels are sorted and limited; the chosen ids, bounded by
    ``most``, are sent to the documents. Ids that are null or labelled both ways
    are left out.
    """
    ids = labels.filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & usable)
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(target).alias("label"), F.max(target).alias("high")).filter("label = high").drop("high")
    parts = [ids.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in most.items()]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")


def logistic(features: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; the last one is the constant."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * weights.sum() / max(len(x), 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (labels - p)) - penalty * w
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(penalty), slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(features: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ w[:-1] + w[-1], -30, 30)))
