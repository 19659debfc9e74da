"""Bounded samples of labelled documents for the classifiers, and their calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """Checksum of the id as text, modulo ``folds``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(folds)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[list[str], np.ndarray, float]:
    """Texts, labels, and the share of label 1 among all labelled rows.

    At most ``per_class`` labelled ids of each class are taken, by a hash of the id; the rest of the rows is only
    counted. An id with both labels, or none, is left out.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("most")).filter("y = most").select("doc_id", "y")
    )
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("doc_id"), F.col("doc_id")
    picked = known.filter("y = 1").orderBy(*order).limit(per_class).unionAll(
        known.filter("y = 0").orderBy(*order).limit(per_class))
    # At most 2 * per_class rows: the bound of the broadcast.
    found = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id", "y").agg(F.max("text").alias("text"))
        .orderBy("doc_id").select("text", "y").toPandas()
    )
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return found["text"].tolist(), found["y"].to_numpy(np.int64), share


def calibrated(margins: np.ndarray, y: np.ndarray, share: float, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins, with classes weighted as in the whole (``share`` of 1)."""
    scale = max(float(np.std(margins)), 1e-9)
    x = np.column_stack([margins / scale, np.ones(len(margins))])
    weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        gradient = x.T @ (weight * (p - y)) + ridge * beta * [1, 0]
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag([ridge, 1e-9])
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(beta[0], 0.0) / scale), float(beta[1])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
