"""A bounded sample of labelled rows for fitting classifiers, and small fitting helpers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled rows fit a classifier; the ids of so many rows are broadcast and their features collected.
SAMPLE_ROWS = 20_000


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id's decimal text has the remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, target: str, modulus: int, remainder: int, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text and y of at most `rows` labelled documents outside the held-out fold, chosen by a hash of the id.

    A document with several labels counts once, with its largest; null labels and ids take no part.
    """
    ids = (
        labels.select("doc_id", F.col(target).alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out("doc_id", modulus, remainder))
        .groupBy("doc_id")
        .agg(F.max("y").cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return docs.select(*[c for c in ("doc_id", "text", "n_chars") if c in docs.columns]).join(F.broadcast(ids), "doc_id")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last is the intercept."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
