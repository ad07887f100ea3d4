"""Bounded samples of labelled rows, and a small logistic fit on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: Column, mod: int) -> Column:
    """``crc32`` of an id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % mod


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, mod: int, held: int, bound: int,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, label`` of at most ``bound`` labelled ids, one row each, none of the held-out ones.

    Ids are chosen in the order of a hash, so the sample does not depend on how
    the rows are spread. At most ``bound`` ids meet the documents, by a
    broadcast of that proven size; no text without a label is shuffled. Of
    rows with one id the text with the smallest hash counts, of its labels the
    smallest.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
                         & (remainder(F.col(id_col), mod) != held))
    chosen = (known.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(bound))
    left = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (left.join(F.broadcast(chosen), "id").groupBy("id", "label")
            .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("id", "text", "label"))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the first is the intercept."""
    x = np.column_stack([np.ones(len(x)), x]) if len(x) else np.zeros((0, x.shape[1] + 1))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, grad)
        step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
