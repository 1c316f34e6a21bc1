"""Labels and folds, shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % folds


def clear_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, label): rows with a null id or a label other than 0 and 1 don't
    count, nor do ids whose rows disagree."""
    return labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)) \
        .groupBy(F.col(id_col).cast("long").alias("id")) \
        .agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).alias("other")) \
        .where("label = other").drop("other")


def monotone(n: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Shares hits / n of sorted bins, pooled until they don't fall."""
    pools: list[list[float]] = []
    for a, b in zip(hits, n, strict=True):
        pools.append([a, b, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return np.concatenate([np.full(int(k), a / b) for a, b, k in pools])
