"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Index: a vector's residual from the corpus mean is turned by a fixed random
rotation and each coordinate kept as its sign, packed to bits; two scalars go
with the code, the residual's length and its inner product with its own code
(the correction that makes the estimate unbiased). All rows are indexed; the
mean covers all rows.

Search: vectors and queries are dealt into blocks of bounded size and every
pair of blocks is one group. In a group the packed codes give an estimate of
each inner product with an error bound; candidates whose upper bound reaches
the k-th largest lower bound are reranked on the original vectors in double
precision. The k best of each block meet in one window per query. Work is a
linear pass over the codes per query block, as the query set is part of the
input.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxcast.llm.tables import stored

#: Rows of a data block and of a query block; queries estimated at once.
DATA_ROWS, QUERY_ROWS, AT_ONCE = 8192, 4096, 256
#: Half-width of the error bound in standard deviations of the estimate.
EPSILON = 4.0


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix; vectors are padded to a multiple of 8."""
    size = -(-dim // 8) * 8
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def padded(x: np.ndarray, size: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, size - x.shape[1])))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int, kind: str) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, residual lengths and code corrections."""
    rest = padded(x - centre, len(turn)) @ turn
    length = np.linalg.norm(rest, axis=1)
    scale = np.where(length > 0, length, 1)
    own = np.abs(rest).sum(axis=1) / (scale * np.sqrt(len(turn)))
    return np.packbits(rest > 0, axis=1), length, np.where(length > 0, own, 1)


def estimates(codes: np.ndarray, length: np.ndarray, own: np.ndarray, q: np.ndarray, centre: np.ndarray,
              turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x codes) and their error bounds."""
    size = len(turn)
    signs = (np.unpackbits(codes, axis=1)[:, :size].astype(np.float32) * 2 - 1) / np.float32(np.sqrt(size))
    turned = (padded(q, size) @ turn).astype(np.float32)
    factor = (length / own).astype(np.float32)
    guess = (q @ centre)[:, None] + turned @ signs.T * factor
    spread = length * np.sqrt(np.maximum(0, 1 - own**2)) / own / np.sqrt(max(size - 1, 1))
    return guess, EPSILON * np.linalg.norm(q, axis=1)[:, None] * spread[None, :] + 1e-5


def inner(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in order of the components."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * q[d]
    return total


def _searched(dim: int, centre: np.ndarray, turn: np.ndarray, k: int) -> Callable:
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(data: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(data) or not len(queries):
            return schema.empty_table()
        ids, x = data["id"].to_numpy(), matrix(data["v"], dim, "f8")
        codes = np.frombuffer(b"".join(data["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
        length, own = data["length"].to_numpy(), data["own"].to_numpy()
        asked, q = queries["id"].to_numpy(), matrix(queries["v"], dim, "f8")
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(asked), AT_ONCE):
            guess, error = estimates(codes, length, own, q[at:at + AT_ONCE], centre, turn)
            for i, (low, high) in enumerate(zip(guess - error, guess + error, strict=True)):
                me = asked[at + i]
                other = ids != me
                low = np.where(other, low, -np.inf)
                enough = np.partition(low, -k)[-k] if len(low) > k else -np.inf
                near = np.flatnonzero(other & (high >= enough))
                rough = x[near] @ q[at + i]
                if len(near) > k:  # all that rounding could bring among the first k
                    least = np.partition(rough, -k)[-k]
                    near = near[rough >= least - 1e-9 * (1 + abs(least))]
                score = inner(x[near], q[at + i])
                best = np.lexsort((ids[near], -score))[:k]
                found.append((np.full(len(best), me), ids[near][best], score[best]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], schema=schema)
    return run


def usable(v: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int, np.ndarray]:
    """The stored index (id, v, code, length, own), its dimension and the
    corpus mean. Rows with a null id and unusable vectors take no part, nor do
    vectors whose length isn't the most frequent one (the largest, if tied)."""
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].alias("v")) \
        .where(F.col("id").isNotNull() & F.coalesce(usable(F.col("v")), F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = sizes["dim"] if sizes else 1
    rows = rows.where(F.size("v") == dim)
    mean = rows.agg(*[F.avg(F.get("v", F.lit(i)).cast("double")) for i in range(dim)]).first()
    centre, turn = np.array([m or 0.0 for m in mean]), rotation(dim)

    def run(batches):
        for b in batches:
            code, length, own = encode(matrix(b.column("v"), dim, "f8"), centre, turn)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("v"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length), pa.array(own)],
                names=["id", "v", "code", "length", "own"])

    kind = rows.schema["v"].dataType.simpleString()
    return stored(rows.mapInArrow(run, f"id long, v {kind}, code binary, length double, own double"), "onebit"), dim, centre


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner
    product for each row whose id is divisible by ``every``, among all rows
    but those with the query's id; ties go to the smaller id. Where rows share
    an id, each is a candidate and the smallest vector is the query. With
    fewer than ``k`` candidates all are returned; an empty table gives an
    empty result. Other columns are ignored."""
    index, dim, centre = build_index(vectors, id_col, vector_col)
    n = index.count()
    asked = index.where(F.pmod("id", F.lit(every)) == 0).groupBy("id").agg(F.min("v").alias("v"))
    data_blocks, query_blocks = max(1, -(-n // DATA_ROWS)), max(1, -(-n // every // QUERY_ROWS))
    deal = lambda df, own, n, other, m: df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n))) \
        .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)).cast("array<bigint>")))
    data = deal(index, "d", data_blocks, "q", query_blocks)
    queries = deal(asked, "q", query_blocks, "d", data_blocks)
    best = data.groupBy("d", "q").cogroup(queries.groupBy("d", "q")).applyInArrow(
        _searched(dim, centre, rotation(dim), k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
