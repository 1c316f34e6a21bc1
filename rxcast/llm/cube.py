"""Mixing sources to target weights by cube-method balanced sampling.

A source's target is its share, by weight, of all words, at most ``cap`` times
its own words; what is above is reshared. Each of its documents is taken
floor(target / words) times for certain and once more with the fractional
part as inclusion probability. Those probabilities are rounded by the cube
method: open documents move along the null space of the two constraints (words
taken, documents taken) until one of them reaches 0 or 1, so both totals stay
exactly as they are. The largest go first, each against all others of its
block, or else one of them would stay open to the end; the rest move three at
a time. A block ends with two open ones at most; these form the blocks of the
next level, and so on until a source has one block. That one keeps its last
``LANDING`` open documents, and all their roundings are compared: the one that
misses the word total least, then the document total, is taken.

Blocks hold about ``BLOCK`` documents whatever the table, so a source of any
size is many small groups; the number of levels grows with the logarithm of
the table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxcast.llm.tables import stored, word_count

BLOCK, LANDING, TINY = 2048, 12, 1e-9
COLUMNS = ["id", "source", "size", "hash", "place", "source_size", "target", "whole", "p", "order"]


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, size) rows: sources in code
    point order, null last, weigh ``weights`` in turn and share all words;
    none exceeds ``cap`` times its words. In order of cap over weight the
    capped sources are a prefix, so one window finds the water level."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank, F.lit(len(weights))))
    per = per.withColumn("weight", weight).withColumn("most", F.col("source_size").cast("double") * cap) \
        .withColumn("ratio", F.col("most") / F.col("weight"))
    order, everything = Window.orderBy("ratio", F.col("source").asc_nulls_last()), Window.partitionBy()
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - before) / rest
    per = per.withColumn("level", level).withColumn("place", F.row_number().over(order))
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))
    per = per.withColumn("water", F.min(fits).over(everything)["level"])
    return per.select("source", "source_size", F.least(F.col("most"), F.coalesce(F.col("water") * F.col("weight"), F.col("most"))).alias("target"))


def settle_largest(p: np.ndarray, x: np.ndarray, rng: np.random.Generator, stop: int = 2) -> np.ndarray:
    """Bring the largest documents to 0 or 1, each along the null-space vector
    nearest to its own axis among all open ones (weighted by their room)."""
    p, scaled = p.copy(), x / max(x.max(initial=0), 1)
    order = np.argsort(-x, kind="stable")
    order = order[(p[order] > 0) & (p[order] < 1)]
    for top in order[:max(64, len(order) // 10)]:
        while 0 < p[top] < 1:
            at = np.flatnonzero((p > 0) & (p < 1))
            if len(at) <= stop:
                return p
            a, room = np.stack([scaled[at], np.ones(len(at))]), p[at] * (1 - p[at])
            own = np.flatnonzero(at == top)[0]
            u = -room * (a.T @ (np.linalg.pinv(a * room @ a.T) @ a[:, own]))
            u[own] += 1
            u[np.abs(u) < 1e-12] = 0
            if not u[own]:
                return p
            moved = np.flatnonzero(u)
            q, v = p[at][moved], u[moved]
            up = np.where(v > 0, (1 - q) / v, q / np.abs(v)).min()
            down = np.where(v > 0, q / v, (1 - q) / np.abs(v)).min()
            q = q + (up if rng.random() * (up + down) < down else -down) * v
            q[q < TINY], q[q > 1 - TINY] = 0, 1
            p[at[moved]] = q
    return p


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator, stop: int = 2) -> np.ndarray:
    """Move probabilities through the null space of (x, 1) until at most ``stop``
    (two or more) are open; sums of p * x and of p are kept."""
    p, x = p.tolist(), x.tolist()
    waiting = [i for i, v in enumerate(p) if TINY < v < 1 - TINY][::-1]
    held: list[int] = []
    draws = iter(rng.random(len(waiting) * 3 + 3).tolist())
    while True:
        if stop > 2 and len(held) + len(waiting) <= stop:
            return np.array(p)
        while len(held) < 3 and waiting:
            held.append(waiting.pop())
        if len(held) == 3:
            a, b, c = (x[i] for i in held)
            u = [b - c, c - a, a - b]
            if a == b:
                u = [1.0, -1.0, 0.0]
            elif a == c:
                u = [1.0, 0.0, -1.0]
            elif b == c:
                u = [0.0, 1.0, -1.0]
        elif len(held) == 2 and x[held[0]] == x[held[1]]:
            u = [1.0, -1.0]
        else:
            return np.array(p)
        up = min((1 - p[i]) / v if v > 0 else p[i] / -v for i, v in zip(held, u, strict=True) if v)
        down = min(p[i] / v if v > 0 else (1 - p[i]) / -v for i, v in zip(held, u, strict=True) if v)
        step = up if next(draws) * (up + down) < down else -down
        for i, v in zip(held, u, strict=True):
            p[i] += step * v
            p[i] = 0.0 if p[i] < TINY else 1.0 if p[i] > 1 - TINY else p[i]
        held = [i for i in held if 0 < p[i] < 1]


def land(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Round what is open (``LANDING`` at most) so that the sum of p * x moves
    least, then the sum of p."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    off = ways - p[open_]
    out = p.copy()
    out[open_] = ways[np.lexsort((np.abs(off.sum(axis=1)), np.abs(off @ x[open_]).round(6)))[0]]
    return out


def _block(seed: int, level: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("size", "descending"), ("order", "ascending"), ("hash", "ascending")])
        first = rows.slice(0, 1).to_pylist()[0]
        rng = np.random.default_rng([seed, level, first["place"], first["block"]])
        x = rows["size"].to_numpy().astype(float)
        stop = LANDING if first["blocks"] == 1 else 2
        p = flight(settle_largest(rows["p"].to_numpy().copy(), x, rng, stop), x, rng, stop)
        p = land(p, x) if first["blocks"] == 1 else p
        return rows.set_column(rows.column_names.index("p"), "p", pa.array(p)).select(COLUMNS)
    return run


def balanced_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 11,
                 id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, source_size, target, copies, taken, text_hash) per row.

    ``size`` counts words (null text: 0); ``copies`` is how often the mix takes
    the document, ``taken`` copies times size. A null source is a source of its
    own, the last. Documents without words balance the document count only;
    a source without words has target 0 and no copies. Rows that repeat an id
    are documents of their own; equal rows are interchangeable. The draw
    depends on ``seed``, ids and texts only, so reruns agree; rows without an id
    are dealt to blocks by their texts. An empty table
    gives an empty result; other columns are ignored."""
    sized = stored(docs.select(docs[id_col].cast("long").alias("id"), docs[source_col].alias("source"),
                               word_count(docs[text_col]).alias("size"), F.xxhash64(docs[text_col]).alias("hash")), "mix-sizes")
    targets = source_targets(sized, weights, cap).withColumnRenamed("source", "name")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("name"))).select(
        "id", "source", "size", "hash", F.crc32(F.encode(F.coalesce("source", F.lit("")), "UTF-8")).alias("place"), "source_size",
        "target", F.floor(share + TINY).cast("long").alias("whole"),
        F.greatest(F.lit(0.0), share - F.floor(share + TINY)).alias("p"), F.xxhash64(F.lit(seed), "id", "hash").alias("order"))
    open_ = (F.col("p") > TINY) & (F.col("p") < 1 - TINY)
    rows = stored(rows, "mix-0")
    done, level = [rows.where(~open_)], 0
    rows = rows.where(open_)
    while True:
        counts = rows.groupBy("source").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).withColumnRenamed("source", "name")
        dealt = rows.join(counts, F.col("source").eqNullSafe(F.col("name"))).drop("name") \
            .withColumn("block", F.pmod("order", "blocks"))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        level += 1
        rows = stored(dealt.groupBy("source", "block").applyInArrow(_block(seed, level), schema), f"mix-{level}")
        done.append(rows.where(~open_))
        rows = rows.where(open_)
        if rows.isEmpty():
            break
    taken = done[0]
    for more in done[1:]:
        taken = taken.unionByName(more)
    copies = (F.col("whole") + F.round("p").cast("long")).cast("long")
    return taken.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                        copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), F.col("hash").alias("text_hash"))
