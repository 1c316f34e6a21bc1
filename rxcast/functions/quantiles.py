"""Exact quantiles (linear interpolation) of several columns and groups.

One way for every size: an approximate summary of fixed size per column and
group gives a bracket around each wanted rank that is sure to hold it (the
summary's rank error is bounded, the bracket is twice as wide). The brackets
come back to the rows as arrays, a fixed number of values a row: conditional
aggregates count what lies below a bracket and keep the nearest values outside,
and only values inside a bracket, two of ten thousand rows a rank and the ties
of these values, leave their row, counted per distinct value before they are
shuffled. Ranks then follow from a running count over the values inside.
Nothing depends on the input's size or on a setting.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Summary accuracy: ranks are off by at most 1 / ACCURACY of the rows. Every task sends
#: its summary (about as many values as this, per column) to one that merges them.
ACCURACY = 20_000


def _with_group(df: DataFrame, per_group: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The columns of a row per group beside the rows; null groups match."""
    if not by:
        return df.join(F.broadcast(per_group))  # one row
    other = per_group.select(*[F.col(k).alias(f"_s_{k}") for k in by], *[c for c in per_group.columns if c not in by])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in by])
    return df.join(other, same, "left").drop(*[f"_s_{k}" for k in by])


def exact_quantiles(df: DataFrame, columns: dict[str, Column], qs: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """``by`` columns and one array of quantiles per name of ``columns``; null
    where a column has no value. Nulls and NaN don't count. Without ``by``
    there is always one row; null groups are a group."""
    value = {j: F.col(f"_v{j}") for j in range(len(columns))}
    rows = df.select(*by, *[F.when(~F.isnan(c.cast("double")), c.cast("double")).alias(f"_v{j}") for j, c in enumerate(columns.values())])
    width = 2 / ACCURACY
    grid = [p for q in qs for p in (max(0.0, q - width), min(1.0, q + width))]
    summary = rows.groupBy(*by).agg(*[a for j, v in value.items() for a in (F.count(v).alias(f"_n{j}"), F.percentile_approx(v, grid, ACCURACY).alias(f"_p{j}"))])
    placed = _with_group(rows, summary, by)

    cells = [(j, i, value[j], F.col(f"_p{j}")[2 * i], F.col(f"_p{j}")[2 * i + 1]) for j in value for i in range(len(qs))]
    outside = placed.groupBy(*by).agg(*[a for j, i, v, low, high in cells for a in (
        F.count_if(v < low).alias(f"_b{j}_{i}"), F.max(F.when(v < low, v)).alias(f"_m{j}_{i}"), F.min(F.when(v > high, v)).alias(f"_x{j}_{i}"))])
    wanted = _with_group(outside, summary.select(*by, *[f"_n{j}" for j in value]), by).select(*by, F.inline(F.array(*[
        F.struct(F.lit(j).alias("_j"), F.lit(i).alias("_i"), F.col(f"_n{j}").alias("_n"), (F.lit(float(qs[i])) * (F.col(f"_n{j}") - 1)).alias("_pos"), F.col(f"_b{j}_{i}").alias("_below"),
                 F.col(f"_m{j}_{i}").alias("_most"), F.col(f"_x{j}_{i}").alias("_least")) for j, i, *_ in cells]))).where("_n > 0")
    hits = F.array(*[F.when((v >= low) & (v <= high), F.struct(F.lit(j).alias("_j"), F.lit(i).alias("_i"), v.alias("_v"))) for j, i, v, low, high in cells])
    keys = [*by, "_j", "_i"]
    inside = placed.select(*by, F.inline(F.filter(hits, lambda h: h.isNotNull()))).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_k"))
    upto = F.sum("_k").over(Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = inside.withColumn("_to", upto).select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_v", "_to", (F.col("_to") - F.col("_k")).alias("_from"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys])
    joined = wanted.join(ranked, same, "left")

    def at(rank: Column) -> Column:
        """The value of a 0-based rank: below the bracket only its last is known, above only the first."""
        here = rank - F.col("_below")
        return F.coalesce(F.max(F.when((F.col("_from") <= here) & (here < F.col("_to")), F.col("_v"))),
                          F.max(F.when(here == -1, F.col("_most"))), F.max(F.when(here >= 0, F.col("_least"))))

    low, high = F.floor("_pos"), F.ceil("_pos")
    picked = joined.groupBy(*keys, "_pos").agg(at(low).alias("_a"), at(high).alias("_z"))
    exact = F.col("_a") + (F.col("_z") - F.col("_a")) * (F.col("_pos") - low)
    arrays = picked.groupBy(*by, "_j").agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", exact.alias("_q")))), lambda s: s["_q"]).alias("_qs"))
    return arrays.groupBy(*by).agg(*[F.max(F.when(F.col("_j") == j, F.col("_qs"))).alias(name) for j, name in enumerate(columns)])
