"""Row positions and prefix sums inside ordered groups, without putting a
whole group into one task.

A ``Window.partitionBy(hcp).orderBy(date)`` sends every row of an HCP to one
task; AQE cannot split window partitions, and a single key (for example the
``Unknown`` prescriber) may hold a third of all claims. Instead:

1. every row gets a *piece*: a non-null key that follows the order (calendar
   months, cut again at sampled split points where they are too large), so
   each group is cut into bounded pieces;
2. a local ``row_number`` / running sum runs per ``(group, bucket)``;
3. per-``(group, bucket)`` totals (a small aggregated table) are turned into
   offsets with a window over buckets of the same group;
4. position = offset + local number. The join on ``(group, bucket)`` reuses
   the partitioning of step 2, so the rows are shuffled once.

Row-count frames (``rolling(n)`` over rows) run inside the pieces; a piece
also gets the last rows of those before it (``rolling_windows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NULL_BUCKET = 2 ** 31 - 1  # null order keys sort last
EXACT = "decimal(38,6)"
#: Rows of a piece, and sampled rows per piece that place its ends.
TARGET_ROWS, PER_PIECE = 1_000_000, 64


def day_bucket(ts_col: str, days: int = 1, origin: int = 0) -> Column:
    """Order-preserving bucket of ``days`` calendar days for a timestamp/date
    column; null -> last."""
    d = F.unix_date(F.to_date(F.col(ts_col)))
    b = F.floor((d - F.lit(origin)) / F.lit(days)) if days > 1 else d
    return F.coalesce(b, F.lit(NULL_BUCKET)).cast("int")


def _every_nth(sample: Column) -> Column:
    """Split points: every ``PER_PIECE``-th element of a sorted sample."""
    return F.filter(F.sort_array(sample), lambda x, i: (i > 0) & (i % PER_PIECE == 0))


def split_buckets(df: DataFrame, group: list[str], ts_col: str, tie_col: str, days: int | None = 32,
                  target: int | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """Add ``_piece``: non-decreasing along (``ts_col``, ``tie_col``), nulls
    last, inside each group, with about ``target`` rows at most.

    A group is cut into pieces of ``days`` calendar days (None: it is one
    piece, so that only groups above the target are cut). A piece above the
    target is cut again at split points over the whole order, not the day
    only: they come from a sample of its rows, chosen by a hash of the order
    key, so every run and layout cuts at the same places. Rows without a date
    are a piece like any other; only rows with one and the same order key stay
    together. With ``days=None``, ``sizes`` (group, _n: rows per group, if they
    are known) saves the count."""
    target = target or TARGET_ROWS
    at = F.concat(F.coalesce(F.date_format(ts_col, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("~")),
                  F.coalesce(F.col(tie_col).cast("string"), F.lit("\U0010ffff")))
    b = df.withColumn("_bkt0", (F.lit(0) if days is None else day_bucket(ts_col, days)).cast("long"))
    keys = [*group, "_bkt0"]
    counts = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if sizes is None or days is not None \
        else sizes.withColumn("_bkt0", F.lit(0).cast("long"))
    big = counts.where(F.col("_n") > target) \
        .select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)], "_n")
    same = None
    for i, k in enumerate(keys):
        eq = F.col(k).eqNullSafe(F.col(f"_s{i}"))
        same = eq if same is None else same & eq
    rate = F.greatest(F.lit(1), F.floor(F.lit(target) / PER_PIECE))
    splits = b.select(*keys, at.alias("_at")).join(big, same).where(F.pmod(F.xxhash64("_at"), rate) == 0) \
        .groupBy(*[f"_s{i}" for i in range(len(keys))]).agg(_every_nth(F.collect_list("_at")).alias("_cuts"))
    below = F.size(F.filter("_cuts", lambda c: c <= at))
    joined = b.join(splits, same, "left").withColumn("_piece", F.col("_bkt0") * (1 << 24) + F.when(F.col("_cuts").isNull(), 0).otherwise(below))
    return joined.select(*df.columns, "_piece")


def value_pieces(df: DataFrame, col: str, target: int | None = None) -> DataFrame:
    """Add ``_piece``: order-preserving pieces of a numeric column with about
    ``target`` rows, cut at a hash-chosen sample's quantiles; their number
    follows the rows."""
    target = target or TARGET_ROWS
    rate = max(1, target // PER_PIECE)
    cuts = df.where(F.pmod(F.xxhash64(col), F.lit(rate)) == 0).agg(_every_nth(F.collect_list(col)).alias("_cuts"))
    joined = df.join(F.broadcast(cuts), how="inner", on=F.lit(True))  # one row: an element per ``target`` rows
    return joined.withColumn("_piece", F.size(F.filter("_cuts", lambda c: c <= F.col(col)))).select(*df.columns, "_piece")


def non_null_keys(df: DataFrame, group: list[str]) -> tuple[DataFrame, list[str], Column | None]:
    """Group keys that may be null are replaced by (value-or-sentinel, is-null)
    pairs, so joins and lag keys never see a null; the returned condition
    marks rows whose original key had a null (pandas leaves those rows out
    of groupby-transforms, so their results are set to null afterwards)."""
    nullable = [f for f in df.schema.fields if f.name in group and f.nullable]
    if not nullable:
        return df, group, None
    keys, cols, flags = [], {}, []
    for g in group:
        f = df.schema[g]
        if not f.nullable:
            keys.append(g)
            continue
        sentinel = F.lit("" if f.dataType.typeName() == "string" else 0).cast(f.dataType)
        cols[f"_gk_{g}"] = F.coalesce(F.col(g), sentinel)
        cols[f"_gn_{g}"] = F.col(g).isNull()
        keys += [f"_gk_{g}", f"_gn_{g}"]
        flags.append(F.col(f"_gn_{g}"))
    cond = flags[0]
    for c in flags[1:]:
        cond = cond | c
    return df.withColumns(cols), keys, cond


def positions(df: DataFrame, group: list[str], order: list[Column], bucket: Column,
              measures: dict[str, Column] | None = None, pos_col: str = "_pos",
              prefix: str = "_cum_", _keys_checked: bool = False) -> DataFrame:
    """Add ``pos_col`` (0-based position of the row inside ``group`` in
    ``order``) and, per measure, its inclusive running sum ``prefix+name``.

    ``bucket`` must be non-decreasing along ``order`` inside each group.
    The per-bucket totals are a map-side-combined aggregate of the input
    rows, so the window runs once and its hash partitioning on
    ``(group, bucket)`` also serves the join with the offsets.
    """
    measures = measures or {}
    df, keys, null_key = (df, group, None) if _keys_checked else non_null_keys(df, group)
    if null_key is not None:
        out = positions(df, keys, order, bucket, measures, pos_col, prefix, True)
        nulled = {pos_col: F.when(~null_key, F.col(pos_col)),
                  **{prefix + m: F.when(~null_key, F.col(prefix + m)) for m in measures}}
        return out.withColumns(nulled).drop(*[k for k in keys if k not in group])
    b = df.withColumn("_bkt", bucket)
    w_local = Window.partitionBy(*group, "_bkt").orderBy(*order)
    run = w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = b.withColumn("_lrn", F.row_number().over(w_local))
    local = local.withColumns({f"_lc_{m}": F.sum(c).over(run) for m, c in measures.items()})

    # Totals per (group, bucket) -> exclusive offsets in bucket order.
    tot = b.groupBy(*group, "_bkt").agg(
        F.count(F.lit(1)).alias("_bn"), *[F.sum(c).alias(f"_bs_{m}") for m, c in measures.items()])
    w_off = Window.partitionBy(*group).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*group, "_bkt",
                     F.coalesce(F.sum("_bn").over(w_off), F.lit(0)).alias("_off_n"),
                     *[F.sum(f"_bs_{m}").over(w_off).alias(f"_off_{m}") for m in measures])

    j = local.join(off, on=[*group, "_bkt"], how="inner")
    out = j.withColumn(pos_col, (F.col("_off_n") + F.col("_lrn") - 1).cast("long"))
    for m in measures:
        out = out.withColumn(prefix + m, F.coalesce(F.col(f"_off_{m}"), F.lit(0)) + F.col(f"_lc_{m}"))
    drop = ["_bkt", "_lrn", "_off_n", *[f"_lc_{m}" for m in measures], *[f"_off_{m}" for m in measures]]
    return out.drop(*drop)


def rolling_windows(df: DataFrame, outer: list[str], inner: list[str], order: list[str], value: str, windows: list[int],
                    pos_col: str | None = None, cut: bool = True) -> DataFrame:
    """pandas ``groupby(outer + inner)[value].rolling(n, min_periods=1)`` over
    rows: the columns of ``df`` less ``_piece`` with ``rolling_sum_{n}`` and
    ``rolling_avg_{n}`` for each n (sum and mean of the non-null values among
    the last n rows; null if there are none, or if an ``inner`` key is null)
    and, as ``pos_col``, the row's 0-based position inside ``outer``.

    ``_piece`` doesn't decrease along ``order`` (column names, nulls last)
    inside ``outer``. Ordinary row frames run inside a piece; a piece that has
    a predecessor also gets the last rows of the pieces before it, as many as
    the largest window looks back, which count as rows before its own and are
    dropped again. Only groups of more than one piece have such rows. So the
    rows are shuffled once and none is emitted twice; the position takes one
    sort, all frames share another. Sums are exact decimals. ``cut=False`` says that every group is one
    piece, so nothing is counted or carried over."""
    df, keys, null_key = non_null_keys(df, inner)
    back = max(windows) - 1
    ascending = [F.col(c).asc_nulls_last() for c in order]
    if not cut:
        rows, offsets = df.withColumns({"_before": F.lit(False), "_off": F.lit(0).cast("long")}), None
    else:
        rows, offsets = _with_rows_before(df, outer, keys, order, ascending, value, back)

    # a hash leads the sorts, so that rows of different groups compare as numbers; where no row is carried over, the
    # position is the order
    rows = rows.withColumn("_hash", F.xxhash64(*outer))
    in_piece = Window.partitionBy("_hash", *outer, "_piece").orderBy(*ascending)
    in_group = Window.partitionBy("_hash", *outer, "_piece", *keys).orderBy(*(ascending if cut else ["_row"]))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = F.col(value)
    local = rows.withColumn("_row", F.sum(F.when(F.col("_before"), 0).otherwise(1)).over(upto(in_piece)))
    local = local.withColumns({"_s": F.sum(F.coalesce(v.cast(EXACT), F.lit(0).cast(EXACT))).over(upto(in_group)), "_k": F.count(v).over(upto(in_group))})
    lags = {f"{c}{n}": F.lag(c, n).over(in_group) for n in windows for c in ("_s", "_k")}
    out = local.withColumns(lags).where(~F.col("_before"))
    if offsets is not None:
        out = out.join(offsets, [*outer, "_piece"])
    cols = {} if pos_col is None else {pos_col: (F.col("_off") + F.col("_row") - 1).cast("long")}
    for n in windows:
        s = (F.col("_s") - F.coalesce(F.col(f"_s{n}"), F.lit(0).cast(EXACT))).cast("double")
        k = F.col("_k") - F.coalesce(F.col(f"_k{n}"), F.lit(0))
        known = (k > 0) if null_key is None else (k > 0) & ~null_key
        cols[f"rolling_sum_{n}"], cols[f"rolling_avg_{n}"] = F.when(known, s), F.when(known, s / k)
    return out.withColumns(cols).drop("_piece", "_before", "_hash", "_row", "_off", "_s", "_k", *lags, *[k for k in keys if k not in inner])


def _with_rows_before(df: DataFrame, outer: list[str], keys: list[str], order: list[str], ascending: list[Column], value: str,
                      back: int) -> tuple[DataFrame, DataFrame]:
    """The rows with those that each piece carries over, and each piece's offset."""
    totals = df.groupBy(*outer, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*outer).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*outer, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rows = df.withColumn("_before", F.lit(False)).unionByName(
        _rows_before(df, outer, keys, order, ascending, value, back, totals).withColumn("_before", F.lit(True)), allowMissingColumns=True)
    return rows, offsets


def _rows_before(df: DataFrame, outer: list[str], keys: list[str], order: list[str], ascending: list[Column], value: str, back: int,
                 totals: DataFrame) -> DataFrame:
    """(outer, keys, _piece, order, value): for each group and piece, the last
    ``back`` rows of the group's pieces before. Every piece of a group has a
    row at least, so they lie in the ``back`` pieces before, whose last rows
    are all that meets here."""
    split = totals.groupBy(*outer).agg(F.count(F.lit(1)).alias("_pieces")).where(F.col("_pieces") > 1).drop("_pieces")
    cut = df.join(split, outer, "left_semi")
    in_group = Window.partitionBy(*outer, "_piece", *keys)
    descending = [F.col(c).desc_nulls_first() for c in order]
    last = cut.withColumn("_r", F.row_number().over(in_group.orderBy(*descending))).where(F.col("_r") <= back)
    carried = list(dict.fromkeys([*order, value]))
    tails = last.groupBy(*outer, *keys, "_piece").agg(F.sort_array(F.collect_list(F.struct((-F.col("_r")).alias("_r"), *carried))).alias("_tail"))
    # all pieces of the group, also those of which no row is in the tail's range
    earlier = Window.partitionBy(*outer, *keys).orderBy("_piece").rowsBetween(-max(back, 1), -1)
    ahead = tails.select(*outer, *keys, "_piece", F.flatten(F.collect_list("_tail").over(earlier)).alias("_t"))
    part = F.slice("_t", F.greatest(F.size("_t") - back + 1, F.lit(1)), back) if back else F.slice("_t", 1, 0)
    return ahead.select(*outer, *keys, "_piece", F.inline(part)).drop("_r")


def rolling_rows(df: DataFrame, group: list[str], order: list[str], bucket: Column, value: str, windows: list[int]) -> DataFrame:
    """``rolling_windows`` of one group, by a ``bucket`` that doesn't decrease
    along ``order``; rows of a null group get null results."""
    df, keys, null_key = non_null_keys(df, group)
    out = rolling_windows(df.withColumn("_piece", bucket), keys, [], order, value, windows)
    if null_key is not None:
        out = out.withColumns({c: F.when(~null_key, F.col(c)) for n in windows for c in (f"rolling_sum_{n}", f"rolling_avg_{n}")})
    return out.drop(*[k for k in keys if k not in group])
