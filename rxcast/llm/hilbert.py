"""Sharding along a Hilbert curve (DataFrame operations only).

Four metadata dimensions are quantised to four bits each: language, source
(first hex digit of their MD5), size (bit length of the byte count) and
``doc_id`` (linear between its extremes). Documents are put in the order of
the curve through these 65,536 cells and the order is cut into runs of equal
row counts, so each shard covers a compact box of all dimensions and file
statistics can prune on any of them.

No global sort and no single-task window over rows: rows are counted per
(cell, slice of the hash of id and text), the counts become offsets (a window over at
most 65,536 cells, and one per cell over its slices), and each row's rank is
its offset plus its number inside its slice. Slices are halved as the table
grows, so a cell that holds a third of all rows is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxcast.llm.tables import stored

BITS, DIMS = 4, 4
SIDE = 1 << BITS
SLICE_ROWS = 50_000


def nibble(c: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(c.cast("string"), F.lit(""))), 1, 1), 16, 10).cast("int")


def bit_length(c: Column) -> Column:
    return F.length(F.bin(c))


def curve_index(*axes: str) -> Column:
    """Hilbert index of quantised axes (Skilling's transform): undo excess
    work per bit and axis, Gray-encode, interleave the bits."""
    n, top = len(axes), 1 << (BITS - 1)
    undo = f"""aggregate(sequence(0, {n * (BITS - 1) - 1}), array({', '.join(axes)}), (s, k) ->
        transform(s, (v, j) ->
            CASE WHEN (s[k % {n}] & shiftright({top}, k div {n})) <> 0
                 THEN IF(j = 0, v ^ (shiftright({top}, k div {n}) - 1), v)
                 WHEN k % {n} <> 0 AND (j = 0 OR j = k % {n})
                 THEN v ^ ((s[0] ^ s[k % {n}]) & (shiftright({top}, k div {n}) - 1))
                 ELSE v END))"""
    gray = "transform(x, (v, j) -> aggregate(slice(x, 1, j + 1), 0, (t, y) -> t ^ y))"
    flip = f"aggregate(sequence(1, {BITS - 1}), 0, (t, b) -> IF((x[{n - 1}] & shiftleft(1, b)) <> 0, t ^ (shiftleft(1, b) - 1), t))"
    bits = (f"aggregate(sequence(0, {n * BITS - 1}), 0L, (h, k) -> shiftleft(h, 1) | "
            f"(shiftright(x[k % {n}], {BITS - 1} - k div {n}) & 1))")
    step = lambda expr, inner: f"transform(array({inner}), x -> {expr})[0]"  # noqa: E731  names the inner value once
    flipped = f"transform(x, v -> v ^ ({flip}))"
    return F.expr(step(bits, step(flipped, step(gray, undo))))


def hilbert_shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard, curve) per row.

    Law ``rows``: shard sizes differ by one row at most; ``slot`` numbers a
    shard's rows from 0 along the curve. Nulls count as empty values: a null
    text has size 1 and CRC 0, a null id the lowest id cell. Equal ids are
    ordered by size and CRC; fully equal rows are interchangeable and each
    keeps a slot. An empty table gives an empty result. Other columns are
    ignored."""
    ends = docs.agg(F.count("*"), F.min(id_col), F.max(id_col)).first()
    n, low, high = ends[0], ends[1] or 0, ends[2] or 0
    shift = 32 - min(32, max(0, -(-n // SLICE_ROWS) - 1).bit_length())
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = F.coalesce(F.col(id_col), F.lit(low)).cast("double")
    base = stored(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        nibble(F.col(lang_col)).alias("x0"), nibble(F.col(source_col)).alias("x1"),
        F.least(F.lit(SIDE - 1), F.floor((ident - low) / (high - low + 1.0) * SIDE)).cast("int").alias("x3"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"))
        # the text's CRC spreads rows without an id, or with one id, over slices
        .withColumn("h", F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("crc"))), 1, 8),
                                16, 10).cast("long"))
        .withColumn("x2", F.least(F.lit(SIDE - 1), bit_length(F.col("size")) - 1))
        .withColumn("cell", ((F.col("x0") * SIDE + F.col("x1")) * SIDE + F.col("x2")) * SIDE + F.col("x3"))
        .withColumn("slice", F.shiftright("h", shift)), "hilbert")

    slices = base.groupBy("cell", "x0", "x1", "x2", "x3", "slice").agg(F.count("*").alias("n"))
    up_to = Window.partitionBy("cell").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("in_cell", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
    cells = base.groupBy("cell", "x0", "x1", "x2", "x3").agg(F.count("*").alias("n")) \
        .withColumn("curve", curve_index("x0", "x1", "x2", "x3"))
    along = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)  # 65,536 rows at most
    cells = cells.select("cell", "curve", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("to_cell"))
    offsets = slices.join(cells, "cell").select(
        "cell", "slice", "curve", (F.col("to_cell") + F.col("in_cell")).alias("offset"))

    inside = Window.partitionBy("cell", "slice").orderBy("h", F.col("id").asc_nulls_first(), "size", "crc")
    ranked = base.withColumn("i", F.row_number().over(inside) - 1).join(offsets, ["cell", "slice"]) \
        .withColumn("r", F.col("offset") + F.col("i"))
    shard = F.expr(f"r * {n_shards} div {max(n, 1)}")
    return ranked.withColumn("s", shard).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("s").cast("int").alias("shard"),
        (F.col("r") - F.expr(f"(s * {n} + {n_shards - 1}) div {n_shards}")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "curve")
