"""Small helpers shared by the operators: tables that cut lineage, words,
connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcast.session import checkpoint_dir

#: A word is a run of characters outside these six (space and \t..\r).
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares."""
    return f"{checkpoint_dir(spark).rstrip('/')}/rxcast-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: what
    follows survives the loss of the executors that computed it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Arrow batches of few rows for what runs inside: rows with whole texts
    or their ids are long, and a batch of the usual size takes tens of
    megabytes on both sides of a Python worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def partitions_for(rows: int, per_partition: int, spark: SparkSession) -> int:
    """Partitions that follow the row count, at least the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_partition))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges``: (node, root), root being
    the smallest node of the component. Alternating large-star and small-star
    rounds, a written table per round; every step is an aggregate or a join on
    the node, so a node of any degree is no group in one task. Nodes without
    an edge don't appear; nulls and self-loops are ignored."""
    e = stored(edges.where(F.col(a) != F.col(b))
               .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc")

    def star(e: DataFrame, both: bool) -> DataFrame:
        arcs = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else e
        low = arcs.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
        low = low.select("c", F.least("c", "m").alias("m"))
        joined = arcs.join(low, F.col("u") == F.col("c"))
        if both:  # large star: larger neighbours hang on the smallest
            out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:  # small star: the node itself and its smaller neighbours do
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")) \
                .union(low.select(F.col("c").alias("u"), F.col("m").alias("v")))
        return out.where(F.col("u") != F.col("v")).distinct()

    def mark(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    seen = mark(e)
    while True:
        e = stored(star(star(e, True), False), "cc")
        now = mark(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


#: Rows up to which a set of row keys is broadcast: a long or two each.
BROADCAST_ROWS = 2_000_000


def match_rows(docs: DataFrame, judged: DataFrame, how: str, *values: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Join ``docs`` with judged rows on the id (nulls match) and the hash of
    the text; ``values`` come along in an inner join. The judged keys are
    broadcast after a look at their number, beyond ``BROADCAST_ROWS`` both
    sides are shuffled."""
    keys = judged.select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__key"), *values)
    if how != "inner":
        keys = keys.distinct()
    few = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    same = docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__key"))
    return docs.join(F.broadcast(keys) if few else keys.hint("merge"), same, how).select(*docs.columns, *values)
