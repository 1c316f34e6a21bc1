"""Corpus pipeline: quality, line dedup, near-dedup, mixing, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes each stage's result as Parquet in the
folder that the cluster shares and hands the reread table to the next. All
stages but the last return the columns of ``documents``.

A stage finds the rows that its operator judged by id and hash of the text, so
rows without an id and rows that repeat one are judged by their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcast.llm.bpe import bpe_encode, load_vocabulary
from rxcast.llm.cube import balanced_mix
from rxcast.llm.linejoin import dedup_lines
from rxcast.llm.minmax import near_duplicates
from rxcast.llm.puquality import quality_scores
from rxcast.llm.queries import VOCABULARY, table, token_digests
from rxcast.llm.tables import match_rows, small_batches, stored, word_count

#: The classifier, the mix and the tokenizer have no SQL form; tests/llm holds brute-force versions of the stages.
ORACLE_SQL: str | None = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier doesn't reject.

    Nulls and empty texts are scored like any text. Without labels nothing is
    rejected; an empty table stays empty."""
    scores = quality_scores(docs, table(spark, sf_dir, "labels"), threshold=0.3)
    return match_rows(docs, scores.where("predicted = 0"), "left_anti")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document less the lines that repeat an earlier one; a document
    that loses all its words goes, one that never had any stays. ``n_chars``
    is counted anew."""
    done = dedup_lines(docs, percent=80, lines_col="__lines", removed_col="__removed")
    left = done.where((F.col("__removed") == 0) | (word_count(F.col("text")) > 0))
    return left.select(*[F.when(F.col("__removed") > 0, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
                         if c == "n_chars" else F.col(c) for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): the
    one with the smallest id. Rows that repeat an id and its text, and rows
    without an id that repeat a text, are one row afterwards."""
    groups = stored(near_duplicates(docs, shingle=5, percent=80), "pipeline-near")
    left = match_rows(docs, groups.where(~F.col("kept")), "left_anti")
    repeated = groups.where("kept").groupBy("doc_id", "text_hash").count().where("count > 1")
    if repeated.isEmpty():
        return left
    return match_rows(left, repeated, "left_anti").unionByName(
        match_rows(left, repeated, "left_semi").withColumn("__hash", F.xxhash64("text")).dropDuplicates(["doc_id", "__hash"]).drop("__hash"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to weights 1, 2, 3 takes it. Rows
    that repeat an id and its text share one row's columns."""
    taken = balanced_mix(docs, weights=(1, 2, 3), cap=3).groupBy("doc_id", "text_hash").agg(
        F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    taken = stored(taken, "pipeline-mix")
    if not taken.where("__rows > 1").isEmpty():
        docs = docs.withColumn("__hash", F.xxhash64("text")).dropDuplicates(["doc_id", "__hash"]).drop("__hash")
    return match_rows(docs, taken.where("__copies > 0"), "inner", "__copies") \
        .withColumn("__copy", F.explode(F.expr("array_repeat(0, int(__copies))"))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every row. The
    ids are a table of their own before they are decoded, so that an executor
    runs either the encoder's or the decoder's workers, and both run here, as
    their rows are long and go to Python in small batches."""
    v = load_vocabulary(VOCABULARY)
    with small_batches(spark):
        return stored(token_digests(stored(bpe_encode(docs, v), "pipeline-ids"), v, with_ids=True), "pipeline-tokens")


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("minhash_near_dedup", near), ("source_mix", mix),
          ("bpe_tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over the table that its predecessor left."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
