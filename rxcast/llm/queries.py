"""Registered queries of the training-data operators: each applies one
operator to its whole table and derives the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcast.llm.alignment import align_tokens
from rxcast.llm.bpe import bpe_decode, bpe_encode, load_vocabulary
from rxcast.llm.cube import balanced_mix
from rxcast.llm.hilbert import hilbert_shards
from rxcast.llm.iblt import fingerprint_edits
from rxcast.llm.linejoin import dedup_lines
from rxcast.llm.minmax import near_duplicates
from rxcast.llm.onebit import nearest
from rxcast.llm.periodic import periodic_runs
from rxcast.llm.puquality import quality_scores
from rxcast.llm.secrets import scan_versions
from rxcast.llm.tables import WORD, shared_path
from rxcast.llm.toxic import toxicity_scores
from rxcast.llm.warc import read_archives, write_archives

QUERIES: dict = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_minmax_near_dedup")
def op1_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


@query("op2_line_dedup")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(table(spark, sf_dir, "documents"), percent=80)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))


@query("op3_warc_dictionary")
def op3_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_archives(spark, write_archives(table(spark, sf_dir, "pages"), revisit_bytes=100))
    own = F.col("type") == "response"
    return records.select(
        F.col("page").alias("page_id"), F.when(own, F.octet_length("payload")).otherwise(F.col("bytes")).cast("long").alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")


@query("op4_cube_mix")
def op4_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = balanced_mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), cap=3)
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op7_iblt_fingerprints")
def op7_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprint_edits(table(spark, sf_dir, "documents"))
    return prints.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                         "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op9_hilbert_sharding")
def op9_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(table(spark, sf_dir, "documents"), 16)


@query("op5_pu_quality")
def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5, held_out=0, threshold=0.3)


@query("op8_toxic_segments")
def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=4, held_out=2, threshold=0.3)
    return scores.select("doc_id", "held_out", "score", "predicted", F.size("segments").alias("n_segments"))


def token_digests(ids: DataFrame, vocabulary: dict, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Decode encoded rows and digest ids and text."""
    digests = ids.select(*keep, F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), "ids")
    names = (*keep, "n_tokens", "ids_sha256")
    text = bpe_decode(digests, vocabulary, keep=(*names, "ids") if with_ids else names)
    return text.select(*names, F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"), *["ids"] * with_ids)


@query("op6_bpe_merge_rounds")
def op6_bpe_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = load_vocabulary(VOCABULARY)
    return token_digests(bpe_encode(table(spark, sf_dir, "documents"), v), v)


@query("op10_rotated_one_bit")
def op10_rotated_one_bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


@query("op11_merge_path_alignment")
def op11_merge_path_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), VOCABULARY, PIECES)


def with_repeats(docs: DataFrame) -> DataFrame:
    """The texts with a tenth of the documents made periodic from some word
    on, as the query's rule for the CRC of the id says; a row without an id
    stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.expr(rf"""transform(array(regexp_extract_all(text, r'{WORD}', 0)), ws -> array_join(transform(ws, (w, i) ->
        CASE WHEN i < __g % size(ws) THEN w
        ELSE ws[int(__g % size(ws) + (i - __g % size(ws)) % (1 + (size(ws) - __g % size(ws)) div (3 + __g % 8)))] END), ' '))[0]""")
    return docs.withColumn("__h", h).withColumn("__g", F.floor(F.col("__h") / 10)) \
        .select("doc_id", F.when(F.col("__h") % 10 == 0, text).otherwise(F.col("text")).alias("text"))


@query("op12_minimizer_runs")
def op12_minimizer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs(with_repeats(table(spark, sf_dir, "documents")), shortest=6, times=4)
    ahead = "l.length * r.period - r.length * l.period"  # exact order of length / period
    best = F.expr(f"""get(array_sort(runs, (l, r) -> CASE WHEN {ahead} <> 0 THEN int(-sign({ahead}))
        WHEN l.start <> r.start THEN int(sign(l.start - r.start)) ELSE int(sign(l.period - r.period)) END), 0)""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return runs.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))


@query("op13_blob_ledger_secrets")
def op13_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_versions(table(spark, sf_dir, "documents"), shared_path(spark, "secret-ledger"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ",")
    base = F.filter("findings", lambda s: s["rule"].isin("assign", "access", "hex"))
    count = lambda rule: F.size(F.filter("findings", lambda s: s["rule"] == rule)).cast("long")
    return found.select("doc_id", *[count(r).alias(f"n_{r}") for r in ("assign", "access", "hex")],
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"))
