"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger
is a Parquet table with a row for each pair of a blob and a rule's version that
has been scanned, findings or none. A run

1. addresses the versions and keeps one text per blob,
2. takes the rules out that the ledger holds for a blob, in their present
   version; blobs with none left are not scanned,
3. scans what is left and appends it to the ledger,
4. joins the ledger's findings back to every path and version of the blob.

So a second run over a grown history reads only new blobs, and a rule whose
version is raised is run over all blobs again, the others not.

Rows are appended by one Parquet write, whose files appear when the job
commits; a run that dies leaves the ledger as it was, and pairs that two runs
scan at the same time are one row's worth of findings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxcast.llm.bpe import chunks
from rxcast.llm.tables import stored


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost matches that don't overlap are findings, if
    ``group`` has at least ``least`` characters. Raise ``version`` with any
    change. ASCII letters alone differ in case under ``any_case``."""

    name: str
    pattern: str
    version: int = 1
    any_case: bool = False
    group: int = 0
    least: int = 0

    def find(self, text: str) -> list[tuple[int, int]]:
        flags = re.ASCII | (re.IGNORECASE if self.any_case else 0)
        return [m.span() for m in re.finditer(self.pattern, text, flags) if m.end(self.group) - m.start(self.group) >= self.least]


# The patterns and lengths of the first three rules are given.
# A run of hex digits, or one that follows AKIA, has the least length or none
# of its parts has, so that the length stands in the pattern.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", any_case=True, group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
LEDGER = "blob binary, rule string, version int, spans array<struct<start:int,end:int>>"
CHUNK_BYTES = 2 << 20
#: A blob with more versions than this, and than a ten-thousandth of all, is joined in salted parts.
HOT_ROWS, HOT_BLOBS = 1_000, 10_000


def blob_of(text: Column) -> Column:
    """Content address: SHA-256 of the UTF-8 bytes, a null text as an empty one."""
    return F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256))


def unseen(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, text, todo): blobs with a rule that the ledger lacks in its
    present version, and the places of these rules."""
    now = rules_table(ledger, rules)
    held = now.groupBy("blob").agg(F.collect_set("place").alias("held"))
    todo = F.array_except(F.sequence(F.lit(0), F.lit(len(rules) - 1)), F.coalesce("held", F.array().cast("array<int>")))
    return blobs.join(held, "blob", "left").select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)


def rules_table(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The ledger's rows of the rules in their present versions, with the
    rule's place; a pair that was written twice is one row."""
    place = F.lit(None).cast("int")
    for i, r in enumerate(rules):
        place = F.when((F.col("rule") == r.name) & (F.col("version") == r.version), i).otherwise(place)
    return ledger.withColumn("place", place).where(F.col("place").isNotNull()).dropDuplicates(["blob", "place"])


def scanned(todo: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of the blobs' open rules, over whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0), np.int64) + 1
            for a, b in chunks(size, CHUNK_BYTES):
                rows: list[tuple] = []
                for blob, text, open_ in zip(*(batch.column(c).slice(a, b - a).to_pylist() for c in ("blob", "text", "todo")), strict=True):
                    rows += [(blob, rules[i].name, rules[i].version, [{"start": s, "end": e} for s, e in rules[i].find(text or "")]) for i in open_]
                blob, rule, version, spans = zip(*rows, strict=True)
                span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blob, pa.binary()), pa.array(rule, pa.string()), pa.array(version, pa.int32()), pa.array(spans, pa.list_(span))],
                    names=["blob", "rule", "version", "spans"])

    return todo.mapInArrow(run, LEDGER)


def scan_versions(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
                  keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row of ``versions`` (a version of a path),
    the blob that it holds and all findings (array of start, place of the
    rule, end, rule, by start and place; code points, end exclusive).
    ``ledger`` is the path of the ledger, made when absent.

    A null text counts as empty. Rows are versions whatever their ids: null
    ids and repeated rows come out as often as they came in, and equal texts
    are one blob. Other columns of ``versions`` are ignored, whatever their
    names; an empty table gives an empty result."""
    spark = versions.sparkSession
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(ledger)
    book = spark.read.schema(LEDGER).parquet(ledger)
    texts = versions.select(blob_of(versions[text_col]).alias("blob"), versions[text_col].alias("text")).dropDuplicates(["blob"])
    scanned(unseen(texts, book, rules), rules).write.mode("append").parquet(ledger)

    names = [f"__{i}" for i in range(len(keep))]  # whatever the columns are called
    paths = stored(versions.select(blob_of(versions[text_col]).alias("__blob"), *[versions[c].alias(n) for c, n in zip(keep, names, strict=True)]), "blobs")
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("place"), s["end"].alias("end"), F.col("rule")))
    found = rules_table(spark.read.schema(LEDGER).parquet(ledger), rules).where(F.size("spans") > 0) \
        .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(spans))).alias("findings"))
    joined = salted(paths, found)
    none = F.array().cast(found.schema["findings"].dataType)
    return joined.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], F.col("__blob").alias("blob"), F.coalesce("findings", none).alias("findings"))


def salted(paths: DataFrame, found: DataFrame) -> DataFrame:
    """Left join of versions with their blob's findings. A blob of very many
    versions is dealt out over salts, one for each ``least`` rows; as it has
    more than a ten-thousandth of the rows, the table of such blobs has at most
    ``HOT_BLOBS`` rows and is broadcast."""
    least = max(HOT_ROWS, paths.count() // HOT_BLOBS)
    hot = paths.groupBy("__blob").count().where(F.col("count") > least) \
        .select("__blob", F.ceil(F.col("count") / least).cast("long").alias("__parts"))
    left = paths.select("*", F.monotonically_increasing_id().alias("__row")).join(F.broadcast(hot), "__blob", "left") \
        .select(*paths.columns, F.coalesce(F.pmod("__row", "__parts"), F.lit(0)).alias("__salt"))
    right = found.withColumnRenamed("blob", "__blob").join(F.broadcast(hot), "__blob", "left") \
        .select("__blob", "findings", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__parts", F.lit(1)) - 1)).alias("__salt"))
    return left.join(right, ["__blob", "__salt"], "left")
