"""The cleaning step (SRC1 + FLT1 + PRJ1-PRJ4) over a stream of landed
claim files: the same reader and projection applied to the files of each
micro-batch. The stream checkpoint lives under the shared
``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rxcast.operators.clean import clean_claims
from rxcast.session import checkpoint_dir
from rxcast.sources.claims import read_claims_csv


def landed_files(spark: SparkSession, input_dir: str, max_files: int = 1000) -> DataFrame:
    """The paths of landed files as a stream; their contents aren't read here."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return (spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", max_files)
            .option("pathGlobFilter", "*.csv*").load(input_dir).select("path"))


def start_ingest(spark: SparkSession, input_dir: str, output_dir: str, checkpoint: str | None = None,
                 available_now: bool = False, max_files: int = 1000) -> StreamingQuery:
    """Cleaned claims in ``output_dir`` as files land in ``input_dir``, each
    file by its own header. A micro-batch hands its new files (``max_files``
    at most) to the batch reader and replaces the folder of its batch number,
    so a batch that is run again after a failure leaves its rows once."""
    def ingest(batch: DataFrame, number: int) -> None:
        files = [r.path for r in batch.collect()]
        if files:
            clean = clean_claims(read_claims_csv(batch.sparkSession, files))
            clean.write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/batch={number}")

    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/claims-ingest"
    w = landed_files(spark, input_dir, max_files).writeStream.foreachBatch(ingest).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
