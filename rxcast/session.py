"""Session construction and cluster-level settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every rxcast job relies on. ANSI stays on (Spark 4 default); the
# operators use try_* functions wherever pandas would have produced NaN/inf.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only what Spark has measured to be small; the static
    # dimensions are broadcast explicitly because their size is fixed.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rxcast", extra: dict | None = None) -> SparkSession:
    """Local/test session builder. On a cluster, pass ``master=None`` and let
    spark-submit supply master, memory and partition counts."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            b = b.config("spark.driver.memory", os.environ.get("RXCAST_DRIVER_MEMORY", "12g"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if master and master.startswith("local"):
        checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is respected as is;
    without it there is an error, as executors can't see a folder of the
    driver's. Only a local master gets a scratch folder.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not cur:
        master = sc.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cur = tempfile.mkdtemp(prefix="rxcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(cur)
    return sc.getCheckpointDir() or cur


# Written intermediates that ``release`` deletes, by the frame that reads them.
_TABLES: dict[int, tuple[DataFrame, str]] = {}


def release(df: DataFrame) -> None:
    """Give back what ``materialize`` keeps for ``df``: its table or its cache."""
    _, path = _TABLES.pop(id(df), (None, None))
    if path is not None:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    elif df.storageLevel.useMemory or df.storageLevel.useDisk:
        df.unpersist()


def materialize(df: DataFrame, name: str = "shared") -> DataFrame:
    """Compute a shared intermediate once, now (a lazy persist would let AQE
    start every branch at once, each missing the empty cache).

    ``rxcast.materialize``: ``table`` writes it as Parquet under the shared
    ``spark.checkpoint.dir`` and reads it back. That cuts the lineage, so a
    lost executor costs a re-read instead of a recompute of the joins.
    ``persist`` keeps it in executor memory/disk (lost blocks are recomputed
    from lineage). ``auto`` (default) picks ``table`` when the cluster
    names a checkpoint folder in its configuration, else ``persist``."""
    spark = df.sparkSession
    mode = spark.conf.get("rxcast.materialize", "auto").lower()
    if mode == "auto":
        mode = "table" if spark.sparkContext.getConf().get("spark.checkpoint.dir", None) else "persist"
    if mode == "table":
        path = f"{checkpoint_dir(spark).rstrip('/')}/rxcast-tables/{name}-{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(path)
        table = spark.read.parquet(path)
        _TABLES[id(table)] = (table, path)
        return table
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.write.format("noop").mode("overwrite").save()
    return df
