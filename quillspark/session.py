"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app: str = "quillspark", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster the submitter owns the session; operators only
    read settings from it."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = os.environ.get("QUILL_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder for iterative jobs.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir) when the cluster names one. Only in a local
    session without one do we pick a folder under the warehouse directory and register it; on a cluster that folder
    may be a machine's own, so there it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        wh = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
        conf_dir = wh.rstrip("/") + "/_quill_checkpoints"
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


#: Bytes of an Arrow batch that the JVM sends to a Python worker, where the session names no size.
BATCH_BYTES = "1m"


def small_batches(spark: SparkSession) -> None:
    """Batches for Python workers hold about ``BATCH_BYTES`` from here on (a longer row is a batch of its own).

    Spark's own limits take a whole input split as one batch, which then stands several times beside the heap: in the
    Arrow vectors, in the stream's direct buffer and in the worker. A size that the session names stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


def sweep(spark: SparkSession) -> None:
    """Have the shuffle files deleted that no plan refers to any more. Spark deletes them when the driver's JVM happens to
    collect its garbage, which a driver with little to do may not do before the job is over: until then the files of all
    former steps stay on the executors' disks."""
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df, replaces=None):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Survives executor loss like a reliable checkpoint, and the re-read relation starts a fresh plan: a
    checkpointed plan keeps its origin constraints, and iterative jobs would grow them round over round.
    ``replaces``: a table of an earlier call that only ``df`` still read; it is deleted afterwards.
    """
    import uuid
    spark = df.sparkSession
    path = checkpoint_dir(spark).rstrip("/") + f"/quill_tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    if replaces is not None:
        drop_table(replaces)
    return spark.read.parquet(path)


def drop_table(df) -> None:
    """Delete the table behind a result of ``cut_lineage`` that nothing reads any more."""
    for f in df.inputFiles()[:1]:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f).getParent()
        if "/quill_tables/" in path.toString():
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
