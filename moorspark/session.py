"""Session settings and the shared scratch location."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # call sites of every column expression cost more driver time than planning itself
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

#: Settings of the series queries: many small shuffle partitions, which adaptive execution puts together up to 4 MB, and
#: small splits of files, so that what a task sorts and aggregates does not grow with the input (up to some 4 GB in one shuffle).
GROWING = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.files.maxPartitionBytes": "4m",
}

#: Shuffle files go with the query that made them, instead of when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Folders that :func:`scratch_path` has named, oldest first.
_made: list[str] = []


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra) -> SparkSession:
    """A session with the engine's settings; on a cluster leave ``master`` to spark-submit."""
    b = SparkSession.builder.appName("moorspark")
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **extra}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def configure(spark: SparkSession, growing: bool = False) -> SparkSession:
    """Apply the settings that can change at run time to a session made elsewhere; ``growing`` adds those of ``GROWING``, else they are taken back."""
    for k, v in {**SETTINGS, **(GROWING if growing else {})}.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    for k, v in ({} if growing else GROWING).items():
        if spark.conf.get(k, None) == v:
            spark.conf.unset(k)
    return spark


def scratch_path(spark: SparkSession, name: str, suffix: str = "") -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder; a cluster has to name a shared one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}{suffix}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch tables this process has made; frames that read them are of no use afterwards."""
    for path in _made[since:]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    del _made[since:]


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Scratch tables made inside the block are deleted at its end, also after a failure: write or collect results before."""
    since = len(_made)
    try:
        yield
    finally:
        clear_scratch(spark, since)


def materialize(df, name: str):
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage, survives executor loss.

    The shuffles behind the written table are deleted, since nothing reads them again.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
