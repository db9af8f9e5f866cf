"""Typed columnar sinks of the processing stages."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moorspark.session import materialize

#: Folders of a stage: series are dealt to them by the hash of their keys.
BUCKET, BUCKETS = "series_bucket", 64

#: Variables stored as 32-bit floats and as small integers.
FLOAT_VARS = ("eastward_velocity", "northward_velocity", "upward_velocity", "temperature", "salinity", "pressure", "pressure_std", "depth",
              "bt_velocity")
SMALL_VARS = ("correlation_magnitude", "echo_intensity", "status", "percent_good", "bt_correlation", "bt_amplitude", "bt_percent_good")


def typed(df: DataFrame) -> DataFrame:
    """Listed variables to 32-bit floats, listed status variables to small integers."""
    d = df.withColumns({c: F.col(c).cast("float") for c in FLOAT_VARS if c in df.columns})
    return d.withColumns({c: F.col(c).cast("smallint") for c in SMALL_VARS if c in df.columns})


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _write_buckets(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Write series by buckets of their keys; series that the path has already are replaced, all others stay.

    Only the touched buckets are written again. Rows are range-partitioned by bucket and ``order``, so a long record is written
    by several tasks, each sorted, and files grow with the rows and not with the series.
    """
    spark = df.sparkSession
    d = df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(BUCKETS)).cast("int"))
    if _exists(spark, path):
        d = materialize(d, "replacing")
        touched = [r[0] for r in d.select(BUCKET).distinct().collect()]  # BUCKETS at most
        old, new = spark.read.parquet(path).where(F.col(BUCKET).isin(touched)).alias("old"), d.select(*keys).distinct().alias("new")
        same = reduce(operator.and_, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])
        d = d.unionByName(old.join(new, same, "left_anti"), allowMissingColumns=True)
    d = d.repartitionByRange(BUCKET, *order).sortWithinPartitions(BUCKET, *order)
    d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(BUCKET).parquet(path)


def write_stage(df: DataFrame, path: str, mode: str = "skip", partition: Sequence[str] = ("mooring", "serial"), time: str = "time") -> None:
    """Write a stage's records, in buckets of the series that ``partition`` names.

    ``skip`` leaves an existing output alone, ``replace`` overwrites the series of the data and keeps the others.
    """
    if mode not in ("skip", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "skip" and _exists(df.sparkSession, path):
        return
    d = typed(df)
    _write_buckets(d, path, partition, [c for c in (*partition, time) if c in d.columns])


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The records of a stage."""
    return spark.read.parquet(path).drop(BUCKET)


def write_products(df: DataFrame, path: str, id_column: str = "id", text_columns: Sequence[str] = (), folders: bool = True) -> None:
    """Write each product into the folder of its id; a missing id raises, null text attributes become empty.

    Without ``folders``, for many products, those of one bucket of ids share files, sorted by id. Either way products
    that the path has already are replaced and all others stay.
    """
    pid: Column = F.col(id_column)
    pid = F.when(pid.isNull() | (F.trim(pid) == ""), F.raise_error(F.lit("product without id"))).otherwise(pid)
    d = df.withColumn(id_column, pid)
    d = d.withColumns({c: F.coalesce(c, F.lit("")) for c in text_columns})
    if folders:
        d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(id_column).parquet(path)
    else:
        _write_buckets(d, path, [id_column], [id_column])
