"""Positions of rows in a global order without a task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorspark.session import materialize

#: bits that ``monotonically_increasing_id`` leaves for a row's place in its partition
_LOW = 33


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with the 0-based position of each row in ``order`` (a stored table).

    Ranges of the order are sorted apart and stored with each row's place in its range; the sizes of the ranges, one
    number per partition, give the offsets. Rows equal in the whole order take any of their positions.
    """
    at = F.monotonically_increasing_id()
    parts = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", at), "ranges")
    parts = parts.withColumn("__range", F.shiftright("__at", _LOW)).withColumn("__at", F.col("__at").bitwiseAND((1 << _LOW) - 1))
    base, rows = 0, []
    for r in sorted(parts.groupBy("__range").agg(F.count("*").alias("n")).collect()):
        rows.append((r["__range"], base))
        base += r["n"]
    offsets = df.sparkSession.createDataFrame(rows, "__range long, __base long")
    # one row per partition of the sort
    return parts.join(F.broadcast(offsets), "__range").select(*df.columns, (F.col("__base") + F.col("__at")).alias(name))
