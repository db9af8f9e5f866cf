"""Relational lookups: configuration, intervals, nearest samples, differences, lagged pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.operators.ordered import DAY_US, RECORD, TIME_CHUNK, attach, ordered, unique


def configure_samples(obs: DataFrame, instr: DataFrame, deploy: DataFrame) -> DataFrame:
    """Samples with their instrument and deployment configuration."""
    d = obs.join(unique(instr, RECORD, "instrument table"), list(RECORD))
    return d.join(deploy, "mooring")


def expected_found(instr: DataFrame, obs: DataFrame, group: str = "mooring") -> DataFrame:
    """Expected and found instruments per group with the list of missing serials."""
    found = obs.select(*RECORD).distinct().withColumn("__f", F.lit(1))
    d = instr.join(found, list(RECORD), "left")
    # serials of one mooring's configuration
    lost = F.sort_array(F.collect_list(F.when(F.col("__f").isNull(), F.col("serial"))))
    return d.groupBy(group).agg(
        F.count(F.lit(1)).alias("expected"), F.count("__f").alias("found"),
        F.array_join(F.transform(lost, lambda s: s.cast("string")), ",").alias("missing"))


def missing_instruments(instr: DataFrame, obs: DataFrame) -> DataFrame:
    return instr.join(obs.select(*RECORD).distinct(), list(RECORD), "left_anti")


def in_intervals(df: DataFrame, intervals: DataFrame, key: str, t: str = "t_us", span: int = DAY_US) -> DataFrame:
    """Samples with every closed interval ``(key, t0, t1, ...)`` that contains them.

    An interval becomes the least number of dyadic cells (``span`` times a power of two) that make up its days, two per
    level at most; a sample stands under the cell of each level in use that holds it. Both sides meet on (key, level, cell): an
    equality join in which a pair meets once, and in which an interval of n days makes about 2 log2(n) rows.
    """
    days = intervals.withColumns({"__a": F.floor(F.col("t0") / span), "__z": F.floor(F.col("t1") / span) + 1}).where("__a < __z")
    # at level k the days left to cover are those from the k-th l up to r; an odd end cannot wait for the next level
    iv = days.withColumn("__level", F.explode(F.sequence(F.lit(0), F.ceil(F.log2((F.col("__z") - F.col("__a")).cast("double"))).cast("int"))))
    iv = iv.withColumns({"__l": F.expr("-shiftright(-__a, __level)"), "__r": F.expr("shiftright(__z, __level)")}).where("__l < __r")
    odd = F.array(F.when(F.col("__l").bitwiseAND(1) == 1, F.col("__l")), F.when(F.col("__r").bitwiseAND(1) == 1, F.col("__r") - 1))
    iv = iv.withColumn("__cell", F.explode(F.array_distinct(F.array_compact(odd)))).drop("__a", "__z", "__l", "__r")
    levels = iv.agg(F.collect_set("__level").alias("levels")).scalar()
    d = df.withColumn("__level", F.explode(levels)).withColumn("__cell", F.expr(f"shiftright(CAST(floor({t} / {span}) AS BIGINT), __level)"))
    d = d.join(iv, [key, "__level", "__cell"])
    return d.where(F.col(t).between(F.col("t0"), F.col("t1"))).drop("__level", "__cell")


def around_boundary(df: DataFrame, bounds: DataFrame, series: Sequence[str], n: int, t: str = "t_us",
                    width: float = TIME_CHUNK) -> DataFrame:
    """Rows from ``n`` before to ``n`` after the sample nearest to each boundary ``(series, bound, b_us)``."""
    d = attach(ordered(df, series, [t], width, index="__i"), bounds, series)
    near = d.where("b_us IS NOT NULL").groupBy(*series, "bound").agg(
        F.min_by("__i", F.struct(F.abs(F.col(t) - F.col("b_us")), F.col("__i"))).alias("__near"))
    d = attach(d, near, [*series, "bound"])
    d = d.withColumn("offset_rows", F.col("__i") - F.col("__near"))
    return d.where(F.abs("offset_rows") <= n).drop("__i", "__near")


def difference(a: DataFrame, b: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``a - b`` per key; a key that only one side has raises."""
    key = list(key)
    x = a.select(*key, *[F.col(v).alias(f"__a_{v}") for v in values], F.lit(1).alias("__in_a"))
    y = b.select(*key, *[F.col(v).alias(f"__b_{v}") for v in values], F.lit(1).alias("__in_b"))
    d = x.join(y, key, "full_outer")
    lone = F.col("__in_a").isNull() | F.col("__in_b").isNull()
    check = F.when(lone, F.raise_error(F.lit("the time axes of the datasets differ")).cast("double"))
    return d.select(*key, *[F.when(lone, check).otherwise(F.col(f"__a_{v}") - F.col(f"__b_{v}")).alias(v) for v in values])


def lagged_pairs(x: DataFrame, y: DataFrame, key: Sequence[str], index: str, max_lag: int, x_value: str,
                 y_value: str, keep: Sequence[str] = ()) -> DataFrame:
    """Pairs ``x[k]``, ``y[k - lag]`` for the integer lags of ``[-max_lag, max_lag]`` as an equality join.

    The reference side ``x`` carries the exploded lags; use ``lag_correlation`` for long records and many lags.
    """
    lags = F.sequence(F.lit(-max_lag).cast("long"), F.lit(max_lag).cast("long"))
    a = x.select(*key, F.col(index).alias("k"), F.col(x_value).alias("x"), F.explode(lags).alias("lag"))
    a = a.withColumn("__j", F.col("k") - F.col("lag"))
    b = y.select(*key, *keep, F.col(index).alias("__j"), F.col(y_value).alias("y"))
    return a.join(b, [*key, "__j"]).drop("__j")
