"""Calibration offsets, drifts and their provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorspark.functions.seawater import practical_salinity
from moorspark.operators.clean import DUMMY_CALIBRATED, DUMMY_RODB
from moorspark.operators.ordered import attach


def average_offset(df: DataFrame, calib: DataFrame, value: str, series: Sequence[str] = ("serial",)) -> DataFrame:
    """Add the mean of the pre and post offset where it is applied and both exist.

    Dummies become null before the offset is added, so none survives as dummy plus offset.
    """
    c = calib.select(*series, F.when(F.col("applied"), (F.col("pre") + F.col("post")) / 2).alias("__o"))
    v = F.nanvl(F.col(value), F.lit(None).cast("double"))
    v = F.when(~v.isin(list(DUMMY_CALIBRATED + DUMMY_RODB)), v)
    return attach(df, c, series, "left").withColumn(value, v + F.coalesce("__o", F.lit(0.0))).drop("__o")


def linear_drift(df: DataFrame, calib: DataFrame, value: str, series: Sequence[str] = ("serial",), t: str = "t_us") -> DataFrame:
    """Subtract the offset that goes linearly from pre at the first to post at the last sample."""
    span = df.groupBy(*series).agg(F.min(t).alias("__t0"), F.max(t).alias("__t1"))
    d = attach(attach(df, span, series), calib.select(*series, "pre", "post"), series, "left")
    len_ = F.col("__t1") - F.col("__t0")
    frac = F.when(len_ > 0, (F.col(t) - F.col("__t0")) / F.when(len_ > 0, len_)).otherwise(0.0)
    corr = F.col("pre") + (F.col("post") - F.col("pre")) * frac
    return d.withColumn(value, F.col(value) - F.coalesce(corr, F.lit(0.0))).drop("__t0", "__t1", "pre", "post")


def general_trend(calib: DataFrame, limits: dict[str, float], var: str = "var") -> DataFrame:
    """Fill a missing pre or post offset with the mean trend of the instruments that have both, per variable.

    Instruments with an offset at or beyond the variable's limit do not count; without any, and for a variable
    without a limit, the trend is 0.
    """
    limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
    top = F.try_element_at(limit, F.col(var))
    ok = (F.abs("pre") < top) & (F.abs("post") < top)
    trend = calib.groupBy(var).agg(F.coalesce(F.avg(F.when(ok, F.col("post"))) - F.avg(F.when(ok, F.col("pre"))), F.lit(0.0)).alias("trend"))
    d = attach(calib, trend, [var])
    return d.withColumn("__a", F.coalesce(F.col("pre"), F.col("post") - F.col("trend"))).withColumn(
        "__b", F.coalesce(F.col("post"), F.col("pre") + F.col("trend"))).drop("pre", "post").withColumnsRenamed({"__a": "pre", "__b": "post"})


def remove_pressure_drift(df: DataFrame, calib: DataFrame, value: str, series: Sequence[str] = ("serial",), t: str = "t_us") -> DataFrame:
    """``p - fit + fit(reference)`` with a linear fit in time.

    The reference is the last sample without a pre, the first without a post offset, else the mean.
    """
    t0 = df.where(F.col(value).isNotNull()).groupBy(*series).agg(F.min(t).alias("__t0"), F.max(t).alias("__t1"))
    d = attach(df, t0, series)
    days = (F.col(t) - F.col("__t0")) / 8.64e10
    d = d.withColumn("__x", days)
    fit = d.groupBy(*series).agg(F.regr_slope(value, "__x").alias("__b"), F.regr_intercept(value, "__x").alias("__a"), F.avg(value).alias("__m"))
    d = attach(attach(d, fit, series), calib.select(*series, "pre", "post"), series, "left")
    end = F.col("__a") + F.col("__b") * (F.col("__t1") - F.col("__t0")) / 8.64e10
    ref = F.when(F.col("pre").isNull(), end).when(F.col("post").isNull(), F.col("__a")).otherwise(F.col("__m"))
    new = F.col(value) - (F.col("__a") + F.col("__b") * F.col("__x")) + ref
    return d.withColumn(value, F.coalesce(new, F.col(value))).drop("__t0", "__t1", "__x", "__a", "__b", "__m", "pre", "post")


def drift_acceptance(df: DataFrame, series: Sequence[str], c: str, t: str, p_before: str, p_after: str) -> DataFrame:
    """Change of the salinity std by a pressure correction; negative is an improvement."""
    s0, s1 = (practical_salinity(F.col(c), F.col(t), F.col(p)) for p in (p_before, p_after))
    d = df.groupBy(*series).agg(F.stddev_samp(s0).alias("std_before"), F.stddev_samp(s1).alias("std_after"))
    return d.withColumn("delta", F.col("std_after") - F.col("std_before")).withColumn("accepted", F.col("delta") <= 0)


def with_provenance(before: Column, after: Column, notes: Column, source: str, operator: str) -> list[Column]:
    """Columns that keep both values and record where the correction came from."""
    return [before.alias("value_before"), after.alias("value"), (~before.eqNullSafe(after)).alias("calibrated"),
            notes.alias("calibration_notes"), F.lit(source).alias("calibration_source"), F.lit(operator).alias("calibration_operator")]
