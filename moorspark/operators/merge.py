"""Merging of deployments and sites into continuous products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorspark.functions.flags import gridded_flag, rollup
from moorspark.functions.seawater import sigma0
from moorspark.operators.grid import interpolate
from moorspark.operators.ordered import DAY_US, PRES_CHUNK, TIME_CHUNK, attach, ordered


def concatenate_deployments(df: DataFrame, values: Sequence[str], site: str = "site", t: str = "t_us", pres: str = "pres",
                            p_step: float = 20.0, p_max: float = 4820.0, t_step: int = DAY_US // 2,
                            t_width: float = 30 * TIME_CHUNK, max_span: float | None = None) -> DataFrame:
    """Profiles of all deployments of a site on one pressure grid and one time axis, across the gaps.

    With ``max_span`` (microseconds) the column ``qc`` marks cells filled over a longer distance.
    """
    g = df.select(site, t).groupBy(site).agg(F.lit(0.0).alias("t0"), F.lit(float(p_step)).alias("step_us"),
                                             F.lit(int(p_max / p_step) + 1).cast("long").alias("n"))
    d = interpolate(df, g, [site, t], [site], values, pres, PRES_CHUNK, min_samples=1)
    ax = df.groupBy(site).agg(F.min(t).alias("t0"), F.lit(t_step).cast("long").alias("step_us"),
                              (F.floor((F.max(t) - F.min(t)) / t_step) + 1).alias("n"))
    out = interpolate(d.drop("k"), ax, [site, pres], [site], values, t, t_width, span="__span" if max_span is not None else None)
    if max_span is not None:
        out = out.withColumn("qc", gridded_flag(F.col(values[0]), F.col("__span"), max_span)).drop("__span")
    return out.drop("k")


def merge_sites(parts: Sequence[DataFrame], values: Sequence[str], t: str = "t_us", pres: str = "pres") -> DataFrame:
    """Union of the records of neighbouring moorings per time, ranked by pressure; all-null rows are dropped."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    u = u.dropna(how="all", subset=list(values)).where(F.col(pres).isNotNull())
    return ordered(u, [t], [pres, "site"], PRES_CHUNK, index="rank")


def by_priority(df: DataFrame, limit: float = 3800.0, t: str = "t_us", pres: str = "pres", priority: str = "priority") -> DataFrame:
    """First site down to the limit, then only what lies deeper than all sites of higher priority."""
    first = F.col(priority) == 0
    d = df.where(~first | (F.col(pres) <= limit))
    deep = d.groupBy(t, priority).agg(F.max(pres).alias("__d"))
    w = Window.partitionBy(t).orderBy(priority).rowsBetween(Window.unboundedPreceding, -1)
    deep = deep.select(t, priority, F.max("__d").over(w).alias("__above"))
    return attach(d, deep, [t, priority]).where(F.col("__above").isNull() | (F.col(pres) > F.col("__above"))).drop("__above")


def static_stability(df: DataFrame, profile: Sequence[str], temp: str = "temp", salt: str = "salt", pres: str = "pres") -> DataFrame:
    """Density and whether it decreases against the next shallower level."""
    d = df.withColumn("sigma0", sigma0(F.col(salt), F.col(temp)))
    d = ordered(d, profile, [pres], PRES_CHUNK, lag={"__s": F.col("sigma0")})
    return d.withColumn("unstable", F.coalesce(F.col("sigma0") < F.col("__s"), F.lit(False))).drop("__s")


def anomaly(df: DataFrame, axis: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Value minus its time mean at each position of ``axis``; partial means are combined before the join."""
    m = df.groupBy(*axis).agg(*[F.avg(v).alias(f"__m_{v}") for v in values])
    d = attach(df, m, axis)
    return d.withColumns({f"{v}_anomaly": F.col(v) - F.col(f"__m_{v}") for v in values}).drop(*[f"__m_{v}" for v in values])


def merged_flag(df: DataFrame, key: Sequence[str], flag: str = "qc") -> DataFrame:
    """Worst flag per cell when several sites contribute: interpolated over missing, then the test precedence."""
    f = F.col(flag)
    a = df.groupBy(*key).agg(*[F.max((f == v).cast("int")).alias(f"__{v}") for v in (1, 2, 3, 4, 8, 9)])
    tests = rollup(*[F.when(F.col(f"__{v}") == 1, F.lit(v)) for v in (1, 2, 3, 4, 9)])
    return a.select(*key, F.when((F.col("__8") == 1) & ~tests.isin(3, 4), 8).otherwise(F.coalesce(tests, F.lit(8))).alias(flag))
