"""Common time grids, interpolation onto them, and stacking of instruments to levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moorspark.operators.ordered import DAY_US, RECORD, TIME_CHUNK, attach, explode_range, ordered, unique


def common_grid(stats: DataFrame, group: str = "mooring", end: str = "max") -> DataFrame:
    """Grid ``(group, t0, step_us, n)`` from sampling statistics; the end itself is not a grid point.

    ``end='max'`` runs to the last end of the group, ``end='median'`` to the median of the ends.
    """
    last = F.max("end_us") if end == "max" else F.floor(F.percentile("end_us", F.lit(0.5))).cast("long")
    g = stats.groupBy(group).agg(
        F.min("start_us").alias("t0"), last.alias("t1"),
        (F.floor(F.percentile("median_dt", F.lit(0.5)) * 60).cast("long") * 1_000_000).alias("step_us"))
    g = g.where("step_us > 0")
    return g.select(group, "t0", "step_us",
                    F.greatest(F.ceil((F.col("t1") - F.col("t0")) / F.col("step_us")), F.lit(0)).alias("n"))


def grid_points(grid: DataFrame) -> DataFrame:
    """One row per grid time."""
    d = explode_range(grid, F.lit(0), F.col("n") - 1, "k")
    return d.withColumn("t_us", F.col("t0") + F.col("k") * F.col("step_us"))


def regular_grid(df: DataFrame, series: Sequence[str], t: str = "t_us", step_us: int = DAY_US // 2,
                 start_offset_us: int = DAY_US, end_offset_us: int = 0) -> DataFrame:
    """Midnight-anchored grid per record, both ends included; ``n`` may be 0."""
    g = df.groupBy(*series).agg(F.min(t).alias("a"), F.max(t).alias("b"))

    def midnight(c: Column) -> Column:
        return F.floor(c / DAY_US) * DAY_US

    t0 = F.when(F.col("a") % DAY_US == 0, F.col("a")).otherwise(midnight(F.col("a") + start_offset_us))
    g = g.select(*series, t0.alias("t0"), midnight(F.col("b") - end_offset_us).alias("t1"))
    n = F.greatest(F.floor((F.col("t1") - F.col("t0")) / step_us) + 1, F.lit(0))
    return g.select(*series, "t0", F.lit(step_us).cast("long").alias("step_us"), n.alias("n"))


def interpolate(
    obs: DataFrame,
    grid: DataFrame,
    series: Sequence[str],
    on: Sequence[str],
    values: Sequence[str],
    t: str = "t_us",
    width: float | None = TIME_CHUNK,
    *,
    whole_grid: bool = False,
    extrapolate: bool = False,
    min_samples: int = 2,
    span: str | None = None,
) -> DataFrame:
    """Linear interpolation of every value column onto ``grid(on, t0, step_us, n)``.

    Each sample generates the grid points up to its successor, so there is neither a range join nor a sort
    of samples with grid points. A null neighbour gives null, an exact hit gives the sample. Points outside
    the record are absent, null (``whole_grid``) or extrapolated from the end segments (``extrapolate``).
    ``span`` names a column for the distance of the two samples used (0 for an exact hit).
    """
    nxt = {"__tn": F.col(t), **{f"__n_{v}": F.col(v) for v in values}}
    prv = {"__tp": F.col(t), **{f"__p_{v}": F.col(v) for v in values}} if extrapolate else None
    cols = list(dict.fromkeys([*series, *on, t, *values]))
    d = ordered(obs.select(*cols), series, [t], width, lead=nxt, lag=prv, index="__i", count="__n")
    d = attach(d.where(F.col("__n") >= min_samples).withColumnRenamed("__n", "__cnt"), grid, on)
    x, xn, t0, s = F.col(t), F.col("__tn"), F.col("t0"), F.col("step_us")
    last = F.col("__tn").isNull()
    edge = whole_grid or extrapolate
    own = F.ceil((x - t0) / s)
    k0 = F.when(F.col("__i") == 0, F.lit(0)).otherwise(own) if edge else own
    k1 = F.when(last, F.col("n") - 1 if edge else F.floor((x - t0) / s)).otherwise(F.ceil((xn - t0) / s) - 1)
    d = explode_range(d, F.greatest(k0, F.lit(0)), F.least(k1, F.col("n") - 1), "k")
    g = t0 + F.col("k") * s
    out = [F.col(c) for c in cols if c not in (t, *values)]
    out += [F.col("k"), g.alias(t)]
    for v in values:
        lin = F.col(v) + (F.col(f"__n_{v}") - F.col(v)) * ((g - x) / (xn - x))
        e = F.when(g == x, F.col(v)).when((g > x) & (g < xn), lin)
        if extrapolate:
            back = F.col(v) + (F.col(v) - F.col(f"__p_{v}")) * ((g - x) / (x - F.col("__tp")))
            e = e.when((g < x) & xn.isNotNull(), lin).when((g > x) & last, back)
        out.append(e.alias(v))
    if span:
        out.append(F.when(g == x, F.lit(0)).otherwise(xn - x).alias(span))
    return d.select(*out)


def levels(instr: DataFrame, present: DataFrame | None = None, group: str = "mooring",
           order: Sequence[str] = ("position",)) -> DataFrame:
    """0-based level of each instrument in configuration order, only for those ``present``."""
    d = unique(instr, RECORD, "instrument table")
    if present is not None:
        d = d.join(present.select(*RECORD).distinct(), list(RECORD), "left_semi")
    w = Window.partitionBy(group).orderBy(*order)
    return d.withColumn("level", F.row_number().over(w).cast("long") - 1)


def clock_code(offset: Column, fallback: Column | None = None) -> Column:
    """Whole-second clock offset of a level: rounded half to even, missing gives the fallback, then 0."""
    c = F.coalesce(offset, fallback) if fallback is not None else offset
    return F.coalesce(F.rint(c.cast("double")).cast("long"), F.lit(0))


def stack_levels(gridded: DataFrame, level_table: DataFrame, values: Sequence[str]) -> DataFrame:
    """Attach the per-level metadata to the gridded records of a mooring."""
    lv = level_table.select(*RECORD, "level", F.col("depth").alias("nominal_depth"), "instrument",
                            clock_code(F.col("clock_offset")).alias("clock_offset"))
    return gridded.join(lv, list(RECORD)).select(
        "mooring", "t_us", "level", "serial", "nominal_depth", "instrument", "clock_offset", *values)


def level_arrays(stacked: DataFrame, value: str) -> DataFrame:
    """``mooring, t_us, <value>``: one array per grid time with the value of each level at the level's place, null where it has none.

    The wide table for any number of levels: thousands of columns would not make a plan.
    """
    cells = F.array_sort(F.collect_list(F.struct("level", F.col(value).alias("v"))))
    d = stacked.groupBy("mooring", "t_us").agg(F.max("level").alias("__top"), cells.alias("__c"))
    at = F.map_from_entries("__c")
    whole = F.size("__c") == F.col("__top") + 1  # the usual case: every level has a row
    filled = F.transform(F.sequence(F.lit(0).cast("long"), "__top"), lambda i: F.try_element_at(at, i))
    return d.select("mooring", "t_us", F.when(whole, F.transform("__c", lambda c: c["v"])).otherwise(filled).alias(value))


def wide_levels(stacked: DataFrame, value: str, level_numbers: Sequence[int]) -> DataFrame:
    """One column per level for the given level numbers, some hundreds at most; :func:`level_arrays` takes any number."""
    d = stacked.where(F.col("level").isin(list(level_numbers)))
    p = d.groupBy("mooring", "t_us").pivot("level", list(level_numbers)).agg(F.max(value))
    return p.withColumnsRenamed({str(n): f"{value}_{n}" for n in level_numbers})


def union_variables(parts: Sequence[DataFrame], keep: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Union of records with different variables; a kept variable absent everywhere is skipped."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*keys, *[k for k in keep if k in out.columns])


def stack_by_depth(records: DataFrame, attrs: DataFrame, values: Sequence[str], group: str = "mooring") -> DataFrame:
    """Legacy stack: level by depth; time axes and positions must agree within a mooring, else it raises.

    Equal axes are tested by counts and two independent sums over the hashes of the times.
    """
    h = F.xxhash64("t_us").cast("decimal(38,0)")
    sig = records.groupBy(group, "serial").agg(
        F.count(F.lit(1)).alias("n"), F.sum(h).alias("s1"), F.sum(F.hash("t_us").cast("long")).alias("s2"))
    chk = sig.join(unique(attrs, (group, "serial"), "attribute table").select(group, "serial", "depth", "lat", "lon"), [group, "serial"])
    bad = chk.groupBy(group).agg(
        (F.count_distinct("n", "s1", "s2") > 1).alias("axes"),
        (F.count_distinct("lat", "lon") > 1).alias("place"))
    w = Window.partitionBy(group).orderBy("depth", "serial")
    lv = chk.select(group, "serial", "depth", "lat", "lon").withColumn("level", F.row_number().over(w).cast("long") - 1)
    lv = lv.join(bad, group)
    msg = F.when(F.col("axes"), F.raise_error(F.lit("time axes differ"))).when(
        F.col("place"), F.raise_error(F.lit("positions differ"))).otherwise(F.col("level"))
    lv = lv.withColumn("level", msg).drop("axes", "place")
    return records.join(lv, [group, "serial"]).select(group, "t_us", "level", "serial", "depth", "lat", "lon", *values)
