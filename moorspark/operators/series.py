"""Windowed operators on ordered series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorspark.operators.ordered import TIME_CHUNK, attach, ordered, percentiles, rolling, sorted_median


def rolling_median(df: DataFrame, series: Sequence[str], value: str, window: int, out: str | None = None,
                   order: Sequence[str] = ("t_us",), width: float | None = TIME_CHUNK) -> DataFrame:
    """Centred rolling median over ``window`` rows (odd); edges shrink, nulls are ignored."""
    out = out or f"{value}_median"
    if window <= 1:
        return df.withColumn(out, F.col(value))
    if window % 2 == 0:
        raise ValueError("the window must be odd")
    d = rolling(df, series, order, width, window // 2, {"__m": lambda w: F.array_sort(F.collect_list(value).over(w))})
    return d.withColumn(out, sorted_median(F.col("__m"))).drop("__m")


def rolling_mean(df: DataFrame, series: Sequence[str], value: str, window: int, out: str | None = None,
                 order: Sequence[str] = ("t_us",), width: float | None = TIME_CHUNK) -> DataFrame:
    """Centred rolling mean over ``window`` rows (odd); edges shrink, nulls are ignored."""
    if window % 2 == 0:
        raise ValueError("the window must be odd")
    return rolling(df, series, order, width, window // 2, {out or f"{value}_mean": lambda w: F.avg(value).over(w)})


def with_run_ids(df: DataFrame, series: Sequence[str], cond: Column, order: Sequence[str] = ("t_us",),
                 width: float | None = TIME_CHUNK) -> DataFrame:
    """Rows where ``cond`` is true, with their position ``idx`` and a number ``run`` shared by one run."""
    c = F.coalesce(cond, F.lit(False))
    d = ordered(df.withColumn("__ok", c), series, order, width, index="idx", count="n_rows",
                cum={"__true": F.col("__ok").cast("long")})
    return d.where("__ok").withColumn("run", F.col("idx") - F.col("__true")).drop("__ok", "__true")


def runs(df: DataFrame, series: Sequence[str], cond: Column, order: Sequence[str] = ("t_us",),
         width: float | None = TIME_CHUNK) -> DataFrame:
    """Runs of true: start and end position, start and end of the axis, length."""
    a = order[0]
    return with_run_ids(df, series, cond, order, width).groupBy(*series, "run").agg(
        F.min("idx").alias("start_idx"), F.max("idx").alias("end_idx"), F.min(a).alias(f"start_{a}"),
        F.max(a).alias(f"end_{a}"), F.count(F.lit(1)).alias("length")).drop("run")


def first_last_run(run_table: DataFrame, series: Sequence[str], min_len: Column | int) -> DataFrame:
    """Start of the first and end of the last run of at least ``min_len`` rows."""
    n = F.lit(min_len) if isinstance(min_len, int) else min_len
    r = run_table.where(F.col("length") >= n)
    return r.groupBy(*series).agg(
        F.min("start_idx").alias("first_start"), F.min_by("end_idx", "start_idx").alias("first_end"),
        F.max_by("start_idx", "end_idx").alias("last_start"), F.max("end_idx").alias("last_end"))


def sampling_interval(df: DataFrame, series: Sequence[str], t: str = "t_us", width: int = TIME_CHUNK,
                      positive: bool = True) -> DataFrame:
    """Median of the (positive) whole-second intervals; records without one are absent."""
    d = ordered(df.select(*series, t), series, [t], width, lag={"__p": F.col(t)})
    dt = F.floor((F.col(t) - F.col("__p")) / 1_000_000)
    d = d.withColumn("__dt", F.when(dt > 0, dt) if positive else dt)
    return percentiles(d, series, F.col("__dt"), {"dt_s": 0.5})


def change_point(df: DataFrame, series: Sequence[str], value: str, min_seg: int | Column = 1,
                 order: Sequence[str] = ("t_us",), width: float | None = TIME_CHUNK) -> DataFrame:
    """Split ``k`` with the least squared error of two constant pieces, ties to the smallest.

    ``k`` rows lie left of the split. Without a valid split: ``max(min_seg, n // 2)`` and the overall mean
    on both sides. ``min_seg`` may be a column constant within the series.
    """
    m = F.lit(min_seg) if isinstance(min_seg, int) else min_seg
    v = F.col(value)
    d = df.withColumn("__m", m)
    has = v.isNotNull().cast("long")
    d = ordered(d, series, order, width, index="__i", count="__n", cum={"__s": v, "__q": v * v, "__c": has},
                total={"__ts": v, "__tq": v * v, "__tc": has})
    k, n = F.col("__i") + 1, F.col("__n")
    n1, n2 = F.col("__c"), F.col("__tc") - F.col("__c")
    mu1 = F.col("__s") / F.when(n1 > 0, n1)
    mu2 = (F.col("__ts") - F.col("__s")) / F.when(n2 > 0, n2)
    sse = (F.col("__q") - n1 * mu1 * mu1) + (F.col("__tq") - F.col("__q") - n2 * mu2 * mu2)
    ok = ((n >= 2 * F.col("__m") + 1) & (k >= F.col("__m")) & (k <= n - F.col("__m"))
          & (n1 >= F.col("__m")) & (n2 >= F.col("__m")))
    best = F.min_by(F.struct(k.alias("k"), mu1.alias("m1"), mu2.alias("m2")), F.when(ok, F.struct(sse, k)))
    a = d.groupBy(*series).agg(best.alias("b"), F.max("__n").alias("n"), F.max("__m").alias("m"),
                               F.avg(v).alias("mu"))
    half = F.floor(F.col("n") / 2)
    return a.select(*series, F.coalesce(F.col("b.k"), F.greatest(F.col("m"), half)).cast("long").alias("k"),
                    F.coalesce(F.col("b.m1"), F.col("mu")).alias("mu_left"),
                    F.coalesce(F.col("b.m2"), F.col("mu")).alias("mu_right"))


def fill_gaps(df: DataFrame, series: Sequence[str], values: Sequence[str], axis: str,
              width: float | None, max_gap: float | None = None) -> DataFrame:
    """Linear fill of interior null gaps along the axis; nulls at the ends stay.

    With ``max_gap`` a gap stays null when the distance between its two valid neighbours exceeds it.
    """
    lv, nv = {}, {}
    for v in values:
        s = F.struct(F.col(axis).alias("x"), F.col(v).alias("y"))
        lv[f"__l_{v}"] = (s, F.col(v).isNotNull())
        nv[f"__r_{v}"] = (s, F.col(v).isNotNull())
    d = ordered(df, series, [axis], width, last_valid=lv, next_valid=nv)
    for v in values:
        a, b = F.col(f"__l_{v}"), F.col(f"__r_{v}")
        lin = a["y"] + (b["y"] - a["y"]) * ((F.col(axis) - a["x"]) / (b["x"] - a["x"]))
        inside = a.isNotNull() & b.isNotNull()
        if max_gap is not None:
            inside = inside & (b["x"] - a["x"] <= max_gap)
        d = d.withColumn(v, F.when(F.col(v).isNotNull(), F.col(v)).when(inside, lin)).drop(f"__l_{v}", f"__r_{v}")
    return d


def every_nth(df: DataFrame, series: Sequence[str], n: int, order: Sequence[str] = ("t_us",),
              width: float | None = TIME_CHUNK, index: str = "sub_idx") -> DataFrame:
    """Every n-th row from the first, numbered anew."""
    d = ordered(df, series, order, width, index="__i").where(F.col("__i") % n == 0)
    return d.withColumn(index, F.floor(F.col("__i") / n)).drop("__i")


def fill_short_gaps(df: DataFrame, series: Sequence[str], value: str, gap_rows: int, min_valid: int = 30,
                    order: Sequence[str] = ("t_us",), width: float | None = TIME_CHUNK) -> DataFrame:
    """Fill null gaps by interpolation but keep runs of more than ``gap_rows`` nulls null.

    Records with fewer than ``min_valid`` values become null. Interior fill only, as in :func:`fill_gaps`.
    """
    axis = order[0]
    s = F.struct(F.col(axis).alias("x"), F.col(value).alias("y"))
    ok = F.col(value).isNotNull()
    d = ordered(df, series, order, width, index="__i", last_valid={"__l": (s, ok)}, next_valid={"__r": (s, ok)},
                total={"__n": ok.cast("long")})
    d = ordered(d, series, order, width, last_valid={"__il": (F.col("__i"), ok)}, next_valid={"__ir": (F.col("__i"), ok)})
    a, b = F.col("__l"), F.col("__r")
    lin = a["y"] + (b["y"] - a["y"]) * ((F.col(axis) - a["x"]) / (b["x"] - a["x"]))
    gap = F.col("__ir") - F.col("__il") - 1
    v = F.when(F.col("__n") < min_valid, F.lit(None).cast("double")).when(ok, F.col(value)).when(gap <= gap_rows, lin)
    return d.withColumn(value, v).drop("__i", "__l", "__r", "__n", "__il", "__ir")


def with_sampling(df: DataFrame, series: Sequence[str], t: str = "t_us", width: int = TIME_CHUNK) -> DataFrame:
    """Attach the sampling interval ``dt_s`` (null without one)."""
    return attach(df, sampling_interval(df, series, t, width), series, "left")
