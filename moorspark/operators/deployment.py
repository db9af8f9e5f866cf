"""Detection of the deployed part of a record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.operators import series as ser
from moorspark.operators import stats
from moorspark.operators.ordered import TIME_CHUNK, attach, ordered, percentiles

_HOUR = 3_600_000_000
#: Chunk for the short windows at both ends of a record.
_END_CHUNK = _HOUR // 4


def bottom_window(df: DataFrame, series: Sequence[str], strategy: str = "percent_span", margin_hours: float = 24.0,
                  inner_fraction: float = 0.25, bounds: DataFrame | None = None, deployment_margin_hours: float = 2.0,
                  t: str = "t_us") -> DataFrame:
    """``(series, tmin, tmax, bot_start, bot_end)``: when the instrument is almost surely at depth.

    ``bounds`` gives ``(series, deploy_us, recover_us)`` for ``deployment_bounds``; a null there falls back
    to the inner fraction. The window is clipped to the record; an empty one becomes 33 % - 66 %.
    """
    a = df.groupBy(*series).agg(F.min(t).alias("tmin"), F.max(t).alias("tmax"))
    span = F.col("tmax") - F.col("tmin")
    lo = (F.col("tmin") + span * inner_fraction).cast("long")
    hi = (F.col("tmax") - span * inner_fraction).cast("long")
    if strategy == "fixed_hours":
        m = int(margin_hours * _HOUR)
        lo, hi = F.col("tmin") + m, F.col("tmax") - m
    elif strategy == "deployment_bounds" and bounds is not None:
        m = int(deployment_margin_hours * _HOUR)
        a = attach(a, bounds.select(*series, "deploy_us", "recover_us"), series, "left")
        both = F.col("deploy_us").isNotNull() & F.col("recover_us").isNotNull()
        lo = F.when(both, F.col("deploy_us") + m).otherwise(lo)
        hi = F.when(both, F.col("recover_us") - m).otherwise(hi)
    a = a.withColumn("__lo", F.greatest(lo, F.col("tmin"))).withColumn("__hi", F.least(hi, F.col("tmax")))
    bad = F.col("__hi") <= F.col("__lo")
    span = F.col("tmax") - F.col("tmin")
    return a.select(
        *series, "tmin", "tmax",
        F.when(bad, (F.col("tmin") + span * 0.33).cast("long")).otherwise(F.col("__lo")).alias("bot_start"),
        F.when(bad, (F.col("tmin") + span * 0.66).cast("long")).otherwise(F.col("__hi")).alias("bot_end"))


def sea_values(df: DataFrame, series: Sequence[str], value: str, window: DataFrame, t: str = "t_us") -> DataFrame:
    """Mean and sample std in the bottom window; an empty window uses the interquartile values."""
    q = percentiles(df, series, F.col(value), {"q25": 0.25, "q75": 0.75})
    d = attach(df.select(*series, t, value), window.select(*series, "bot_start", "bot_end").join(q, list(series), "left"), series)
    inside = F.col(t).between(F.col("bot_start"), F.col("bot_end"))
    mid = F.col(value).between(F.col("q25"), F.col("q75"))
    w, m = F.when(inside, F.col(value)), F.when(mid, F.col(value))
    a = d.groupBy(*series).agg(
        F.max(inside.cast("int")).alias("any"), F.avg(w).alias("wm"), F.count(w).alias("wn"), F.stddev_samp(w).alias("ws"),
        F.avg(m).alias("mm"), F.count(m).alias("mn"), F.stddev_samp(m).alias("ms"), F.avg(value).alias("am"),
        F.stddev_samp(value).alias("asd"))
    return a.select(
        *series, F.when(F.col("any") == 1, F.col("wm")).otherwise(F.coalesce("mm", "am")).alias("sea_mean"),
        F.when(F.col("any") == 1, F.when(F.col("wn") > 1, F.col("ws")).otherwise(0.0))
        .otherwise(F.when(F.col("mn") > 1, F.col("ms")).otherwise(F.col("asd"))).alias("sea_std"))


def smoothed_ends(df: DataFrame, series: Sequence[str], value: str, window: DataFrame, hours: float = 24.0,
                  smooth_window: int = 9, t: str = "t_us", width: float = TIME_CHUNK) -> DataFrame:
    """Smoothed values of the first and last ``hours``: rows ``(series, side, t, ys)``; a row may be in both."""
    h = int(hours * _HOUR)
    d = ser.rolling_median(df.select(*series, t, value), series, value, smooth_window, "ys", [t], width)
    d = attach(d, window.select(*series, "tmin", "tmax"), series)
    side = F.array_compact(F.array(F.when(F.col(t) <= F.col("tmin") + h, F.lit("early")),
                                   F.when(F.col(t) >= F.col("tmax") - h, F.lit("late"))))
    return d.withColumn("side", F.explode(side)).select(*series, "side", t, "ys")


def sigma_threshold(ends: DataFrame, series: Sequence[str], sea: DataFrame, band_sigma: float = 3.0,
                    min_halfwidth: float = 0.1, warm_side: str = "auto", warm_percentile: float = 90.0) -> DataFrame:
    """``(series, threshold, deep_is_below)``: sea mean plus or minus the half-width of the band."""
    p = percentiles(ends, [*series, "side"], F.col("ys"), {"p": warm_percentile / 100})
    warm = p.groupBy(*series).agg(F.percentile("p", F.lit(0.5)).alias("warm"))
    d = attach(sea, warm, series, "left")
    hw = F.greatest(F.col("sea_std") * band_sigma, F.lit(min_halfwidth))
    if warm_side == "auto":
        low = F.coalesce(F.col("warm") < F.col("sea_mean"), F.lit(False))
    else:
        low = F.lit(warm_side == "low")
    return d.select(*series, F.when(low, F.col("sea_mean") - hw).otherwise(F.col("sea_mean") + hw).alias("threshold"),
                    (~low).alias("deep_is_below"))


def entry_exit(df: DataFrame, series: Sequence[str], value: str, threshold: DataFrame, t: str = "t_us") -> DataFrame:
    """First and last time strictly below the threshold (null when never)."""
    d = attach(df.select(*series, t, value), threshold.select(*series, "threshold"), series)
    below = F.when(F.col(value) < F.col("threshold"), F.col(t))
    return d.groupBy(*series).agg(F.min(below).alias("start_us"), F.max(below).alias("end_us"),
                                  F.first("threshold").alias("split_value"))


def find_deployment(df: DataFrame, series: Sequence[str], value: str, strategy: str = "percent_span",
                    band_sigma: float = 1.5, smooth_window: int = 9, hours: float = 24.0, t: str = "t_us",
                    width: float = TIME_CHUNK, **window_args) -> DataFrame:
    """Start, end and split value of every record."""
    w = bottom_window(df, series, strategy, t=t, **window_args)
    sea = sea_values(df, series, value, w, t)
    thr = sigma_threshold(smoothed_ends(df, series, value, w, hours, smooth_window, t, width), series, sea, band_sigma)
    return entry_exit(df, series, value, thr, t)


def surface_times(df: DataFrame, series: Sequence[str], value: str, window: DataFrame, sea: DataFrame,
                  hours: float = 24.0, smooth_window: int = 9, dwell_seconds: float = 1800, tol_sigma: float = 2.0,
                  t: str = "t_us", width: float = TIME_CHUNK) -> DataFrame:
    """Sink time, float time and the threshold between warm and sea regimes.

    In each end window a change point is preferred when its sea-like side is colder and nearer the sea
    mean; the first (last) sustained cold run behind (before) it is taken, else of the whole window.
    """
    series = list(series)
    key = [*series, "side"]
    e = smoothed_ends(df, series, value, window, hours, smooth_window, t, width)
    dt = ser.sampling_interval(df, series, t, width)
    info = sea.join(dt, series, "left").select(
        *series, "sea_mean", "sea_std",
        F.coalesce(F.ceil(F.lit(float(dwell_seconds)) / F.col("dt_s")), F.lit(1)).cast("long").alias("min_len"))
    e = attach(e, info, series)
    cp = ser.change_point(e, key, "ys", F.col("min_len"), [t], _END_CHUNK)
    d = ordered(attach(e, cp, key), key, [t], _END_CHUNK, index="j", count="n")
    d1, d2 = F.abs(F.col("mu_left") - F.col("sea_mean")), F.abs(F.col("mu_right") - F.col("sea_mean"))
    early = F.col("side") == "early"
    long = F.col("n") >= 2 * F.col("min_len") + 1
    pref = long & F.when(early, (F.col("mu_right") < F.col("mu_left")) & (d2 <= d1)).otherwise(
        (F.col("mu_left") < F.col("mu_right")) & (d1 <= d2))
    d = d.withColumn("pref", F.coalesce(pref, F.lit(False)))
    cold = F.col("ys") <= F.col("sea_mean") + tol_sigma * F.col("sea_std")
    ok = cold & (~F.col("pref") | F.when(early, F.col("j") >= F.col("k")).otherwise(F.col("j") < F.col("k")))
    r = ser.runs(d, key, ok, [t], _END_CHUNK)
    r = attach(r, info.select(*series, "min_len"), series).where(F.col("length") >= F.col("min_len"))
    pick = r.groupBy(*key).agg(
        F.min("start_idx").alias("s0"), F.min(f"start_{t}").alias("t0"), F.max("end_idx").alias("e1"), F.max(f"end_{t}").alias("t1"))
    d = attach(d, pick, key, "left")
    outside = F.when(early, F.col("j") < F.col("s0")).otherwise(F.col("j") > F.col("e1"))
    s = d.groupBy(*key).agg(
        F.first("pref").alias("pref"), F.first("mu_left").alias("mu_left"), F.first("mu_right").alias("mu_right"),
        F.avg(F.when(outside, F.col("ys"))).alias("edge"), F.first("t0").alias("t0"), F.first("t1").alias("t1"))
    warm = F.when(F.col("pref"), F.when(early, F.col("mu_left")).otherwise(F.col("mu_right"))).otherwise(F.col("edge"))
    s = s.withColumn("warm", warm).groupBy(*series).agg(
        F.max(F.when(early, F.col("t0"))).alias("sink_us"), F.max(F.when(~early, F.col("t1"))).alias("float_us"),
        F.avg("warm").alias("warm"))
    s = attach(sea, s, series, "left")
    thr = F.when(F.col("warm").isNotNull(), 0.5 * (F.col("sea_mean") + F.col("warm"))).otherwise(
        F.col("sea_mean") + F.greatest(F.lit(0.5), 2.0 * F.col("sea_std")))
    return s.select(*series, "sink_us", "float_us", thr.alias("threshold"))


def cold_regime(df: DataFrame, series: Sequence[str], value: str, quantile: float = 0.95, dwell_seconds: float = 1800,
                smooth_window: int = 5, t: str = "t_us", width: float = TIME_CHUNK) -> DataFrame:
    """Start of the first and end of the last sustained run at or below the quantile."""
    series = list(series)
    thr = percentiles(df, series, F.col(value), {"threshold": quantile})
    dt = ser.sampling_interval(df, series, t, width, positive=False)
    info = thr.join(dt, series, "left").withColumn(
        "min_len", F.ceil(F.lit(float(dwell_seconds)) / F.when(F.col("dt_s") > 0, F.col("dt_s"))))
    d = ser.rolling_median(df.select(*series, t, value), series, value, smooth_window, "ys", [t], width)
    d = attach(d, info.select(*series, "threshold"), series)
    r = ser.runs(d, series, F.col("ys") <= F.col("threshold"), [t], width)
    r = attach(r, info.select(*series, "min_len"), series).where(F.col("length") >= F.col("min_len"))
    r = r.groupBy(*series).agg(F.min(f"start_{t}").alias("start_us"), F.max(f"end_{t}").alias("end_us"))
    return info.select(*series, "threshold").join(r, series, "left")


def suggest_trim(df: DataFrame, series: Sequence[str], values: Sequence[str], percent: float = 95.0,
                 threshold: float = 3.0, t: str = "t_us") -> DataFrame:
    """Latest of the variables' first and earliest of their last time with abs(z) below the threshold."""
    z = stats.normalise(df.select(*series, t, *values), series, values, percent)
    near = {v: F.when(F.abs(F.col(f"z_{v}")) < threshold, F.col(t)) for v in values}
    a = z.groupBy(*series).agg(*[f(c).alias(f"{n}_{v}") for v, c in near.items() for n, f in (("a", F.min), ("b", F.max))])
    cols_a, cols_b = [F.col(f"a_{v}") for v in values], [F.col(f"b_{v}") for v in values]
    if len(values) == 1:
        return a.select(*series, cols_a[0].alias("start_us"), cols_b[0].alias("end_us"))
    return a.select(*series, F.greatest(*cols_a).alias("start_us"), F.least(*cols_b).alias("end_us"))


def trim_review(df: DataFrame, series: Sequence[str], bounds: DataFrame, hours: float = 12.0, t: str = "t_us") -> DataFrame:
    """Rows within ``hours`` of a record's start or end bound, tagged inside or outside the bounds."""
    h = int(hours * _HOUR)
    d = attach(df, bounds.select(*series, "start_us", "end_us"), series)
    near = F.array_compact(F.array(
        F.when(F.abs(F.col(t) - F.col("start_us")) <= h, F.lit("start")),
        F.when(F.abs(F.col(t) - F.col("end_us")) <= h, F.lit("end"))))
    inside = F.col(t).between(F.col("start_us"), F.col("end_us"))
    return d.withColumn("bound", F.explode(near)).withColumn("place", F.when(inside, "inside").otherwise("outside")).drop(
        "start_us", "end_us")
