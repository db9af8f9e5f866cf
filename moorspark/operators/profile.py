"""Vertical gridding of sparse profiles with a climatology of vertical gradients."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moorspark.functions.seawater import sigma0
from moorspark.operators.clean import in_box
from moorspark.operators.grid import interpolate
from moorspark.operators.ordered import PRES_CHUNK, TIME_CHUNK, attach, explode_range, ordered
from moorspark.operators.series import fill_gaps, rolling_mean

#: Fixed values of the climatology axis: first edge, bin width, number of bins.
BIN_EDGE, BIN_WIDTH, BINS = -2.0, 0.5, 74
MIN_SAMPLES = 5


def pressure_grid(df: DataFrame, p0: Column, p1: Column, step: float, name: str = "p") -> DataFrame:
    """Grid from ``p0`` to ``p1`` in either direction, the end covered."""
    sign = F.when(p0 < p1, F.lit(1.0)).otherwise(F.lit(-1.0))
    n = F.ceil((F.abs(p1 - p0) + step) / step)
    d = explode_range(df, F.lit(0), n - 1, "__j")
    return d.withColumn(name, p0 + sign * F.col("__j") * step).drop("__j")


def to_levels(df: DataFrame, profile: Sequence[str], values: Sequence[str], pressures: Sequence[float],
              pres: str = "pres", width: float | None = PRES_CHUNK) -> DataFrame:
    """Interpolate profiles to the given pressures; null outside the profile."""
    profile = list(profile)
    nxt = {"__xn": F.col(pres), **{f"__n_{v}": F.col(v) for v in values}}
    d = ordered(df.select(*profile, pres, *values), profile, [pres], width, lead=nxt, index="__i")
    x, xn = F.col(pres), F.col("__xn")
    levels = F.array(*[F.lit(float(p)) for p in pressures])
    mine = F.filter(levels, lambda p: ((p >= x) | (F.col("__i") == 0)) & (xn.isNull() | (p < xn)))
    d = d.withColumn("__p", F.explode(mine))
    p = F.col("__p")

    def at(v: str) -> Column:
        lin = F.col(v) + (F.col(f"__n_{v}") - F.col(v)) * ((p - x) / (xn - x))
        return F.when(p == x, F.col(v)).when((p > x) & (p < xn), lin)

    return d.select(*profile, p.alias(pres), *[at(v).alias(v) for v in values])


def hydrographic_subset(df: DataFrame, lat: tuple[float, float], lon: tuple[float, float], profile: Sequence[str],
                        values: Sequence[str], step: float = 20.0, pres: str = "pres") -> DataFrame:
    """Profiles of a region on a regular pressure grid from 0 (rows exist where a profile has data)."""
    d = in_box(df, lat, lon)
    g = d.groupBy(*profile).agg(F.lit(0.0).alias("t0"), F.lit(float(step)).alias("step_us"),
                                (F.floor(F.max(pres) / step) + 1).alias("n"))
    out = interpolate(d, g, profile, profile, values, pres, PRES_CHUNK)
    return out.drop("k")


def gradients(df: DataFrame, profile: Sequence[str], values: Sequence[str], axis: str = "pres",
              width: float | None = PRES_CHUNK, min_levels: int = 1) -> DataFrame:
    """``d<value>``: second-order central difference for uneven spacing, one-sided at the ends.

    Profiles with fewer than ``min_levels`` rows are skipped.
    """
    vals = {v: F.col(v) for v in values}
    d = ordered(df, profile, [axis], width, lag={"__xp": F.col(axis), **{f"__p_{v}": c for v, c in vals.items()}},
                lead={"__xn": F.col(axis), **{f"__n_{v}": c for v, c in vals.items()}}, count="__cnt")
    d = d.where(F.col("__cnt") >= min_levels).drop("__cnt")
    hs, hd = F.col(axis) - F.col("__xp"), F.col("__xn") - F.col(axis)
    for v in values:
        c, p, n = F.col(v), F.col(f"__p_{v}"), F.col(f"__n_{v}")
        mid = (hs * hs * n + (hd * hd - hs * hs) * c - hd * hd * p) / (hs * hd * (hs + hd))
        d = d.withColumn(f"d{v}", F.when(F.col("__xp").isNull(), (n - c) / hd).when(
            F.col("__xn").isNull(), (c - p) / hs).otherwise(mid))
    return d.drop("__xp", "__xn", *[f"__{s}_{v}" for v in values for s in "pn"])


def bin_gradients(grad: DataFrame, temp: str = "temp", dtdp: str = "dtemp", dsdp: str = "dsalt", time: str = "time",
                  min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Mean gradients per month and temperature bin on the full month x bin grid."""
    b = F.floor((F.col(temp) - BIN_EDGE) / BIN_WIDTH).cast("int")
    d = grad.select(F.month(time).alias("month"), b.alias("bin"), F.col(dtdp).alias("g1"), F.col(dsdp).alias("g2"))
    a = d.where(F.col("bin").between(0, BINS - 1)).groupBy("month", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("g1").alias("dtdp"), F.avg("g2").alias("dsdp"))
    grid = grad.sparkSession.range(12 * BINS).select(
        (F.floor(F.col("id") / BINS) + 1).cast("int").alias("month"), (F.col("id") % BINS).cast("int").alias("bin"))
    ok = F.col("n") >= min_samples
    return grid.join(a, ["month", "bin"], "left").select(
        "month", "bin", (BIN_EDGE + BIN_WIDTH * (F.col("bin") + 0.5)).cast("double").alias("temp_center"),
        F.when(ok, F.col("dtdp")).alias("dtdp"), F.when(ok, F.col("dsdp")).alias("dsdp"))


def build_climatology(df: DataFrame, profile: Sequence[str], pressures: Sequence[float], temp: str = "temp",
                      salt: str = "salt", pres: str = "pres", time: str = "time") -> DataFrame:
    """Climatology from profiles: to standard pressures, gradients, monthly temperature bins.

    Levels lacking a value are masked; profiles with fewer than two valid levels are skipped.
    """
    profile = list(profile)
    d = df.where(F.col(temp).isNotNull() & F.col(salt).isNotNull() & F.col(pres).isNotNull())
    head = d.groupBy(*profile).agg(F.count(F.lit(1)).alias("__n"), F.min(time).alias(time)).where("__n >= 2").drop("__n")
    g = gradients(to_levels(d, profile, [temp, salt], pressures, pres), profile, [temp, salt], pres)
    return bin_gradients(attach(g, head, profile), temp, f"d{temp}", f"d{salt}", time)


def climatology_attributes() -> dict[str, str]:
    """Attributes stored with a climatology."""
    return {"method": "seasonal climatology built from downsampled CTD profiles", "temp_bin_width": str(BIN_WIDTH)}


def smooth_climatology(clim: DataFrame, window: int = 3) -> DataFrame:
    """Centred mean over neighbouring bins of a month."""
    d = rolling_mean(clim, ["month"], "dtdp", window, "__t", ["bin"], None)
    d = rolling_mean(d, ["month"], "dsdp", window, "__s", ["bin"], None)
    return d.drop("dtdp", "dsdp").withColumnsRenamed({"__t": "dtdp", "__s": "dsdp"})


def complete_climatology(clim: DataFrame, cold: float = 4.0) -> DataFrame:
    """Fill interior gaps over the bins, then use the mean over months below ``cold`` degrees."""
    d = fill_gaps(clim, ["month"], ["dtdp", "dsdp"], "temp_center", None)
    w = Window.partitionBy("bin")
    for v in ("dtdp", "dsdp"):
        d = d.withColumn(f"__{v}", F.when(F.col("temp_center") < cold, F.avg(v).over(w)).otherwise(F.col(v)))
    return d.drop("dtdp", "dsdp").withColumnsRenamed({"__dtdp": "dtdp", "__dsdp": "dsdp"})


def gradient_arrays(clim: DataFrame) -> DataFrame:
    """``(month, gt, gs)``: twelve rows of one array per gradient, ordered by bin."""
    s = F.sort_array(F.collect_list(F.struct("bin", "dtdp", "dsdp")))
    a = clim.groupBy("month").agg(s.alias("a"))
    return a.select("month", F.transform("a", lambda r: r["dtdp"]).alias("gt"), F.transform("a", lambda r: r["dsdp"]).alias("gs"))


def with_gradients(df: DataFrame, clim: DataFrame, time: str = "time") -> DataFrame:
    """Attach the gradient arrays of the row's month; twelve rows of 74 bins, so broadcasting is bounded."""
    return df.withColumn("month", F.month(time)).join(F.broadcast(gradient_arrays(clim)), "month")


def lookup(arr: Column | str, temp: Column) -> Column:
    """Gradient at a temperature: linear between bin centres, end values outside; null bins propagate."""
    pos = _place(temp)
    return _between(F.col(arr) if isinstance(arr, str) else arr, pos, _bin(pos))


def _place(temp: Column) -> Column:
    """Place of a temperature among the bin centres."""
    return (temp - (BIN_EDGE + BIN_WIDTH / 2)) / BIN_WIDTH


def _bin(pos: Column) -> Column:
    """The bin whose centre is the lower end of the line at a place."""
    return F.least(F.greatest(F.ceil(pos) - 1, F.lit(0)), F.lit(BINS - 2)).cast("int")


def _between(a: Column, pos: Column, i: Column) -> Column:
    lin = F.get(a, i) + (F.get(a, i + 1) - F.get(a, i)) * (pos - i)
    return F.when(pos < 0, F.get(a, F.lit(0))).when(pos > BINS - 1, F.get(a, F.lit(BINS - 1))).when(pos.isNotNull(), lin)


def _ordered_pairs(df: DataFrame, profile: Sequence[str], temp: str, salt: str, pres: str, time: str, width) -> DataFrame:
    """Valid sensors with their next deeper one; profiles with a single valid sensor are skipped."""
    d = df.where(F.col(temp).isNotNull() & F.col(pres).isNotNull())
    d = d.select(*profile, time, F.col(pres).alias("p1"), F.col(temp).alias("t1"), F.col(salt).alias("s1"))
    nxt = {"p2": F.col("p1"), "t2": F.col("t1"), "s2": F.col("s1")}
    # of sensors at one pressure the warmer one comes last, so a rerun gives the same rows
    return ordered(d, profile, ["p1", "t1", "s1"], width, lead=nxt, lag={"t0": F.col("t1")}, index="i", count="n").where("n >= 2")


def skipped_profiles(df: DataFrame, profile: Sequence[str], temp: str = "temp", pres: str = "pres") -> DataFrame:
    """Profiles that the filling operators give no rows, since fewer than two of their sensors are valid, with that number."""
    valid = F.count(F.when(F.col(temp).isNotNull() & F.col(pres).isNotNull(), 1))
    return df.groupBy(*profile).agg(valid.alias("valid_sensors"), F.count(F.lit(1)).alias("sensors")).where("valid_sensors < 2")


def _with_end_gradients(d: DataFrame) -> DataFrame:
    """Gradients of both sensors of a pair, at their temperatures, and the values at the upper sensor.

    A missing gradient makes the line from its sensor missing, also where that line has no weight: at a
    sensor the value is missing with the gradient of the sensor above it (of the one below it at the top).
    """
    # places and bins are columns of their own: six lookups written out make a method too long to be compiled
    temps = (F.coalesce("t0", "t2"), F.col("t1"), F.col("t2"))
    d = d.select("*", *[_place(t).alias(f"__x{i}") for i, t in enumerate(temps)])
    d = d.select("*", *[_bin(F.col(f"__x{i}")).alias(f"__b{i}") for i in range(3)])
    d = d.select("*", *[_between(F.col(a), F.col(f"__x{i}"), F.col(f"__b{i}")).alias(f"{a}{i}") for a in ("gt", "gs") for i in range(3)])
    return d.select("*", F.when(F.col("gt0").isNotNull(), F.col("t1")).alias("town"),
                    F.when(F.col("gs0").isNotNull(), F.col("s1")).alias("sown")).drop(
                        "gt", "gs", "gt0", "gs0", *[f"__{k}{i}" for k in "xb" for i in range(3)])


def _blend(p: Column, v: str, g: str) -> Column:
    """Value at ``p`` between two sensors: both end lines, weighted by distance."""
    u = (p - F.col("p1")) / (F.col("p2") - F.col("p1"))
    return (1 - u) * (F.col(f"{v}1") + F.col(f"{g}1") * (p - F.col("p1"))) + u * (F.col(f"{v}2") + F.col(f"{g}2") * (p - F.col("p2")))


def fill_between(df: DataFrame, clim: DataFrame, profile: Sequence[str], temp: str = "temp", salt: str = "salt",
                 pres: str = "pres", time: str = "time", step: float = 20.0, width: float | None = PRES_CHUNK) -> DataFrame:
    """Knots between neighbouring sensors, every ``step`` from the upper one, and the lowest sensor itself."""
    d = _with_end_gradients(with_gradients(_ordered_pairs(df, profile, temp, salt, pres, time, width), clim, time))
    n = F.coalesce(F.ceil((F.col("p2") - F.col("p1")) / step), F.lit(1))
    d = explode_range(d, F.lit(0), n - 1, "j")
    p = F.col("p1") + F.col("j") * step
    first = F.col("j") == 0
    return d.select(*profile, p.alias(pres), F.when(first, F.col("town")).otherwise(_blend(p, "t", "gt")).alias(temp),
                    F.when(first, F.col("sown")).otherwise(_blend(p, "s", "gs")).alias(salt))


def collect_gradients(clim: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The gradients as two 12 x 74 arrays: a climatology is 888 rows, whatever it was built from."""
    c = clim.select("month", "bin", F.col("dtdp").cast("double"), F.col("dsdp").cast("double")).where(
        F.col("month").between(1, 12) & F.col("bin").between(0, BINS - 1)).toPandas()
    out = np.full((2, 12, BINS), np.nan)
    for k, v in enumerate(("dtdp", "dsdp")):
        out[k, c["month"].to_numpy(int) - 1, c["bin"].to_numpy(int)] = c[v].to_numpy(float)
    return out[0], out[1]


def _at(table: np.ndarray, month: np.ndarray, temp: np.ndarray) -> np.ndarray:
    """The same lookup as :func:`lookup` on arrays."""
    pos = (temp - (BIN_EDGE + BIN_WIDTH / 2)) / BIN_WIDTH
    i = np.clip(np.ceil(np.nan_to_num(pos)).astype(int) - 1, 0, BINS - 2)
    a, b = table[month, i], table[month, i + 1]
    v = a + (b - a) * (pos - i)
    return np.where(pos < 0, table[month, 0], np.where(pos > BINS - 1, table[month, BINS - 1], v))


def _integrate(ends: DataFrame, keep: Sequence[str], tables: tuple[np.ndarray, np.ndarray], step: float,
               p_step: float | None) -> DataFrame:
    """Integrate from end sensors ``(p1, t1, s1, month, bound)`` to their bounds, many profiles at a time.

    The temperature path is the Euler recursion with the gradient at the running temperature; the values are
    the trapezoid integrals of the gradients along that path. Gives the knots, or with ``p_step`` the grid
    points beyond the sensor, linear between knots. Each row is on its own, so any partitioning will do.
    """
    gt, gs = tables
    keep = list(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            start, bound = pdf["p1"].to_numpy(float), pdf["bound"].to_numpy(float)
            month = pdf["month"].to_numpy(int) - 1
            sign, n = np.sign(bound - start), np.ceil(np.abs(bound - start) / step).astype(int)
            t, s = pdf["t1"].to_numpy(float), pdf["s1"].to_numpy(float)
            p, e, g, h = start, t, _at(gt, month, t), _at(gs, month, t)
            row = np.arange(len(pdf))
            pieces = [] if p_step else [(row, p, t, s)]
            for j in range(1, n.max(initial=0) + 1):
                on = n[row] >= j
                row, p, t, s, e, g, h = (x[on] for x in (row, p, t, s, e, g, h))
                p1 = np.where(j < n[row], start[row] + sign[row] * step * j, bound[row])
                dp = p1 - p
                e = e + g * dp
                g1, h1 = _at(gt, month[row], e), _at(gs, month[row], e)
                t1, s1 = t + 0.5 * (g + g1) * dp, s + 0.5 * (h + h1) * dp
                if p_step:
                    down = dp > 0
                    k0 = np.where(down, np.floor(p / p_step) + 1, np.ceil(p1 / p_step)).astype(int)
                    k1 = np.where(down, np.floor(p1 / p_step), np.ceil(p / p_step) - 1).astype(int)
                    m = np.maximum(k1 - k0 + 1, 0)
                    r = np.repeat(np.arange(len(row)), m)
                    q = (np.repeat(k0, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)) * p_step
                    u = (q - p[r]) / dp[r]
                    pieces.append((row[r], q, np.where(u == 1, t1[r], t[r] + (t1 - t)[r] * u), np.where(u == 1, s1[r], s[r] + (s1 - s)[r] * u)))
                else:
                    pieces.append((row, p1, t1, s1))
                p, t, s, g, h = p1, t1, s1, g1, h1
            if pieces:
                r, p, t, s = (np.concatenate(x) for x in zip(*pieces))
                yield pdf[keep].iloc[r].assign(p=p, t=t, s=s)

    types = dict(ends.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keep] + ["p double", "t double", "s double"])
    return ends.select(*keep, "p1", "t1", "s1", "month", "bound").mapInPandas(run, schema)


def _ends(pairs: DataFrame, time: str, p_top: float, p_bottom: float) -> DataFrame:
    """First and last sensor of each profile with the bounds to integrate to."""
    up = F.when((F.col("i") == 0) & (F.col("p1") > p_top), F.lit(float(p_top)))
    down = F.when(F.col("p2").isNull() & (F.col("p1") < p_bottom), F.lit(float(p_bottom)))
    d = pairs.where(up.isNotNull() | down.isNotNull()).withColumn("month", F.month(time))
    return d.withColumn("bound", F.explode(F.array_compact(F.array(up, down))))


def extrapolate_ends(df: DataFrame, clim: DataFrame, profile: Sequence[str], p_top: float = 0.0, p_bottom: float = 4980.0,
                     temp: str = "temp", salt: str = "salt", pres: str = "pres", time: str = "time", step: float = 20.0,
                     width: float | None = PRES_CHUNK) -> DataFrame:
    """Knots above the top and below the bottom sensor (the sensors themselves included)."""
    d = _ends(_ordered_pairs(df, profile, temp, salt, pres, time, width), time, p_top, p_bottom)
    d = d.withColumn("direction", F.when(F.col("bound") < F.col("p1"), "up").otherwise("down"))
    out = _integrate(d, [*profile, "direction"], collect_gradients(clim), step, None)
    return out.withColumnsRenamed({"p": pres, "t": temp, "s": salt})


def full_profiles(df: DataFrame, clim: DataFrame, profile: Sequence[str], temp: str = "temp", salt: str = "salt",
                  pres: str = "pres", time: str = "time", p_step: float = 20.0, p_max: float = 4980.0,
                  step: float = 20.0, extrapolate: bool = True, width: float | None = PRES_CHUNK) -> DataFrame:
    """Profiles on the grid ``0, p_step .. p_max`` with density; grid points without a value have no row.

    Each sensor row generates the grid points down to its successor, on the chord between the two knots
    around each point, so nothing is shuffled after the profile has been ordered.
    """
    tables = collect_gradients(clim)
    spark = df.sparkSession
    arrays = spark.createDataFrame(
        [(m + 1, *[[None if np.isnan(x) else float(x) for x in t[m]] for t in tables]) for m in range(12)],
        "month int, gt array<double>, gs array<double>")
    pairs = _ordered_pairs(df, profile, temp, salt, pres, time, width)
    d = _with_end_gradients(pairs.withColumn("month", F.month(time)).join(F.broadcast(arrays), "month"))
    top = int(p_max / p_step)
    hi = F.when(F.col("p2").isNull(), F.floor(F.col("p1") / p_step)).otherwise(F.ceil(F.col("p2") / p_step) - 1)
    d = explode_range(d, F.ceil(F.col("p1") / p_step), F.least(hi, F.lit(top)), "g")
    q = F.col("g") * F.lit(float(p_step))
    lo = F.col("p1") + F.floor((q - F.col("p1")) / step) * step
    up = F.least(lo + step, F.col("p2"))
    d = d.select("*", q.alias("q"), lo.alias("lo"), up.alias("hi"))

    def value(v: str, g: str) -> Column:
        a = F.when(F.col("lo") == F.col("p1"), F.col(f"{v}own")).otherwise(_blend(F.col("lo"), v, g))
        end = F.when(F.col(f"{g}1").isNotNull(), F.col(f"{v}2"))
        b = F.when(F.col("hi") == F.col("p2"), end).otherwise(_blend(F.col("hi"), v, g))
        w = (F.col("q") - F.col("lo")) / (F.col("hi") - F.col("lo"))
        return F.when(F.col("q") == F.col("lo"), a).otherwise(a + (b - a) * w)

    out = d.select(*profile, time, F.col("q").alias(pres), value("t", "gt").alias(temp), value("s", "gs").alias(salt))
    if extrapolate:
        e = _integrate(_ends(pairs, time, 0.0, p_max), [*profile, time], tables, step, p_step)
        out = out.unionByName(e.withColumnsRenamed({"p": pres, "t": temp, "s": salt}))
    return out.withColumn("sigma0", sigma0(F.col(salt), F.col(temp)))


def repair_pressure(df: DataFrame, group: str = "mooring", level: str = "level", t: str = "t_us", pres: str = "pres") -> DataFrame:
    """Fill partly missing pressure from the nearest complete level (ties: the deeper one).

    Quadratic fit of (neighbour - own) on the neighbour's pressure over the common times, from moment sums.
    """
    info = df.groupBy(group, level).agg(F.count(F.lit(1)).alias("n"), F.count(pres).alias("ok"), F.avg(pres).alias("mx"))
    full = F.col("ok") == F.col("n")
    info = ordered(info, [group], [level], None, last_valid={"__a": (F.col(level), full)}, next_valid={"__b": (F.col(level), full)})
    up, dn = F.col(level) - F.col("__a"), F.col("__b") - F.col(level)
    comp = F.when(F.col("__a").isNull() | (dn <= up), F.col("__b")).otherwise(F.col("__a"))
    part = info.where("ok > 0 AND ok < n").select(group, level, comp.alias("__comp")).where("__comp IS NOT NULL")
    means = info.select(group, F.col(level).alias("__comp"), F.col("mx").alias("__mx"))
    part = part.join(means, [group, "__comp"])
    own = attach(df.select(group, level, t, pres), part, [group, level])
    other = df.select(group, F.col(level).alias("__comp"), t, F.col(pres).alias("__pc"))
    j = own.join(other, [group, "__comp", t]).withColumn("__x", F.col("__pc") - F.col("__mx"))
    x, y = F.when(F.col(pres).isNotNull(), F.col("__x")), F.col("__pc") - F.col(pres)
    m = j.groupBy(group, level).agg(
        F.count(pres).alias("m0"), F.sum(x).alias("m1"), F.sum(x * x).alias("m2"), F.sum(x * x * x).alias("m3"),
        F.sum(x * x * x * x).alias("m4"), F.sum(y).alias("y0"), F.sum(x * y).alias("y1"), F.sum(x * x * y).alias("y2"))

    def det(a, b, c, d, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    m0, m1, m2, m3, m4 = (F.col(f"m{i}") for i in range(5))
    y0, y1, y2 = F.col("y0"), F.col("y1"), F.col("y2")
    den = det(m0, m1, m2, m1, m2, m3, m2, m3, m4)
    den = F.when(den != 0, den)
    m = m.select(group, level, (det(y0, m1, m2, y1, m2, m3, y2, m3, m4) / den).alias("c0"),
                 (det(m0, y0, m2, m1, y1, m3, m2, y2, m4) / den).alias("c1"),
                 (det(m0, m1, y0, m1, m2, y1, m2, m3, y2) / den).alias("c2"))
    fix = attach(j, m, [group, level]).where(F.col(pres).isNull()).select(
        group, level, t, (F.col("__pc") - (F.col("c0") + F.col("c1") * F.col("__x") + F.col("c2") * F.col("__x") * F.col("__x"))).alias("__fix"))
    return df.join(fix, [group, level, t], "left").withColumn(pres, F.coalesce(pres, "__fix")).drop("__fix")


def substitute_pressure(df: DataFrame, sensors: DataFrame, group: str = "mooring", level: str = "level", t: str = "t_us",
                        pres: str = "pres") -> DataFrame:
    """Fill fully missing pressure records.

    ``sensors`` has ``(group, level, depth, p0, waterdepth)``. With two complete records: the anomaly of the
    nearest plus a linear fit of the anomaly difference scaled by depth, on the start pressure ``p0``; with
    one, the sea bed stands in for the second; with none the start pressure alone.
    """
    info = df.groupBy(group, level).agg(F.count(F.lit(1)).alias("n"), F.count(pres).alias("ok"), F.avg(pres).alias("mp"))
    info = info.join(sensors, [group, level])
    full = F.col("ok") == F.col("n")
    s = F.struct(F.col(level).alias("lev"), F.col("depth").alias("d"), F.col("mp").alias("mp"))
    comp = ordered(info.where(full), [group], ["depth", level], None, lag={"__c2": s}, lead={"__c3": s})
    info = info.join(comp.select(group, level, "__c2", "__c3"), [group, level], "left")
    me = F.struct(F.col("__c2").alias("before"), s.alias("me"), F.col("__c3").alias("after"))
    info = ordered(info, [group], ["depth", level], None, last_valid={"__a": (me, full)}, next_valid={"__b": (me, full)})
    bad = info.where("ok = 0")
    cand = F.array_compact(F.array(F.col("__a.before"), F.col("__a.me"), F.col("__b.me"), F.col("__b.after")))
    near = F.array_sort(F.transform(cand, lambda c: F.struct(F.abs(c["d"] - F.col("depth")).alias("far"), c["lev"].alias("lev"),
                                                            c["d"].alias("d"), c["mp"].alias("mp"))))
    bad = bad.withColumn("__near", near).withColumns({"__n1": F.get("__near", F.lit(0)), "__n2": F.get("__near", F.lit(1))})
    d1, d2 = F.col("__n1.d"), F.coalesce(F.col("__n2.d"), F.col("waterdepth"))
    bad = bad.select(group, level, "p0", ((F.col("depth") - d1) / F.when(d2 != d1, d2 - d1)).alias("fac"),
                     F.col("__n1.lev").alias("l1"), F.col("__n1.mp").alias("mp1"), F.col("__n2.lev").alias("l2"), F.col("__n2.mp").alias("mp2"))
    rows = attach(df.select(group, level, t), bad, [group, level])
    p = df.select(group, F.col(level).alias("l1"), t, F.col(pres).alias("pa"))
    q = df.select(group, F.col(level).alias("l2"), t, F.col(pres).alias("pb"))
    rows = rows.join(p, [group, "l1", t], "left").join(q, [group, "l2", t], "left")
    a = F.col("pa") - F.col("mp1")
    b = F.when(F.col("l2").isNull() & F.col("l1").isNotNull(), F.lit(0.0)).otherwise(F.col("pb") - F.col("mp2"))
    rows = rows.withColumn("__x", a).withColumn("__y", b - a)
    fit = rows.groupBy(group, level).agg(F.regr_slope("__y", "__x").alias("sl"), F.regr_intercept("__y", "__x").alias("ic"))
    rows = attach(rows, fit, [group, level])
    val = F.when(F.col("l1").isNull(), F.col("p0")).otherwise(
        (F.col("ic") + F.col("sl") * F.col("__x")) * F.col("fac") + F.col("p0") + F.col("__x"))
    fix = rows.select(group, level, t, val.alias("__fix"))
    return df.join(fix, [group, level, t], "left").withColumn(pres, F.coalesce(pres, "__fix")).drop("__fix")


def fill_salinity(df: DataFrame, series: Sequence[str], temp: str = "temp", salt: str = "salt") -> DataFrame:
    """Missing salinity from the record's own linear relation to temperature."""
    ok = F.col(salt).isNotNull() & F.col(temp).isNotNull()
    fit = df.where(ok).groupBy(*series).agg(F.regr_slope(salt, temp).alias("__b"), F.regr_intercept(salt, temp).alias("__a"))
    d = attach(df, fit, series, "left")
    return d.withColumn(salt, F.coalesce(F.col(salt), F.col("__a") + F.col("__b") * F.col(temp))).drop("__a", "__b")


def grid_bounds(df: DataFrame, group: Sequence[str], step: float = 20.0, pres: str = "pres") -> DataFrame:
    """Pressure grid inside the observed range: rounded-up minimum to rounded-down maximum."""
    return df.groupBy(*group).agg((F.ceil(F.min(pres) / step) * step).cast("double").alias("p_min"),
                                  (F.floor(F.max(pres) / step) * step).cast("double").alias("p_max"))
