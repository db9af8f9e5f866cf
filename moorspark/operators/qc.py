"""Automatic quality control: boolean checks, flag tests, rollup and de-spiking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorspark.functions.flags import FAIL, GOOD, MISSING, NOT_EVALUATED, SUSPECT, rollup
from moorspark.functions.seawater import with_salinity
from moorspark.operators.ordered import attach, ordered, percentiles, TIME_CHUNK, trailing_extremes
from moorspark.operators.stats import normalise


def salinity_outlier(df: DataFrame, level: Sequence[str], salt: str, n_std: float = 4.0, flag: str | None = None,
                     out: str = "outlier") -> DataFrame:
    """True outside mean -/+ n population std of the level; statistics over rows with flag 0 if a flag is given."""
    v = F.when(F.col(flag) == 0, F.col(salt)) if flag else F.col(salt)
    st = df.groupBy(*level).agg(F.avg(v).alias("__m"), F.stddev_pop(v).alias("__s"))
    d = attach(df, st, level)
    bad = F.abs(F.col(salt) - F.col("__m")) > n_std * F.col("__s")
    return d.withColumn(out, F.coalesce(bad, F.lit(False))).drop("__m", "__s")


def temporal_spike(df: DataFrame, level: Sequence[str], value: str, threshold: float = 5.0, t: str = "t_us",
                   width: float = TIME_CHUNK, out: str = "spike") -> DataFrame:
    """True where the value differs from the previous one by more than the threshold."""
    d = ordered(df, level, [t], width, lag={"__p": F.col(value)})
    return d.withColumn(out, F.coalesce(F.abs(F.col(value) - F.col("__p")) > threshold, F.lit(False))).drop("__p")


def vertical_inconsistency(df: DataFrame, profile: Sequence[str], value: str, threshold: float = 2.0,
                           level: str = "level", out: str = "inconsistent") -> DataFrame:
    """True where the value differs from that of the next shallower level by more than the threshold."""
    d = ordered(df, profile, [level], None, lag={"__p": F.col(value)})
    return d.withColumn(out, F.coalesce(F.abs(F.col(value) - F.col("__p")) > threshold, F.lit(False))).drop("__p")


def combined_qc(df: DataFrame, level: Sequence[str], c: str = "conductivity", t: str = "temperature", p: str = "pressure",
                salt: str = "salinity", axis: str = "t_us", width: float = TIME_CHUNK) -> DataFrame:
    """Two-pass salinity outliers (6, then 3 std over rows good in pass one) or conductivity spikes."""
    d = temporal_spike(with_salinity(df, c, t, p, salt), level, c, 5.0, axis, width, "__spike")
    d = salinity_outlier(d, level, salt, 6.0, out="__o")
    d = d.withColumn("__f", (F.col("__o") | F.col("__spike")).cast("int"))
    d = salinity_outlier(d, level, salt, 3.0, "__f", "__o2")
    return d.withColumn(f"{c}_qc", (F.col("__o2") | F.col("__spike")).cast("int")).drop("__o", "__o2", "__f", "__spike")


def gross_range(v: Column, suspect: tuple[float, float], fail: tuple[float, float]) -> Column:
    return F.when(v.isNull(), MISSING).when(~v.between(*fail), FAIL).when(~v.between(*suspect), SUSPECT).otherwise(GOOD)


def spike_flag(v: Column, prev: Column, nxt: Column, suspect: float, fail: float) -> Column:
    """Distance from the mean of both neighbours; a missing neighbour gives not evaluated."""
    dev = F.abs(v - (prev + nxt) / 2)
    return (F.when(v.isNull(), MISSING).when(dev.isNull(), NOT_EVALUATED).when(dev > fail, FAIL)
            .when(dev > suspect, SUSPECT).otherwise(GOOD))


def climatology_flag(v: Column, time: Column, depth: Column, spans: Sequence[dict]) -> Column:
    """Value range by time and depth span; later spans win, a sample no span covers is not evaluated."""
    flag: Column = F.lit(NOT_EVALUATED)
    for s in spans:
        t0, t1 = (F.lit(x).cast("timestamp_ntz") for x in s["tspan"])
        cover = (time >= t0) & (time <= t1) & depth.between(*s["zspan"])
        flag = F.when(cover, F.when(v.between(*s["vspan"]), GOOD).otherwise(SUSPECT)).otherwise(flag)
    return F.when(v.isNull(), MISSING).otherwise(flag)


def climatology_flag_by_level(df: DataFrame, ranges: DataFrame, level: Sequence[str], value: str, out: str) -> DataFrame:
    """The same test against a table of ranges per level (see ``climatology_ranges``)."""
    r = ranges.select(*level, F.col("vmin").alias("__lo"), F.col("vmax").alias("__hi"))
    v = F.col(value)
    f = (F.when(v.isNull(), MISSING).when(F.col("__lo").isNull(), NOT_EVALUATED)
         .when(v.between(F.col("__lo"), F.col("__hi")), GOOD).otherwise(SUSPECT))
    return attach(df, r, level, "left").withColumn(out, f).drop("__lo", "__hi")


def location_flag(lon: Column, lat: Column, bbox: tuple[float, float, float, float]) -> Column:
    x0, x1, y0, y1 = bbox
    return F.when(lon.isNull() | lat.isNull(), MISSING).when(lon.between(x0, x1) & lat.between(y0, y1), GOOD).otherwise(FAIL)


def rate_flag(v: Column, prev: Column, dt_seconds: Column, threshold: float) -> Column:
    rate = F.abs(v - prev) / F.when(dt_seconds > 0, dt_seconds)
    return F.when(v.isNull(), MISSING).when(rate.isNull(), NOT_EVALUATED).when(rate > threshold, SUSPECT).otherwise(GOOD)


def flat_line(df: DataFrame, series: Sequence[str], value: str, tolerance: float, suspect_s: int, fail_s: int,
              t: str = "t_us", out: str = "flat") -> DataFrame:
    """Range over the trailing duration below the tolerance: suspect, or fail for the longer one.

    Windows that reach back beyond the start of the record do not count.
    """
    first = df.groupBy(*series).agg(F.min(t).alias("__t0"))
    d = attach(df, first, series)
    for name, sec in (("__a", suspect_s), ("__b", fail_s)):
        us = int(sec * 1_000_000)
        d = trailing_extremes(d, series, t, us, F.col(value), "__lo", "__hi")
        d = d.withColumn(name, (F.col("__hi") - F.col("__lo") < tolerance) & (F.col(t) - F.col("__t0") >= us)).drop("__lo", "__hi")
    f = F.when(F.col(value).isNull(), MISSING).when(F.col("__b"), FAIL).when(F.col("__a"), SUSPECT).otherwise(GOOD)
    return d.withColumn(out, f).drop("__t0", "__a", "__b")


def ts_flag(df: DataFrame, series: Sequence[str], temp: str, salt: str, k: float = 3.0, out: str = "ts") -> DataFrame:
    """Salinity further than k residual std from the record's linear relation to temperature."""
    both = df.where(F.col(temp).isNotNull() & F.col(salt).isNotNull())
    fit = both.groupBy(*series).agg(
        F.regr_slope(salt, temp).alias("__b"), F.regr_intercept(salt, temp).alias("__a"),
        F.sqrt(F.var_pop(salt) * (1 - F.regr_r2(salt, temp))).alias("__s"))
    d = attach(df, fit, series, "left")
    r = F.abs(F.col(salt) - F.col("__a") - F.col("__b") * F.col(temp))
    f = F.when(F.col(salt).isNull() | F.col(temp).isNull(), MISSING).when(r.isNull(), NOT_EVALUATED).when(
        r > k * F.col("__s"), SUSPECT).otherwise(GOOD)
    return d.withColumn(out, f).drop("__a", "__b", "__s")


def vertical_neighbours(df: DataFrame, profile: Sequence[str], value: str, level: str = "level") -> DataFrame:
    """Value of the next shallower (``above``) and next deeper (``below``) level."""
    return ordered(df, profile, [level], None, lag={"above": F.col(value)}, lead={"below": F.col(value)})


def neighbour_flag(df: DataFrame, level: Sequence[str], profile: Sequence[str], value: str, threshold: float,
                   order: str = "level", out: str = "neighbour", percent: float = 95.0) -> DataFrame:
    """Normalised value against the mean of its vertical neighbours."""
    d = vertical_neighbours(normalise(df, level, [value], percent), profile, f"z_{value}", order)
    a, b = F.col("above"), F.col("below")
    mean = F.when(a.isNotNull() & b.isNotNull(), (a + b) / 2).otherwise(F.coalesce(a, b))
    z = F.col(f"z_{value}")
    f = F.when(z.isNull(), MISSING).when(mean.isNull(), NOT_EVALUATED).when(F.abs(z - mean) > threshold, SUSPECT).otherwise(GOOD)
    return d.withColumn(out, f).drop("above", "below", f"z_{value}")


def class_despike(df: DataFrame, series: Sequence[str], temp: str, salt: str, classes: int = 14, k: float = 6.0) -> DataFrame:
    """Null salinity beyond median -/+ k sample std of its temperature class.

    A class with fewer than three points uses the std of the class before it.
    """
    series = list(series)
    ok = F.col(temp).isNotNull() & F.col(salt).isNotNull()
    rng = df.where(ok).groupBy(*series).agg(F.min(temp).alias("__lo"), F.max(temp).alias("__hi"))
    d = attach(df, rng, series, "left")
    w = (F.col("__hi") - F.col("__lo")) / classes
    pos = F.when(w > 0, F.floor((F.col(temp) - F.col("__lo")) / F.when(w > 0, w))).otherwise(0)
    d = d.withColumn("__c", F.when(ok, F.least(pos, F.lit(classes - 1)).cast("int")))
    part = [*series, "__c"]
    med = percentiles(d.where(ok), part, F.col(salt), {"__med": 0.5})
    sd = d.where(ok).groupBy(*part).agg(F.count(F.lit(1)).alias("__n"), F.stddev_samp(salt).alias("__sd"))
    sd = sd.withColumn("__c", F.col("__c").cast("int"))
    sd = ordered(sd, series, ["__c"], None, last_valid={"__use": (F.col("__sd"), F.col("__n") >= 3)}).join(med, part)
    d = attach(d, sd.select(*part, "__use", "__med"), part, "left")
    far = F.abs(F.col(salt) - F.col("__med")) > k * F.col("__use")
    return d.withColumn(salt, F.when(~F.coalesce(far, F.lit(False)), F.col(salt))).drop("__lo", "__hi", "__c", "__use", "__med")


def iterative_despike(df: DataFrame, series: Sequence[str], temp: str, salt: str, bounds: dict[str, tuple[float, float]],
                      k: float = 4.0, passes: int = 5) -> DataFrame:
    """Absolute bounds, then ``passes`` rounds of mean -/+ k std; a removed salinity removes its temperature.

    Only the bounds per record go from one round to the next, so the samples are read once per round.
    """
    series = list(series)
    lim = df.groupBy(*series).agg(F.lit(float(bounds[temp][0])).alias("t0"), F.lit(float(bounds[temp][1])).alias("t1"),
                                  F.lit(float(bounds[salt][0])).alias("s0"), F.lit(float(bounds[salt][1])).alias("s1"))
    s, t = F.col(salt), F.col(temp)
    kept_s = F.when(s.between(F.col("s0"), F.col("s1")), s)
    kept_t = F.when(t.between(F.col("t0"), F.col("t1")) & (s.isNull() | kept_s.isNotNull()), t)
    base = df.select(*series, temp, salt)
    for _ in range(passes):
        a = attach(base, lim, series).select(*series, "t0", "t1", "s0", "s1", kept_t.alias("__t"), kept_s.alias("__s"))
        a = a.groupBy(*series).agg(
            *[F.min(c).alias(c) for c in ("t0", "t1", "s0", "s1")], F.avg("__t").alias("tm"), F.stddev_pop("__t").alias("td"),
            F.avg("__s").alias("sm"), F.stddev_pop("__s").alias("sd"))
        lim = a.select(
            *series, F.greatest("t0", F.col("tm") - k * F.col("td")).alias("t0"), F.least("t1", F.col("tm") + k * F.col("td")).alias("t1"),
            F.greatest("s0", F.col("sm") - k * F.col("sd")).alias("s0"), F.least("s1", F.col("sm") + k * F.col("sd")).alias("s1"))
    d = attach(df, lim, series).withColumn("__t", kept_t).withColumn("__s", kept_s)
    return d.drop(temp, salt, "t0", "t1", "s0", "s1").withColumnsRenamed({"__t": temp, "__s": salt})


def failure_diagnosis(df: DataFrame, tests: Sequence[str], rollup_col: str = "qc_rollup") -> DataFrame:
    """Rows whose rollup fails, with the names of the failing tests."""
    names = F.array_compact(F.array(*[F.when(F.col(c) == FAIL, F.lit(c)) for c in tests]))
    return df.where(F.col(rollup_col) == FAIL).withColumn("failed_tests", F.array_join(names, ", "))


def run_tests(df: DataFrame, series: Sequence[str], config: Sequence[dict], t: str = "t_us", time: str = "time",
              depth: str = "depth", width: float = TIME_CHUNK) -> DataFrame:
    """Run a table of tests ``{test, var, ...parameters}``; adds one flag column per entry and the rollup.

    Neighbours of all tested variables come from one pass over the record.
    """
    vs = sorted({c["var"] for c in config if c["test"] in ("spike", "rate_of_change")})
    d = df
    if vs:
        d = ordered(df, series, [t], width, lag={"__tp": F.col(t), **{f"__p_{v}": F.col(v) for v in vs}},
                    lead={f"__n_{v}": F.col(v) for v in vs})
    names = []
    for c in config:
        v, name = F.col(c["var"]), f"{c['var']}_{c['test']}"
        names.append(name)
        if c["test"] == "gross_range":
            d = d.withColumn(name, gross_range(v, tuple(c["suspect_span"]), tuple(c["fail_span"])))
        elif c["test"] == "spike":
            d = d.withColumn(name, spike_flag(v, F.col(f"__p_{c['var']}"), F.col(f"__n_{c['var']}"), c["suspect_threshold"], c["fail_threshold"]))
        elif c["test"] == "rate_of_change":
            dt = (F.col(t) - F.col("__tp")) / 1e6
            d = d.withColumn(name, rate_flag(v, F.col(f"__p_{c['var']}"), dt, c["threshold"]))
        elif c["test"] == "climatology":
            d = d.withColumn(name, climatology_flag(v, F.col(time), F.col(depth), c["ranges"]))
        elif c["test"] == "location":
            d = d.withColumn(name, location_flag(F.col("lon"), F.col("lat"), tuple(c["bbox"])))
        elif c["test"] == "flat_line":
            d = flat_line(d, series, c["var"], c["tolerance"], c["suspect_seconds"], c["fail_seconds"], t, name)
        else:
            raise ValueError(f"unknown test {c['test']!r}")
    d = d.withColumn("qc_rollup", rollup(*[F.col(n) for n in names]))
    return d.drop("__tp", *[f"__{s}_{v}" for v in vs for s in "pn"])
