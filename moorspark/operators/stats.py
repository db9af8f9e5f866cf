"""Sampling, timing and distribution statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moorspark.operators.ordered import RECORD, TIME_CHUNK, attach, ordered, percentiles, percentiles_of_counts, value_counts


def sampling_stats(obs: DataFrame, series: Sequence[str], t: str = "t_us", width: int = TIME_CHUNK) -> DataFrame:
    """Count, first and last time, and median/min/max/std (population) of the interval in minutes.

    Records with fewer than two samples are skipped.
    """
    series = list(series)
    base = obs.groupBy(*series).agg(F.count(F.lit(1)).alias("n"), F.min(t).alias("start_us"), F.max(t).alias("end_us")).where("n > 1")
    d = ordered(obs.select(*series, t), series, [t], width, lag={"__p": F.col(t)})
    v = value_counts(d, series, (F.col(t) - F.col("__p")) / 60e6)
    med = percentiles_of_counts(v, series, {"median_dt": 0.5})
    mean = (F.col("end_us") - F.col("start_us")) / (F.col("n") - 1) / 60e6
    far = F.col("__qv") - mean
    spread = v.join(base, series).groupBy(*series, "n", "start_us", "end_us").agg(
        F.min("__qv").alias("min_dt"), F.max("__qv").alias("max_dt"),
        F.sqrt(F.sum(F.col("__qc") * far * far) / F.sum("__qc")).alias("std_dt"))
    return spread.join(med, series)


def timing_report(stats: DataFrame, group: str = "mooring") -> DataFrame:
    """Compare each record's sampling with the common step of its mooring.

    One row per record here, so the second-level median is a plain exact ``percentile``.
    """
    common = stats.groupBy(group).agg(
        F.percentile("median_dt", F.lit(0.5)).alias("common_dt"),
        (F.max("median_dt") / F.min("median_dt") > 2).alias("rate_warning"))
    d = attach(stats, common, [group])
    change = F.abs(F.col("median_dt") - F.col("common_dt")) / F.col("median_dt") * 100
    return d.withColumn("irregular", F.col("std_dt") > 0.1 * F.col("median_dt")).withColumn(
        "change", F.when(change > 10, "SIGNIFICANT").when(change > 1, "MINOR").otherwise("MINIMAL"))


def middle_bounds(df: DataFrame, series: Sequence[str], value: str, percent: float = 95.0) -> DataFrame:
    """Bounds of the middle ``percent`` of the values."""
    if not 0 < percent < 100:
        raise ValueError("percent must lie between 0 and 100")
    p = (100 - percent) / 200
    return percentiles(df, series, F.col(value), {"lo": p, "hi": 1 - p})


def middle_stats(df: DataFrame, series: Sequence[str], value: str, percent: float = 95.0) -> DataFrame:
    """Mean and population std of the values within the middle bounds."""
    d = attach(df.select(*series, value), middle_bounds(df, series, value, percent), series)
    v = F.when(F.col(value).between(F.col("lo"), F.col("hi")), F.col(value))
    return d.groupBy(*series).agg(F.avg(v).alias("mid_mean"), F.stddev_pop(v).alias("mid_std"))


def normalise(df: DataFrame, series: Sequence[str], values: Sequence[str], percent: float = 95.0) -> DataFrame:
    """``z_<value>`` = (v - mid_mean) / mid_std; zero std raises, an all-null variable stays null."""
    for v in values:
        st = middle_stats(df.where(F.col(v).isNotNull()), series, v, percent)
        st = st.withColumnsRenamed({"mid_mean": "__m", "mid_std": "__s"})
        sd = F.when(F.col("__s") == 0, F.raise_error(F.lit(f"zero standard deviation of {v}"))).otherwise(
            F.col("__s"))
        df = attach(df, st, series, "left").withColumn(f"z_{v}", (F.col(v) - F.col("__m")) / sd).drop("__m", "__s")
    return df


def histogram(df: DataFrame, series: Sequence[str], value: str, nbins: int = 30) -> DataFrame:
    """Equal-width counts ``(series, bin, n, lo, width)`` of the bins that hold values; last bin closed."""
    d = df.where(F.col(value).isNotNull())
    rng = d.groupBy(*series).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    same = F.col("__lo") == F.col("__hi")
    rng = rng.select(*series, F.when(same, F.col("__lo") - 0.5).otherwise(F.col("__lo")).alias("lo"),
                     F.when(same, F.lit(1.0)).otherwise(F.col("__hi") - F.col("__lo")).alias("range"))
    d = attach(d.select(*series, value), rng, series)
    b = F.least(F.floor((F.col(value) - F.col("lo")) / F.col("range") * nbins), F.lit(nbins - 1)).cast("int")
    return d.groupBy(*series, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), (F.min("range") / nbins).alias("width"))


def histogram_split(df: DataFrame, series: Sequence[str], value: str, nbins: int = 30) -> DataFrame:
    """Left edge of the emptiest bin between the first two histogram peaks; null below two peaks.

    A flat peak counts once at its floor-middle bin, end bins are never peaks.
    """
    h = histogram(df, series, value, nbins)
    # nbins counts per record, a fixed-size array
    m = F.map_from_entries(F.collect_list(F.struct("bin", "n")))
    a = h.groupBy(*series).agg(m.alias("m"), F.min("lo").alias("lo"), F.min("width").alias("width"))
    cnt = F.transform(F.sequence(F.lit(0), F.lit(nbins - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)))
    a = a.withColumn("c", cnt)

    def plateau_end(i: Column) -> Column:
        """Last bin of the run of equal counts that starts at ``i``."""
        after = F.filter(F.sequence(i, F.lit(nbins - 1)), lambda j: F.get("c", j) != F.get("c", i))
        return F.coalesce(F.array_min(after) - 1, F.lit(nbins - 1))

    starts = F.filter(
        F.sequence(F.lit(1), F.lit(nbins - 2)),
        lambda i: (F.get("c", i) > F.get("c", i - 1)) & (plateau_end(i) < nbins - 1)
        & (F.get("c", plateau_end(i) + 1) < F.get("c", i)))
    peaks = F.transform(starts, lambda i: F.floor((i + plateau_end(i)) / 2).cast("int"))
    a = a.withColumn("p", peaks).withColumn("p1", F.get("p", F.lit(0))).withColumn("p2", F.get("p", F.lit(1)))
    valley = F.array_min(F.transform(
        F.sequence(F.col("p1"), F.col("p2") - 1),
        lambda j: F.struct(F.get("c", j).alias("n"), j.alias("bin"))))["bin"]
    split = F.when(F.col("p2").isNotNull(), F.col("lo") + valley * F.col("width"))
    return a.select(*series, split.alias("split_value"))


def climatology_ranges(df: DataFrame, level: Sequence[str], value: str, k: float = 3.0) -> DataFrame:
    """QC range per level: mean -/+ k population standard deviations, rounded to 2 digits."""
    a = df.groupBy(*level).agg(F.avg(value).alias("m"), F.stddev_pop(value).alias("s"))
    return a.select(*level, F.round(F.col("m") - k * F.col("s"), 2).alias("vmin"),
                    F.round(F.col("m") + k * F.col("s"), 2).alias("vmax"))


def flag_summary(df: DataFrame, series: Sequence[str], flag: str) -> DataFrame:
    """Count and percentage of each flag value per record."""
    c = df.groupBy(*series, flag).agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy(*series))
    return c.withColumn("percent", 100.0 * F.col("n") / tot)


def batch_report(instr: DataFrame, processed: DataFrame, group: str = "mooring") -> DataFrame:
    """Processed and total instruments per mooring; success when any was processed."""
    ok = processed.select(*RECORD).distinct().withColumn("__ok", F.lit(1))
    d = instr.join(ok, list(RECORD), "left").groupBy(group).agg(
        F.count(F.lit(1)).alias("total"), F.sum(F.coalesce("__ok", F.lit(0))).alias("processed"))
    return d.withColumn("success", F.col("processed") > 0)


def sensor_map(instr: DataFrame, variables: DataFrame, group: str = "mooring") -> DataFrame:
    """Per mooring and depth the comma list of sensor variables, with the serials of that depth."""
    return instr.join(variables, "instrument").groupBy(group, "depth").agg(
        F.array_join(F.sort_array(F.collect_set("var")), ", ").alias("vars"),
        F.array_join(F.transform(F.sort_array(F.collect_set("serial")), lambda s: s.cast("string")), ",")
        .alias("serials"))


def stacked_attributes(sensors: DataFrame, group: str = "mooring") -> DataFrame:
    """Attributes of a stacked mooring from per-sensor rows ``(mooring, platform, deployment, depth, source)``.

    Comma lists in ``source`` are split, the distinct file names sorted.
    """
    f = sensors.withColumn("__f", F.explode(F.split("source", ",\\s*")))
    files = f.groupBy(group).agg(F.array_join(F.sort_array(F.collect_set("__f")), ", ").alias("source"))
    a = sensors.groupBy(group).agg(
        F.min("depth").alias("geospatial_vertical_min"), F.max("depth").alias("geospatial_vertical_max"),
        F.min("platform").alias("platform"), F.min("deployment").alias("deployment"))
    return a.join(files, group).select(
        group, F.format_string("Time series from %s_%s", "platform", "deployment").alias("title"),
        F.format_string("OS_%s_%s_P", "platform", "deployment").alias("id"),
        "geospatial_vertical_min", "geospatial_vertical_max", "source")


def sampling_text(median_minutes: Column) -> Column:
    """``10 min`` above one minute, else seconds."""
    return F.when(median_minutes.isNull(), F.lit(None).cast("string")).when(
        median_minutes > 1, F.concat(F.round(median_minutes).cast("long").cast("string"), F.lit(" min"))
    ).otherwise(F.concat(F.round(median_minutes * 60).cast("long").cast("string"), F.lit(" sec")))


def coverage_table(instr: DataFrame, stats: DataFrame, variables: DataFrame) -> DataFrame:
    """One row per configured instrument; those without data are ``MISSING``."""
    s = stats.select(*RECORD, "n", "start_us", "end_us", "median_dt")
    v = variables.groupBy("instrument").agg(F.array_join(F.sort_array(F.collect_set("var")), ", ").alias("vars"))
    d = instr.join(s, list(RECORD), "left").join(v, "instrument", "left")
    return d.select(
        "mooring", "serial", "instrument", "depth",
        F.when(F.col("n").isNull(), "MISSING").otherwise("OK").alias("status"),
        F.coalesce("n", F.lit(0)).cast("long").alias("points"), "start_us", "end_us",
        sampling_text(F.col("median_dt")).alias("sampling"),
        F.when(F.col("n").isNotNull(), F.col("vars")).alias("vars"))


def percentile_limits(df: DataFrame, values: Sequence[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Percentile limits per variable over all levels."""
    stack = ", ".join(f"'{v}', CAST({v} AS DOUBLE)" for v in values)
    d = df.selectExpr(f"stack({len(values)}, {stack}) AS (var, v)")
    return percentiles(d, ["var"], F.col("v"), {"lo": lo, "hi": hi})
