"""Clock shift, trimming, masking and regularising of instrument records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorspark.operators.ordered import RECORD, TIME_CHUNK, attach, explode_range, ordered, percentiles, unique

#: Fixed values that mark missing data: RODB, the older reader, and after calibration.
DUMMY_RODB = (-9999.0, -99.999, -999.999)
DUMMY_OLD = (1e32, -9.0, -9.9)
DUMMY_CALIBRATED = (-9.99e-29,)


def from_us(c: Column | str) -> Column:
    return F.timestamp_micros(F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def shift_clock(obs: DataFrame, instr: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Add the instrument's whole-second clock offset (missing: 0) to its sample times; ``keep`` more of its columns."""
    off = unique(instr, RECORD, "instrument table").select(*RECORD, *keep, F.coalesce(F.col("clock_offset").cast("long"), F.lit(0)).alias("__off"))
    d = obs.join(off, list(RECORD))
    return d.withColumn("t_us", F.col("t_us") + F.col("__off") * 1_000_000).withColumn(
        "time", F.expr("timestampadd(SECOND, __off, time)")).drop("__off")


def inside(time: Column, start: Column, end: Column) -> Column:
    """Inclusive window; a null bound leaves that side open."""
    return (start.isNull() | (time >= start)) & (end.isNull() | (time <= end))


def trim(obs: DataFrame, deploy: DataFrame) -> DataFrame:
    """Keep samples inside the mooring's deployment window."""
    win = deploy.select("mooring", "deployment_time", "recovery_time")
    return obs.join(win, "mooring").where(
        inside(F.col("time"), F.col("deployment_time"), F.col("recovery_time"))
    ).drop("deployment_time", "recovery_time")


def shift_and_trim(obs: DataFrame, instr: DataFrame, deploy: DataFrame) -> DataFrame:
    """Stage 2: attach the instrument's depth and name, shift the clock, then trim.

    Samples without a configured instrument or mooring are not here but in :func:`quarantine`.
    """
    return trim(shift_clock(obs, instr, keep=("depth", "instrument")), deploy)


def quarantine(obs: DataFrame, instr: DataFrame, deploy: DataFrame) -> DataFrame:
    """The samples that :func:`shift_and_trim` cannot place, with the ``reason``: no instrument or no deployment in the configuration.

    A null mooring or serial is not configured. With the kept and the trimmed samples these are all samples.
    """
    known = instr.select(*RECORD).distinct().withColumn("__known", F.lit(True))
    sent = deploy.select("mooring").distinct().withColumn("__sent", F.lit(True))
    d = obs.join(known, list(RECORD), "left").join(sent, "mooring", "left")
    reason = F.when(F.col("__known").isNull(), "no instrument").when(F.col("__sent").isNull(), "no deployment")
    return d.select(*obs.columns, reason.alias("reason")).where("reason IS NOT NULL")


def within_bounds(obs: DataFrame, instr: DataFrame, deploy: DataFrame) -> DataFrame:
    """``obs`` without samples that no deployment window can hold, by a filter on ``time`` that reaches the scan.

    Two numbers come to the driver: the earliest start less the largest clock offset, and the latest end less the smallest.
    A mooring without start or end leaves that side open. Samples of moorings that are not configured go too.
    """
    offset = F.coalesce(F.col("clock_offset").cast("long"), F.lit(0))
    o = instr.groupBy("mooring").agg(F.max(offset).alias("__late"), F.min(offset).alias("__early"))
    d = deploy.join(o, "mooring").select(F.expr("timestampadd(SECOND, -__late, deployment_time)").alias("a"), F.expr("timestampadd(SECOND, -__early, recovery_time)").alias("b"))
    n, na, nb, lo, hi = d.agg(F.count("*"), F.count("a"), F.count("b"), F.min("a"), F.max("b")).first()
    if n and na == n:
        obs = obs.where(F.col("time") >= F.lit(lo))
    if n and nb == n:
        obs = obs.where(F.col("time") <= F.lit(hi))
    return obs


def parse_time(text: Column) -> Column:
    """Lenient time parsing: missing, blank or invalid text gives null."""
    return F.trim(text).try_cast("timestamp_ntz")


def regularise(df: DataFrame, series: Sequence[str], values: Sequence[str], t: str = "t_us",
               width: int = TIME_CHUNK) -> DataFrame:
    """Reindex each record onto its own regular axis by exact match.

    The step is the whole-second median interval; samples off the axis are lost and empty slots are null.
    A record with one sample is returned as it is.
    """
    lead = {"__tn": F.col(t)}
    d = ordered(df.select(*series, t, *values), series, [t], width, lead=lead)
    step = percentiles(d, series, F.floor((F.col("__tn") - F.col(t)) / 1_000_000), {"__med": 0.5})
    first = df.groupBy(*series).agg(F.min(t).alias("__t0"))
    d = attach(d, first.join(step, list(series), "left"), series)
    us = F.floor("__med").cast("long") * 1_000_000
    d = d.withColumn("__s", F.when(us > 0, us))
    rel, nxt = F.col(t) - F.col("__t0"), F.col("__tn") - F.col("__t0")
    k0 = F.coalesce(F.ceil(rel / F.col("__s")), F.lit(0))
    k1 = F.when(F.col("__tn").isNull(), k0).otherwise(F.ceil(nxt / F.col("__s")) - 1)
    d = explode_range(d, k0, k1, "__k")
    slot = F.col("__t0") + F.col("__k") * F.coalesce("__s", F.lit(0))
    hit = F.col(t) == slot
    return d.select(*series, slot.alias(t), *[F.when(hit, F.col(v)).alias(v) for v in values])


def null_intervals(df: DataFrame, intervals: DataFrame, key: str, values: Sequence[str], t: str = "t_us",
                   span: int = 86_400_000_000) -> DataFrame:
    """Null values of ``var`` inside closed intervals ``(key, var, t0, t1)``.

    Intervals are cut at day borders and gathered per (key, day), so the join is an
    equality join and a record of any length is spread over its days.
    """
    day = F.floor(F.col(t) / span)
    iv = explode_range(intervals, F.floor(F.col("t0") / span), F.floor(F.col("t1") / span), "__day")
    iv = iv.select(key, "__day", "var", F.greatest(F.col("t0"), F.col("__day") * span).alias("t0"),
                   F.least(F.col("t1"), (F.col("__day") + 1) * span - 1).alias("t1"))
    iv = iv.groupBy(key, "__day").agg(F.collect_set(F.struct("var", "t0", "t1")).alias("__iv"))
    d = df.withColumn("__day", day).join(iv, [key, "__day"], "left")

    def covers(name: str):
        return lambda s: (s["var"] == name) & (F.col(t) >= s["t0"]) & (F.col(t) <= s["t1"])

    for v in values:
        d = d.withColumn(v, F.when(~F.coalesce(F.exists("__iv", covers(v)), F.lit(False)), F.col(v)))
    return d.drop("__day", "__iv")


def null_dummies(df: DataFrame, values: Sequence[str], dummies: Sequence[float] = DUMMY_RODB) -> DataFrame:
    """Replace dummy values (and NaN) by null."""
    for v in values:
        c = F.nanvl(F.col(v), F.lit(None).cast("double"))
        df = df.withColumn(v, F.when(~c.isin(list(dummies)), c))
    return df


def in_box(df: DataFrame, lat: tuple[float, float], lon: tuple[float, float] | None = None) -> DataFrame:
    """Rows inside the inclusive latitude/longitude box."""
    df = df.where(F.col("lat").between(*lat))
    return df.where(F.col("lon").between(*lon)) if lon else df


def emptied_instruments(instr: DataFrame, used: DataFrame) -> DataFrame:
    """Configured instruments with no sample left after the trim."""
    return instr.join(used.select(*RECORD).distinct(), list(RECORD), "left_anti")


def variable_stats(df: DataFrame, series: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Valid count, mean, population std, min and max per record and variable."""
    stack = ", ".join(f"'{v}', CAST({v} AS DOUBLE)" for v in values)
    d = df.selectExpr(*series, f"stack({len(values)}, {stack}) AS (var, v)")
    return d.groupBy(*series, "var").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"),
        F.min("v").alias("vmin"), F.max("v").alias("vmax"))


def apply_flags(df: DataFrame, value: str, flag: str, good: int = 1) -> DataFrame:
    """Mask values whose flag is not the good one."""
    return df.withColumn(value, F.when(F.col(flag) == good, F.col(value)))
