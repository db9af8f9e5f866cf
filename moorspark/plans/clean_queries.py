"""Queries of the cleaning operators."""

from pyspark.sql import functions as F

from moorspark.operators import clean
from moorspark.plans.registry import q6, query, r6
from moorspark.plans.standin import calib, deploy, instr, obs, oracle, prof, stage2

_HOUR = 3_600_000_000


@query("c1_clock_shift", oracle(
    "obs instr", "SELECT event_id, o.serial, t_us + clock_offset * 1000000 AS t_us,"
    " epoch_us(time + clock_offset * INTERVAL '1' SECOND) AS shifted_us FROM obs o JOIN instr i ON o.serial = i.serial AND o.mooring = i.mooring"))
def _(spark, sf):
    d = clean.shift_clock(obs(spark, sf), instr(spark, sf))
    return d.select("event_id", "serial", "t_us", F.unix_micros(F.col("time").cast("timestamp")).alias("shifted_us"))


@query("c2_trim_window", oracle("stage2", f"SELECT event_id, serial, mooring, t_us, {q6('temp', 'cond', 'pres')} FROM stage2"))
def _(spark, sf):
    return stage2(spark, sf).select("event_id", "serial", "mooring", "t_us", *[r6(c).alias(c) for c in ("temp", "cond", "pres")])


_KNOWN = ("ki AS (SELECT * FROM instr WHERE serial % 5 <> 3), kd AS (SELECT * FROM deploy WHERE mooring <> 2)")


@query("c2_quarantine", oracle("obs instr deploy", """SELECT event_id, o.serial, o.mooring,
 CASE WHEN i.serial IS NULL THEN 'no instrument' ELSE 'no deployment' END AS reason FROM obs o LEFT JOIN ki i ON i.serial = o.serial AND i.mooring = o.mooring
 LEFT JOIN kd d ON d.mooring = o.mooring WHERE i.serial IS NULL OR d.mooring IS NULL""", _KNOWN))
def _(spark, sf):
    # all samples, against a configuration with gaps
    d = clean.quarantine(obs(spark, sf), instr(spark, sf).where("serial % 5 <> 3"), deploy(spark, sf).where("mooring <> 2"))
    return d.select("event_id", "serial", "mooring", "reason")


@query("c2_bounded_trim", oracle("stage2", f"SELECT event_id, serial, mooring, t_us, {q6('temp', 'cond', 'pres')} FROM stage2"))
def _(spark, sf):
    i, d = instr(spark, sf), deploy(spark, sf)
    kept = clean.shift_and_trim(clean.within_bounds(obs(spark, sf), i, d), i, d)
    return kept.select("event_id", "serial", "mooring", "t_us", *[r6(c).alias(c) for c in ("temp", "cond", "pres")])


@query("c3_lenient_time", oracle("obs", """SELECT event_id, epoch_us(TRY_CAST(trim(txt) AS TIMESTAMP)) AS t_us FROM
 (SELECT event_id, CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN NULL WHEN 3 THEN ' 2024-13-45 '
  ELSE strftime(time, '%Y-%m-%d %H:%M:%S') END AS txt FROM obs)"""))
def _(spark, sf):
    e = F.col("event_id") % 7
    txt = (F.when(e == 0, "").when(e == 1, "N/A").when(e == 2, F.lit(None)).when(e == 3, " 2024-13-45 ")
           .otherwise(F.date_format(F.col("time").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")))
    d = obs(spark, sf).select("event_id", clean.parse_time(txt).alias("t"))
    return d.select("event_id", F.unix_micros(F.col("t").cast("timestamp")).alias("t_us"))


def hourly(spark, sf):
    """Records averaged to the hour, so that sample times share an axis."""
    return obs(spark, sf).groupBy("serial", (F.floor(F.col("t_us") / _HOUR) * _HOUR).alias("t_us")).agg(
        F.avg("temp").alias("temp"), F.avg("cond").alias("cond"))


HOURLY = f"""hourly AS (SELECT serial, CAST(t_us // {_HOUR} * {_HOUR} AS BIGINT) AS t_us, AVG(temp) AS temp, AVG(cond) AS cond
 FROM obs GROUP BY 1, 2)"""


@query("c4_regularise", oracle("obs", f"SELECT g.serial, g.t_us, {q6('temp', 'cond')} FROM g LEFT JOIN hourly h"
                               " ON g.serial = h.serial AND g.t_us = h.t_us", HOURLY + """,
 d AS (SELECT serial, t_us, (lead(t_us) OVER (PARTITION BY serial ORDER BY t_us) - t_us) // 1000000 AS dt FROM hourly),
 s AS (SELECT serial, min(t_us) AS t0, max(t_us) AS t1, CAST(floor(quantile_cont(dt, 0.5)) AS BIGINT) * 1000000 AS st
  FROM d GROUP BY serial),
 g AS (SELECT serial, CAST(t0 + k * coalesce(st, 0) AS BIGINT) AS t_us FROM s,
  unnest(range(0, CAST(coalesce(ceil((t1 - t0) / CAST(st AS DOUBLE)), 0) AS BIGINT) + 1)) u(k))"""))
def _(spark, sf):
    d = clean.regularise(hourly(spark, sf), ["serial"], ["temp", "cond"])
    return d.select("serial", "t_us", r6("temp").alias("temp"), r6("cond").alias("cond"))


@query("c5_null_intervals", oracle("obs", f"""SELECT event_id, {q6('temp', 'cond')} FROM (SELECT o.event_id,
 CASE WHEN EXISTS (SELECT 1 FROM iv WHERE iv.serial = o.serial AND var = 'temp' AND o.t_us BETWEEN t0 AND t1) THEN NULL ELSE temp END AS temp,
 CASE WHEN EXISTS (SELECT 1 FROM iv WHERE iv.serial = o.serial AND var = 'cond' AND o.t_us BETWEEN t0 AND t1) THEN NULL ELSE cond END AS cond
 FROM obs o)""", f"""iv AS (SELECT serial, CASE WHEN event_id % 2 = 0 THEN 'temp' ELSE 'cond' END AS var, t_us AS t0,
 t_us + {30 * _HOUR} AS t1 FROM obs WHERE kind = 'purchase')"""))
def _(spark, sf):
    o = obs(spark, sf)
    iv = o.where("kind = 'purchase'").select(
        "serial", F.when(F.col("event_id") % 2 == 0, "temp").otherwise("cond").alias("var"),
        F.col("t_us").alias("t0"), (F.col("t_us") + 30 * _HOUR).alias("t1"))
    d = clean.null_intervals(o, iv, "serial", ["temp", "cond"])
    return d.select("event_id", r6("temp").alias("temp"), r6("cond").alias("cond"))


@query("c6_null_dummies", oracle("obs", f"""SELECT event_id, {q6('temp')} FROM (SELECT event_id,
 CASE WHEN event_id % 10 IN (0, 1, 2) THEN NULL ELSE temp END AS temp FROM obs)"""))
def _(spark, sf):
    e = F.col("event_id") % 10
    d = obs(spark, sf).withColumn("temp", F.when(e == 0, -9999.0).when(e == 1, -99.999).when(e == 2, float("nan"))
                                  .otherwise(F.col("temp")))
    return clean.null_dummies(d, ["temp"]).select("event_id", r6("temp").alias("temp"))


@query("c7_region_box", oracle("prof", f"SELECT profile_id, pres, {q6('lat', 'lon')} FROM (SELECT *, -10.0 * site AS lon"
                               " FROM prof) WHERE lat BETWEEN 5 AND 15 AND lon BETWEEN -30 AND -10"))
def _(spark, sf):
    d = prof(spark, sf).withColumn("lon", F.lit(-10.0) * F.col("site"))
    d = clean.in_box(d, (5, 15), (-30, -10))
    return d.select("profile_id", "pres", r6("lat").alias("lat"), r6("lon").alias("lon"))


@query("c8_emptied_instruments", oracle("obs instr", """SELECT i.serial, i.mooring FROM instr i WHERE NOT EXISTS
 (SELECT 1 FROM obs o WHERE o.serial = i.serial AND o.mooring = i.mooring AND o.time >= TIMESTAMP '2024-01-10 00:00:00'
  AND o.time <= TIMESTAMP '2024-01-10 08:00:00')"""))
def _(spark, sf):
    win = deploy(spark, sf).select("mooring", F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'").alias("deployment_time"),
                                   F.expr("TIMESTAMP_NTZ '2024-01-10 08:00:00'").alias("recovery_time"))
    used = clean.trim(obs(spark, sf), win)
    return clean.emptied_instruments(instr(spark, sf), used).select("serial", "mooring")


@query("c9_variable_stats", oracle("stage2", f"SELECT serial, var, n, {q6('mean', 'std', 'vmin', 'vmax')} FROM (" + " UNION ALL ".join(
    f"SELECT serial, '{v}' AS var, count({v}) AS n, avg({v}) AS mean, stddev_pop({v}) AS std, min({v}) AS vmin,"
    f" max({v}) AS vmax FROM stage2 GROUP BY serial" for v in ("temp", "cond", "pres")) + ")"))
def _(spark, sf):
    d = clean.variable_stats(stage2(spark, sf), ["serial"], ["temp", "cond", "pres"])
    return d.select("serial", "var", "n", *[r6(c).alias(c) for c in ("mean", "std", "vmin", "vmax")])


@query("c10_apply_flags", oracle("obs", f"""SELECT event_id, {q6('temp')} FROM (SELECT event_id,
 CASE WHEN temp BETWEEN 2 AND 20 THEN temp END AS temp FROM obs)"""))
def _(spark, sf):
    d = obs(spark, sf).withColumn("temp_qc", F.when(F.col("temp").between(2, 20), 1).otherwise(4))
    return clean.apply_flags(d, "temp", "temp_qc").select("event_id", r6("temp").alias("temp"))
