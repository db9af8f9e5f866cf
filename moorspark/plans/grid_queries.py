"""Queries of the time gridding and stacking operators."""

from pyspark.sql import functions as F

from moorspark.operators import grid, stats
from moorspark.operators.ordered import DAY_US
from moorspark.plans.clean_queries import HOURLY, hourly
from moorspark.plans.mooring_step import mooring_step
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import instr, obs, oracle, stage2, stored
from moorspark.plans.stats_queries import SAMPLING, sampling

GRID = SAMPLING + """,
 g AS (SELECT mooring, t0, step_us, CAST(greatest(ceil((t1 - t0) / CAST(step_us AS DOUBLE)), 0) AS BIGINT) AS n FROM
 (SELECT mooring, min(start_us) AS t0, max(end_us) AS t1, CAST(floor(quantile_cont(median_dt, 0.5) * 60) AS BIGINT) * 1000000 AS step_us
  FROM st GROUP BY 1)),
 gp AS (SELECT mooring, k, t0 + k * step_us AS t_us FROM g, unnest(range(0, n)) u(k))"""

#: Samples with their successors; a grid point between two of them is interpolated, on one it is copied.
SEG = GRID + """,
 seg AS (SELECT mooring, serial, t_us, temp, cond, lead(t_us) OVER w AS tn, lead(temp) OVER w AS tempn, lead(cond) OVER w AS condn
  FROM stage2 WINDOW w AS (PARTITION BY mooring, serial ORDER BY t_us)),
 ip AS (SELECT gp.mooring, s.serial, k, gp.t_us,
  CASE WHEN gp.t_us = s.t_us THEN temp ELSE temp + (tempn - temp) * (CAST(gp.t_us - s.t_us AS DOUBLE) / (tn - s.t_us)) END AS temp,
  CASE WHEN gp.t_us = s.t_us THEN cond ELSE cond + (condn - cond) * (CAST(gp.t_us - s.t_us AS DOUBLE) / (tn - s.t_us)) END AS cond
  FROM gp JOIN seg s ON gp.mooring = s.mooring AND gp.t_us >= s.t_us AND (gp.t_us < tn OR (tn IS NULL AND gp.t_us = s.t_us)))"""
LEVELS = """lv AS (SELECT serial, mooring, depth, instrument, clock_offset,
 row_number() OVER (PARTITION BY mooring ORDER BY position) - 1 AS level FROM instr WHERE (mooring, serial) IN (SELECT (mooring, serial) FROM st)),
 stk AS (SELECT lv.mooring, gp.t_us, level, lv.serial, depth AS nominal_depth, instrument, clock_offset, temp, cond
 FROM lv JOIN gp ON gp.mooring = lv.mooring LEFT JOIN ip ON ip.serial = lv.serial AND ip.mooring = lv.mooring AND ip.k = gp.k)"""


@query("i1_common_grid", oracle("stage2", "SELECT mooring, k, t_us FROM gp", GRID))
def _(spark, sf):
    return grid.grid_points(grid.common_grid(sampling(spark, sf))).select("mooring", "k", "t_us")


@query("h8_clock_grid", oracle("stage2", """SELECT mooring, t0, step_us, CAST(greatest(ceil((t1 - t0) / CAST(step_us AS DOUBLE)), 0) AS BIGINT) AS n FROM
 (SELECT mooring, min(start_us) AS t0, CAST(floor(quantile_cont(end_us, 0.5)) AS BIGINT) AS t1,
  CAST(floor(quantile_cont(median_dt, 0.5) * 60) AS BIGINT) * 1000000 AS step_us FROM st GROUP BY 1)""", SAMPLING))
def _(spark, sf):
    return grid.common_grid(sampling(spark, sf), end="median")


@query("i2_interpolate", oracle("stage2", f"SELECT mooring, serial, k, t_us, {q6('temp', 'cond')} FROM ip", SEG))
def _(spark, sf):
    d = stored(stage2, spark, sf)
    g = grid.common_grid(stats.sampling_stats(d, ["mooring", "serial"]))
    d = grid.interpolate(d, g, ["mooring", "serial"], ["mooring"], ["temp", "cond"])
    return rounded(d, "mooring serial k t_us", "temp cond")


REGULAR = f"""rg AS (SELECT serial, t0, greatest(CAST(floor((t1 - t0) / {DAY_US / 2}) AS BIGINT) + 1, 0) AS n FROM (SELECT serial,
 CASE WHEN a % {DAY_US} = 0 THEN a ELSE (a + {DAY_US}) // {DAY_US} * {DAY_US} END AS t0, b // {DAY_US} * {DAY_US} AS t1
 FROM (SELECT serial, min(t_us) AS a, max(t_us) AS b FROM obs GROUP BY 1)))"""


@query("i3_regular_grid", oracle("obs", f"SELECT serial, k, t0 + k * {DAY_US // 2} AS t_us FROM rg, unnest(range(0, n)) u(k)", REGULAR))
def _(spark, sf):
    g = grid.regular_grid(obs(spark, sf), ["serial"])
    return grid.grid_points(g).select("serial", "k", "t_us")


@query("i4_interpolate_extrapolate", oracle("obs", f"""SELECT serial, t_us, {q6('temp')} FROM (SELECT p.serial, p.t_us,
 (SELECT CASE WHEN x0 = p.t_us THEN y0 ELSE y0 + (y1 - y0) * (CAST(p.t_us - x0 AS DOUBLE) / (x1 - x0)) END FROM sg
  WHERE sg.serial = p.serial AND (p.t_us >= x0 OR i = 1) AND (p.t_us < x1 OR i = m)) AS temp FROM pts p)""", REGULAR + f""",
 pts AS (SELECT serial, t0 + k * {DAY_US // 2} AS t_us FROM rg, unnest(range(0, n)) u(k)),
 sg AS (SELECT *, max(i) OVER (PARTITION BY serial) AS m FROM (SELECT serial, t_us AS x0, temp AS y0, lead(t_us) OVER w AS x1,
  lead(temp) OVER w AS y1, row_number() OVER w AS i FROM obs WINDOW w AS (PARTITION BY serial ORDER BY t_us)) WHERE x1 IS NOT NULL)"""))
def _(spark, sf):
    o = obs(spark, sf)
    d = grid.interpolate(o, grid.regular_grid(o, ["serial"]), ["serial"], ["serial"], ["temp"], extrapolate=True)
    return rounded(d, "serial t_us", "temp")


@query("i5_union_variables", oracle("obs", f"""SELECT serial, t_us, {q6('temp', 'pres')} FROM (
 SELECT serial, t_us, temp, NULL AS pres FROM obs WHERE serial % 2 = 0 UNION ALL
 SELECT serial, t_us, temp, pres FROM obs WHERE serial % 2 = 1)"""))
def _(spark, sf):
    o = obs(spark, sf)
    d = grid.union_variables(
        [o.where("serial % 2 = 0").select("serial", "t_us", "temp"), o.where("serial % 2 = 1").select("serial", "t_us", "temp", "pres", "cond")],
        ["temp", "pres", "u_velocity"], ["serial", "t_us"])
    return rounded(d, "serial t_us", "temp pres")


def stacked(spark, sf, values=("temp", "cond")):
    """Stage-2 records gridded and stacked, one row per cell of the mooring's time x level matrix."""
    d, i = stored(stage2, spark, sf), instr(spark, sf)
    st = stats.sampling_stats(d, ["mooring", "serial"])
    g = grid.interpolate(d, grid.common_grid(st), ["mooring", "serial"], ["mooring"], list(values), whole_grid=True)
    return grid.stack_levels(g, grid.levels(i, st), list(values))


@query("i6_stack_levels", oracle("stage2", f"SELECT mooring, t_us, level, serial, nominal_depth, instrument, clock_offset, {q6('temp', 'cond')} FROM stk",
                                 SEG + "," + LEVELS))
def _(spark, sf):
    return rounded(stacked(spark, sf), "mooring t_us level serial nominal_depth instrument clock_offset", "temp cond")


@query("i6_wide_levels", oracle("stage2", f"""SELECT mooring, t_us, n, {q6('weighted', 'temp_0')} FROM (SELECT mooring, t_us, count(temp) AS n, sum((level + 1) * temp) AS weighted,
 max(CASE WHEN level = 0 THEN temp END) AS temp_0 FROM stk GROUP BY 1, 2)""", SEG + "," + LEVELS))
def _(spark, sf):
    # as many places as the mooring has levels; all of them are checked, by their number and a sum weighted by level
    wide = grid.level_arrays(stacked(spark, sf), "temp")
    n = F.size(F.filter("temp", lambda v: v.isNotNull())).cast("long")
    weighted = F.aggregate(F.transform("temp", lambda v, i: (i + 1) * F.coalesce(v, F.lit(0.0))), F.lit(0.0), lambda a, v: a + v)
    d = wide.select("mooring", "t_us", n.alias("n"), F.when(n > 0, weighted).alias("weighted"), F.get("temp", F.lit(0)).alias("temp_0"))
    return rounded(d, "mooring t_us n", "weighted temp_0")


def depth_records(spark, sf):
    """Records on a shared half-day axis per mooring: 12-h means at every axis point (null where empty)."""
    o = obs(spark, sf).withColumn("t_us", F.floor(F.col("t_us") / (DAY_US // 2)) * (DAY_US // 2))
    d = o.groupBy("mooring", "serial", "t_us").agg(F.avg("temp").alias("temp"))
    axis = o.select("mooring", "t_us").distinct()
    lv = instr(spark, sf).select("mooring", "serial")
    return axis.join(lv, "mooring").join(d, ["mooring", "serial", "t_us"], "left")


DEPTH = f"""hd AS (SELECT mooring, serial, CAST(t_us // {DAY_US // 2} * {DAY_US // 2} AS BIGINT) AS t_us, avg(temp) AS temp FROM obs GROUP BY 1, 2, 3),
 ax AS (SELECT DISTINCT mooring, t_us FROM hd), dl AS (SELECT *, row_number() OVER (PARTITION BY mooring ORDER BY depth, serial) - 1 AS level FROM instr),
 sd AS (SELECT ax.mooring, ax.t_us, level, dl.serial, depth, temp FROM ax JOIN dl ON dl.mooring = ax.mooring
 LEFT JOIN hd ON hd.serial = dl.serial AND hd.mooring = dl.mooring AND hd.t_us = ax.t_us)"""


@query("i7_stack_by_depth", oracle("obs instr", f"SELECT mooring, t_us, level, serial, depth, 26.5 AS lat, -76.7 AS lon, {q6('temp')} FROM sd", DEPTH)
       .replace("26.5 AS lat, -76.7 AS lon", "CAST(26.5 AS DOUBLE) AS lat, CAST(-76.7 AS DOUBLE) AS lon"))
def _(spark, sf):
    attrs = instr(spark, sf).select("mooring", "serial", "depth", F.lit(26.5).alias("lat"), F.lit(-76.7).alias("lon"))
    d = grid.stack_by_depth(depth_records(spark, sf), attrs, ["temp"])
    return rounded(d, "mooring t_us level serial depth lat lon", "temp")


@query("i8_concat_depth", oracle("obs instr", f"SELECT mooring, t_us, serial, depth, level, instrument, {q6('temp')} FROM"
                                 " (SELECT sd.*, instrument FROM sd JOIN instr i ON i.serial = sd.serial AND i.mooring = sd.mooring)", DEPTH))
def _(spark, sf):
    d = depth_records(spark, sf)
    parts = [d.where("serial % 2 = 0"), d.where("serial % 2 = 1")]
    u = grid.union_variables(parts, ["temp"], ["mooring", "serial", "t_us"])
    sensors = grid.levels(instr(spark, sf), order=["depth", "serial"]).select("mooring", "serial", "depth", "level", "instrument")
    return rounded(u.join(sensors, ["mooring", "serial"]), "mooring t_us serial depth level instrument", "temp")


@query("i9_mooring_step", oracle("stage2", f"SELECT mooring, t_us, level, serial, nominal_depth, clock_offset, instrument_code, instrument_meanings, {q6('temp', 'cond')}"
                                 " FROM stk JOIN codes USING (mooring, instrument) JOIN names USING (mooring)", SEG + "," + LEVELS + """,
 fa AS (SELECT mooring, instrument, min(level) AS fl FROM lv GROUP BY 1, 2),
 codes AS (SELECT mooring, instrument, row_number() OVER (PARTITION BY mooring ORDER BY fl) AS instrument_code FROM fa),
 names AS (SELECT mooring, string_agg(replace(instrument, ' ', '_'), ' ' ORDER BY fl) AS instrument_meanings FROM fa GROUP BY 1)"""))
def _(spark, sf):
    d = mooring_step(stored(stage2, spark, sf), instr(spark, sf), ["temp", "cond"])
    return rounded(d, "mooring t_us level serial nominal_depth clock_offset instrument_code instrument_meanings", "temp cond")
