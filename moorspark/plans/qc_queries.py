"""Queries of the quality control operators."""

from pyspark.sql import functions as F

from moorspark.functions import flags
from moorspark.operators import grid, qc, stats
from moorspark.operators.ordered import DAY_US
from moorspark.plans.profile_queries import salinity_sql
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import instr, obs, oracle

H = DAY_US // 2
LV = ["mooring", "level"]


def cells(spark, sf, digits=None):
    """Time x level matrix of half-day means with temperature, conductivity, pressure (null where empty).

    The last bits of a mean depend on the order of addition; means rounded to ``digits`` decimals do not, so that a test
    of them against a limit they may meet exactly is the same in every run.
    """
    o = obs(spark, sf).withColumn("t_us", F.floor(F.col("t_us") / H) * H)
    means = {c: F.avg(c) if digits is None else F.round(F.avg(c), digits) for c in ("temp", "cond", "pres")}
    d = o.groupBy("mooring", "serial", "t_us").agg(*[m.alias(c) for c, m in means.items()])
    lv = grid.levels(instr(spark, sf)).select("mooring", "level", "serial", "depth")
    return lv.join(o.select("mooring", "t_us").distinct(), "mooring").join(d, ["mooring", "serial", "t_us"], "left")


CELLS = f"""hm AS (SELECT mooring, serial, CAST(t_us // {H} * {H} AS BIGINT) AS t_us, avg(temp) AS temp, avg(cond) AS cond, avg(pres) AS pres FROM obs GROUP BY 1, 2, 3),
 cl AS (SELECT l.mooring, l.level, l.serial, l.depth, a.t_us, temp, cond, pres FROM (SELECT *, row_number() OVER (PARTITION BY mooring ORDER BY position) - 1 AS level FROM instr) l
 JOIN (SELECT DISTINCT mooring, CAST(t_us // {H} * {H} AS BIGINT) AS t_us FROM obs) a ON a.mooring = l.mooring LEFT JOIN hm ON hm.serial = l.serial AND hm.mooring = l.mooring AND hm.t_us = a.t_us),
 cs AS (SELECT *, {salinity_sql('cond', 'temp', 'pres')} AS salt FROM cl)"""

#: The same with the means rounded as in ``cells(..., MEAN_DIGITS)``.
MEAN_DIGITS = 9
EXACT_CELLS = CELLS
for _c in ("temp", "cond", "pres"):
    EXACT_CELLS = EXACT_CELLS.replace(f"avg({_c}) AS {_c}", f"round(avg({_c}), {MEAN_DIGITS}) AS {_c}")


def salty(spark, sf, digits=None):
    from moorspark.functions.seawater import with_salinity

    return with_salinity(cells(spark, sf, digits), "cond", "temp", "pres", "salt")


@query("j1_salinity_outlier", oracle("obs instr", """SELECT mooring, level, t_us, coalesce(abs(salt - avg(salt) OVER w) > 2 * stddev_pop(salt) OVER w, false) AS outlier
 FROM cs WINDOW w AS (PARTITION BY mooring, level)""", CELLS))
def _(spark, sf):
    return qc.salinity_outlier(salty(spark, sf), LV, "salt", 2.0).select(*LV, "t_us", "outlier")


@query("j2_temporal_spike", oracle("obs instr", """SELECT mooring, level, t_us, coalesce(abs(cond - lag(cond) OVER (PARTITION BY mooring, level ORDER BY t_us)) > 0.5, false) AS spike FROM cl""", CELLS))
def _(spark, sf):
    return qc.temporal_spike(cells(spark, sf), LV, "cond", 0.5).select(*LV, "t_us", "spike")


@query("j3_vertical_inconsistency", oracle("obs instr", """SELECT mooring, level, t_us, coalesce(abs(cond - lag(cond) OVER (PARTITION BY mooring, t_us ORDER BY level)) > 0.5, false) AS inconsistent FROM cl""", CELLS))
def _(spark, sf):
    return qc.vertical_inconsistency(cells(spark, sf), ["mooring", "t_us"], "cond", 0.5).select(*LV, "t_us", "inconsistent")


@query("j4_combined_qc", oracle("obs instr", """SELECT mooring, level, t_us, CAST(coalesce(abs(salt - m) > 3 * s, false) OR sp AS INT) AS cond_qc FROM (SELECT *,
 avg(salt) FILTER (NOT f) OVER w AS m, stddev_pop(salt) FILTER (NOT f) OVER w AS s FROM (SELECT *, sp OR coalesce(abs(salt - avg(salt) OVER w) > 6 * stddev_pop(salt) OVER w, false) AS f
 FROM (SELECT *, coalesce(abs(cond - lag(cond) OVER (PARTITION BY mooring, level ORDER BY t_us)) > 5, false) AS sp FROM cs) WINDOW w AS (PARTITION BY mooring, level))
 WINDOW w AS (PARTITION BY mooring, level))""", EXACT_CELLS))
def _(spark, sf):
    d = qc.combined_qc(cells(spark, sf, MEAN_DIGITS), LV, "cond", "temp", "pres", "salt")
    return d.select(*LV, "t_us", "cond_qc")


GROSS = "CASE WHEN {v} IS NULL THEN 9 WHEN {v} < 0.1 OR {v} > 25 THEN 4 WHEN {v} < 0.5 OR {v} > 15 THEN 3 ELSE 1 END"
SPIKE = "CASE WHEN {v} IS NULL THEN 9 WHEN abs({v} - (p + n) / 2) IS NULL THEN 2 WHEN abs({v} - (p + n) / 2) > 8 THEN 4 WHEN abs({v} - (p + n) / 2) > 4 THEN 3 ELSE 1 END"
CLIMF = """CASE WHEN temp IS NULL THEN 9 WHEN time BETWEEN '2024-01-10' AND '2024-01-20' AND depth BETWEEN 100 AND 150 THEN CASE WHEN temp BETWEEN 1 AND 8 THEN 1 ELSE 3 END
 WHEN time BETWEEN '2024-01-05' AND '2024-01-15' AND depth BETWEEN 100 AND 250 THEN CASE WHEN temp BETWEEN 0.5 AND 12 THEN 1 ELSE 3 END ELSE 2 END"""
SPANS = [{"tspan": ["2024-01-05", "2024-01-15"], "zspan": [100, 250], "vspan": [0.5, 12]},
         {"tspan": ["2024-01-10", "2024-01-20"], "zspan": [100, 150], "vspan": [1, 8]}]
RATE = "CASE WHEN temp IS NULL THEN 9 WHEN abs(temp - p) / ((t_us - tp) / 1e6) IS NULL THEN 2 WHEN abs(temp - p) / ((t_us - tp) / 1e6) > 0.0002 THEN 3 ELSE 1 END"
NB = """nb AS (SELECT o.*, depth, lag(temp) OVER w AS p, lead(temp) OVER w AS n, lag(t_us) OVER w AS tp FROM obs o JOIN instr i ON i.serial = o.serial AND i.mooring = o.mooring
 WINDOW w AS (PARTITION BY o.serial ORDER BY t_us))"""
CONFIG = [
    {"test": "gross_range", "var": "temp", "suspect_span": [0.5, 15], "fail_span": [0.1, 25]},
    {"test": "spike", "var": "temp", "suspect_threshold": 4.0, "fail_threshold": 8.0},
    {"test": "rate_of_change", "var": "temp", "threshold": 0.0002},
    {"test": "climatology", "var": "temp", "ranges": SPANS},
]
TESTS = ["temp_gross_range", "temp_spike", "temp_rate_of_change", "temp_climatology"]


def deep(spark, sf):
    return obs(spark, sf).join(instr(spark, sf).select("mooring", "serial", "depth"), ["mooring", "serial"])


def tested(spark, sf):
    return qc.run_tests(deep(spark, sf), ["serial"], CONFIG)


def _all(cols):
    return f"SELECT event_id, {cols} FROM nb"


TST = NB + f""", tst AS (SELECT event_id, {GROSS.format(v='temp')} AS temp_gross_range, {SPIKE.format(v='temp')} AS temp_spike, {RATE} AS temp_rate_of_change, {CLIMF} AS temp_climatology FROM nb),
 rl AS (SELECT *, CASE WHEN 4 IN ({', '.join(TESTS)}) THEN 4 WHEN 3 IN ({', '.join(TESTS)}) THEN 3 WHEN 1 IN ({', '.join(TESTS)}) THEN 1 WHEN 2 IN ({', '.join(TESTS)}) THEN 2 ELSE 9 END AS qc_rollup FROM tst)"""


@query("j5_gross_range", oracle("obs", f"SELECT event_id, {GROSS.format(v='temp')} AS flag FROM obs"))
def _(spark, sf):
    return obs(spark, sf).select("event_id", qc.gross_range(F.col("temp"), (0.5, 15), (0.1, 25)).alias("flag"))


@query("j6_spike_flag", oracle("obs instr", _all(SPIKE.format(v="temp") + " AS flag"), NB))
def _(spark, sf):
    d = qc.run_tests(obs(spark, sf), ["serial"], [CONFIG[1]])
    return d.select("event_id", F.col("temp_spike").alias("flag"))


@query("j7_climatology_flag", oracle("obs instr", _all(CLIMF + " AS flag"), NB))
def _(spark, sf):
    d = deep(spark, sf)
    return d.select("event_id", qc.climatology_flag(F.col("temp"), F.col("time"), F.col("depth"), SPANS).alias("flag"))


@query("j7_climatology_by_level", oracle("obs instr", """SELECT event_id, CASE WHEN temp BETWEEN vmin AND vmax THEN 1 ELSE 3 END AS flag FROM obs o JOIN (SELECT serial,
 round(avg(temp) - 1.5 * stddev_pop(temp), 2) AS vmin, round(avg(temp) + 1.5 * stddev_pop(temp), 2) AS vmax FROM obs GROUP BY 1) r ON r.serial = o.serial"""))
def _(spark, sf):
    o = obs(spark, sf)
    d = qc.climatology_flag_by_level(o, stats.climatology_ranges(o, ["serial"], "temp", 1.5), ["serial"], "temp", "flag")
    return d.select("event_id", "flag")


@query("j8_location_flag", oracle("prof", """SELECT profile_id, pres, CASE WHEN -10 * site BETWEEN -30 AND -10 AND lat BETWEEN 5 AND 20 THEN 1 ELSE 4 END AS flag FROM prof"""))
def _(spark, sf):
    from moorspark.plans.standin import prof

    d = prof(spark, sf)
    return d.select("profile_id", "pres", qc.location_flag(F.lit(-10.0) * F.col("site"), F.col("lat"), (-30, -10, 5, 20)).alias("flag"))


@query("j9_rollup", oracle("obs instr", "SELECT event_id, qc_rollup FROM rl", TST))
def _(spark, sf):
    return tested(spark, sf).select("event_id", flags.rollup(*[F.col(t) for t in TESTS]).alias("qc_rollup"))


@query("j10_failure_diagnosis", oracle("obs instr", """SELECT event_id, concat_ws(', ', CASE WHEN temp_gross_range = 4 THEN 'temp_gross_range' END, CASE WHEN temp_spike = 4 THEN 'temp_spike' END,
 CASE WHEN temp_climatology = 4 THEN 'temp_climatology' END) AS failed_tests FROM rl WHERE qc_rollup = 4""", TST))
def _(spark, sf):
    return qc.failure_diagnosis(tested(spark, sf), TESTS).select("event_id", "failed_tests")


@query("j11_rate_of_change", oracle("obs instr", _all(RATE + " AS flag"), NB))
def _(spark, sf):
    d = qc.run_tests(obs(spark, sf), ["serial"], [CONFIG[2]])
    return d.select("event_id", F.col("temp_rate_of_change").alias("flag"))


@query("j12_flat_line", oracle("obs", f"""SELECT event_id, CASE WHEN b < 4.0 AND t_us - t0 >= {3 * DAY_US} THEN 4 WHEN a < 4.0 AND t_us - t0 >= {DAY_US} THEN 3 ELSE 1 END AS flag FROM (SELECT event_id, t_us,
 min(t_us) OVER (PARTITION BY serial) AS t0, max(temp) OVER x - min(temp) OVER x AS a, max(temp) OVER y - min(temp) OVER y AS b FROM obs
 WINDOW x AS (PARTITION BY serial ORDER BY t_us RANGE BETWEEN {DAY_US} PRECEDING AND CURRENT ROW), y AS (PARTITION BY serial ORDER BY t_us RANGE BETWEEN {3 * DAY_US} PRECEDING AND CURRENT ROW))"""))
def _(spark, sf):
    d = qc.flat_line(obs(spark, sf), ["serial"], "temp", 4.0, 86_400, 3 * 86_400, out="flag")
    return d.select("event_id", "flag")


@query("j13_ts_flag", oracle("obs instr", """SELECT mooring, level, t_us, CASE WHEN salt IS NULL THEN 9 WHEN abs(salt - a - b * temp) > 1.5 * s THEN 3 ELSE 1 END AS ts FROM cs JOIN (SELECT mooring AS m, level AS l,
 regr_slope(salt, temp) AS b, regr_intercept(salt, temp) AS a, sqrt(var_pop(salt) * (1 - regr_r2(salt, temp))) AS s FROM cs WHERE salt IS NOT NULL GROUP BY 1, 2) ON m = mooring AND l = level""", CELLS))
def _(spark, sf):
    return qc.ts_flag(salty(spark, sf), LV, "temp", "salt", 1.5).select(*LV, "t_us", "ts")


@query("d6_vertical_neighbours", oracle("obs instr", f"SELECT mooring, level, t_us, {q6('above', 'below')} FROM (SELECT mooring, level, t_us, lag(temp) OVER w AS above, lead(temp) OVER w AS below FROM cl"
                                        " WINDOW w AS (PARTITION BY mooring, t_us ORDER BY level))", CELLS))
def _(spark, sf):
    return rounded(qc.vertical_neighbours(cells(spark, sf), ["mooring", "t_us"], "temp"), "mooring level t_us", "above below")


@query("j14_neighbour_flag", oracle("obs instr", """SELECT mooring, level, t_us, CASE WHEN z IS NULL THEN 9 WHEN coalesce((a + b) / 2, a, b) IS NULL THEN 2 WHEN abs(z - coalesce((a + b) / 2, a, b)) > 2 THEN 3 ELSE 1 END AS neighbour
 FROM (SELECT *, lag(z) OVER w AS a, lead(z) OVER w AS b FROM (SELECT mooring, level, t_us, (temp - mm) / ms AS z FROM cl JOIN (SELECT cl.mooring AS m, cl.level AS l, avg(temp) AS mm, stddev_pop(temp) AS ms FROM cl JOIN
 (SELECT mooring AS m0, level AS l0, quantile_cont(temp, 0.05) AS lo, quantile_cont(temp, 0.95) AS hi FROM cl GROUP BY 1, 2) ON m0 = cl.mooring AND l0 = cl.level WHERE temp BETWEEN lo AND hi GROUP BY 1, 2) ON m = cl.mooring AND l = cl.level)
 WINDOW w AS (PARTITION BY mooring, t_us ORDER BY level))""", CELLS))
def _(spark, sf):
    d = qc.neighbour_flag(cells(spark, sf), LV, ["mooring", "t_us"], "temp", 2.0, percent=90.0)
    return d.select(*LV, "t_us", "neighbour")


@query("j15_class_despike", oracle("obs instr", f"""SELECT mooring, level, t_us, {q6('salt')} FROM (SELECT x.mooring, x.level, x.t_us, CASE WHEN abs(salt - med) > 1.2 * use THEN NULL ELSE salt END AS salt FROM x LEFT JOIN kx
 ON kx.mooring = x.mooring AND kx.level = x.level AND kx.c = x.c)""", EXACT_CELLS + """,
 x0 AS (SELECT *, min(temp) FILTER (salt IS NOT NULL) OVER w AS lo, max(temp) FILTER (salt IS NOT NULL) OVER w AS hi FROM cs WINDOW w AS (PARTITION BY mooring, level)),
 x AS (SELECT mooring, level, t_us, temp, salt, CASE WHEN salt IS NOT NULL THEN CASE WHEN hi > lo THEN CAST(least(floor((temp - lo) / ((hi - lo) / 14)), 13) AS INT) ELSE 0 END END AS c FROM x0),
 kc AS (SELECT mooring, level, c, median(salt) AS med, stddev_samp(salt) AS sd, count(*) AS n FROM x WHERE salt IS NOT NULL GROUP BY 1, 2, 3),
 kx AS (SELECT mooring, level, c, med, last_value(CASE WHEN n >= 3 THEN sd END IGNORE NULLS) OVER (PARTITION BY mooring, level ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS use FROM kc)"""))
def _(spark, sf):
    d = qc.class_despike(salty(spark, sf, MEAN_DIGITS), LV, "temp", "salt", k=1.2)
    return rounded(d, "mooring level t_us", "salt")


def _passes(n):
    out = ["i0 AS (SELECT serial, event_id, CASE WHEN cond BETWEEN 30 AND 44.5 THEN cond END AS s, CASE WHEN temp BETWEEN 0 AND 29.5 AND cond BETWEEN 30 AND 44.5 THEN temp END AS t FROM obs)"]
    for i in range(n):
        out.append(f"""k{i} AS (SELECT serial AS k, avg(s) AS sm, stddev_pop(s) AS sd, avg(t) AS tm, stddev_pop(t) AS td FROM i{i} GROUP BY 1),
 i{i + 1} AS (SELECT serial, event_id, CASE WHEN s BETWEEN sm - 2 * sd AND sm + 2 * sd THEN s END AS s, CASE WHEN s BETWEEN sm - 2 * sd AND sm + 2 * sd AND t BETWEEN tm - 2 * td AND tm + 2 * td THEN t END AS t FROM i{i} JOIN k{i} ON k = serial)""")
    return ", ".join(out)


@query("j16_iterative_despike", oracle("obs", f"SELECT event_id, {q6('temp', 'cond')} FROM (SELECT event_id, t AS temp, s AS cond FROM i5)", _passes(5)))
def _(spark, sf):
    d = qc.iterative_despike(obs(spark, sf), ["serial"], "temp", "cond", {"temp": (0, 29.5), "cond": (30, 44.5)}, 2.0)
    return rounded(d, "event_id", "temp cond")


@query("j17_flag_vocabulary", oracle("obs", f"""SELECT event_id, CASE f WHEN 1 THEN 'good' WHEN 3 THEN 'suspect' WHEN 4 THEN 'bad' END AS meaning, CASE f WHEN 1 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 4 END AS oceansites,
 CASE f WHEN 1 THEN 'good_data' WHEN 3 THEN 'probably_good_data' WHEN 4 THEN 'bad_data' END AS os_meaning FROM (SELECT event_id, {GROSS.format(v='temp')} AS f FROM obs)"""))
def _(spark, sf):
    f = qc.gross_range(F.col("temp"), (0.5, 15), (0.1, 25))
    o = flags.to_oceansites(f)
    return obs(spark, sf).select("event_id", flags.meaning(f).alias("meaning"), o.alias("oceansites"), flags.meaning(o, flags.OCEANSITES).alias("os_meaning"))


@query("j18_run_tests", oracle("obs instr", f"SELECT event_id, {', '.join(TESTS)}, qc_rollup FROM rl", TST))
def _(spark, sf):
    return tested(spark, sf).select("event_id", *TESTS, "qc_rollup")
