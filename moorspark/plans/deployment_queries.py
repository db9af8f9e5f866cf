"""Queries of the deployment detection operators."""

from pyspark.sql import functions as F

from moorspark.operators import deployment as dep
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import deploy, instr, obs, oracle, us
from moorspark.plans.stats_queries import _mid

S = ["serial"]
H = 3_600_000_000


def _window_sql(lo, hi, src="obs"):
    return f"""bw0 AS (SELECT o.serial, min(t_us) AS tmin, max(t_us) AS tmax, min(epoch_us(d.deployment_time)) AS dep,
 min(epoch_us(d.recovery_time)) AS rec FROM {src} o JOIN deploy d ON o.mooring = d.mooring GROUP BY 1),
 bw1 AS (SELECT *, greatest({lo}, tmin) AS lo, least({hi}, tmax) AS hi, tmax - tmin AS sp FROM bw0),
 bw AS (SELECT serial, tmin, tmax, CASE WHEN hi <= lo THEN CAST(trunc(tmin + sp * CAST(0.33 AS DOUBLE)) AS BIGINT) ELSE lo END AS bot_start,
 CASE WHEN hi <= lo THEN CAST(trunc(tmin + sp * CAST(0.66 AS DOUBLE)) AS BIGINT) ELSE hi END AS bot_end FROM bw1)"""


_SPAN = ("CAST(trunc(tmin + (tmax - tmin) * CAST(0.25 AS DOUBLE)) AS BIGINT)", "CAST(trunc(tmax - (tmax - tmin) * CAST(0.25 AS DOUBLE)) AS BIGINT)")
WINDOW = _window_sql(*_SPAN)
SEA = """q AS (SELECT serial, quantile_cont(temp, 0.25) AS q25, quantile_cont(temp, 0.75) AS q75 FROM obs GROUP BY 1),
 sea AS (SELECT o.serial, avg(temp) FILTER (t_us BETWEEN bot_start AND bot_end) AS sea_mean,
 CASE WHEN count(*) FILTER (t_us BETWEEN bot_start AND bot_end) > 1 THEN stddev_samp(temp) FILTER (t_us BETWEEN bot_start AND bot_end) ELSE 0.0 END AS sea_std
 FROM obs o JOIN bw ON bw.serial = o.serial GROUP BY 1)"""
ENDS = f"""sm AS (SELECT event_id, serial, t_us, temp, median(temp) OVER (PARTITION BY serial ORDER BY t_us ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS ys FROM obs),
 ends AS (SELECT sm.serial, 'early' AS side, t_us, ys FROM sm JOIN bw ON bw.serial = sm.serial WHERE t_us <= tmin + {96 * H}
  UNION ALL SELECT sm.serial, 'late', t_us, ys FROM sm JOIN bw ON bw.serial = sm.serial WHERE t_us >= tmax - {96 * H})"""
THR = """pe AS (SELECT serial, side, quantile_cont(ys, 0.9) AS p FROM ends GROUP BY 1, 2),
 wm AS (SELECT serial, median(p) AS warm FROM pe GROUP BY 1),
 thr AS (SELECT sea.serial, CASE WHEN warm < sea_mean THEN sea_mean - greatest(sea_std * 1.5, 0.1) ELSE sea_mean + greatest(sea_std * 1.5, 0.1) END AS threshold,
 NOT warm < sea_mean AS deep_is_below FROM sea JOIN wm ON wm.serial = sea.serial)"""
EXIT = """ex AS (SELECT o.serial, min(CASE WHEN temp < threshold THEN t_us END) AS start_us, max(CASE WHEN temp < threshold THEN t_us END) AS end_us,
 min(threshold) AS split_value FROM obs o JOIN thr ON thr.serial = o.serial GROUP BY 1)"""
CHAIN = ", ".join([WINDOW, SEA, ENDS, THR, EXIT])
#: The stand-in records have a sample every 11 hours, so the end windows are four days long.
HOURS = 96.0


@query("g1_bottom_window", oracle("obs deploy", "SELECT * FROM bw", WINDOW))
def _(spark, sf):
    return dep.bottom_window(obs(spark, sf), S)


@query("g1_bottom_window_fixed_hours", oracle("obs deploy", "SELECT * FROM bw", _window_sql(f"tmin + {24 * H}", f"tmax - {24 * H}")))
def _(spark, sf):
    return dep.bottom_window(obs(spark, sf), S, "fixed_hours")


@query("g1_bottom_window_deployment", oracle("obs deploy", "SELECT * FROM bw", _window_sql(
    f"CASE WHEN rec IS NULL OR dep IS NULL THEN {_SPAN[0]} ELSE dep + {2 * H} END", f"CASE WHEN rec IS NULL OR dep IS NULL THEN {_SPAN[1]} ELSE rec - {2 * H} END")))
def _(spark, sf):
    b = instr(spark, sf).join(deploy(spark, sf), "mooring").select(
        "serial", us("deployment_time").alias("deploy_us"), us("recovery_time").alias("recover_us")).groupBy("serial").agg(
        F.min("deploy_us").alias("deploy_us"), F.min("recover_us").alias("recover_us"))
    return dep.bottom_window(obs(spark, sf), S, "deployment_bounds", bounds=b)


def _sea(spark, sf):
    o = obs(spark, sf)
    w = dep.bottom_window(o, S)
    return o, w, dep.sea_values(o, S, "temp", w)


@query("g2_sea_values", oracle("obs deploy", f"SELECT serial, {q6('sea_mean', 'sea_std')} FROM sea", WINDOW + "," + SEA))
def _(spark, sf):
    return rounded(_sea(spark, sf)[2], "serial", "sea_mean sea_std")


@query("g3_sigma_threshold", oracle("obs deploy", f"SELECT serial, deep_is_below, {q6('threshold')} FROM thr", CHAIN))
def _(spark, sf):
    o, w, sea = _sea(spark, sf)
    d = dep.sigma_threshold(dep.smoothed_ends(o, S, "temp", w, HOURS), S, sea, 1.5)
    return rounded(d, "serial deep_is_below", "threshold")


@query("g5_entry_exit", oracle("obs", f"""SELECT o.serial, min(CASE WHEN temp < m THEN t_us END) AS start_us, max(CASE WHEN temp < m THEN t_us END) AS end_us,
 round(min(m), 6) + 0.0 AS split_value FROM obs o JOIN (SELECT serial, 0.5 + serial % 7 AS m FROM instr) t ON t.serial = o.serial GROUP BY 1""").replace(
    "WITH RECURSIVE obs", "WITH RECURSIVE instr AS (SELECT DISTINCT CAST(user_id AS BIGINT) AS serial FROM events),\nobs"))
def _(spark, sf):
    thr = instr(spark, sf).select("serial", (F.lit(0.5) + F.col("serial") % 7).alias("threshold")).distinct()
    return rounded(dep.entry_exit(obs(spark, sf), S, "temp", thr), "serial start_us end_us", "split_value")


@query("g6_find_deployment", oracle("obs deploy", f"SELECT serial, start_us, end_us, {q6('split_value')} FROM ex", CHAIN))
def _(spark, sf):
    d = dep.find_deployment(obs(spark, sf), S, "temp", hours=HOURS)
    return rounded(d, "serial start_us end_us", "split_value")


SURFACE = f"""dt AS (SELECT serial, quantile_cont(d, 0.5) AS dt_s FROM (SELECT serial, (t_us - lag(t_us) OVER (PARTITION BY serial ORDER BY t_us)) // 1000000 AS d FROM obs) WHERE d > 0 GROUP BY 1),
 inf AS (SELECT sea.serial, sea_mean, sea_std, CAST(coalesce(ceil(72000.0 / dt_s), 1) AS BIGINT) AS ml FROM sea LEFT JOIN dt ON dt.serial = sea.serial),
 e0 AS (SELECT ends.serial, side, t_us, ys, sea_mean, sea_std, ml, row_number() OVER w AS k, sum(ys) OVER w AS s, sum(ys * ys) OVER w AS q,
  count(*) OVER p AS n, sum(ys) OVER p AS st, sum(ys * ys) OVER p AS qt FROM ends JOIN inf ON inf.serial = ends.serial
  WINDOW w AS (PARTITION BY ends.serial, side ORDER BY t_us), p AS (PARTITION BY ends.serial, side)),
 e1 AS (SELECT serial, side, k, s / k AS m1, (st - s) / nullif(n - k, 0) AS m2, row_number() OVER (PARTITION BY serial, side ORDER BY
  q - k * (s / k) * (s / k) + (qt - q) - (n - k) * ((st - s) / nullif(n - k, 0)) * ((st - s) / nullif(n - k, 0)), k) AS rk
  FROM e0 WHERE n >= 2 * ml + 1 AND k >= ml AND n - k >= ml),
 cp AS (SELECT e.serial, e.side, coalesce(max(CASE WHEN rk = 1 THEN e1.k END), greatest(max(ml), max(n) // 2)) AS k,
  coalesce(max(CASE WHEN rk = 1 THEN m1 END), max(st / n)) AS m1, coalesce(max(CASE WHEN rk = 1 THEN m2 END), max(st / n)) AS m2
  FROM (SELECT serial, side, max(ml) AS ml, max(n) AS n, max(st) AS st FROM e0 GROUP BY 1, 2) e LEFT JOIN e1 ON e1.serial = e.serial AND e1.side = e.side GROUP BY 1, 2),
 e2 AS (SELECT e0.serial, e0.side, t_us, ys, ml, e0.k - 1 AS j, cp.k AS ck, m1, m2, n >= 2 * ml + 1 AND CASE WHEN e0.side = 'early'
  THEN m2 < m1 AND abs(m2 - sea_mean) <= abs(m1 - sea_mean) ELSE m1 < m2 AND abs(m1 - sea_mean) <= abs(m2 - sea_mean) END AS pref,
  ys <= sea_mean + 2.0 * sea_std AS cold FROM e0 JOIN cp ON cp.serial = e0.serial AND cp.side = e0.side),
 e3 AS (SELECT *, CASE WHEN cold AND (NOT pref OR CASE WHEN side = 'early' THEN j >= ck ELSE j < ck END) THEN 1 ELSE 0 END AS ok FROM e2),
 e4 AS (SELECT *, j - sum(ok) OVER (PARTITION BY serial, side ORDER BY j) AS run FROM e3),
 r AS (SELECT serial, side, min(j) AS s0, max(j) AS e1, min(t_us) AS t0, max(t_us) AS t1 FROM e4 WHERE ok = 1 GROUP BY serial, side, run HAVING count(*) >= max(ml)),
 rp AS (SELECT serial, side, min(s0) AS s0, max(e1) AS e1, min(t0) AS t0, max(t1) AS t1 FROM r GROUP BY 1, 2),
 w AS (SELECT e3.serial, e3.side, max(t0) AS t0, max(t1) AS t1, CASE WHEN bool_or(pref) THEN CASE WHEN e3.side = 'early' THEN max(m1) ELSE max(m2) END ELSE
  avg(CASE WHEN e3.side = 'early' AND j < s0 OR e3.side = 'late' AND j > e1 THEN ys END) END AS warm
  FROM e3 LEFT JOIN rp ON rp.serial = e3.serial AND rp.side = e3.side GROUP BY 1, 2),
 sf AS (SELECT sea.serial, max(CASE WHEN side = 'early' THEN t0 END) AS sink_us, max(CASE WHEN side = 'late' THEN t1 END) AS float_us,
  CASE WHEN avg(warm) IS NOT NULL THEN 0.5 * (max(sea_mean) + avg(warm)) ELSE max(sea_mean) + greatest(0.5, 2.0 * max(sea_std)) END AS threshold
  FROM sea LEFT JOIN w ON w.serial = sea.serial GROUP BY 1)"""


@query("g4_surface_times", oracle("obs deploy", f"SELECT serial, sink_us, float_us, {q6('threshold')} FROM sf", ", ".join([WINDOW, SEA, ENDS, SURFACE])))
def _(spark, sf):
    o, w, sea = _sea(spark, sf)
    d = dep.surface_times(o, S, "temp", w, sea, HOURS, dwell_seconds=72000)
    return rounded(d, "serial sink_us float_us", "threshold")


@query("g7_cold_regime", oracle("obs", f"SELECT th.serial, start_us, end_us, {q6('threshold')} FROM th LEFT JOIN rr ON rr.serial = th.serial", """
 th AS (SELECT serial, quantile_cont(temp, 0.6) AS threshold FROM obs GROUP BY 1),
 dt AS (SELECT serial, ceil(72000.0 / quantile_cont(d, 0.5)) AS ml FROM (SELECT serial, (t_us - lag(t_us) OVER (PARTITION BY serial ORDER BY t_us)) // 1000000 AS d FROM obs) GROUP BY 1),
 sm AS (SELECT serial, t_us, row_number() OVER (PARTITION BY serial ORDER BY t_us) AS i,
  median(temp) OVER (PARTITION BY serial ORDER BY t_us ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS ys FROM obs),
 b AS (SELECT sm.*, CASE WHEN ys <= threshold THEN 1 ELSE 0 END AS ok FROM sm JOIN th ON th.serial = sm.serial),
 g AS (SELECT *, i - sum(ok) OVER (PARTITION BY serial ORDER BY i) AS run FROM b),
 r AS (SELECT g.serial, min(t_us) AS a, max(t_us) AS z FROM g JOIN dt ON dt.serial = g.serial WHERE ok = 1 GROUP BY g.serial, run HAVING count(*) >= max(ml)),
 rr AS (SELECT serial, min(a) AS start_us, max(z) AS end_us FROM r GROUP BY 1)"""))
def _(spark, sf):
    d = dep.cold_regime(obs(spark, sf), S, "temp", 0.6, 72000)
    return rounded(d, "serial start_us end_us", "threshold")


@query("g8_suggest_trim", oracle("stage2", """SELECT serial, greatest(max(a1), max(a2)) AS start_us, least(max(b1), max(b2)) AS end_us FROM (SELECT serial,
 min(CASE WHEN abs(zt) < 0.5 THEN t_us END) AS a1, max(CASE WHEN abs(zt) < 0.5 THEN t_us END) AS b1,
 min(CASE WHEN abs(zp) < 0.5 THEN t_us END) AS a2, max(CASE WHEN abs(zp) < 0.5 THEN t_us END) AS b2 FROM (SELECT serial, t_us,
 (temp - a.mid_mean) / a.mid_std AS zt, (pres - b.mid_mean) / b.mid_std AS zp FROM stage2 LEFT JOIN m_temp a ON serial = s_temp
 LEFT JOIN m_pres b ON serial = s_pres) GROUP BY 1) GROUP BY 1""", _mid("temp") + "," + _mid("pres")))
def _(spark, sf):
    from moorspark.plans.standin import stage2

    return dep.suggest_trim(stage2(spark, sf), S, ["temp", "pres"], 90.0, 0.5)


@query("g9_trim_review", oracle("obs", f"""SELECT event_id, bound, CASE WHEN t_us BETWEEN a AND z THEN 'inside' ELSE 'outside' END AS place FROM (
 SELECT *, unnest(['start', 'end']) AS bound FROM obs JOIN (SELECT serial AS s, min(t_us) + {36 * H} AS a, max(t_us) - {36 * H} AS z FROM obs GROUP BY 1) ON s = serial)
 WHERE abs(t_us - CASE WHEN bound = 'start' THEN a ELSE z END) <= {12 * H}"""))
def _(spark, sf):
    o = obs(spark, sf)
    b = o.groupBy("serial").agg((F.min("t_us") + 36 * H).alias("start_us"), (F.max("t_us") - 36 * H).alias("end_us"))
    return dep.trim_review(o.select("event_id", "serial", "t_us"), S, b).select("event_id", "bound", "place")
