"""Queries of the calibration operators."""

from pyspark.sql import functions as F

from moorspark.operators import calibration as cal
from moorspark.plans.profile_queries import salinity_sql
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import calib, instr, obs, oracle, raw


def partial_calib(spark, sf):
    """Every seventh instrument lacks the pre, every eleventh the post offset."""
    k = F.col("serial")
    return calib(spark, sf).withColumn("pre", F.when(k % 7 != 0, F.col("pre"))).withColumn("post", F.when(k % 11 != 0, F.col("post")))


PART = """pc AS (SELECT serial, CASE WHEN serial % 7 <> 0 THEN pre END AS pre, CASE WHEN serial % 11 <> 0 THEN post END AS post, applied FROM calib)"""


@query("k1_average_offset", oracle("raw calib", f"""SELECT serial, okey, line, t_us, {q6('v')} FROM (SELECT r.serial, okey, line, t_us, v + CASE WHEN applied AND pre IS NOT NULL AND post IS NOT NULL
 THEN (pre + post) / 2 ELSE 0 END AS v FROM raw r LEFT JOIN pc c ON c.serial = r.serial)""", PART))
def _(spark, sf):
    d = cal.average_offset(raw(spark, sf), partial_calib(spark, sf), "v")
    return rounded(d, "serial okey line t_us", "v")


@query("k2_linear_drift", oracle("raw calib", f"""SELECT serial, okey, line, t_us, {q6('v')} FROM (SELECT r.serial, okey, line, t_us, v - (pre + (post - pre) * (CAST(t_us - min(t_us) OVER w AS DOUBLE) / (max(t_us) OVER w - min(t_us) OVER w))) AS v
 FROM raw r JOIN calib c ON c.serial = r.serial WINDOW w AS (PARTITION BY r.serial))"""))
def _(spark, sf):
    return rounded(cal.linear_drift(raw(spark, sf), calib(spark, sf), "v"), "serial okey line t_us", "v")


@query("k3_general_trend", oracle("calib", f"""SELECT serial, var, {q6('pre', 'post', 'trend')} FROM (SELECT serial, var, coalesce(pre, post - trend) AS pre, coalesce(post, pre + trend) AS post, trend FROM pv JOIN
 (SELECT var AS v, coalesce(avg(post) FILTER (ok) - avg(pre) FILTER (ok), 0) AS trend FROM (SELECT *, abs(pre) < CASE var WHEN 'conductivity' THEN 0.08 ELSE 3.0 END AND abs(post) < CASE var WHEN 'conductivity' THEN 0.08 ELSE 3.0 END AS ok FROM pv) GROUP BY 1)
 ON v = var)""", PART + """,
 pv AS (SELECT serial, 'conductivity' AS var, pre, post FROM pc UNION ALL SELECT serial, 'pressure', -50 * pre, 50 * post FROM pc)"""))
def _(spark, sf):
    c = partial_calib(spark, sf)
    both = c.withColumn("var", F.lit("conductivity")).unionByName(c.select("serial", "applied", (-50 * F.col("pre")).alias("pre"), (50 * F.col("post")).alias("post"), F.lit("pressure").alias("var")))
    return rounded(cal.general_trend(both, {"conductivity": 0.08, "pressure": 3.0}), "serial var", "pre post trend")


@query("k4_pressure_drift", oracle("raw calib", f"""SELECT serial, okey, line, t_us, {q6('v')} FROM (SELECT r.serial, okey, line, r.t_us, r.v - (a + b * x) + CASE WHEN pre IS NULL THEN a + b * x1 WHEN post IS NULL THEN a ELSE m END AS v
 FROM (SELECT *, (t_us - min(t_us) OVER (PARTITION BY serial)) / 8.64e10 AS x FROM raw) r JOIN (SELECT serial AS s, regr_slope(v, x) AS b, regr_intercept(v, x) AS a, avg(v) AS m, max(x) AS x1 FROM
 (SELECT *, (t_us - min(t_us) OVER (PARTITION BY serial)) / 8.64e10 AS x FROM raw) GROUP BY 1) ON s = r.serial LEFT JOIN pc c ON c.serial = r.serial)""", PART))
def _(spark, sf):
    return rounded(cal.remove_pressure_drift(raw(spark, sf), partial_calib(spark, sf), "v"), "serial okey line t_us", "v")


@query("k5_drift_acceptance", oracle("obs", f"""SELECT serial, delta <= 0 AS accepted, {q6('std_before', 'std_after', 'delta')} FROM (SELECT serial, stddev_samp({salinity_sql('cond', 'temp', 'pres')}) AS std_before,
 stddev_samp({salinity_sql('cond', 'temp', '(pres - 50)')}) AS std_after, std_after - std_before AS delta FROM obs GROUP BY 1)"""))
def _(spark, sf):
    d = obs(spark, sf).withColumn("pres2", F.col("pres") - 50)
    return rounded(cal.drift_acceptance(d, ["serial"], "cond", "temp", "pres", "pres2"), "serial accepted", "std_before std_after delta")


@query("k6_provenance", oracle("raw calib", f"""SELECT serial, okey, line, t_us, calibrated, calibration_notes, calibration_source, calibration_operator, {q6('value_before', 'value')} FROM (SELECT r.serial, okey, line, t_us, v AS value_before,
 v + CASE WHEN applied THEN (pre + post) / 2 ELSE 0 END AS value, coalesce(applied, false) AND pre + post <> 0 AS calibrated, CASE WHEN applied THEN 'average of pre and post offset' ELSE 'not applied' END AS calibration_notes,
 'calibration log' AS calibration_source, 'auto' AS calibration_operator FROM raw r LEFT JOIN calib c ON c.serial = r.serial)"""))
def _(spark, sf):
    c = calib(spark, sf)
    d = raw(spark, sf).withColumn("orig", F.col("v"))
    d = cal.average_offset(d, c, "v").join(c.select("serial", "applied"), "serial", "left")
    notes = F.when(F.col("applied"), "average of pre and post offset").otherwise("not applied")
    d = d.select("serial", "okey", "line", "t_us", *cal.with_provenance(F.col("orig"), F.col("v"), notes, "calibration log", "auto"))
    return rounded(d, "serial okey line t_us calibrated calibration_notes calibration_source calibration_operator", "value_before value")
