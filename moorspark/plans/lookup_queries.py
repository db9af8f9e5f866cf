"""Queries of the relational lookups."""

from pyspark.sql import functions as F

from moorspark.operators import lookup
from moorspark.operators.series import every_nth
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import deploy, instr, obs, oracle, stage2, us

H = 3_600_000_000


@query("d1_configure_samples", oracle("obs instr deploy", """SELECT event_id, o.mooring, o.serial, depth, clock_offset, instrument, epoch_us(deployment_time) AS deploy_us FROM obs o JOIN instr i ON i.serial = o.serial AND i.mooring = o.mooring
 JOIN deploy d ON d.mooring = o.mooring"""))
def _(spark, sf):
    d = lookup.configure_samples(obs(spark, sf), instr(spark, sf), deploy(spark, sf))
    return d.select("event_id", "mooring", "serial", "depth", "clock_offset", "instrument", us("deployment_time").alias("deploy_us"))


@query("d2_expected_found", oracle("obs instr", """SELECT mooring, count(*) AS expected, count(f) AS found, coalesce(string_agg(CASE WHEN f IS NULL THEN serial END, ',' ORDER BY serial), '') AS missing FROM (SELECT i.*,
 (SELECT max(1) FROM obs o WHERE o.serial = i.serial AND o.mooring = i.mooring AND temp > 25) AS f FROM instr i) GROUP BY 1"""))
def _(spark, sf):
    return lookup.expected_found(instr(spark, sf), obs(spark, sf).where("temp > 25"))


@query("d3_interval_membership", oracle("obs", f"""SELECT o.event_id, iv.event_id AS interval_id FROM obs o JOIN (SELECT event_id, serial, t_us AS t0, t_us + {30 * H} AS t1 FROM obs WHERE kind = 'error') iv
 ON iv.serial = o.serial AND o.t_us BETWEEN t0 AND t1"""))
def _(spark, sf):
    o = obs(spark, sf)
    iv = o.where("kind = 'error'").select(F.col("event_id").alias("interval_id"), "serial", F.col("t_us").alias("t0"), (F.col("t_us") + 30 * H).alias("t1"))
    return lookup.in_intervals(o, iv, "serial").select("event_id", "interval_id")


@query("d4_around_boundary", oracle("obs instr deploy", """SELECT x.event_id, x.bound, x.i - n.i AS offset_rows FROM x JOIN (SELECT mooring, serial, bound, arg_min(i, {'d': d, 'i': i}) AS i FROM x GROUP BY 1, 2, 3) n
 ON n.serial = x.serial AND n.mooring = x.mooring AND n.bound = x.bound AND abs(x.i - n.i) <= 3""", """b AS (SELECT i.mooring, i.serial, 'start' AS bound, epoch_us(deployment_time) AS b_us FROM instr i JOIN deploy d ON d.mooring = i.mooring
 UNION ALL SELECT i.mooring, i.serial, 'end', epoch_us(recovery_time) FROM instr i JOIN deploy d ON d.mooring = i.mooring WHERE recovery_time IS NOT NULL),
 x AS (SELECT o.event_id, o.mooring, o.serial, bound, i, abs(t_us - b_us) AS d FROM (SELECT *, row_number() OVER (PARTITION BY mooring, serial ORDER BY t_us) - 1 AS i FROM obs) o JOIN b ON b.serial = o.serial AND b.mooring = o.mooring)"""))
def _(spark, sf):
    c = instr(spark, sf).join(deploy(spark, sf), "mooring")
    b = c.select("mooring", "serial", F.explode(F.array(
        F.struct(F.lit("start").alias("bound"), us("deployment_time").alias("b_us")),
        F.struct(F.lit("end").alias("bound"), us("recovery_time").alias("b_us")))).alias("s")).select("mooring", "serial", "s.bound", "s.b_us")
    d = lookup.around_boundary(obs(spark, sf).select("event_id", "mooring", "serial", "t_us"), b, ["mooring", "serial"], 3)
    return d.select("event_id", "bound", "offset_rows")


@query("d5_difference", oracle("stage2", f"SELECT event_id, {q6('temp', 'pres')} FROM (SELECT a.event_id, a.temp - b.temp AS temp, a.pres - b.pres AS pres FROM stage2 a JOIN obs b ON b.event_id = a.event_id)"))
def _(spark, sf):
    a = stage2(spark, sf)
    b = obs(spark, sf).join(a.select("event_id"), "event_id", "left_semi")
    return rounded(lookup.difference(a, b, ["event_id"], ["temp", "pres"]), "event_id", "temp pres")


@query("d8_lagged_pairs", oracle("obs", f"""SELECT y.serial, x.k, x.k - y.k AS lag, {q6('x.temp', 'y.temp').replace('AS x.temp', 'AS x').replace('AS y.temp', 'AS y')} FROM su x JOIN su y ON x.mooring = y.mooring AND x.serial = x.mooring
 AND abs(x.k - y.k) <= 3""", """su AS (SELECT mooring, serial, temp, i // 5 AS k FROM (SELECT *, row_number() OVER (PARTITION BY serial ORDER BY t_us) - 1 AS i FROM obs) WHERE i % 5 = 0)"""))
def _(spark, sf):
    s = every_nth(obs(spark, sf), ["serial"], 5, index="k").select("mooring", "serial", "k", "temp")
    x = s.where("serial = mooring").select("mooring", "k", "temp")
    d = lookup.lagged_pairs(x, s, ["mooring"], "k", 3, "temp", "temp", keep=["serial"])
    return rounded(d, "serial k lag", "x y")
