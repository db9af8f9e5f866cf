"""Queries of the statistics and report operators."""

from pyspark.sql import functions as F

from moorspark.operators import stats
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import configured, instr, obs, oracle, stage2, table

SAMPLING = """d AS (SELECT mooring, serial, t_us,
 (t_us - lag(t_us) OVER (PARTITION BY mooring, serial ORDER BY t_us)) / 60e6 AS dt FROM stage2),
 st AS (SELECT mooring, serial, count(*) AS n, min(t_us) AS start_us, max(t_us) AS end_us,
 quantile_cont(dt, 0.5) AS median_dt, min(dt) AS min_dt, max(dt) AS max_dt, stddev_pop(dt) AS std_dt
 FROM d GROUP BY 1, 2 HAVING count(*) > 1)"""


def sampling(spark, sf):
    return stats.sampling_stats(stage2(spark, sf), ["mooring", "serial"])


@query("e1_sampling_stats", oracle("stage2", "SELECT mooring, serial, n, start_us, end_us, "
                                   + q6("median_dt", "min_dt", "max_dt", "std_dt") + " FROM st", SAMPLING))
def _(spark, sf):
    return rounded(sampling(spark, sf), "mooring serial n start_us end_us", "median_dt min_dt max_dt std_dt")


@query("e2_timing_report", oracle("stage2", f"""SELECT mooring, serial, rate_warning, std_dt > 0.1 * median_dt AS irregular,
 CASE WHEN abs(median_dt - common_dt) / median_dt * 100 > 10 THEN 'SIGNIFICANT'
 WHEN abs(median_dt - common_dt) / median_dt * 100 > 1 THEN 'MINOR' ELSE 'MINIMAL' END AS change,
 {q6('common_dt', 'median_dt')} FROM st JOIN (SELECT mooring AS m, quantile_cont(median_dt, 0.5) AS common_dt,
 max(median_dt) / min(median_dt) > 2 AS rate_warning FROM st GROUP BY 1) ON m = mooring""", SAMPLING))
def _(spark, sf):
    d = stats.timing_report(sampling(spark, sf))
    return rounded(d, "mooring serial rate_warning irregular change", "common_dt median_dt")


@query("e3_middle_bounds", oracle("stage2", f"SELECT serial, {q6('lo', 'hi')} FROM (SELECT serial, quantile_cont(temp, 0.05)"
                                  " AS lo, quantile_cont(temp, 0.95) AS hi FROM stage2 GROUP BY 1)"))
def _(spark, sf):
    return rounded(stats.middle_bounds(stage2(spark, sf), ["serial"], "temp", 90.0), "serial", "lo hi")


def _mid(v):
    return (f"b_{v} AS (SELECT serial AS s_{v}, quantile_cont({v}, 0.05) AS lo, quantile_cont({v}, 0.95) AS hi FROM stage2 GROUP BY 1),"
            f" m_{v} AS (SELECT serial AS s_{v}, avg({v}) AS mid_mean, stddev_pop({v}) AS mid_std FROM stage2 JOIN b_{v}"
            f" ON serial = s_{v} WHERE {v} BETWEEN lo AND hi GROUP BY 1)")


@query("e4_middle_stats", oracle("stage2", f"SELECT s_temp AS serial, {q6('mid_mean', 'mid_std')} FROM m_temp", _mid("temp")))
def _(spark, sf):
    return rounded(stats.middle_stats(stage2(spark, sf), ["serial"], "temp", 90.0), "serial", "mid_mean mid_std")


@query("e5_normalise", oracle("stage2", f"""SELECT event_id, {q6('z_temp', 'z_cond')} FROM (SELECT event_id,
 (temp - a.mid_mean) / a.mid_std AS z_temp, (cond - b.mid_mean) / b.mid_std AS z_cond FROM stage2
 LEFT JOIN m_temp a ON serial = s_temp LEFT JOIN m_cond b ON serial = s_cond)""", _mid("temp") + "," + _mid("cond")))
def _(spark, sf):
    d = stats.normalise(stage2(spark, sf), ["serial"], ["temp", "cond"], 90.0)
    return rounded(d, "event_id", "z_temp z_cond")


@query("e6_histogram_split", oracle("obs", f"SELECT mooring, {q6('split_value')} FROM split", """
 r AS (SELECT mooring, min(temp) AS lo, max(temp) - min(temp) AS rg FROM obs GROUP BY 1),
 h AS (SELECT o.mooring, CAST(least(floor((temp - lo) / rg * 30), 29) AS INT) AS bin, count(*) AS n
  FROM obs o JOIN r ON r.mooring = o.mooring GROUP BY 1, 2),
 c AS (SELECT r.mooring, CAST(b AS INT) AS bin, coalesce(n, 0) AS n FROM r, unnest(range(0, 30)) u(b)
  LEFT JOIN h ON h.mooring = r.mooring AND h.bin = b),
 x AS (SELECT *, CASE WHEN n = lag(n) OVER (PARTITION BY mooring ORDER BY bin) THEN 0 ELSE 1 END AS fresh FROM c),
 y AS (SELECT *, sum(fresh) OVER (PARTITION BY mooring ORDER BY bin) AS g FROM x),
 p AS (SELECT mooring, g, min(bin) AS b0, max(bin) AS b1, min(n) AS n FROM y GROUP BY 1, 2),
 pk AS (SELECT mooring, CAST(floor((b0 + b1) / 2.0) AS INT) AS pos FROM (SELECT *, lag(n) OVER w AS ln, lead(n) OVER w AS rn
  FROM p WINDOW w AS (PARTITION BY mooring ORDER BY g)) WHERE n > ln AND n > rn),
 two AS (SELECT mooring, pos, row_number() OVER (PARTITION BY mooring ORDER BY pos) AS k FROM pk),
 pr AS (SELECT mooring, max(CASE WHEN k = 1 THEN pos END) AS p1, max(CASE WHEN k = 2 THEN pos END) AS p2 FROM two GROUP BY 1),
 best AS (SELECT c.mooring, arg_min(bin, n * 100 + bin) AS bin FROM c JOIN pr ON pr.mooring = c.mooring
  WHERE bin >= p1 AND bin < p2 GROUP BY 1),
 split AS (SELECT r.mooring, lo + bin * (rg / 30) AS split_value FROM r LEFT JOIN best ON best.mooring = r.mooring)"""))
def _(spark, sf):
    return rounded(stats.histogram_split(obs(spark, sf), ["mooring"], "temp"), "mooring", "split_value")


@query("e8_climatology_ranges", oracle("obs instr", """SELECT mooring, depth, round(avg(temp) - 3 * stddev_pop(temp), 2) + 0.0 AS vmin,
 round(avg(temp) + 3 * stddev_pop(temp), 2) + 0.0 AS vmax FROM obs JOIN instr USING (serial, mooring) GROUP BY 1, 2"""))
def _(spark, sf):
    d = obs(spark, sf).join(instr(spark, sf).select("mooring", "serial", "depth"), ["mooring", "serial"])
    d = stats.climatology_ranges(d, ["mooring", "depth"], "temp")
    return d.select("mooring", "depth", (F.col("vmin") + 0.0).alias("vmin"), (F.col("vmax") + 0.0).alias("vmax"))


@query("e9_flag_summary", oracle("obs", f"""SELECT serial, flag, n, {q6('percent')} FROM (SELECT serial, flag, n,
 100.0 * n / sum(n) OVER (PARTITION BY serial) AS percent FROM (SELECT serial,
 CAST(CASE WHEN temp > 20 THEN 4 WHEN temp > 10 THEN 3 ELSE 1 END AS INT) AS flag, count(*) AS n FROM obs GROUP BY 1, 2))"""))
def _(spark, sf):
    t = F.col("temp")
    d = obs(spark, sf).withColumn("flag", F.when(t > 20, 4).when(t > 10, 3).otherwise(1))
    return rounded(stats.flag_summary(d, ["serial"], "flag"), "serial flag n", "percent")


@query("e10_batch_report", oracle("obs instr", """SELECT mooring, count(*) AS total, CAST(sum(ok) AS BIGINT) AS processed, sum(ok) > 0 AS success
 FROM (SELECT i.mooring, CASE WHEN EXISTS (SELECT 1 FROM obs o WHERE o.serial = i.serial AND o.mooring = i.mooring AND temp > 25) THEN 1 ELSE 0 END AS ok
 FROM instr i) GROUP BY 1"""))
def _(spark, sf):
    return stats.batch_report(instr(spark, sf), obs(spark, sf).where("temp > 25"))


def sensor_variables(spark, sf):
    """Variables of each instrument type, from the event kinds its records carry."""
    return obs(spark, sf).join(instr(spark, sf).select("mooring", "serial", "instrument"), ["mooring", "serial"]).select(
        "instrument", F.col("kind").alias("var")).distinct()


@query("e11_sensor_map", oracle("obs instr", """SELECT mooring, depth, array_to_string(list_sort(list(DISTINCT kind)), ', ') AS vars,
 array_to_string(list_sort(list(DISTINCT i.serial)), ',') AS serials FROM instr i JOIN (SELECT DISTINCT instrument, kind FROM obs
 JOIN instr USING (mooring, serial)) v USING (instrument) GROUP BY 1, 2"""))
def _(spark, sf):
    return stats.sensor_map(instr(spark, sf), sensor_variables(spark, sf))


@query("e12_stacked_attributes", oracle("instr", """SELECT mooring, 'Time series from ' || mooring || '_9' AS title,
 'OS_' || mooring || '_9_P' AS id, min(depth) AS geospatial_vertical_min, max(depth) AS geospatial_vertical_max,
 (SELECT string_agg(f, ', ' ORDER BY f) FROM (SELECT DISTINCT unnest([instrument || '.nc', 'common.nc']) AS f FROM instr j
  WHERE j.mooring = i.mooring)) AS source FROM instr i GROUP BY mooring"""))
def _(spark, sf):
    d = instr(spark, sf).select(
        "mooring", "depth", F.col("mooring").cast("string").alias("platform"), F.lit("9").alias("deployment"),
        F.concat("instrument", F.lit(".nc, common.nc")).alias("source"))
    return stats.stacked_attributes(d)


@query("e13_coverage_table", oracle("stage2 configured", """SELECT i.mooring, i.serial, i.instrument, i.depth,
 CASE WHEN st.n IS NULL THEN 'MISSING' ELSE 'OK' END AS status, coalesce(st.n, 0) AS points, start_us, end_us,
 CASE WHEN median_dt > 1 THEN CAST(round(median_dt) AS BIGINT) || ' min'
  WHEN median_dt IS NOT NULL THEN CAST(round(median_dt * 60) AS BIGINT) || ' sec' END AS sampling,
 CASE WHEN st.n IS NOT NULL THEN vars END AS vars FROM configured i LEFT JOIN st ON st.serial = i.serial AND st.mooring = i.mooring LEFT JOIN
 (SELECT instrument, array_to_string(list_sort(list(DISTINCT kind)), ', ') AS vars FROM obs JOIN instr USING (mooring, serial) GROUP BY 1) v
 ON v.instrument = i.instrument""", SAMPLING))
def _(spark, sf):
    st = stats.sampling_stats(stage2(spark, sf), ["mooring", "serial"])
    return stats.coverage_table(configured(spark, sf), st, sensor_variables(spark, sf))


@query("e14_percentile_limits", oracle("obs", f"SELECT var, {q6('lo', 'hi')} FROM (" + " UNION ALL ".join(
    f"SELECT '{v}' AS var, quantile_cont({v}, 0.01) AS lo, quantile_cont({v}, 0.99) AS hi FROM obs" for v in ("temp", "cond", "pres")) + ")"))
def _(spark, sf):
    return rounded(stats.percentile_limits(obs(spark, sf), ["temp", "cond", "pres"]), "var", "lo hi")
