"""Queries of the clock-offset operators."""

from pyspark.sql import functions as F

from moorspark.operators import clock, grid, stats
from moorspark.operators.ordered import attach
from moorspark.plans.grid_queries import LEVELS, SEG
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import instr, obs, oracle, stage2, stored
from moorspark.session import materialize

TIMES = """lv0 AS (SELECT serial, mooring, position AS level FROM instr),
 tm AS (SELECT l.mooring, l.level, l.serial, min(CASE WHEN temp < 10 THEN t_us END) AS start_us, max(CASE WHEN temp < 10 THEN t_us END) AS end_us
 FROM obs o JOIN lv0 l ON l.serial = o.serial AND l.mooring = o.mooring GROUP BY 1, 2, 3),
 p0 AS (SELECT *, (start_us - min(start_us) OVER (PARTITION BY mooring)) / 1e6 AS start_off0,
 (end_us - max(end_us) OVER (PARTITION BY mooring)) / 1e6 AS end_off0 FROM tm)"""
CONS = """pb AS (SELECT *, CAST(floor(start_off0 / 7200.0) AS BIGINT) AS b FROM p0),
 bb AS (SELECT mooring, b, row_number() OVER (PARTITION BY mooring ORDER BY count(*) DESC, b) AS rk, count(end_us) AS both_n FROM pb WHERE b IS NOT NULL GROUP BY 1, 2),
 cs AS (SELECT pb.*, coalesce(pb.b = bb.b AND (both_n = 0 OR end_us IS NOT NULL), false) AS in_consensus FROM pb LEFT JOIN bb ON bb.mooring = pb.mooring AND rk = 1),
 rf AS (SELECT mooring AS m, min(start_us) FILTER (in_consensus) AS rs, max(end_us) FILTER (in_consensus) AS re FROM cs GROUP BY 1),
 off AS (SELECT mooring, level, serial, in_consensus, start_us, end_us, (start_us - rs) / 1e6 AS start_offset, (end_us - re) / 1e6 AS end_offset,
 ((start_us - rs) / 1e6 + (end_us - re) / 1e6) / 2.0 AS avg_offset, (start_us - rs) / 1e6 - (end_us - re) / 1e6 AS diff_offset,
 ((end_us - re) / 1e6 - (start_us - rs) / 1e6) / CASE WHEN end_us > start_us THEN (end_us - start_us) / 1e6 END * 86400.0 AS drift_per_day FROM cs JOIN rf ON m = mooring)"""


def times(spark, sf):
    """First and last cold time per level of each mooring."""
    lv = grid.levels(instr(spark, sf)).select("mooring", "serial", "level")
    cold = F.when(F.col("temp") < 10, F.col("t_us"))
    return obs(spark, sf).join(lv, ["mooring", "serial"]).groupBy("mooring", "level", "serial").agg(
        F.min(cold).alias("start_us"), F.max(cold).alias("end_us"))


@query("h1_provisional_offsets", oracle("obs instr", f"SELECT mooring, serial, {q6('start_off0', 'end_off0')} FROM p0", TIMES))
def _(spark, sf):
    return rounded(clock.provisional_offsets(times(spark, sf)), "mooring serial", "start_off0 end_off0")


@query("h2_consensus", oracle("obs instr", "SELECT mooring, serial, in_consensus FROM cs", TIMES + "," + CONS))
def _(spark, sf):
    return clock.consensus(times(spark, sf), bin_seconds=7200.0).select("mooring", "serial", "in_consensus")


@query("h3_timing_offsets", oracle("obs instr", f"SELECT mooring, level, serial, {q6('start_offset', 'end_offset', 'avg_offset', 'diff_offset', 'drift_per_day')} FROM off",
                                   TIMES + "," + CONS))
def _(spark, sf):
    return rounded(clock.timing_offsets(times(spark, sf), bin_seconds=7200.0), "mooring level serial",
                   "start_offset end_offset avg_offset diff_offset drift_per_day")


@query("h4_suggest_reference", oracle("obs instr", f"SELECT mooring, ref_level, ref_serial, reason, {q6('offset_seconds')} FROM (SELECT mooring, level AS ref_level, serial AS ref_serial,"
                                      " 'smallest absolute average timing offset' AS reason, avg_offset AS offset_seconds, row_number() OVER"
                                      " (PARTITION BY mooring ORDER BY abs(avg_offset), level) AS rk FROM off WHERE avg_offset IS NOT NULL) WHERE rk = 1", TIMES + "," + CONS))
def _(spark, sf):
    return rounded(clock.suggest_reference(clock.timing_offsets(times(spark, sf), bin_seconds=7200.0)),
                   "mooring ref_level ref_serial reason", "offset_seconds")


def gridded(spark, sf):
    d = stored(stage2, spark, sf)
    st = stats.sampling_stats(d, ["mooring", "serial"])
    g = grid.common_grid(st)
    c = grid.interpolate(d, g, ["mooring", "serial"], ["mooring"], ["temp"], whole_grid=True)
    s = grid.stack_levels(c, grid.levels(instr(spark, sf), st), ["temp"])
    # the gridded product is a stored table: the lag analysis reads it several times
    return materialize(attach(s, g.select("mooring", "step_us"), ["mooring"]), "gridded")


PAIRS = """sb AS (SELECT mooring, level, clock_offset, temp, row_number() OVER (PARTITION BY mooring, level ORDER BY t_us) - 1 AS i FROM stk),
 su AS (SELECT mooring, level, clock_offset, temp, i // 2 AS k FROM sb WHERE i % 2 = 0),
 ns AS (SELECT mooring, (max(k) + 1) // 5 AS ml FROM su GROUP BY 1),
 lc AS (SELECT a.mooring, a.level, a.lag, count(x.temp) AS n, CASE WHEN count(x.temp) >= 10 THEN corr(x.temp, y.temp) END AS corr
 FROM (SELECT s.mooring, level, lag FROM (SELECT DISTINCT mooring, level FROM su) s JOIN ns ON ns.mooring = s.mooring, unnest(range(-ml, ml + 1)) u(lag)) a
 LEFT JOIN (su x JOIN su y ON x.mooring = y.mooring AND x.level = 0 AND x.temp IS NOT NULL AND y.temp IS NOT NULL) ON y.mooring = a.mooring AND y.level = a.level AND x.k - y.k = a.lag GROUP BY 1, 2, 3)"""


def reference(spark, sf):
    return instr(spark, sf).select("mooring", F.lit(0).cast("long").alias("ref_level")).distinct()


@query("h5_lag_correlation", oracle("stage2", f"SELECT mooring, level, lag, n, {q6('corr')} FROM lc", ", ".join([SEG, LEVELS, PAIRS])))
def _(spark, sf):
    from moorspark.operators.series import every_nth

    sub = every_nth(gridded(spark, sf).select("mooring", "level", "t_us", "temp"), ["mooring", "level"], 2, index="k")
    n = sub.groupBy("mooring").agg(F.floor((F.max("k") + 1) / 5).alias("ml"))
    p = clock.pair_with_reference(sub, reference(spark, sf), "temp").join(n, "mooring")
    d = clock.lag_correlation(p, ["mooring", "level"], "x", "y", "k", "ml")
    return rounded(d, "mooring level lag n", "corr")


BEST = """bl AS (SELECT lc.mooring, lc.level, arg_max(lag, {'c': round(corr, 12), 'l': -lag}) AS lag, max(corr) AS max_corr FROM lc WHERE corr IS NOT NULL GROUP BY 1, 2),
 bo AS (SELECT bl.*, lag * 2 * step_us / 1e6 + clock_offset AS recommended_clock_offset FROM bl JOIN g ON g.mooring = bl.mooring
 JOIN lv ON lv.mooring = bl.mooring AND lv.level = bl.level)"""


def best(spark, sf):
    lv = grid.levels(instr(spark, sf)).select("mooring", "level", "clock_offset")
    return clock.best_lag(gridded(spark, sf), reference(spark, sf), lv, "temp", 2)


@query("h6_best_lag", oracle("stage2", f"SELECT mooring, level, lag, {q6('max_corr', 'recommended_clock_offset')} FROM bo", ", ".join([SEG, LEVELS, PAIRS, BEST])))
def _(spark, sf):
    return rounded(best(spark, sf), "mooring level lag", "max_corr recommended_clock_offset")


@query("h7_offset_summary", oracle("obs instr", f"""SELECT mooring, level, 'Level ' || (level + 1) || ' (#' || serial || '): start ' || printf('%+.1f', start_offset) || 's end ' ||
 printf('%+.1f', end_offset) || 's avg ' || printf('%+.1f', avg_offset) || 's diff ' || printf('%+.1f', diff_offset) || 's drift ' || printf('%+.3f', drift_per_day) ||
 's/day' || CASE WHEN in_consensus THEN ' REF' ELSE '' END AS summary, {q6('recommended_clock_offset')} FROM (SELECT *, -avg_offset AS recommended_clock_offset FROM off)""", TIMES + "," + CONS))
def _(spark, sf):
    d = clock.offset_summary(clock.timing_offsets(times(spark, sf), bin_seconds=7200.0))
    return rounded(d, "mooring level summary", "recommended_clock_offset")


@query("h7_correlation_summary", oracle("stage2", """SELECT mooring, level, printf('Level %d: max corr = %.3f @lag %d --> clock_offset: %.0fs', level + 1, max_corr, lag,
 CAST(recommended_clock_offset AS DOUBLE)) AS summary FROM bo""", ", ".join([SEG, LEVELS, PAIRS, BEST])))
def _(spark, sf):
    return clock.correlation_summary(best(spark, sf)).select("mooring", "level", "summary")
