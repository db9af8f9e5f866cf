"""Queries of the whole processing steps."""


from moorspark.plans import jobs
from moorspark.plans.grid_queries import LEVELS, SEG
from moorspark.plans.mooring_step import mooring_step
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import configured, deploy, instr, obs, oracle, stage2, stored
from moorspark.session import scratch_path

_COUNTS = """nin AS (SELECT mooring, serial, count(*) AS n_in FROM obs GROUP BY 1, 2),
 nout AS (SELECT mooring, serial, count(*) AS n_out FROM stage2 GROUP BY 1, 2)"""


@query("p1_stage2_status", oracle("stage2 configured", """SELECT mooring, serial, coalesce(n_in, 0) AS n_in, coalesce(n_out, 0) AS n_out, CASE WHEN n_out > 0 THEN 'ok' WHEN n_in > 0 THEN 'emptied' ELSE 'no data' END AS status
 FROM configured LEFT JOIN nin USING (mooring, serial) LEFT JOIN nout USING (mooring, serial)""", _COUNTS))
def _(spark, sf):
    return jobs.stage2_step(obs(spark, sf), configured(spark, sf), deploy(spark, sf), scratch_path(spark, "stage2"))[1]


@query("p1_stage2_report", oracle("stage2 configured", """SELECT mooring, count(*) AS total, count(n_out) AS processed, count(n_out) > 0 AS success FROM configured LEFT JOIN nout USING (mooring, serial) GROUP BY 1""", _COUNTS))
def _(spark, sf):
    return jobs.stage2_step(obs(spark, sf), configured(spark, sf), deploy(spark, sf))[2]


@query("p2_mooring_status", oracle("stage2", """SELECT mooring, serial, count(temp) AS n_temp, count(cond) AS n_cond FROM instr LEFT JOIN (SELECT mooring AS m, serial AS s, temp, cond FROM stk) ON m = mooring AND s = serial GROUP BY 1, 2""", SEG + "," + LEVELS))
def _(spark, sf):
    i = instr(spark, sf)
    return jobs.product_status(i, mooring_step(stored(stage2, spark, sf), i, ["temp", "cond"]), ["temp", "cond"])


@query("p3_clock_offsets")
def _(spark, sf):
    """Timing offsets of the clock step over all moorings (the parts have their own restatements: g6, h3, h6)."""
    offsets, _ = jobs.clock_step(stored(stage2, spark, sf), instr(spark, sf), "temp", bin_seconds=7200.0, sub_sample=2, smooth_window=9, hours=96.0)
    return rounded(offsets, "mooring level serial", "start_offset end_offset avg_offset")
