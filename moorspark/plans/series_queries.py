"""Queries of the windowed series operators and filters."""

from pyspark.sql import functions as F

from moorspark.operators import filters, series
from moorspark.operators.ordered import DAY_US
from moorspark.plans import filter_sql
from moorspark.plans.grid_queries import DEPTH, depth_records
from moorspark.plans.profile_views import CLIM_RAW, clim_raw
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import obs, oracle, stage2, stored

S = ["serial"]


def gappy(spark, sf):
    """Records with nulls strewn in and one longer hole per record."""
    h = (F.col("event_id") % 6 == 0) | (F.floor(F.col("t_us") / DAY_US) % 10 == 3)
    return obs(spark, sf).select("event_id", "serial", "t_us", F.when(~h, F.col("temp")).alias("v"))


GAPPY = f"gap AS (SELECT event_id, serial, t_us, CASE WHEN event_id % 6 = 0 OR t_us // {DAY_US} % 10 = 3 THEN NULL ELSE temp END AS v FROM obs)"
RUNS = """rr AS (SELECT *, row_number() OVER w - 1 AS i, CASE WHEN temp > 3 THEN 1 ELSE 0 END AS ok FROM obs WINDOW w AS (PARTITION BY serial ORDER BY t_us)),
 ri AS (SELECT *, i - sum(ok) OVER (PARTITION BY serial ORDER BY i) AS run FROM rr),
 runs AS (SELECT serial, min(i) AS start_idx, max(i) AS end_idx, min(t_us) AS start_t_us, max(t_us) AS end_t_us, count(*) AS length
 FROM ri WHERE ok = 1 GROUP BY serial, run)"""


@query("f1_rolling_median", oracle("obs", f"SELECT event_id, {q6('temp_median')} FROM (SELECT event_id, median(v) OVER (PARTITION BY serial"
                                   " ORDER BY t_us ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS temp_median FROM gap)", GAPPY))
def _(spark, sf):
    return rounded(series.rolling_median(gappy(spark, sf), S, "v", 9, "temp_median"), "event_id", "temp_median")


@query("f2_runs", oracle("obs", "SELECT * FROM runs", RUNS))
def _(spark, sf):
    return series.runs(obs(spark, sf), S, F.col("temp") > 3)


@query("f3_first_last_run", oracle("obs", """SELECT serial, min(start_idx) AS first_start, arg_min(end_idx, start_idx) AS first_end,
 arg_max(start_idx, end_idx) AS last_start, max(end_idx) AS last_end FROM runs WHERE length >= 2 GROUP BY 1""", RUNS))
def _(spark, sf):
    return series.first_last_run(series.runs(obs(spark, sf), S, F.col("temp") > 3), S, 2)


@query("f4_sampling_interval", oracle("obs", f"""SELECT serial, {q6('dt_s')} FROM (SELECT serial, quantile_cont(d, 0.5) AS dt_s FROM (
 SELECT serial, (t_us - lag(t_us) OVER (PARTITION BY serial ORDER BY t_us)) // 1000000 AS d FROM obs) WHERE d > 0 GROUP BY 1)"""))
def _(spark, sf):
    return rounded(series.sampling_interval(obs(spark, sf), S), "serial", "dt_s")


@query("f5_change_point", oracle("obs", f"SELECT serial, k, {q6('mu_left', 'mu_right')} FROM cp", """
 a AS (SELECT serial, temp AS y, row_number() OVER w AS k, sum(temp) OVER w AS s, sum(temp * temp) OVER w AS q,
  count(*) OVER p AS n, sum(temp) OVER p AS st, sum(temp * temp) OVER p AS qt FROM obs
  WINDOW w AS (PARTITION BY serial ORDER BY t_us), p AS (PARTITION BY serial)),
 b AS (SELECT *, q - k * (s / k) * (s / k) + (qt - q) - (n - k) * ((st - s) / (n - k)) * ((st - s) / (n - k)) AS sse
  FROM a WHERE k BETWEEN 3 AND n - 3 AND n >= 7),
 c AS (SELECT *, row_number() OVER (PARTITION BY serial ORDER BY sse, k) AS rk FROM b),
 cp AS (SELECT serial, k, s / k AS mu_left, (st - s) / (n - k) AS mu_right FROM c WHERE rk = 1)"""))
def _(spark, sf):
    return rounded(series.change_point(obs(spark, sf), S, "temp", 3), "serial k", "mu_left mu_right")


@query("f6_rolling_mean", oracle("prof", f"SELECT month, bin, {q6('dtdp', 'dtdp_mean')} FROM (SELECT month, bin, dtdp, avg(dtdp) OVER"
                                 " (PARTITION BY month ORDER BY bin ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS dtdp_mean FROM clim_raw)", CLIM_RAW))
def _(spark, sf):
    d = series.rolling_mean(clim_raw(spark, sf), ["month"], "dtdp", 3, "dtdp_mean", ["bin"], None)
    return rounded(d, "month bin", "dtdp dtdp_mean")


FILL = """fl AS (SELECT *, row_number() OVER w AS i, last_value(CASE WHEN v IS NOT NULL THEN t_us END IGNORE NULLS) OVER a AS x0,
 last_value(v IGNORE NULLS) OVER a AS y0, first_value(CASE WHEN v IS NOT NULL THEN t_us END IGNORE NULLS) OVER b AS x1,
 first_value(v IGNORE NULLS) OVER b AS y1, count(v) OVER (PARTITION BY serial) AS nv FROM gap
 WINDOW w AS (PARTITION BY serial ORDER BY t_us), a AS (PARTITION BY serial ORDER BY t_us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 b AS (PARTITION BY serial ORDER BY t_us ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 fi AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER a AS i0,
 first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS i1 FROM fl
 WINDOW a AS (PARTITION BY serial ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 b AS (PARTITION BY serial ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query("f7_fill_gaps", oracle("obs", f"""SELECT event_id, {q6('v')} FROM (SELECT event_id, CASE WHEN v IS NOT NULL THEN v
 WHEN x0 IS NOT NULL AND x1 IS NOT NULL THEN y0 + (y1 - y0) * (CAST(t_us - x0 AS DOUBLE) / (x1 - x0)) END AS v FROM fi)""", GAPPY + "," + FILL))
def _(spark, sf):
    return rounded(series.fill_gaps(gappy(spark, sf), S, ["v"], "t_us", DAY_US), "event_id", "v")


@query("f8_every_nth", oracle("obs", """SELECT event_id, serial, i // 5 AS sub_idx FROM (SELECT event_id, serial,
 row_number() OVER (PARTITION BY serial ORDER BY t_us) - 1 AS i FROM obs) WHERE i % 5 = 0"""))
def _(spark, sf):
    return series.every_nth(obs(spark, sf), S, 5).select("event_id", "serial", "sub_idx")


#: four days as cut-off, prewarped for a median interval ``md`` in seconds
_TAN = "tan(pi() * md / 345600)"
RATE = """md AS (SELECT serial, count(*) AS n, quantile_cont(dt, 0.5) AS md FROM (SELECT serial, (t_us - lag(t_us) OVER (PARTITION BY serial ORDER BY t_us)) / 1e6 AS dt FROM {src}) GROUP BY 1),
 ok AS (SELECT *, n >= 30 AND md > 0 AND 1 / 345600.0 < 0.5 / md AS fits FROM md)"""
LOWPASS = RATE.format(src="stage2") + f""",
 lg AS (SELECT *, row_number() OVER (PARTITION BY serial, var ORDER BY t_us) - 1 AS i, serial * 2 + (var = 'cond')::INT AS k FROM (SELECT serial, t_us, 'temp' AS var, temp AS v FROM stage2
  UNION ALL SELECT serial, t_us, 'cond', cond FROM stage2)),
 seg AS (SELECT k, i, v FROM lg JOIN ok USING (serial) WHERE fits AND n > 50), rate AS (SELECT DISTINCT k, {_TAN} AS tan FROM lg JOIN ok USING (serial) WHERE fits AND n > 50),
 """ + filter_sql.zero_phase(6, "low", filter_sql.low_six("tan"))


@query("f9_lowpass", oracle("stage2", f"""SELECT serial, t_us, {q6('temp', 'cond')} FROM (SELECT serial, t_us, max(coalesce(y, v)) FILTER (var = 'temp') AS temp,
 max(coalesce(y, v)) FILTER (var = 'cond') AS cond FROM lg LEFT JOIN flt USING (k, i) GROUP BY 1, 2)""", LOWPASS))
def _(spark, sf):
    d = filters.lowpass(stored(stage2, spark, sf), S, ["temp", "cond"], cutoff_days=4.0, min_rows=30)
    return rounded(d, "serial t_us", "temp cond")


@query("f10_valid_segments", oracle("obs", """SELECT event_id, serial, i - min(i) OVER (PARTITION BY serial, seg) AS idx,
 count(*) OVER (PARTITION BY serial, seg) AS seg_len FROM (SELECT *, i - count(v) OVER (PARTITION BY serial ORDER BY i) AS seg FROM (SELECT *,
 row_number() OVER (PARTITION BY serial ORDER BY t_us) - 1 AS i FROM gap)) WHERE v IS NOT NULL""", GAPPY))
def _(spark, sf):
    return filters.segments(gappy(spark, sf), S, "v").select("event_id", "serial", "idx", "seg_len")


GAPLOW = RATE.format(src="gap") + f""",
 gi AS (SELECT *, row_number() OVER (PARTITION BY serial ORDER BY t_us) - 1 AS r FROM gap), gs AS (SELECT *, r - count(v) OVER (PARTITION BY serial ORDER BY r) AS sg FROM gi),
 gr AS (SELECT serial, t_us, v, serial || ':' || sg AS k, row_number() OVER (PARTITION BY serial, sg ORDER BY t_us) - 1 AS i, count(*) OVER (PARTITION BY serial, sg) AS len FROM gs WHERE v IS NOT NULL),
 us AS (SELECT serial, md FROM ok JOIN (SELECT serial, count(v) AS nv FROM gap GROUP BY 1) USING (serial) WHERE fits AND nv >= 0.1 * n),
 seg AS (SELECT k, i, v FROM gr JOIN us USING (serial) WHERE len > 21), rate AS (SELECT DISTINCT k, {_TAN} AS tan FROM gr JOIN us USING (serial) WHERE len > 21),
 """ + filter_sql.zero_phase(6, "low", filter_sql.low_six("tan"))


@query("f10_gap_aware_lowpass", oracle("obs", f"""SELECT serial, t_us, {q6('v')} FROM (SELECT g.serial, g.t_us, coalesce(y, g.v) AS v FROM gap g LEFT JOIN gr ON gr.serial = g.serial AND gr.t_us = g.t_us
 LEFT JOIN flt ON flt.k = gr.k AND flt.i = gr.i)""", GAPPY + "," + GAPLOW))
def _(spark, sf):
    d = filters.lowpass(stored(gappy, spark, sf), S, ["v"], cutoff_days=4.0, min_rows=30, min_segment=21)
    return rounded(d, "serial t_us", "v")


def _plain(order, kind, fc):
    """SQL that filters whole records at one sample per unit."""
    pad = filters.pad_length(order, kind)
    ctes = f"""lg AS (SELECT serial AS k, t_us, temp AS v, row_number() OVER (PARTITION BY serial ORDER BY t_us) - 1 AS i, count(*) OVER (PARTITION BY serial) AS n FROM obs),
 seg AS (SELECT k, i, v FROM lg WHERE n > {pad}), rate AS (SELECT DISTINCT k, 0 AS tan FROM seg), """
    return oracle("obs", f"SELECT serial, t_us, {q6('temp')} FROM (SELECT k AS serial, t_us, coalesce(y, v) AS temp FROM lg LEFT JOIN flt USING (k, i))",
                  ctes + filter_sql.zero_phase(order, kind, filter_sql.constant(order, kind, 1.0, fc)))


@query("f12_butter_highpass", _plain(4, "high", 0.2))
def _(spark, sf):
    d = filters.butter_filter(obs(spark, sf), S, "temp", 1.0, 0.2, "high", 4)
    return rounded(d, "serial t_us", "temp")


@query("f12_butter_bandstop", _plain(3, "bandstop", (0.15, 0.25)))
def _(spark, sf):
    d = filters.butter_filter(obs(spark, sf), S, "temp", 1.0, (0.15, 0.25), "bandstop", 3)
    return rounded(d, "serial t_us", "temp")


LEGACY = DEPTH + f""",
 lg AS (SELECT mooring, serial, t_us, temp AS v, mooring || ':' || serial AS k, row_number() OVER w - 1 AS i, lead(t_us) OVER w - t_us AS d, count(*) OVER (PARTITION BY mooring, serial) AS n,
  count(temp) OVER (PARTITION BY mooring, serial) AS nv FROM sd WINDOW w AS (PARTITION BY mooring, serial ORDER BY t_us)),
 seg AS (SELECT k, i, v FROM lg WHERE n = nv AND n > 21), rate AS (SELECT k, tan(pi() * (d / 1e6) / 345600) AS tan FROM lg WHERE i = 0 AND n = nv AND n > 21),
 """ + filter_sql.zero_phase(6, "low", filter_sql.low_six("tan"))


@query("f13_legacy_lowpass", oracle("obs instr", f"""SELECT mooring, serial, t_us, {q6('temp')} FROM (SELECT mooring, serial, t_us, CASE WHEN n <= 18 OR n = nv THEN coalesce(y, v) END AS temp
 FROM lg LEFT JOIN flt USING (k, i))""", LEGACY))
def _(spark, sf):
    d = filters.legacy_lowpass(depth_records(spark, sf), ["mooring", "serial"], ["temp"], cutoff_days=4.0)
    return rounded(d, "mooring serial t_us", "temp")


@query("f14_power_spectrum")
def _(spark, sf):
    d = filters.power_spectrum(obs(spark, sf), ["mooring"], "temp")
    return rounded(d, "mooring bin", "freq_per_hour psd period_days")


@query("f15_fill_short_gaps", oracle("obs", f"""SELECT event_id, {q6('v')} FROM (SELECT event_id, CASE WHEN nv < 30 THEN NULL WHEN v IS NOT NULL THEN v
 WHEN i1 - i0 - 1 <= 4 THEN y0 + (y1 - y0) * (CAST(t_us - x0 AS DOUBLE) / (x1 - x0)) END AS v FROM fi)""", GAPPY + "," + FILL))
def _(spark, sf):
    return rounded(series.fill_short_gaps(gappy(spark, sf), S, "v", 4), "event_id", "v")
