"""Queries of the vertical gridding operators and the climatology lookup."""

from pyspark.sql import functions as F

from moorspark.functions import seawater
from moorspark.operators import profile
from moorspark.plans.profile_views import BIN_SQL, CLIM, CLIM_RAW, GRAD, clim, clim_raw, grads
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import instr, obs, oracle, prof
from moorspark.session import materialize

P = ["profile_id"]

def _tables(spark, sf):
    """Stored profiles and the stored climatology made from them."""
    p = materialize(prof(spark, sf).select("profile_id", "pres", "temp", "salt", "time"), "prof")
    # a profile has seven levels: dealt whole, its rows cross one exchange, without neighbours or summaries of chunks
    g = profile.gradients(p.repartition(*P), P, ["temp", "salt"], min_levels=2, width=None)
    c = profile.complete_climatology(profile.smooth_climatology(profile.bin_gradients(g)))
    return p, materialize(c, "climatology")


#: Fixed values, restated for the checking engine: specific volume at zero pressure (rows: powers of the salinity root).
SPV = """
1.0769995862e-3 -1.5649734675e-5 2.7762106484e-5 -1.6521159259e-5 6.9111322702e-6 -8.0539615540e-7 2.0543094268e-7
-3.1038981976e-4 3.5009599764e-5 -3.7435842344e-5 2.4141479483e-5 -8.7595873154e-6 -3.3052758900e-7
6.6928067038e-4 -4.3592678561e-5 3.5907822760e-5 -1.4353633048e-5 4.3703680598e-6
-8.5047933937e-4 3.4532461828e-5 -1.8698584187e-5 2.2863324556e-6
5.8086069943e-4 -1.1959409788e-5 3.8595339244e-6
-2.1092370507e-4 1.3864594581e-6
3.1932457305e-5"""
#: Fixed values, restated: practical salinity scale 1978.
PSS = {"rt": "0.6766097 2.00564e-2 1.104259e-4 -6.9698e-7 1.0031e-9", "a": "0.0080 -0.1692 25.3851 14.0941 -7.0261 2.7081", "b": "0.0005 -0.0056 -0.0066 -0.0375 0.0636 -0.0144"}


def _sum(coefficients: str, x: str) -> str:
    return " + ".join(f"({c}) * pow({x}, {i})" for i, c in enumerate(coefficients.split()))


def sigma_sql(s, t):
    xs, ys = f"sqrt(0.0248826675584615 * {s} + 0.5971840214030754)", f"({t} / 40.0)"
    terms = " + ".join(f"({_sum(row, ys)}) * pow({xs}, {i})" for i, row in enumerate(SPV.strip().split("\n")))
    return f"(1 / CAST({terms} AS DOUBLE) - 1000)"


def salinity_sql(c, t, p):
    t68, r = f"({t} * 1.00024)", f"({c} / 42.9140)"
    rp = (f"(1 + {p} * (2.070e-5 - 6.370e-10 * {p} + 3.989e-15 * {p} * {p}) / (1 + 3.426e-2 * {t68} + 4.464e-4 * {t68} * {t68}"
          f" + (4.215e-1 - 3.107e-3 * {t68}) * {r}))")
    rt = "(" + _sum(PSS["rt"], t68) + ")"
    x = f"sqrt({r} / ({rp} * {rt}))"
    a, b = _sum(PSS["a"], x), _sum(PSS["b"], x)
    return f"({a} + ({t68} - 15) / (1 + 0.0162 * ({t68} - 15)) * ({b}))"


@query("n1_practical_salinity", oracle("obs", f"SELECT event_id, {q6('salinity')} FROM (SELECT event_id, {salinity_sql('cond', 'temp', 'pres')} AS salinity FROM obs)"))
def _(spark, sf):
    d = seawater.with_salinity(obs(spark, sf), "cond", "temp", "pres")
    return rounded(d, "event_id", "salinity")


@query("n2_sigma0", oracle("prof", f"SELECT profile_id, pres, {q6('sigma0')} FROM (SELECT *, {sigma_sql('salt', 'temp')} AS sigma0 FROM prof)"))
def _(spark, sf):
    d = prof(spark, sf).withColumn("sigma0", seawater.sigma0(F.col("salt"), F.col("temp")))
    return rounded(d, "profile_id pres", "sigma0")


@query("n3_absolute_salinity", oracle("prof", f"SELECT profile_id, pres, {q6('sa')} FROM (SELECT *, salt * (CAST(35.16504 AS DOUBLE) / 35) AS sa FROM prof)"))
def _(spark, sf):
    return rounded(prof(spark, sf).withColumn("sa", seawater.absolute_salinity(F.col("salt"))), "profile_id pres", "sa")


@query("l1_pressure_grid", oracle("prof", """SELECT profile_id, a + CASE WHEN a < b THEN 1.0 ELSE -1.0 END * j * CAST(150 AS DOUBLE) AS p FROM (SELECT profile_id,
 CASE WHEN profile_id % 2 = 0 THEN min(pres) ELSE max(pres) END AS a, CASE WHEN profile_id % 2 = 0 THEN max(pres) ELSE min(pres) END AS b FROM prof GROUP BY 1),
 unnest(range(0, CAST(ceil((abs(b - a) + 150) / 150.0) AS BIGINT))) u(j)"""))
def _(spark, sf):
    even = F.col("profile_id") % 2 == 0
    lo, hi = F.min("pres"), F.max("pres")
    d = prof(spark, sf).groupBy("profile_id").agg(lo.alias("lo"), hi.alias("hi"))
    d = d.select("profile_id", F.when(even, F.col("lo")).otherwise(F.col("hi")).alias("a"), F.when(even, F.col("hi")).otherwise(F.col("lo")).alias("b"))
    return profile.pressure_grid(d, F.col("a"), F.col("b"), 150.0).select("profile_id", "p")


LV = (100.0, 200.0, 250.0, 480.0, 900.0, 1300.0, 1500.0)


@query("l2_to_levels", oracle("prof", f"""SELECT profile_id, pres, {q6('temp', 'salt')} FROM (SELECT q.profile_id, p AS pres,
 max(CASE WHEN s.pres = p THEN temp ELSE temp + (tn - temp) * ((p - s.pres) / (xn - s.pres)) END) AS temp,
 max(CASE WHEN s.pres = p THEN salt ELSE salt + (sn - salt) * ((p - s.pres) / (xn - s.pres)) END) AS salt
 FROM (SELECT DISTINCT profile_id FROM prof) q CROSS JOIN (SELECT CAST(unnest([{', '.join(map(str, LV))}]) AS DOUBLE) AS p) LEFT JOIN (SELECT *, lead(pres) OVER w AS xn,
 lead(temp) OVER w AS tn, lead(salt) OVER w AS sn FROM prof WINDOW w AS (PARTITION BY profile_id ORDER BY pres)) s
 ON s.profile_id = q.profile_id AND (s.pres = p OR s.pres < p AND xn > p) GROUP BY 1, 2)"""))
def _(spark, sf):
    return rounded(profile.to_levels(prof(spark, sf), P, ["temp", "salt"], LV), "profile_id pres", "temp salt")


SEGP = """sg AS (SELECT *, lead(pres) OVER w AS xn, lead(temp) OVER w AS tn, lead(salt) OVER w AS sn, count(*) OVER (PARTITION BY profile_id) AS nl
 FROM prof WINDOW w AS (PARTITION BY profile_id ORDER BY pres))"""


@query("l3_hydrographic_subset", oracle("prof", f"""SELECT profile_id, pres, {q6('temp', 'salt')} FROM (SELECT profile_id, 20.0 * k AS pres,
 CASE WHEN s.pres = 20.0 * k THEN temp ELSE temp + (tn - temp) * ((20.0 * k - s.pres) / (xn - s.pres)) END AS temp,
 CASE WHEN s.pres = 20.0 * k THEN salt ELSE salt + (sn - salt) * ((20.0 * k - s.pres) / (xn - s.pres)) END AS salt
 FROM sg s JOIN (SELECT unnest(range(0, 100)) AS k) ON s.pres = 20.0 * k OR s.pres < 20.0 * k AND xn > 20.0 * k
 WHERE nl >= 2 AND lat BETWEEN 5 AND 12 AND -10 * site BETWEEN -30 AND 0)""", SEGP).replace("20.0 * k", "CAST(20 * k AS DOUBLE)"))
def _(spark, sf):
    d = prof(spark, sf).withColumn("lon", F.lit(-10.0) * F.col("site"))
    d = profile.hydrographic_subset(d, (5, 12), (-30, 0), P, ["temp", "salt"])
    return rounded(d, "profile_id pres", "temp salt")


@query("l4_gradients", oracle("prof", f"SELECT profile_id, pres, {q6('dtemp', 'dsalt')} FROM grad", GRAD))
def _(spark, sf):
    return rounded(grads(spark, sf), "profile_id pres", "dtemp dsalt")


@query("l5_bin_climatology", oracle("prof", f"SELECT month, bin, temp_center, {q6('dtdp', 'dsdp', digits=8)} FROM clim_raw", CLIM_RAW))
def _(spark, sf):
    return rounded(clim_raw(spark, sf), "month bin temp_center", "dtdp dsdp", 8)


STD = tuple(200.0 * i for i in range(1, 8))


@query("l5_build_climatology", oracle("prof", f"SELECT month, bin, temp_center, {q6('dtdp', 'dsdp', digits=8)} FROM cb", """
 pn AS (SELECT profile_id, min(time) AS time FROM prof GROUP BY 1 HAVING count(*) >= 2),
 fg AS (SELECT pn.profile_id, pn.time, p, temp, salt FROM pn CROSS JOIN (SELECT CAST(unnest(range(200, 1600, 200)) AS DOUBLE) AS p)
  LEFT JOIN prof ON prof.profile_id = pn.profile_id AND prof.pres = p),
 ff AS (SELECT profile_id, time, p, coalesce(temp, t0 + (t1 - t0) * ((p - x0) / (x1 - x0))) AS temp, coalesce(salt, s0 + (s1 - s0) * ((p - x0) / (x1 - x0))) AS salt FROM (SELECT *,
  last_value(CASE WHEN temp IS NOT NULL THEN p END IGNORE NULLS) OVER a AS x0, last_value(temp IGNORE NULLS) OVER a AS t0, last_value(salt IGNORE NULLS) OVER a AS s0,
  first_value(CASE WHEN temp IS NOT NULL THEN p END IGNORE NULLS) OVER b AS x1, first_value(temp IGNORE NULLS) OVER b AS t1, first_value(salt IGNORE NULLS) OVER b AS s1
  FROM fg WINDOW a AS (PARTITION BY profile_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY profile_id ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))),
 gg AS (SELECT time, temp, CASE p WHEN 200 THEN (lead(temp) OVER w - temp) / 200 WHEN 1400 THEN (temp - lag(temp) OVER w) / 200
   ELSE (lead(temp) OVER w - lag(temp) OVER w) / 400 END AS dtemp, CASE p WHEN 200 THEN (lead(salt) OVER w - salt) / 200 WHEN 1400 THEN (salt - lag(salt) OVER w) / 200
   ELSE (lead(salt) OVER w - lag(salt) OVER w) / 400 END AS dsalt FROM ff WINDOW w AS (PARTITION BY profile_id ORDER BY p)),
 cb AS (""" + BIN_SQL.format(src="(SELECT * FROM gg WHERE temp IS NOT NULL)") + ")"))
def _(spark, sf):
    d = profile.build_climatology(prof(spark, sf), P, STD)
    return rounded(d, "month bin temp_center", "dtdp dsdp", 8)


@query("l6_smooth_climatology", oracle("prof", f"SELECT month, bin, temp_center, {q6('dtdp', 'dsdp', digits=8)} FROM sm", CLIM))
def _(spark, sf):
    return rounded(profile.smooth_climatology(clim_raw(spark, sf)), "month bin temp_center", "dtdp dsdp", 8)


@query("l7_complete_climatology", oracle("prof", f"SELECT month, bin, temp_center, {q6('dtdp', 'dsdp', digits=8)} FROM clim", CLIM))
def _(spark, sf):
    return rounded(clim(spark, sf), "month bin temp_center", "dtdp dsdp", 8)


def look_sql(m, t, g):
    """Gradient lookup as a correlated subquery on the climatology."""
    pos = f"(({t} + 1.75) / 0.5)"
    i = f"least(greatest(ceil({pos}) - 1, 0), 72)"
    return (f"(SELECT CASE WHEN {pos} < 0 THEN max(CASE WHEN bin = 0 THEN {g} END) WHEN {pos} > 73 THEN max(CASE WHEN bin = 73 THEN {g} END)"
            f" ELSE max(CASE WHEN bin = {i} THEN {g} END) + (max(CASE WHEN bin = {i} + 1 THEN {g} END) - max(CASE WHEN bin = {i} THEN {g} END))"
            f" * ({pos} - {i}) END FROM cm WHERE cm.month = {m})")


GT = """cm AS (SELECT month, bin, dtdp, dsdp FROM clim),
 pv AS (SELECT DISTINCT month(time) AS mo, temp AS tv FROM prof),
 pp AS (SELECT mo, tv, (tv + 1.75) / 0.5 AS pos, CAST(least(greatest(ceil((tv + 1.75) / 0.5) - 1, 0), 72) AS INT) AS i FROM pv),
 gv AS (SELECT mo, tv, CASE WHEN pos < 0 THEN a.dtdp WHEN pos > 73 THEN b.dtdp ELSE a.dtdp + (b.dtdp - a.dtdp) * (pos - i) END AS gt,
  CASE WHEN pos < 0 THEN a.dsdp WHEN pos > 73 THEN b.dsdp ELSE a.dsdp + (b.dsdp - a.dsdp) * (pos - i) END AS gs
  FROM pp JOIN cm a ON a.month = mo AND a.bin = i JOIN cm b ON b.month = mo AND b.bin = i + 1)"""


@query("d7_climatology_lookup", oracle("prof", f"SELECT profile_id, pres, {q6('gt', 'gs', digits=8)} FROM (SELECT profile_id, pres, gt, gs FROM prof JOIN gv ON mo = month(time) AND tv = temp)",
                                       CLIM + "," + GT))
def _(spark, sf):
    d = profile.with_gradients(*_tables(spark, sf))
    d = d.select("profile_id", "pres", profile.lookup("gt", F.col("temp")).alias("a"), profile.lookup("gs", F.col("temp")).alias("b"))
    return rounded(d.withColumnsRenamed({"a": "gt", "b": "gs"}), "profile_id pres", "gt gs", 8)


KNOT = GT + """, pr AS (SELECT s.*, a.gt AS g1, a.gs AS h1, b.gt AS g2, b.gs AS h2 FROM (SELECT *, lead(pres) OVER w AS xn, lead(temp) OVER w AS tn,
  lead(salt) OVER w AS sn, row_number() OVER w AS i, count(*) OVER (PARTITION BY profile_id) AS nl FROM prof WINDOW w AS (PARTITION BY profile_id ORDER BY pres)) s
  JOIN gv a ON a.mo = month(s.time) AND a.tv = s.temp LEFT JOIN gv b ON b.mo = month(s.time) AND b.tv = s.tn WHERE nl >= 2),
 kp AS (SELECT profile_id, i, p, (1 - u) * CASE WHEN j = 0 THEN temp ELSE temp + g1 * (p - pres) END + u * CASE WHEN j = n THEN tn ELSE tn + g2 * (p - xn) END AS temp,
  (1 - u) * CASE WHEN j = 0 THEN salt ELSE salt + h1 * (p - pres) END + u * CASE WHEN j = n THEN sn ELSE sn + h2 * (p - xn) END AS salt
  FROM (SELECT *, (p - pres) / (xn - pres) AS u FROM (SELECT pr.*, n, j, CASE WHEN j = n THEN xn ELSE pres + 30 * j END AS p
  FROM (SELECT *, CAST(ceil((xn - pres) / 30) AS BIGINT) AS n FROM pr WHERE xn IS NOT NULL) pr, unnest(range(0, n + 1)) x(j)))),
 kn AS (SELECT profile_id, p AS pres, temp, salt FROM (SELECT *, row_number() OVER (PARTITION BY profile_id, p ORDER BY i) AS first FROM kp) WHERE first = 1)"""


@query("l8_fill_between", oracle("prof", f"SELECT profile_id, pres, {q6('temp', 'salt')} FROM kn", CLIM + "," + KNOT))
def _(spark, sf):
    d = profile.fill_between(*_tables(spark, sf), P, step=30.0)
    return rounded(d, "profile_id pres", "temp salt")


EULER = KNOT + """, st0 AS (SELECT profile_id, 'up' AS direction, month(time) AS mo, pres AS p0, CAST(0 AS DOUBLE) AS bound, temp, salt FROM pr WHERE i = 1
  UNION ALL SELECT profile_id, 'down', month(time), pres, CAST(1600 AS DOUBLE), temp, salt FROM pr WHERE xn IS NULL AND pres < 1600),
 cl AS (SELECT month, list(dtdp ORDER BY bin) AS gt, list(dsdp ORDER BY bin) AS gs FROM clim GROUP BY 1),
 stx AS (SELECT *, sign(bound - p0) AS sg, CAST(ceil(abs(bound - p0) / 30) AS INT) AS n FROM st0),
 eu AS (SELECT profile_id, direction, mo, p0, bound, sg, n, 0 AS j, p0 AS pres, temp AS e, temp, salt, temp + CAST(1.75 AS DOUBLE) AS q FROM stx
  UNION ALL SELECT profile_id, direction, mo, p0, bound, sg, n, j + 1, p1, e1, temp + 0.5 * (g0 + g1) * (p1 - pres), salt + 0.5 * (h0 + h1) * (p1 - pres), e1 + 1.75 FROM (
   SELECT *, CASE WHEN q1 < 0 THEN gt[1] WHEN q1 > 73 THEN gt[74] ELSE gt[i1 + 1] + (gt[i1 + 2] - gt[i1 + 1]) * (q1 - i1) END AS g1,
    CASE WHEN q1 < 0 THEN gs[1] WHEN q1 > 73 THEN gs[74] ELSE gs[i1 + 1] + (gs[i1 + 2] - gs[i1 + 1]) * (q1 - i1) END AS h1 FROM (
    SELECT *, (e1 + 1.75) / 0.5 AS q1, CAST(least(greatest(ceil((e1 + 1.75) / 0.5) - 1, 0), 72) AS INT) AS i1 FROM (
     SELECT *, e + g0 * (p1 - pres) AS e1 FROM (SELECT x.*, CASE WHEN j + 1 < n THEN p0 + sg * 30 * (j + 1) ELSE bound END AS p1, gt, gs,
      CASE WHEN q0 < 0 THEN gt[1] WHEN q0 > 73 THEN gt[74] ELSE gt[i0 + 1] + (gt[i0 + 2] - gt[i0 + 1]) * (q0 - i0) END AS g0,
      CASE WHEN q0 < 0 THEN gs[1] WHEN q0 > 73 THEN gs[74] ELSE gs[i0 + 1] + (gs[i0 + 2] - gs[i0 + 1]) * (q0 - i0) END AS h0
      FROM (SELECT *, q / 0.5 AS q0, CAST(least(greatest(ceil(q / 0.5) - 1, 0), 72) AS INT) AS i0 FROM eu WHERE j < n) x JOIN cl ON cl.month = mo)))))"""


@query("l9_extrapolate_ends", oracle("prof", f"SELECT profile_id, direction, pres, {q6('temp', 'salt')} FROM eu", CLIM + "," + EULER))
def _(spark, sf):
    d = profile.extrapolate_ends(*_tables(spark, sf), P, 0.0, 1600.0, step=30.0)
    return rounded(d, "profile_id direction pres", "temp salt")


CHORD = KNOT + """, ks AS (SELECT *, lead(pres) OVER w AS xn, lead(temp) OVER w AS tn, lead(salt) OVER w AS sn FROM kn WINDOW w AS (PARTITION BY profile_id ORDER BY pres)),
 fp0 AS (SELECT profile_id, g AS pres, CASE WHEN pres = g THEN temp ELSE temp + (tn - temp) * ((g - pres) / (xn - pres)) END AS temp,
 CASE WHEN pres = g THEN salt ELSE salt + (sn - salt) * ((g - pres) / (xn - pres)) END AS salt FROM (SELECT ks.*, CAST(20 * k AS DOUBLE) AS g FROM ks,
 unnest(range(CAST(ceil(pres / 20) AS BIGINT), CAST(CASE WHEN xn IS NULL THEN floor(pres / 20) + 1 ELSE ceil(xn / 20) END AS BIGINT))) u(k)))"""


@query("l10_full_profiles_inner", oracle("prof", f"SELECT profile_id, pres, {q6('temp', 'salt', 'sigma0')} FROM (SELECT *, {sigma_sql('salt', 'temp')} AS sigma0 FROM fp0)", CLIM + "," + CHORD))
def _(spark, sf):
    d = profile.full_profiles(*_tables(spark, sf), P, p_max=2000.0, step=30.0, extrapolate=False)
    return rounded(d, "profile_id pres", "temp salt sigma0")


@query("l10_skipped_profiles", oracle("prof", "SELECT profile_id, count(*) AS valid_sensors, count(*) AS sensors FROM prof GROUP BY 1 HAVING count(*) < 2"))
def _(spark, sf):
    return profile.skipped_profiles(prof(spark, sf), P)


@query("l10_full_profiles")
def _(spark, sf):
    p, c = _tables(spark, sf)
    # dealt whole as for the gradients; both readers of the ordered sensors use this one exchange
    d = profile.full_profiles(p.repartition(*P), c, P, p_max=2000.0, width=None)
    return rounded(d, "profile_id pres", "temp salt sigma0")


HOLE = """hp AS (SELECT mooring, level, t_us, depth, depth * 1.01 + CAST((t_us // 43200000000) % 13 AS DOUBLE) * (1 + depth / 1000) AS full_pres FROM (SELECT l.mooring, level, depth, t.t_us FROM
 (SELECT *, row_number() OVER (PARTITION BY mooring ORDER BY position) - 1 AS level FROM instr) l JOIN (SELECT DISTINCT mooring, CAST(t_us // 43200000000 * 43200000000 AS BIGINT) AS t_us FROM obs) t ON t.mooring = l.mooring)),
 pm AS (SELECT mooring, level, t_us, depth, CASE WHEN level % 7 = 3 THEN NULL WHEN level % 3 = 1 AND (t_us // 43200000000) % 5 = 2 THEN NULL ELSE full_pres END AS pres FROM hp)"""


def pressures(spark, sf):
    """Pressure on a half-day axis: some records lack every fifth time, some lack all."""
    from moorspark.operators import grid

    lv = grid.levels(instr(spark, sf)).select("mooring", "level", "depth")
    k = F.floor(F.col("t_us") / 43_200_000_000)
    ax = obs(spark, sf).select("mooring", (k * 43_200_000_000).alias("t_us")).distinct()
    p = F.col("depth") * 1.01 + (k % 13).cast("double") * (1 + F.col("depth") / 1000)
    gone = (F.col("level") % 7 == 3) | ((F.col("level") % 3 == 1) & (k % 5 == 2))
    return lv.join(ax, "mooring").select("mooring", "level", "depth", "t_us", F.when(~gone, p).alias("pres"))


@query("l11_repair_pressure", oracle("obs instr", f"SELECT mooring, level, t_us, {q6('pres', digits=4)} FROM (SELECT mooring, level, t_us, CASE WHEN level % 7 = 3 THEN NULL ELSE full_pres END AS pres FROM hp)", HOLE))
def _(spark, sf):
    # the stand-in pressures are exactly linear in each other, so the repair must restore them
    d = profile.repair_pressure(pressures(spark, sf))
    return rounded(d, "mooring level t_us", "pres", 4)


SUB = HOLE + """, inf AS (SELECT mooring, level, min(depth) AS depth, count(*) AS n, count(pres) AS ok, avg(pres) AS mp FROM pm GROUP BY 1, 2),
 cand AS (SELECT b.mooring, b.level, b.depth, c.level AS lc, c.depth AS dc, c.mp, row_number() OVER (PARTITION BY b.mooring, b.level ORDER BY abs(c.depth - b.depth), c.level) AS rk
  FROM inf b JOIN inf c ON c.mooring = b.mooring AND b.ok = 0 AND c.ok = c.n),
 two AS (SELECT a.mooring, a.level, a.depth, a.lc AS l1, a.mp AS mp1, b.lc AS l2, b.mp AS mp2, (a.depth - a.dc) / nullif(b.dc - a.dc, 0) AS fac
  FROM cand a JOIN cand b ON a.mooring = b.mooring AND a.level = b.level AND a.rk = 1 AND b.rk = 2),
 xy AS (SELECT two.*, p.t_us, p.pres - mp1 AS x, q.pres - mp2 - (p.pres - mp1) AS y FROM two JOIN pm p ON p.mooring = two.mooring AND p.level = l1
  JOIN pm q ON q.mooring = two.mooring AND q.level = l2 AND q.t_us = p.t_us),
 ft AS (SELECT mooring, level, regr_slope(y, x) AS sl, regr_intercept(y, x) AS ic FROM xy GROUP BY 1, 2),
 sub AS (SELECT pm.mooring, pm.level, pm.t_us, coalesce(pm.pres, (ic + sl * x) * fac + pm.depth * CAST(1.01 AS DOUBLE) + x) AS pres FROM pm LEFT JOIN xy ON xy.mooring = pm.mooring AND xy.level = pm.level AND xy.t_us = pm.t_us
  LEFT JOIN ft ON ft.mooring = pm.mooring AND ft.level = pm.level)"""


@query("l12_substitute_pressure", oracle("obs instr", f"SELECT mooring, level, t_us, {q6('pres', digits=4)} FROM sub", SUB))
def _(spark, sf):
    d = pressures(spark, sf)
    s = d.select("mooring", "level", "depth").distinct().withColumns({"p0": F.col("depth") * 1.01, "waterdepth": F.lit(5000.0)})
    return rounded(profile.substitute_pressure(d.drop("depth"), s), "mooring level t_us", "pres", 4)


@query("l13_fill_salinity", oracle("prof", f"""SELECT profile_id, pres, {q6('salt')} FROM (SELECT profile_id, pres, CASE WHEN profile_id % 5 <> 0 THEN salt ELSE a + b * temp END AS salt
 FROM prof JOIN (SELECT site AS s, regr_slope(salt, temp) AS b, regr_intercept(salt, temp) AS a FROM prof WHERE profile_id % 5 <> 0 GROUP BY 1) ON s = site)"""))
def _(spark, sf):
    d = prof(spark, sf).withColumn("salt", F.when(F.col("profile_id") % 5 != 0, F.col("salt")))
    return rounded(profile.fill_salinity(d, ["site"]), "profile_id pres", "salt")


@query("l14_grid_bounds", oracle("prof", "SELECT profile_id, CAST(ceil(min(pres) / 150) * 150 AS DOUBLE) AS p_min, CAST(floor(max(pres) / 150) * 150 AS DOUBLE) AS p_max FROM prof GROUP BY 1"))
def _(spark, sf):
    return profile.grid_bounds(prof(spark, sf), P, 150.0)
