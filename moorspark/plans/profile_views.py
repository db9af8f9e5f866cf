"""Climatology views shared by several query modules."""

from moorspark.operators import profile
from moorspark.plans.standin import prof

GRAD = """pn AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY profile_id) AS nl FROM prof) WHERE nl >= 2),
 pl AS (SELECT *, lag(pres) OVER w AS xp, lead(pres) OVER w AS xn, lag(temp) OVER w AS tp, lead(temp) OVER w AS tn,
  lag(salt) OVER w AS sp, lead(salt) OVER w AS sn FROM pn WINDOW w AS (PARTITION BY profile_id ORDER BY pres)),
 grad AS (SELECT profile_id, pres, temp, salt, time,
  CASE WHEN xp IS NULL THEN (tn - temp) / (xn - pres) WHEN xn IS NULL THEN (temp - tp) / (pres - xp) ELSE
  ((pres - xp) * (pres - xp) * tn + ((xn - pres) * (xn - pres) - (pres - xp) * (pres - xp)) * temp - (xn - pres) * (xn - pres) * tp)
  / ((pres - xp) * (xn - pres) * (xn - xp)) END AS dtemp,
  CASE WHEN xp IS NULL THEN (sn - salt) / (xn - pres) WHEN xn IS NULL THEN (salt - sp) / (pres - xp) ELSE
  ((pres - xp) * (pres - xp) * sn + ((xn - pres) * (xn - pres) - (pres - xp) * (pres - xp)) * salt - (xn - pres) * (xn - pres) * sp)
  / ((pres - xp) * (xn - pres) * (xn - xp)) END AS dsalt FROM pl)"""
_BIN = """SELECT CAST(m AS INT) AS month, CAST(b AS INT) AS bin, -2 + 0.5 * (b + CAST(0.5 AS DOUBLE)) AS temp_center,
 CASE WHEN n >= 5 THEN g1 END AS dtdp, CASE WHEN n >= 5 THEN g2 END AS dsdp FROM (SELECT unnest(range(1, 13)) AS m), unnest(range(0, 74)) u(b)
 LEFT JOIN (SELECT month(time) AS mo, floor((temp + 2) / 0.5) AS bi, count(*) AS n, avg(dtemp) AS g1, avg(dsalt) AS g2 FROM {src} GROUP BY 1, 2)
 ON mo = m AND bi = b"""
CLIM_RAW = GRAD + ", clim_raw AS (" + _BIN.format(src="grad") + ")"
CLIM = CLIM_RAW + """, sm AS (SELECT month, bin, temp_center, avg(dtdp) OVER w AS dtdp, avg(dsdp) OVER w AS dsdp FROM clim_raw
  WINDOW w AS (PARTITION BY month ORDER BY bin ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
 fl AS (SELECT *, last_value(CASE WHEN dtdp IS NOT NULL THEN temp_center END IGNORE NULLS) OVER a AS x0, last_value(dtdp IGNORE NULLS) OVER a AS t0,
  last_value(dsdp IGNORE NULLS) OVER a AS s0, first_value(CASE WHEN dtdp IS NOT NULL THEN temp_center END IGNORE NULLS) OVER b AS x1,
  first_value(dtdp IGNORE NULLS) OVER b AS t1, first_value(dsdp IGNORE NULLS) OVER b AS s1 FROM sm
  WINDOW a AS (PARTITION BY month ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY month ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 fd AS (SELECT month, bin, temp_center, CASE WHEN dtdp IS NOT NULL THEN dtdp ELSE t0 + (t1 - t0) * ((temp_center - x0) / (x1 - x0)) END AS dtdp,
  CASE WHEN dsdp IS NOT NULL THEN dsdp ELSE s0 + (s1 - s0) * ((temp_center - x0) / (x1 - x0)) END AS dsdp FROM fl),
 clim AS (SELECT month, bin, temp_center, CASE WHEN temp_center < 4 THEN avg(dtdp) OVER (PARTITION BY bin) ELSE dtdp END AS dtdp,
  CASE WHEN temp_center < 4 THEN avg(dsdp) OVER (PARTITION BY bin) ELSE dsdp END AS dsdp FROM fd)"""
BIN_SQL = _BIN


def grads(spark, sf):
    return profile.gradients(prof(spark, sf), ["profile_id"], ["temp", "salt"], min_levels=2)


def clim_raw(spark, sf):
    return profile.bin_gradients(grads(spark, sf))


def clim(spark, sf):
    return profile.complete_climatology(profile.smooth_climatology(clim_raw(spark, sf)))
