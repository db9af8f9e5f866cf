"""Queries of the merging operators."""

from pyspark.sql import functions as F

from moorspark.operators import merge
from moorspark.operators.ordered import DAY_US
from moorspark.plans.profile_queries import sigma_sql
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import oracle, prof, us


def site_profiles(spark, sf):
    """One profile per site and day."""
    return prof(spark, sf).groupBy("site", us("time").alias("t_us"), "pres").agg(
        F.avg("temp").alias("temp"), F.avg("salt").alias("salt"))


SITE = "sp AS (SELECT site, epoch_us(time) AS t_us, pres, avg(temp) AS temp, avg(salt) AS salt FROM prof GROUP BY 1, 2, 3)"
H = DAY_US // 2
CONCAT = SITE + f""", sv AS (SELECT *, lead(pres) OVER w AS pn, lead(temp) OVER w AS tn, lead(salt) OVER w AS sn FROM sp WINDOW w AS (PARTITION BY site, t_us ORDER BY pres)),
 pg AS (SELECT site, t_us, CAST(k * 100 AS DOUBLE) AS pres, CASE WHEN s.pres = k * 100 THEN temp ELSE temp + (tn - temp) * ((k * 100 - s.pres) / (pn - s.pres)) END AS temp,
  CASE WHEN s.pres = k * 100 THEN salt ELSE salt + (sn - salt) * ((k * 100 - s.pres) / (pn - s.pres)) END AS salt FROM sv s JOIN (SELECT unnest(range(0, 15)) AS k) ON s.pres = k * 100 OR s.pres < k * 100 AND pn > k * 100),
 tv AS (SELECT *, lead(t_us) OVER w AS x1, lead(temp) OVER w AS t1, lead(salt) OVER w AS s1, count(*) OVER (PARTITION BY site, pres) AS m FROM pg WINDOW w AS (PARTITION BY site, pres ORDER BY t_us)),
 ax AS (SELECT site AS st, min(t_us) AS a, (max(t_us) - min(t_us)) // {H} + 1 AS n FROM sp GROUP BY 1),
 cc AS (SELECT site, pres, g AS t_us, CASE WHEN g = t_us THEN 0 ELSE x1 - t_us END AS span, CASE WHEN g = t_us THEN temp ELSE temp + (t1 - temp) * (CAST(g - t_us AS DOUBLE) / (x1 - t_us)) END AS temp,
  CASE WHEN g = t_us THEN salt ELSE salt + (s1 - salt) * (CAST(g - t_us AS DOUBLE) / (x1 - t_us)) END AS salt FROM (SELECT tv.*, a + k * {H} AS g FROM tv JOIN ax ON st = site,
  unnest(range(CAST(ceil((t_us - a) / CAST({H} AS DOUBLE)) AS BIGINT), CASE WHEN x1 IS NULL THEN (t_us - a) // {H} + 1 ELSE CAST(ceil((x1 - a) / CAST({H} AS DOUBLE)) AS BIGINT) END)) u(k) WHERE m >= 2))"""


@query("m1_concatenate_deployments", oracle("prof", f"SELECT site, pres, t_us, {q6('temp', 'salt')} FROM cc", CONCAT))
def _(spark, sf):
    d = merge.concatenate_deployments(site_profiles(spark, sf), ["temp", "salt"], p_step=100.0, p_max=1400.0)
    return rounded(d, "site pres t_us", "temp salt")


@query("m2_merge_sites", oracle("prof", f"""SELECT site, t_us, pres, row_number() OVER (PARTITION BY t_us ORDER BY pres, site) - 1 AS rank, {q6('temp', 'salt')} FROM (SELECT site, t_us, pres, temp, CASE WHEN site NOT IN (2, 4) THEN salt END AS salt FROM sp)""", SITE))
def _(spark, sf):
    d = site_profiles(spark, sf)
    parts = [d.where(f"site = {s}") if s not in (2, 4) else d.where(f"site = {s}").drop("salt") for s in range(5)]
    return rounded(merge.merge_sites(parts, ["temp", "salt"]), "site t_us pres rank", "temp salt")


@query("m3_site_priority", oracle("prof", f"""SELECT site, t_us, pres, {q6('temp')} FROM (SELECT d.*, (SELECT max(pres) FROM d e WHERE e.t_us = d.t_us AND e.site < d.site) AS above FROM d) WHERE above IS NULL OR pres > above""",
                                  SITE + ", d AS (SELECT * FROM sp WHERE site > 0 OR pres <= 600)"))
def _(spark, sf):
    d = site_profiles(spark, sf).withColumn("priority", F.col("site"))
    return rounded(merge.by_priority(d, 600.0), "site t_us pres", "temp")


@query("m4_static_stability", oracle("prof", f"""SELECT profile_id, pres, coalesce(s < lag(s) OVER (PARTITION BY profile_id ORDER BY pres), false) AS unstable, round(s + CAST(2.3e-8 AS DOUBLE), 6) + 0.0 AS sigma0
 FROM (SELECT *, {sigma_sql('salt', 'temp')} AS s FROM prof)"""))
def _(spark, sf):
    return rounded(merge.static_stability(prof(spark, sf), ["profile_id"]), "profile_id pres unstable", "sigma0")


@query("m5_anomaly", oracle("prof", f"SELECT site, t_us, pres, {q6('temp_anomaly', 'salt_anomaly')} FROM (SELECT site, t_us, pres, temp - avg(temp) OVER w AS temp_anomaly, salt - avg(salt) OVER w AS salt_anomaly FROM sp"
                            " WINDOW w AS (PARTITION BY site, pres))", SITE))
def _(spark, sf):
    d = merge.anomaly(site_profiles(spark, sf), ["site", "pres"], ["temp", "salt"])
    return rounded(d, "site t_us pres", "temp_anomaly salt_anomaly")


@query("m6_interpolated_flags", oracle("prof", f"SELECT site, pres, t_us, CASE WHEN span > {3 * DAY_US} THEN 8 ELSE 1 END AS qc FROM cc", CONCAT))
def _(spark, sf):
    d = merge.concatenate_deployments(site_profiles(spark, sf), ["temp", "salt"], p_step=100.0, p_max=1400.0, max_span=3 * DAY_US)
    return d.select("site", "pres", "t_us", "qc")


@query("m6_merged_flags", oracle("prof", f"SELECT pres, t_us, CASE WHEN max(span) > {3 * DAY_US} THEN 8 ELSE 1 END AS qc FROM cc GROUP BY 1, 2", CONCAT))
def _(spark, sf):
    d = merge.concatenate_deployments(site_profiles(spark, sf), ["temp", "salt"], p_step=100.0, p_max=1400.0, max_span=3 * DAY_US)
    return merge.merged_flag(d, ["pres", "t_us"])
