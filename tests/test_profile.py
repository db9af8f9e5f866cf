"""Vertical gridding against a plain numpy loop."""

import re
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from moorspark.operators import merge, profile

CENTERS = -1.75 + 0.5 * np.arange(74)


@pytest.fixture(scope="module")
def climate(spark):
    r = np.random.default_rng(5)
    rows = [(m, b, float(CENTERS[b]), float(-0.01 + 0.002 * r.normal()), float(0.0005 * r.normal())) for m in range(1, 13) for b in range(74)]
    return spark.createDataFrame(rows, "month int, bin int, temp_center double, dtdp double, dsdp double"), pd.DataFrame(rows, columns=["month", "bin", "c", "t", "s"])


def path(T, S, P, bound, gt, gs, step):
    """Knots from a sensor to the bound: Euler path for the gradient, trapezoid integral for the values."""
    if P == bound:
        return [(P, T, S)]
    sign = np.sign(bound - P)
    p = list(np.arange(P, bound, sign * step)) + [bound]
    e, t, s, out = T, T, S, [(P, T, S)]
    for a, b in zip(p[:-1], p[1:]):
        n = e + gt(e) * (b - a)
        t += (gt(e) + gt(n)) / 2 * (b - a)
        s += (gs(e) + gs(n)) / 2 * (b - a)
        e = n
        out.append((b, t, s))
    return out


def brute(prof, gt, gs, grid, step, extrapolate):
    P, T, S = prof
    knots = {}
    if extrapolate and P[0] > grid[0]:
        knots.update({p: (t, s) for p, t, s in path(T[0], S[0], P[0], grid[0], gt, gs, step)})
    for i in range(len(P) - 1):
        for p in list(np.arange(P[i], P[i + 1], step)) + [P[i + 1]]:
            u = (p - P[i]) / (P[i + 1] - P[i])
            knots[p] = ((1 - u) * (T[i] + gt(T[i]) * (p - P[i])) + u * (T[i + 1] + gt(T[i + 1]) * (p - P[i + 1])),
                        (1 - u) * (S[i] + gs(T[i]) * (p - P[i])) + u * (S[i + 1] + gs(T[i + 1]) * (p - P[i + 1])))
    if extrapolate and P[-1] < grid[-1]:
        knots.update({p: (t, s) for p, t, s in path(T[-1], S[-1], P[-1], grid[-1], gt, gs, step)[1:]})
    ps = np.array(sorted(knots))
    return (np.interp(grid, ps, [knots[p][0] for p in ps], left=np.nan, right=np.nan), np.interp(grid, ps, [knots[p][1] for p in ps], left=np.nan, right=np.nan))


@pytest.mark.parametrize("extrapolate", [True, False])
def test_full_profiles(spark, climate, extrapolate):
    cs, cp = climate
    r = np.random.default_rng(2)
    rows, profs = [], {}
    for k in range(12):
        n = r.integers(2, 9)
        p = np.sort(r.choice(np.arange(5, 950), n, replace=False)).astype(float)
        if k == 3:
            p[0], p[-1] = 0.0, 1000.0
        t, s = np.round(20 - p / 70 + r.normal(0, .3, n), 4), np.round(35 + r.normal(0, .2, n), 4)
        profs[k] = (k % 12 + 1, p, t, s)
        rows += [(k, datetime(2020, k % 12 + 1, 5), float(a), float(b), float(c)) for a, b, c in zip(p, t, s)]
    rows.append((99, datetime(2020, 1, 1), 50.0, 10.0, 35.0))
    d = spark.createDataFrame(rows, "id long, time timestamp_ntz, pres double, temp double, salt double")
    got = profile.full_profiles(d, cs, ["id"], p_max=1000.0, extrapolate=extrapolate, width=200.0).toPandas()
    assert 99 not in set(got["id"])
    assert [(r.id, r.valid_sensors, r.sensors) for r in profile.skipped_profiles(d, ["id"]).collect()] == [(99, 1, 1)]
    grid = np.arange(0, 1001, 20.0)
    for k, (m, p, t, s) in profs.items():
        c = cp[cp.month == m].sort_values("bin")
        gt = lambda x: np.interp(x, CENTERS, c["t"])
        gs = lambda x: np.interp(x, CENTERS, c["s"])
        et, es = brute((p, t, s), gt, gs, grid, 20.0, extrapolate)
        g = got[got.id == k].set_index("pres").reindex(grid)
        assert np.allclose(g["temp"], et, atol=1e-9, equal_nan=True) and np.allclose(g["salt"], es, atol=1e-9, equal_nan=True)
        assert not got[got.id == k].duplicated(["pres"]).any()


def test_lookup_clamps_and_nulls_propagate(spark, climate):
    cs, cp = climate
    cs = cs.withColumn("dtdp", F.when(F.col("bin") != 30, F.col("dtdp")))
    temps = [-5.0, -1.75, -1.5, 13.0, 13.25, 13.3, 34.75, 50.0]
    d = spark.createDataFrame([(t, datetime(2020, 4, 1)) for t in temps], "temp double, time timestamp_ntz")
    got = {r.temp: r.g for r in profile.with_gradients(d, cs).select("temp", profile.lookup("gt", F.col("temp")).alias("g")).collect()}
    y = cp[cp.month == 4].sort_values("bin")["t"].to_numpy()
    assert got[-5.0] == got[-1.75] == y[0] and got[50.0] == got[34.75] == y[73] and got[-1.5] == pytest.approx((y[0] + y[1]) / 2)
    assert got[13.25] is None and got[13.0] is None and got[13.3] is None


def test_gradients_equal_numpy(spark):
    p = np.array([0, 10, 25, 60, 61, 200.0])
    v = np.array([1, 4, 2, 8, 8.5, 3.0])
    d = spark.createDataFrame([(1, float(a), float(b)) for a, b in zip(p, v)], "id long, pres double, v double")
    got = [r.dv for r in profile.gradients(d, ["id"], ["v"], width=30.0).orderBy("pres").collect()]
    assert np.allclose(got, np.gradient(v, p))


def test_climatology_needs_five_samples(spark):
    rows = [(i, datetime(2020, 1, 1), p, 10.1 + 0.0 * p + (0.01 if p else 0), 35.0) for i in range(4) for p in (0.0, 20.0)]
    d = spark.createDataFrame(rows, "id long, time timestamp_ntz, pres double, temp double, salt double")
    c = profile.build_climatology(d, ["id"], [0.0, 20.0])
    assert c.count() == 888 and c.where("dtdp IS NOT NULL").count() == 1
    few = profile.build_climatology(d.where("id < 2"), ["id"], [0.0, 20.0])
    assert few.where("dtdp IS NOT NULL").count() == 0


def test_repair_pressure_by_quadratic(spark):
    r = np.random.default_rng(1)
    base = 1000 + 30 * r.random(60)
    own = base - (5 + 0.02 * (base - 1015) + 0.001 * (base - 1015) ** 2)
    rows = [(1, 0, t, None if 10 <= t < 20 else float(own[t])) for t in range(60)] + [(1, 1, t, float(base[t])) for t in range(60)]
    d = spark.createDataFrame(rows, "mooring long, level long, t_us long, pres double")
    got = profile.repair_pressure(d).where("level = 0").orderBy("t_us").toPandas()["pres"]
    assert np.allclose(got, own, atol=1e-6)


def test_substitute_pressure(spark):
    wave = np.sin(np.arange(40))
    rows = []
    for lev, (depth, amp) in enumerate(((100, 1.0), (200, 2.0), (300, None), (400, 4.0))):
        rows += [(1, lev, t, None if amp is None else float(depth + amp * wave[t])) for t in range(40)]
    rows += [(2, 0, t, None) for t in range(3)] + [(3, 0, t, float(100 + wave[t])) for t in range(40)] + [(3, 1, t, None) for t in range(40)]
    d = spark.createDataFrame(rows, "mooring long, level long, t_us long, pres double")
    s = spark.createDataFrame([(1, i, x, x, 1000.0) for i, x in enumerate((100.0, 200.0, 300.0, 400.0))] + [(2, 0, 50.0, 55.0, 1000.0), (3, 0, 100.0, 100.0, 1000.0), (3, 1, 400.0, 400.0, 1000.0)],
                              "mooring long, level long, depth double, p0 double, waterdepth double")
    got = profile.substitute_pressure(d, s).orderBy("mooring", "level", "t_us").toPandas()
    a = wave - wave.mean()
    x = got[(got.mooring == 1) & (got.level == 2)]["pres"].to_numpy()
    assert np.allclose(x, 300 + 3 * a)
    assert (got[got.mooring == 2]["pres"] == 55.0).all()
    y = got[(got.mooring == 3) & (got.level == 1)]["pres"].to_numpy()
    assert np.allclose(y, 400 + a * (1 - 300 / 900))


def test_concatenation_crosses_the_gap(spark):
    day = 86_400_000_000
    rows = [(1, t * day, p, float(t), 35.0) for t in (0, 1, 5, 6) for p in (0.0, 100.0)]
    d = spark.createDataFrame(rows, "site long, t_us long, pres double, temp double, salt double")
    c = merge.concatenate_deployments(d, ["temp", "salt"], p_step=50.0, p_max=100.0, max_span=2 * day).toPandas()
    assert len(c) == 3 * 13 and np.allclose(c["temp"], c["t_us"] / day)
    assert set(c[(c.t_us > day) & (c.t_us < 5 * day)]["qc"]) == {8} and set(c[c.t_us % day == 0][lambda x: (x.t_us <= day) | (x.t_us >= 5 * day)]["qc"]) == {1}


def test_merged_flags(spark):
    d = spark.createDataFrame([(1, 1), (1, 8), (2, 8), (2, 4), (3, 9), (3, 9), (4, 9), (4, 8)], "k long, qc int")
    assert {r.k: r.qc for r in merge.merged_flag(d, ["k"]).collect()} == {1: 8, 2: 4, 3: 9, 4: 8}


def test_generated_methods_of_full_profiles_are_short_enough_to_be_compiled(spark, capsys):
    # HotSpot leaves methods above 8000 bytes to its interpreter
    df = spark.sql("SELECT 1L AS id, CAST(100 * id AS DOUBLE) AS pres, CAST(id AS DOUBLE) AS temp, 35D AS salt, TIMESTAMP_NTZ '2024-01-02 00:00:00' AS time FROM range(3)")
    clim = spark.sql("SELECT CAST(m AS INT) AS month, CAST(b AS INT) AS bin, 0.01D AS dtdp, 0.001D AS dsdp FROM (SELECT explode(sequence(1, 12)) AS m) JOIN (SELECT explode(sequence(0, 73)) AS b)")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        profile.full_profiles(df, clim, ["id"], extrapolate=False).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
