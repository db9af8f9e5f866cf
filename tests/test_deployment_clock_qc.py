import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from moorspark.operators import clock, deployment as dep, qc, series, stats

H = 3_600_000_000


def cast(seed, n=24 * 20):
    """Hourly record: warm on deck, cold at depth, warm again."""
    r = np.random.default_rng(seed)
    y = 4 + 0.05 * r.normal(size=n)
    a, z = 8 + seed, n - 6 - seed
    y[:a], y[z:] = 18 + r.normal(size=a), 17 + r.normal(size=n - z)
    return y, a, z


def test_find_deployment_equals_numpy(spark):
    rows, exp = [], {}
    for s in (1, 2, 3):
        y, a, z = cast(s)
        rows += [(s, i * H, float(v)) for i, v in enumerate(y)]
        exp[s] = (y, a, z)
    d = spark.createDataFrame(rows, "serial long, t_us long, temp double")
    got = {r.serial: r for r in dep.find_deployment(d, ["serial"], "temp", width=10 * H).collect()}
    for s, (y, a, z) in exp.items():
        n = len(y) - 1
        t = np.arange(n + 1)
        m = (t >= n * 0.25) & (t <= n * 0.75)
        thr = y[m].mean() + max(1.5 * y[m].std(ddof=1), 0.1)
        assert got[s].split_value == pytest.approx(thr)
        i = np.flatnonzero(y < thr)
        assert (got[s].start_us, got[s].end_us) == (i[0] * H, i[-1] * H)


def test_surface_times_find_the_steps(spark):
    rows = []
    for s in (1, 2):
        y, a, z = cast(s)
        rows += [(s, i * H, float(v)) for i, v in enumerate(y)]
    d = spark.createDataFrame(rows, "serial long, t_us long, temp double")
    w = dep.bottom_window(d, ["serial"])
    sea = dep.sea_values(d, ["serial"], "temp", w)
    for r in dep.surface_times(d, ["serial"], "temp", w, sea, smooth_window=1).collect():
        _, a, z = cast(r.serial)
        assert abs(r.sink_us / H - a) <= 3 and abs(r.float_us / H - (z - 1)) <= 3 and 9 < r.threshold < 13


def test_change_point_equals_loop(spark):
    r = np.random.default_rng(4)
    rows, exp = [], {}
    for s, n in ((1, 40), (2, 3), (3, 9)):
        y = np.round(np.r_[r.normal(0, 1, n // 2), r.normal(3, 1, n - n // 2)], 3)
        rows += [(s, i, float(v)) for i, v in enumerate(y)]
        best = min(((((y[:k] - y[:k].mean()) ** 2).sum() + ((y[k:] - y[k:].mean()) ** 2).sum(), k) for k in range(2, n - 1)), default=None) if n >= 5 else None
        exp[s] = (best[1], y[:best[1]].mean(), y[best[1]:].mean()) if best else (max(2, n // 2), y.mean(), y.mean())
    d = spark.createDataFrame(rows, "serial long, t_us long, y double")
    for row in series.change_point(d, ["serial"], "y", 2, width=7).collect():
        assert (row.k, row.mu_left, row.mu_right) == pytest.approx(exp[row.serial])


def test_lag_correlation_equals_loop_and_blocks(spark):
    r = np.random.default_rng(3)
    n, L = 150, 12
    x = np.cumsum(r.normal(size=n))
    y = np.roll(x, -4) + 0.1 * r.normal(size=n)
    y[17] = np.nan
    d = spark.createDataFrame(pd.DataFrame({"m": 1, "level": 2, "k": np.arange(n), "x": x, "y": y})).withColumn("y", F.nanvl("y", F.lit(None).cast("double")))
    res = {}
    for block in (40, 1 << 17):
        res[block] = {row.lag: row.corr for row in clock.lag_correlation(d, ["m", "level"], "x", "y", "k", L, block=block).collect()}
        for lag in range(-L, L + 1):
            a, b = (x[lag:], y[:n - lag]) if lag >= 0 else (x[:lag], y[-lag:])
            ok = ~np.isnan(b)
            assert res[block][lag] == pytest.approx(np.corrcoef(a[ok], b[ok])[0, 1], abs=1e-9)
    best = max(res[40], key=res[40].get)
    assert best == 4


def test_few_overlaps_and_constants_give_null(spark):
    d = spark.createDataFrame([(1, k, float(k % 3), 2.0) for k in range(30)] + [(2, k, float(k), float(k)) for k in range(8)], "m long, k long, x double, y double")
    got = clock.lag_correlation(d, ["m"], "x", "y", "k", 2)
    assert got.where("corr IS NOT NULL").count() == 0 and got.count() == 10


def test_consensus_bin(spark):
    s = 1_000_000
    rows = [(1, 0, 10, 0, 100 * s), (1, 1, 11, 65 * s, 160 * s), (1, 2, 12, 70 * s, 170 * s), (1, 3, 13, 200 * s, None)]
    d = spark.createDataFrame(rows, "mooring long, level long, serial long, start_us long, end_us long")
    o = {r.level: r for r in clock.timing_offsets(d).collect()}
    assert [o[i].in_consensus for i in range(4)] == [False, True, True, False]
    assert o[0].start_offset == -65.0 and o[2].end_offset == 0.0 and o[3].avg_offset is None
    assert clock.suggest_reference(clock.timing_offsets(d)).collect()[0].ref_level == 2


def test_middle_bounds(spark):
    d = spark.createDataFrame([(1, float(v)) for v in np.linspace(0, 100, 1000)], "s long, v double")
    r = stats.middle_bounds(d, ["s"], "v", 90.0).collect()[0]
    assert (r.lo, r.hi) == pytest.approx((5, 95))
    for bad in (0, 100, -5):
        with pytest.raises(ValueError):
            stats.middle_bounds(d, ["s"], "v", bad)


def test_zero_std_raises(spark):
    d = spark.createDataFrame([(1, 5.0)] * 4, "s long, v double")
    with pytest.raises(Exception, match="zero standard deviation"):
        stats.normalise(d, ["s"], ["v"]).collect()


def test_histogram_split_needs_two_peaks(spark):
    r = np.random.default_rng(1)
    two = np.r_[r.normal(4, .4, 800), r.normal(15, .6, 500), [0, 20]]
    rows = [(1, float(v)) for v in two] + [(2, float(v)) for v in np.linspace(0, 1, 31)]
    got = {row.s: row.split_value for row in stats.histogram_split(spark.createDataFrame(rows, "s long, v double"), ["s"], "v").collect()}
    assert got[2] is None
    c, e = np.histogram(two, 30)
    runs = [(k, k2) for k in range(1, 29) for k2 in range(k, 29) if c[k - 1] < c[k] and (c[k:k2 + 1] == c[k]).all() and c[k2 + 1] < c[k]]
    p = [(a + b) // 2 for a, b in runs][:2]
    assert got[1] == pytest.approx(e[p[0] + np.argmin(c[p[0]:p[1]])])


def test_qc_flags(spark):
    r = np.random.default_rng(2)
    rows = [(lev, t, float(40 + lev + 0.1 * r.normal()), float(10 + 0.1 * r.normal()), 100.0 * lev) for lev in (1, 2, 3) for t in range(6)]
    rows[4] = (1, 4, 60.0, 10.0, 100.0)
    d = spark.createDataFrame(rows, "level long, t_us long, conductivity double, temperature double, pressure double")
    got = qc.combined_qc(d, ["level"]).toPandas()
    assert len(got) == 18 and "salinity" in got and set(got["conductivity_qc"]) == {0, 1}
    assert set(map(tuple, got[got.conductivity_qc == 1][["level", "t_us"]].values)) == {(1, 4), (1, 5)}


def test_iterative_despike_equals_loop(spark):
    r = np.random.default_rng(8)
    t, s = r.normal(10, 1, 300), r.normal(35, .1, 300)
    s[::37] += 5
    t[5] = 99
    d = spark.createDataFrame([(1, i, float(a), float(b)) for i, (a, b) in enumerate(zip(t, s))], "k long, i long, t double, s double")
    got = qc.iterative_despike(d, ["k"], "t", "s", {"t": (0, 40), "s": (30, 41)}, 3.0).orderBy("i").toPandas()
    T, S = np.where((t >= 0) & (t <= 40), t, np.nan), s.copy()
    for _ in range(5):
        bad = np.abs(S - np.nanmean(S)) > 3 * np.nanstd(S)
        badt = np.abs(T - np.nanmean(T)) > 3 * np.nanstd(T)
        S[bad], T[bad | badt] = np.nan, np.nan
    assert np.allclose(got["s"], S, equal_nan=True) and np.allclose(got["t"], T, equal_nan=True)


def test_many_short_records_are_correlated_together(spark):
    rng = np.random.default_rng(5)
    rows = [(m, k, float(rng.normal()) if rng.random() > 0.1 else None, float(rng.normal())) for m in range(40) for k in range(int(rng.integers(1, 30)))]
    # batches smaller than a record
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        d = clock.lag_correlation(spark.createDataFrame(rows, "m long, k long, x double, y double"), ["m"], "x", "y", "k", 4, block=8)
        got = {(r.m, r.lag): (r.n, r.corr) for r in d.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    # one call of Python per tile costs more than its sums
    assert "FlatMapGroupsInPandas" not in d._jdf.queryExecution().executedPlan().toString()
    for m in range(40):
        x, y = ({r[1]: r[c] for r in rows if r[0] == m and r[c] is not None} for c in (2, 3))
        for lag in range(-4, 5):
            a, b = np.array([(x[k], y[k - lag]) for k in x if k - lag in y]).reshape(-1, 2).T
            n, corr = got[m, lag]
            assert n == len(a)
            assert corr is None if n < 10 else corr == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9)


def test_rounded_cell_means_do_not_depend_on_the_order_of_addition(spark, tmp_path):
    from moorspark.plans.qc_queries import MEAN_DIGITS, cells

    got = {}
    for name, values in (("up", [1.1, 2.2, 3.3, 700.7]), ("down", [700.7, 3.3, 2.2, 1.1])):
        rows = [(i, pd.Timestamp("2024-01-02") + pd.Timedelta(hours=i), 5, "a", v) for i, v in enumerate(values)]
        d = spark.createDataFrame(pd.DataFrame(rows, columns="event_id ts user_id event_type value".split()))
        d.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(str(tmp_path / name / "events.parquet"))
        got[name] = [[(r.temp, r.cond) for r in cells(spark, str(tmp_path / name), n).collect()] for n in (None, MEAN_DIGITS)]
    assert got["up"][0] != got["down"][0]
    assert got["up"][1] == got["down"][1] == [(17.6825, 38.84125)]
