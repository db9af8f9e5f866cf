from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from moorspark.operators import grid, meta, stats
from moorspark.operators.ordered import DAY_US
from moorspark.plans.mooring_step import mooring_step

T0 = datetime(2018, 8, 12, 8)


def us(t):
    return int((t - datetime(1970, 1, 1)).total_seconds() * 1e6)


def mooring(spark):
    rows = []
    for serial, depth, minutes in ((7518, 100, 10), (7519, 200, 5), (1234, 300, 1)):
        n = 240 // minutes + 1
        r = np.random.default_rng(serial)
        for i, p in enumerate(np.linspace(0, 4 * np.pi, n)):
            rows.append((1, serial, us(T0 + timedelta(minutes=i * minutes)), 15 + 5 * np.sin(p) + 0.1 * r.random()))
    o = spark.createDataFrame([(a, b, c, float(d)) for a, b, c, d in rows], "mooring long, serial long, t_us long, temperature double")
    i = spark.createDataFrame([(1, 7518, 100.0, "microcat", 300, 0), (1, 7519, 200.0, "microcat", None, 1), (1, 1234, 300.0, "adcp", 0, 2), (1, 99, 400.0, "sbe 56", 0, 3)],
                              "mooring long, serial long, depth double, instrument string, clock_offset long, position long")
    return o, i, pd.DataFrame(rows, columns=["mooring", "serial", "t", "v"])


def test_common_step_is_the_median_of_medians(spark):
    o, _, _ = mooring(spark)
    st = stats.sampling_stats(o, ["mooring", "serial"])
    rep = {r.serial: r for r in stats.timing_report(st).collect()}
    assert rep[7518].common_dt == 5.0 and rep[7518].rate_warning
    assert rep[7518].change == "SIGNIFICANT" and rep[7519].change == "MINIMAL" and not rep[7519].irregular
    g = grid.common_grid(st).collect()[0]
    assert (g.step_us, g.n) == (300_000_000, 48)


def test_interpolation_equals_numpy_and_levels(spark):
    o, i, pdf = mooring(spark)
    d = mooring_step(o, i, ["temperature"]).toPandas()
    assert sorted(d["level"].unique()) == [0, 1, 2] and len(d) == 3 * 48
    assert set(d["instrument_meanings"]) == {"microcat adcp"} and set(d["clock_offset"]) == {300, 0}
    for s, g in d.groupby("serial"):
        e = pdf[pdf.serial == s].sort_values("t")
        g = g.sort_values("t_us")
        assert np.allclose(g["temperature"], np.interp(g["t_us"], e["t"], e["v"]))


def test_shift_moves_the_grid_with_the_data(spark):
    o, _, _ = mooring(spark)
    g = grid.common_grid(stats.sampling_stats(o, ["mooring", "serial"]))
    a = grid.interpolate(o, g, ["serial"], ["mooring"], ["temperature"]).toPandas()
    dt = 123_456_789
    o2 = o.withColumn("t_us", F.col("t_us") + dt)
    g2 = grid.common_grid(stats.sampling_stats(o2, ["mooring", "serial"]))
    b = grid.interpolate(o2, g2, ["serial"], ["mooring"], ["temperature"]).toPandas()
    k = ["serial", "k"]
    a, b = a.sort_values(k).reset_index(drop=True), b.sort_values(k).reset_index(drop=True)
    assert np.allclose(a["temperature"], b["temperature"]) and ((b["t_us"] - a["t_us"]) == dt).all()


def test_null_neighbours_and_exact_hits(spark):
    d = spark.createDataFrame([(1, 0, 1.0), (1, 10, None), (1, 20, 3.0), (1, 40, 5.0)], "s long, t_us long, v double")
    g = spark.createDataFrame([(1, 0, 5, 11)], "s long, t0 long, step_us long, n long")
    got = {r.t_us: r.v for r in grid.interpolate(d, g, ["s"], ["s"], ["v"], whole_grid=True).collect()}
    assert got == {0: 1.0, 5: None, 10: None, 15: None, 20: 3.0, 25: 3.5, 30: 4.0, 35: 4.5, 40: 5.0, 45: None, 50: None}


@pytest.mark.parametrize("times,off0,off1,first,last", [
    ([datetime(2020, 1, 1, 6) + timedelta(days=i) for i in range(5)], 1, 0, datetime(2020, 1, 2), datetime(2020, 1, 5)),
    ([datetime(2022, 3, 15, 2), datetime(2022, 3, 20, 10)], 1, 0, datetime(2022, 3, 16), datetime(2022, 3, 20)),
    ([datetime(2023, 7, 1), datetime(2023, 7, 3, 23, 59)], 0, 1, datetime(2023, 7, 1), datetime(2023, 7, 2)),
    ([datetime(2023, 1, 1), datetime(2023, 1, 3)], 1, 0, datetime(2023, 1, 1), datetime(2023, 1, 3)),
    ([datetime(2023, 1, 1, 12)], 1, 0, None, None)])
def test_half_day_grids(spark, times, off0, off1, first, last):
    d = spark.createDataFrame([(1, us(t)) for t in times], "s long, t_us long")
    g = grid.grid_points(grid.regular_grid(d, ["s"], start_offset_us=off0 * DAY_US, end_offset_us=off1 * DAY_US)).orderBy("k").collect()
    if first is None:
        assert g == []
    else:
        assert (g[0].t_us, g[-1].t_us) == (us(first), us(last)) and len(g) == (last - first) // timedelta(hours=12) + 1


def test_extrapolation_at_the_ends(spark):
    d = spark.createDataFrame([(1, 10, 1.0), (1, 20, 2.0), (1, 40, 8.0)], "s long, t_us long, v double")
    g = spark.createDataFrame([(1, 0, 5, 11)], "s long, t0 long, step_us long, n long")
    got = {r.t_us: r.v for r in grid.interpolate(d, g, ["s"], ["s"], ["v"], extrapolate=True).collect()}
    assert got[0] == pytest.approx(0.0) and got[30] == 5.0 and got[50] == pytest.approx(11.0) and len(got) == 11


def test_stack_by_depth_checks_axes(spark):
    a = spark.createDataFrame([(1, "b", 0.0, 0.0, 200.0), (1, "a", 0.0, 0.0, 100.0)], "mooring long, serial string, lat double, lon double, depth double")
    rows = [(1, s, t, 1.0) for s in "ab" for t in (1, 2)]
    d = spark.createDataFrame(rows, "mooring long, serial string, t_us long, v double")
    assert {(r.serial, r.level) for r in grid.stack_by_depth(d, a, ["v"]).collect()} == {("a", 0), ("b", 1)}
    bad = spark.createDataFrame(rows[:3] + [(1, "b", 3, 1.0)], d.schema)
    with pytest.raises(Exception, match="time axes differ"):
        grid.stack_by_depth(bad, a, ["v"]).collect()


def test_missing_oxygen_and_common_attributes(spark):
    parts = [spark.createDataFrame([(s, 1, 5.0)], "serial string, t_us long, TEMP double") for s in ("SN001", "SN002")]
    parts.append(spark.createDataFrame([("SN003", 1, 5.0, 6.0)], "serial string, t_us long, TEMP double, O2 double"))
    u = grid.union_variables(parts, ["TEMP", "O2", "PSAL"], ["serial", "t_us"])
    assert u.columns == ["serial", "t_us", "TEMP", "O2"] and u.where("O2 IS NULL").count() == 2
    at = [(1, s, k, v) for s in "abc" for k, v in (("mooring", "M123"), ("water_depth", "4000"), ("serial", s))]
    c = meta.common_attributes(spark.createDataFrame(at, "g long, dataset_id string, key string, value string"), ["g"])
    assert {(r.key, r.value) for r in c.collect()} == {("mooring", "M123"), ("water_depth", "4000")}


def test_thousands_of_levels_in_one_array(spark):
    d = spark.range(12000).select(F.lit(1).alias("mooring"), (F.col("id") % 2).alias("t_us"), F.floor(F.col("id") / 2).alias("level"),
                                  F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("temp"))
    got = {r.t_us: r.temp for r in grid.level_arrays(d.where("level <> 5 OR t_us = 0"), "temp").collect()}
    assert got == {t: [None if (2 * i + t) % 3 == 0 or (i == 5 and t == 1) else float(2 * i + t) for i in range(6000)] for t in (0, 1)}
