from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from moorspark.plans import jobs
from moorspark.operators import calibration, clean, deployment, lookup, meta
from moorspark.operators.ordered import ordered
from moorspark.plans.mooring_step import mooring_step

H = 3_600_000_000
T0 = datetime(2021, 3, 5, 14)


def test_shift_then_trim(spark):
    rows = [(1, 431, T0 + timedelta(minutes=15 * i), float(i), 1.0) for i in range(700)]
    o = spark.createDataFrame(rows, "mooring long, serial long, time timestamp_ntz, temperature double, timeS double")
    o = o.withColumn("t_us", F.unix_micros(F.col("time").cast("timestamp")))
    i = spark.createDataFrame([(1, 431, -137, 62.5, "logger")], "mooring long, serial long, clock_offset long, depth double, instrument string")
    lo, hi = T0 + timedelta(hours=7, minutes=42), T0 + timedelta(days=5, seconds=-137)
    d = spark.createDataFrame([(1, lo, hi)], "mooring long, deployment_time timestamp_ntz, recovery_time timestamp_ntz")
    got = meta.drop_working(clean.shift_and_trim(o, i, d))
    assert "timeS" not in got.columns
    exp = [t + timedelta(seconds=-137) for _, _, t, _, _ in rows if lo <= t + timedelta(seconds=-137) <= hi]
    assert sorted(r.time for r in got.select("time").collect()) == exp


def test_zero_offset_and_open_bounds(spark):
    o = spark.createDataFrame([(1, 5, T0, 0)], "mooring long, serial long, time timestamp_ntz, t_us long")
    i = spark.createDataFrame([(1, 5, None)], "mooring long, serial long, clock_offset long")
    assert clean.shift_clock(o, i).collect()[0].time == T0
    d = spark.createDataFrame([(1, None, None)], "mooring long, deployment_time timestamp_ntz, recovery_time timestamp_ntz")
    assert clean.trim(o, d).count() == 1


def test_one_serial_on_two_moorings(spark):
    """Each deployment of an instrument has its own clock offset, depth and level."""
    rows = [(m, 7, T0 + timedelta(hours=i), float(i)) for m in (1, 2) for i in range(24)]
    o = spark.createDataFrame(rows, "mooring long, serial long, time timestamp_ntz, temperature double").withColumn("t_us", F.unix_micros(F.col("time").cast("timestamp")))
    i = spark.createDataFrame([(1, 7, 60, 500.0, "a", 0), (2, 7, -60, 90.0, "a", 0), (1, 8, 0, 50.0, "b", 1)],
                              "mooring long, serial long, clock_offset long, depth double, instrument string, position long")
    shifted = clean.shift_clock(o, i).collect()
    assert len(shifted) == 48 and {(r.mooring, r.time.second + 60 * r.time.minute) for r in shifted} == {(1, 60), (2, 59 * 60)}
    cells = mooring_step(o.unionByName(o.where("mooring = 1").withColumn("serial", F.lit(8).cast("long"))), i, ["temperature"]).collect()
    assert len([r for r in cells if r.serial == 7]) == 46 and {(r.mooring, r.serial, r.level, r.nominal_depth) for r in cells} == {(1, 7, 0, 500.0), (1, 8, 1, 50.0), (2, 7, 0, 90.0)}
    found = {r.mooring: (r.expected, r.found, r.missing) for r in lookup.expected_found(i, o.where("mooring = 1")).collect()}
    assert found == {1: (2, 1, "8"), 2: (1, 0, "7")}
    with pytest.raises(Exception, match="more than once"):
        clean.shift_clock(o, i.unionByName(i.limit(1))).collect()


def test_null_keys_raise(spark):
    d = spark.createDataFrame([(1, 0, 1.0), (None, 0, 2.0)], "serial long, t_us long, v double")
    with pytest.raises(Exception, match="null in a series key"):
        ordered(d, ["serial"], ["t_us"], 1000, index="i").collect()


def test_regularise(spark):
    # a gap of two slots, one sample beside the axis, one record of a single sample
    rows = [(1, 0, 3.5, 0.25), (1, H, 3.0, 0.5), (1, 2 * H, 2.5, 1.0), (1, 5 * H, 7.0, 2.0), (1, 6 * H + 11, 8.0, 4.0), (1, 7 * H, -1.0, 8.0), (2, 7, 1.0, 2.0)]
    d = spark.createDataFrame(rows, "serial long, t_us long, temp double, cond double")
    got = {(r.serial, r.t_us): (r.temp, r.cond) for r in clean.regularise(d, ["serial"], ["temp", "cond"]).collect()}
    none = (None, None)
    assert got == {(1, 0): (3.5, 0.25), (1, H): (3.0, 0.5), (1, 2 * H): (2.5, 1.0), (1, 3 * H): none, (1, 4 * H): none, (1, 5 * H): (7.0, 2.0), (1, 6 * H): none,
                   (1, 7 * H): (-1.0, 8.0), (2, 7): (1.0, 2.0)}


def test_overlapping_intervals_null_once(spark):
    d = spark.createDataFrame([(1, i * H, float(i)) for i in range(100)], "serial long, t_us long, v double")
    iv = spark.createDataFrame([(1, "v", 10 * H, 60 * H), (1, "v", 50 * H, 55 * H), (1, "w", 0, 5 * H)], "serial long, var string, t0 long, t1 long")
    got = clean.null_intervals(d, iv, "serial", ["v"])
    assert got.count() == 100 and got.where("v IS NULL").count() == 51


def test_dummies_and_nan(spark):
    d = spark.createDataFrame([(-9999.0,), (-99.999,), (float("nan"),), (5.0,), (None,)], "v double")
    assert [r.v for r in clean.null_dummies(d, ["v"]).where("v IS NOT NULL").collect()] == [5.0]


def test_average_offset_by_flag(spark):
    c = spark.createDataFrame([(1, "C", 0.25, 0.75, True), (1, "T", -3.0, 1.0, True), (1, "P", 6.0, 8.0, False), (2, "P", 6.0, 8.0, True)], "serial long, var string, pre double, post double, applied boolean")
    d = spark.createDataFrame([(k, v, x) for k, v, x in ((1, "C", 28.0), (1, "C", 29.5), (1, "T", 4.0), (1, "P", 310.0), (1, "P", -9999.0), (2, "P", 310.0))], "serial long, var string, v double")
    got = sorted((r["var"], r.v) for r in calibration.average_offset(d, c, "v", ["serial", "var"]).where("v IS NOT NULL").collect())
    assert got == [("C", 28.5), ("C", 30.0), ("P", 310.0), ("P", 317.0), ("T", 3.0)]


def test_linear_drift_has_the_other_sign(spark):
    c = spark.createDataFrame([(1, 1.0, 3.0, True)], "serial long, pre double, post double, applied boolean")
    d = spark.createDataFrame([(1, t, 10.0) for t in (0, 5, 10)], "serial long, t_us long, v double")
    assert [r.v for r in calibration.linear_drift(d, c, "v").orderBy("t_us").collect()] == [9.0, 8.0, 7.0]


def test_general_trend_without_pairs_is_zero(spark):
    c = spark.createDataFrame([(1, 1.0, None), (2, None, 4.0)], "serial long, pre double, post double").withColumn("var", F.lit("p"))
    got = {r.serial: (r.pre, r.post) for r in calibration.general_trend(c, {"p": 0.02}).collect()}
    assert got == {1: (1.0, 1.0), 2: (4.0, 4.0)}


def test_general_trend_is_per_variable(spark):
    rows = [(1, "c", 0.001, 0.003), (2, "c", None, 0.004), (1, "p", -2.0, -1.0), (2, "p", -3.0, None), (3, "p", 50.0, 90.0), (1, "o", 1.0, None)]
    c = spark.createDataFrame(rows, "serial long, var string, pre double, post double")
    got = {(r.serial, r["var"]): (r.pre, r.post, r.trend) for r in calibration.general_trend(c, {"c": 0.02, "p": 20.0}).collect()}
    assert got[2, "c"] == pytest.approx((0.002, 0.004, 0.002)) and got[2, "p"] == pytest.approx((-3.0, -2.0, 1.0)) and got[1, "o"] == (1.0, 1.0, 0.0)


def test_suggested_trim(spark):
    t = [0.0] * 3 + [10.0] * 4 + [0.0] * 3
    rows = [(1, i * H, t[i], t[i] * 1.2, t[i] * 0.8) for i in range(10)]
    d = spark.createDataFrame(rows, "serial long, t_us long, T double, C double, P double")
    r = deployment.suggest_trim(d, ["serial"], ["T", "C", "P"], 80.0, 5.0).collect()[0]
    assert (r.start_us, r.end_us) == (0, 9 * H)


def test_difference_and_unequal_axes(spark):
    a = spark.createDataFrame([(0, 10.0), (1, 12.0)], "t long, v double")
    b = spark.createDataFrame([(0, 9.5), (1, 11.5)], "t long, v double")
    assert [r.v for r in lookup.difference(a, b, ["t"], ["v"]).collect()] == [0.5, 0.5]
    with pytest.raises(Exception, match="time axes"):
        lookup.difference(a, b.where("t = 0"), ["t"], ["v"]).collect()


def _placed(spark):
    t = "TIMESTAMP_NTZ '2024-03-0"
    rows = [(1, 10, 1), (1, 10, 5), (1, 10, 9), (1, 99, 5), (2, 20, 5), (3, 30, 5), (None, 10, 5), (1, None, 5)]
    obs = spark.createDataFrame(rows, "mooring long, serial long, day int").withColumn("time", F.expr("timestampadd(DAY, day - 1, TIMESTAMP_NTZ '2024-03-01 00:00:00')"))
    obs = obs.withColumn("t_us", F.unix_micros(F.col("time").cast("timestamp")))
    instr = spark.createDataFrame([(1, 10, 60, 1.0, "a"), (2, 20, None, 2.0, "b"), (3, 30, -60, 3.0, "c")], "mooring long, serial long, clock_offset long, depth double, instrument string")
    deploy = spark.sql(f"SELECT CAST(m AS BIGINT) AS mooring, {t}2 00:00:00' AS deployment_time, {t}8 00:00:00' AS recovery_time FROM VALUES (1), (3) v(m)")
    return obs, instr, deploy


def test_every_sample_is_kept_trimmed_or_in_quarantine(spark):
    obs, instr, deploy = _placed(spark)
    lost = sorted((str(r.mooring), str(r.serial), r.reason) for r in clean.quarantine(obs, instr, deploy).collect())
    assert lost == [("1", "99", "no instrument"), ("1", "None", "no instrument"), ("2", "20", "no deployment"), ("None", "10", "no instrument")]
    kept = clean.shift_and_trim(obs, instr, deploy)
    assert kept.count() == 2 and obs.count() == kept.count() + len(lost) + 2
    status = {(r.mooring, r.serial): (r.n_in, r.n_out, r.status) for r in jobs.stage2_step(obs, instr, deploy)[1].collect()}
    assert status[1, 10] == (3, 1, "ok") and status[2, 20] == (1, 0, "emptied") and status[1, 99] == (1, 0, "not configured")
    assert sum(n for n, *_ in status.values()) == obs.count()


def test_bounds_reach_the_scan(spark, tmp_path):
    obs, instr, deploy = _placed(spark)
    obs.write.parquet(str(tmp_path / "obs"))
    stored = spark.read.parquet(str(tmp_path / "obs"))
    near = clean.within_bounds(stored, instr, deploy)
    assert "GreaterThanOrEqual(time,2024-03-01T23:59" in near._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, clean.shift_and_trim(near, instr, deploy).collect())) == sorted(map(str, clean.shift_and_trim(stored, instr, deploy).collect()))
    open_ = deploy.withColumn("recovery_time", F.lit(None).cast("timestamp_ntz"))
    assert clean.within_bounds(stored, instr, open_).count() == near.count() + 1


def test_long_intervals_make_few_rows(spark):
    day = 86_400_000_000
    iv = [(1, 0, 10 * 365 * day + 5, "decade"), (1, 3 * day, 3 * day, "instant"), (1, 2 * day - 1, 2 * day, "border"), (2, 7 * day, 6 * day, "empty"), (2, -5 * day, 9 * day + 1, "before the epoch"), (1, 3 * day, 3 * day, "twice")]
    at = [(k, x) for k in (1, 2, 3) for x in (-6 * day, -5 * day, -1, 0, 2 * day - 2, 2 * day - 1, 2 * day, 3 * day, 9 * day + 1, 9 * day + 2, 10 * 365 * day + 5, 10 * 365 * day + 6)]
    df = spark.createDataFrame(at, "serial long, t_us long")
    got = sorted((r.serial, r.t_us, r.name) for r in lookup.in_intervals(df, spark.createDataFrame(iv, "serial long, t0 long, t1 long, name string"), "serial").collect())
    assert got == sorted((k, x, n) for k, x in at for s, a, b, n in iv if s == k and a <= x <= b)
    none = spark.createDataFrame([], "serial long, t0 long, t1 long, name string")
    assert lookup.in_intervals(df, none, "serial").count() == 0
