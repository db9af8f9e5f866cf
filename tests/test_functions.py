import numpy as np
import pytest
from pyspark.sql import functions as F

from moorspark.functions import flags, seawater, text


def one(spark, col):
    return spark.range(1).select(col.alias("x")).collect()[0]["x"]


def test_seawater_check_values(spark):
    f = F.lit
    sp = seawater.practical_salinity
    assert one(spark, sp(f(34.5487), f(28.7856), f(10.0))) == pytest.approx(20.009869599086951, abs=1e-12)
    assert one(spark, sp(f(34.5600), f(4.4036), f(1000.0))) == pytest.approx(36.40030849438817, abs=1e-12)
    assert one(spark, seawater.sigma0(f(34.7118), f(28.8099))) == pytest.approx(21.797900819337656, abs=1e-9)
    assert one(spark, seawater.sigma0(f(34.7324), f(4.3236))) == pytest.approx(27.409748977090885, abs=1e-9)
    assert one(spark, seawater.absolute_salinity(f(35.0))) == pytest.approx(35.16504)


def test_salinity_kept_when_present(spark):
    d = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "conductivity double, temperature double, pressure double, salinity double")
    assert seawater.with_salinity(d).collect()[0]["salinity"] == 4.0


def test_positions(spark):
    assert one(spark, text.degrees(F.lit("7 12 S"))) == -7.2
    assert one(spark, text.degrees(F.lit("101 36 W"))) == -101.6
    for v, t in ((3.125, "03 07.500 N"), (-61.9, "61 54.000 S")):
        assert one(spark, text.degree_text(F.lit(v), "lat")) == t
    for v, t in ((9.05, "009 03.000 E"), (-170.2, "170 12.000 W")):
        assert one(spark, text.degree_text(F.lit(v), "lon")) == t


def test_durations(spark):
    pairs = {86400: "P1D", 172800: "P2D", 3600: "PT1H", 7200: "PT2H", 1800: "PT30M", 60: "PT1M", 90: "PT1M", 30: "PT30S", 0: "PT0S"}
    for s, t in pairs.items():
        assert one(spark, text.iso_duration(F.lit(float(s)))) == t


def test_utc_text(spark):
    ok = {"2023-06-09T12:00:00Z": True, "2023/06/09T12:00:00Z": True, "2023-06-09 12:00:00": False, "2023-02-30T12:00:00Z": False}
    for s, v in ok.items():
        assert one(spark, text.is_utc_text(F.lit(s))) is v


def test_data_mode(spark):
    cases = [("test.raw", None, "P"), ("file.use", None, "P"), ("data.microcat", None, "D"), (None, "delayed mode", "D"), (None, "realtime", "R"), (None, None, "P")]
    for s, h, m in cases:
        assert one(spark, text.data_mode(F.lit(s).cast("string"), F.lit(h).cast("string"))) == m


def test_rollup_precedence(spark):
    def r(*f):
        return one(spark, flags.rollup(*[F.lit(x) for x in f]))

    assert r(1, 3, 4) == 4 and r(1, 3, 2) == 3 and r(2, 1, 9) == 1 and r(9, 2) == 2 and r(9, 9) == 9


def test_random_salinity_is_finite(spark):
    r = np.random.default_rng(0)
    d = spark.createDataFrame([tuple(map(float, x)) for x in np.c_[r.uniform(25, 60, 50), r.uniform(-1, 30, 50), r.uniform(0, 5000, 50)]], "c double, t double, p double")
    assert d.select(seawater.practical_salinity(F.col("c"), F.col("t"), F.col("p")).alias("s")).where("s IS NULL OR isnan(s)").count() == 0


def test_fixed_decimals_round_the_exact_value(spark):
    from moorspark.functions.text import fixed

    xs = [0.15, 0.25, 0.35, -0.04, 0.0, 2.5, 1234567.05, 18.1234565, 12.0000005, -3.65, None]
    d = spark.createDataFrame([(x,) for x in xs], "x double").select("x", fixed("x", 1).alias("a"), fixed("x", 6).alias("b"), fixed("x", 1, sign=True).alias("c"))
    for r in d.collect():
        assert (r.a, r.b, r.c) == ((None,) * 3 if r.x is None else ("%.1f" % r.x, "%.6f" % r.x, "%+.1f" % r.x))
