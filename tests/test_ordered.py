"""The ordered building blocks against pandas and numpy, for several chunk widths."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from moorspark.operators import ordered as o
from moorspark.operators import series


def frame(seed=1, n=400):
    """One series holds two thirds of the rows, one has gaps of many chunks, one a single row."""
    r = np.random.default_rng(seed)
    key = np.where(r.random(n) < 0.67, 1, r.integers(2, 5, n))
    t = r.permutation(n * 7)[:n] + np.where(key == 3, (r.integers(0, 3, n) * 100_000), 0)
    v = np.round(r.normal(10, 5, n), 3)
    d = pd.DataFrame({"k": key.astype("int64"), "t": t.astype("int64"), "v": v})
    d.loc[r.random(n) < 0.2, "v"] = None
    d = pd.concat([d, pd.DataFrame({"k": [9], "t": [5], "v": [1.5]})], ignore_index=True)
    return d.drop_duplicates(["k", "t"]).reset_index(drop=True)


def spark_frame(spark, d):
    return spark.createDataFrame(d).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))


def same(a, b):
    a, b = np.asarray(a, float), np.asarray(b, float)
    return np.allclose(a, b, rtol=0, atol=1e-9, equal_nan=True)


@pytest.mark.parametrize("width", [None, 13, 500, 10_000_000])
def test_ordered_equals_pandas(spark, width):
    d = frame()
    got = o.ordered(
        spark_frame(spark, d), ["k"], ["t"], width, lag={"p": F.col("t"), "pv": F.col("v")}, lead={"n": F.col("t")}, index="i", count="cnt",
        cum={"c": F.col("v")}, total={"tot": F.col("v")}, last_valid={"lv": (F.col("t"), F.col("v").isNotNull())},
        next_valid={"nv": (F.col("t"), F.col("v").isNotNull())}).toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    e = d.sort_values(["k", "t"]).reset_index(drop=True)
    g = e.groupby("k")
    assert same(got["p"], g["t"].shift())
    assert same(got["pv"], g["v"].shift())
    assert same(got["n"], g["t"].shift(-1))
    assert same(got["i"], g.cumcount())
    assert same(got["cnt"], g["t"].transform("size"))
    z = e.assign(v=e["v"].fillna(0)).groupby("k")["v"]
    assert same(got["c"], z.cumsum()) and same(got["tot"], z.transform("sum"))
    tv = e["t"].where(e["v"].notna())
    assert same(got["lv"], tv.groupby(e["k"]).ffill()) and same(got["nv"], tv.groupby(e["k"]).bfill())


@pytest.mark.parametrize("block", [8, 32, 1 << 17])
def test_rolling_median_equals_pandas(spark, block):
    d = frame(2)
    got = o.rolling(spark_frame(spark, d), ["k"], ["t"], 200, 4, {"m": lambda w: F.array_sort(F.collect_list("v").over(w))}, block)
    got = got.withColumn("m", o.sorted_median(F.col("m"))).toPandas().sort_values(["k", "t"])
    e = d.sort_values(["k", "t"])
    exp = e.groupby("k")["v"].transform(lambda s: s.rolling(9, center=True, min_periods=1).median())
    assert len(got) == len(e) and same(got["m"], exp)


def test_even_window_is_rejected(spark):
    with pytest.raises(ValueError):
        series.rolling_median(spark_frame(spark, frame()), ["k"], "v", 4, order=["t"])


@pytest.mark.parametrize("width", [50, 5000])
def test_trailing_range(spark, width):
    d = frame(3).dropna()
    got = o.trailing(spark.createDataFrame(d), ["k"], "t", width, 120, {"m": lambda w: F.max("v").over(w)}).toPandas().sort_values(["k", "t"])
    exp = [max(d[(d.k == k) & (d.t >= t - 120) & (d.t <= t)].v) for k, t in zip(got.k, got.t)]
    assert len(got) == len(d) and same(got["m"], exp)


@pytest.mark.parametrize("draw", [
    lambda r, n: r.normal(0, 1, n), lambda r, n: r.normal(0, 1e-9, n), lambda r, n: r.integers(0, 3, n).astype(float),
    lambda r, n: np.where(r.random(n) < 0.3, 1e30, r.normal(-500, 200, n)), lambda r, n: np.exp(r.normal(0, 8, n)) * r.choice([-1, 1], n)])
def test_percentiles_equal_numpy(spark, draw):
    r = np.random.default_rng(7)
    n = 600
    d = pd.DataFrame({"k": np.where(r.random(n) < 0.8, 0, r.integers(1, 6, n)), "v": draw(r, n)})
    ps = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.925, "e": 1.0}
    got = o.percentiles(spark.createDataFrame(d), ["k"], F.col("v"), ps, "n").toPandas().set_index("k")
    for k, g in d.groupby("k"):
        assert got.loc[k, "n"] == len(g)
        for name, p in ps.items():
            assert got.loc[k, name] == pytest.approx(np.percentile(g["v"], 100 * p), rel=1e-12, abs=1e-15)


def test_percentiles_without_key_and_with_nulls(spark):
    d = spark.createDataFrame([(1.0,), (None,), (4.0,), (2.0,)], "v double")
    assert o.percentiles(d, [], F.col("v"), {"m": 0.5}).collect()[0]["m"] == 2.0


def test_explode_range_in_short_pieces(spark):
    d = spark.createDataFrame([(1, 0, 10_001), (2, 5, 4), (3, 7, 7)], "id int, a long, b long")
    got = o.explode_range(d, F.col("a"), F.col("b"), "k", step=100).groupBy("id").agg(F.count("*").alias("n"), F.min("k").alias("a"), F.max("k").alias("b"))
    assert {tuple(r) for r in got.collect()} == {(1, 10_002, 0, 10_001), (3, 1, 7, 7)}


def test_partition_count_does_not_matter(spark):
    d = spark_frame(spark, frame(4))
    a = series.runs(d.repartition(1), ["k"], F.col("v") > 10, ["t"], 300).toPandas()
    b = series.runs(d.repartition(17), ["k"], F.col("v") > 10, ["t"], 300).toPandas()
    c = ["k", "start_idx"]
    assert a.sort_values(c).reset_index(drop=True).equals(b.sort_values(c).reset_index(drop=True))


@pytest.mark.parametrize("span", [1, 37, 120, 100_000])
def test_trailing_extremes_equal_a_plain_frame(spark, span):
    d = frame(6)
    d = pd.concat([d, d.iloc[:5].assign(v=99.0)], ignore_index=True)  # repeated axis values
    got = o.trailing_extremes(spark_frame(spark, d), ["k"], "t", span, F.col("v"), "lo", "hi").toPandas().sort_values(["k", "t", "v"]).reset_index(drop=True)
    e = d.sort_values(["k", "t", "v"]).reset_index(drop=True)
    for name, f in (("lo", min), ("hi", max)):
        want = [f((x for x in e.v[(e.k == k) & (e.t >= t - span) & (e.t <= t)] if x == x), default=None) for k, t in zip(e.k, e.t)]
        assert same(got[name], [np.nan if w is None else w for w in want])
    assert len(got) == len(d)
