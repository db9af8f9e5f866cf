import inspect

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from moorspark.operators import filters

HOUR = 3_600_000_000


def cascade(x, sos, z):
    """Plain sample-by-sample recursion."""
    y = np.array(x, float)
    for (b0, b1, b2, _, a1, a2), (s1, s2) in zip(sos, z):
        out = np.empty_like(y)
        for i, v in enumerate(y):
            o = b0 * v + s1
            s1, s2 = b1 * v - a1 * o + s2, b2 * v - a2 * o
            out[i] = o
        y = out
    return y


def steady(sos):
    """States of each section for a unit step that has settled."""
    g, z = 1.0, []
    for b0, b1, b2, _, a1, a2 in sos:
        o = (b0 + b1 + b2) / (1 + a1 + a2)
        z.append(np.array([o - b0, b2 - a2 * o]) * g)
        g *= o
    return z


def brute(x, sos, pad):
    ext = np.r_[2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2:-pad - 2:-1]]
    for _ in range(2):
        ext = cascade(ext, sos, [s * ext[0] for s in steady(sos)])[::-1]
    return ext[pad:-pad]


def gain(sos, f, fs):
    e = np.exp(-2j * np.pi * f / fs)
    return abs(np.prod([(b0 + b1 * e + b2 * e * e) / (1 + a1 * e + a2 * e * e) for b0, b1, b2, _, a1, a2 in sos]))


def test_gains():
    sos = filters.butterworth(6, "low", 1.0, 1 / 48)
    assert gain(sos, 0, 1) == pytest.approx(1) and gain(sos, 1 / 48, 1) == pytest.approx(2 ** -0.5, abs=1e-9)
    assert gain(sos, 1 / 12, 1) == pytest.approx(2.142e-4, rel=1e-3)
    high = filters.butterworth(5, "high", 1.0, 0.1)
    assert gain(high, 0.5, 1) == pytest.approx(1) and gain(high, 0.1, 1) == pytest.approx(2 ** -0.5) and gain(high, 0, 1) < 1e-12
    stop = filters.butterworth(3, "bandstop", 1.0, (0.1, 0.2))
    assert gain(stop, 0, 1) == pytest.approx(1) and gain(stop, 0.1, 1) == pytest.approx(2 ** -0.5) and gain(stop, 0.2, 1) == pytest.approx(2 ** -0.5)
    assert gain(stop, 0.5, 1) == pytest.approx(1)


@pytest.mark.parametrize("kind,fc,order", [("low", 0.02, 6), ("high", 0.1, 4), ("low", 0.05, 5), ("bandstop", (0.1, 0.2), 3)])
def test_kernel_equals_recursion(kind, fc, order):
    x = np.random.default_rng(0).normal(5, 1, 700)
    sos, pad = filters.butterworth(order, kind, 1.0, fc), filters.pad_length(order, kind)
    assert np.allclose(filters.zero_phase(x, sos, pad), brute(x, sos, pad), atol=1e-8)


def record(n=240, seed=0):
    t = np.arange(n)
    r = np.random.default_rng(seed)
    return pd.DataFrame({"serial": 1, "t_us": t * HOUR, "temperature": np.sin(2 * np.pi * t / 96) + 0.5 * np.sin(2 * np.pi * t / 12) + r.normal(0, .01, n)})


def test_lowpass_equals_the_recursion_on_a_ramp_with_steps(spark):
    d = record(seed=8)
    d["temperature"] = 0.02 * np.arange(240) + 3.0 * (np.arange(240) > 90) - 1.5 * (np.arange(240) % 7 == 0)
    got = filters.lowpass(spark.createDataFrame(d), ["serial"]).toPandas().sort_values("t_us")["temperature"].to_numpy()
    assert np.allclose(got, brute(d["temperature"].to_numpy(), filters.butterworth(6, "low", 1.0, 1 / 48), 21), atol=1e-8)


def test_blocks_equal_the_whole_segment(spark):
    n = 30_000
    r = np.random.default_rng(3)
    d = pd.DataFrame({"k": 1, "idx": np.arange(n), "t_us": np.arange(n) * HOUR, "v": np.cumsum(r.normal(0, 1, n))})
    s = spark.createDataFrame(d)
    one = filters.filter_blocks(s, ["k"], "t_us", "v", F.lit(1.0), 1 / 48, block=1 << 20).toPandas().sort_values("t_us")["v"].to_numpy()
    many = filters.filter_blocks(s, ["k"], "t_us", "v", F.lit(1.0), 1 / 48, block=2500).toPandas().sort_values("t_us")["v"].to_numpy()
    assert len(one) == len(many) == n and np.abs(one - many).max() < 1e-8


@pytest.mark.parametrize("kind,fc,order,block", [("low", 1 / 48, 6, 60), ("low", 1 / 48, 6, 333), ("high", 0.02, 4, 100), ("bandstop", (0.1, 0.12), 3, 50)])
def test_composed_states_equal_the_recursion(spark, kind, fc, order, block):
    """Blocks far shorter than the response, with last blocks of one row, of less than the extension, and whole."""
    r = np.random.default_rng(6)
    lengths = {1: 10 * block + 1, 2: 7 * block, 3: 3 * block + 5, 4: block, 5: block + 1, 6: 12}
    d = pd.concat([pd.DataFrame({"k": k, "idx": np.arange(n), "t_us": np.arange(n) * HOUR, "v": np.cumsum(r.normal(0, 1, n)) + 5}) for k, n in lengths.items()])
    got = filters.filter_blocks(spark.createDataFrame(d), ["k"], "t_us", "v", F.lit(1.0), fc, kind, order, block=block, min_segment=20).toPandas().sort_values(["k", "t_us"])
    assert len(got) == len(d)
    sos, pad = filters.butterworth(order, kind, 1.0, fc), filters.pad_length(order, kind)
    for k, g in got.groupby("k"):
        x = d.loc[d["k"] == k, "v"].to_numpy()
        want = brute(x, sos, pad) if len(x) > max(20, pad) else x
        assert np.abs(g["v"].to_numpy() - want).max() < 1e-7, k


def test_block_size_does_not_follow_the_sampling_rate(spark):
    n = 900  # one sample a second, a cut-off of two days
    d = pd.DataFrame({"serial": 1, "t_us": np.arange(n) * 1_000_000, "temperature": np.sin(np.arange(n) / 50.0)})
    d = spark.createDataFrame(d.assign(idx=np.arange(n)))
    sos = filters.butterworth(6, "low", 1.0, 1 / 172800)
    got = filters.filter_blocks(d, ["serial"], "t_us", "temperature", F.lit(1.0), 1 / 172800, block=128).toPandas().sort_values("t_us")["temperature"].to_numpy()
    whole = filters.zero_phase(np.sin(np.arange(n) / 50.0), sos, 21)
    assert np.abs(got - whole).max() < 1e-6


def test_lowpass_guards(spark):
    short = record(99)
    assert np.allclose(filters.lowpass(spark.createDataFrame(short), ["serial"]).toPandas().sort_values("t_us")["temperature"], short["temperature"])
    slow = record(150).assign(t_us=np.arange(150) * 30 * HOUR)
    assert np.allclose(filters.lowpass(spark.createDataFrame(slow), ["serial"]).toPandas().sort_values("t_us")["temperature"], slow["temperature"])
    const = record(150).assign(temperature=4.0)
    assert np.allclose(filters.lowpass(spark.createDataFrame(const), ["serial"]).toPandas()["temperature"], 4.0, atol=1e-9)


def test_gaps_are_filtered_by_segment(spark):
    d = record(400)
    d.loc[120:125, "temperature"] = np.nan
    d.loc[150, "temperature"] = np.nan
    s = spark.createDataFrame(d).withColumn("temperature", F.nanvl("temperature", F.lit(None).cast("double")))
    got = filters.lowpass(s, ["serial"]).toPandas().sort_values("t_us")["temperature"].to_numpy()
    x, sos = d["temperature"].to_numpy(), filters.butterworth(6, "low", 1.0, 1 / 48)
    assert np.isnan(got[120:126]).all() and np.isnan(got[150])
    assert np.allclose(got[:120], brute(x[:120], sos, 21), atol=1e-8)
    assert np.array_equal(got[126:150], x[126:150])
    assert np.allclose(got[151:], brute(x[151:], sos, 21), atol=1e-8)


def test_filter_types(spark):
    d = spark.createDataFrame(record(120))
    assert filters.apply_filter(d, ["serial"], ["temperature"], "bandpass") is d
    assert filters.apply_filter(d, ["serial"], ["temperature"], "detide") is not d
    with pytest.raises(ValueError):
        filters.butter_filter(d, ["serial"], "temperature", 1.0, 0.1, "notch")


@pytest.mark.parametrize("kind,fc", [("high", 0.2), ("low", 0.07)])
def test_generic_filter_equals_the_recursion(spark, kind, fc):
    x = np.cumsum(np.random.default_rng(12).integers(-3, 4, 333)).astype(float)
    d = pd.DataFrame({"k": 5, "t_us": np.arange(333) * 17, "v": x})
    got = filters.butter_filter(spark.createDataFrame(d), ["k"], "v", 1.0, fc, kind).toPandas().sort_values("t_us")["v"].to_numpy()
    order = inspect.signature(filters.butter_filter).parameters["order"].default
    assert np.allclose(got, brute(x, filters.butterworth(order, kind, 1.0, fc), filters.pad_length(order, kind)), atol=1e-7)


def test_legacy_lowpass_nulls(spark):
    d = record(60)
    d = pd.concat([d, d.assign(serial=2), d.assign(serial=3).head(10)])
    s = spark.createDataFrame(d).withColumn("temperature", F.when((F.col("serial") == 2) & (F.col("t_us") == 5 * HOUR), None).otherwise(F.col("temperature")))
    got = filters.legacy_lowpass(s, ["serial"], ["temperature"]).toPandas()
    assert got[got.serial == 2]["temperature"].isna().all()
    assert np.allclose(got[got.serial == 3].sort_values("t_us")["temperature"], record(60)["temperature"][:10])
    assert np.allclose(got[got.serial == 1].sort_values("t_us")["temperature"], brute(record(60)["temperature"].to_numpy(), filters.butterworth(6, "low", 1.0, 1 / 48), 21), atol=1e-8)


def test_power_spectrum_equals_direct_sum(spark):
    d = record(500)
    got = filters.power_spectrum(spark.createDataFrame(d), ["serial"], "temperature").toPandas().sort_values("bin")
    n, x = 125, d["temperature"].to_numpy()
    step = n - n // 2
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
    acc = []
    for j in range((500 - n // 2) // step):
        y = x[j * step:j * step + n]
        p = np.abs(np.fft.rfft((y - y.mean()) * w)) ** 2 / (w ** 2).sum()
        p[1:] *= 2
        acc.append(p)
    assert np.allclose(got["psd"], np.mean(acc, axis=0))
