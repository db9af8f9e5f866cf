"""Zero-phase Butterworth filtering and power spectra.

The recursion is the only part Catalyst cannot express. Records are cut into contiguous valid segments, and
those into blocks of a fixed number of rows, whatever the sampling rate and the cut-off. A filter is linear: what a
block does to the state it starts with is one affine map, and such maps compose. So each block of a long segment is first
run from the zero state; the end states, a few numbers per block, are composed along the segment, forward and
then backward; and each block is run once more from its true states. The result is that of the whole segment.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorspark.operators.ordered import BLOCK_ROWS, TIME_CHUNK, attach, in_batches, in_blocks, ordered, percentiles, spread, whole_groups
from moorspark.session import materialize

#: Variables that are low-passed when present.
FILTER_VARS = ("temperature", "salinity", "conductivity", "pressure", "u_velocity", "v_velocity",
               "eastward_velocity", "northward_velocity")


#: samples of one matrix product of the recursion
_PRODUCT = 64


def butterworth(order: int, kind: str, fs: float, fc) -> np.ndarray:
    """Second-order sections ``[b0 b1 b2 1 a1 a2]`` by the bilinear transform of the analog poles."""
    k = 2 * fs
    s = np.exp(1j * np.pi * (2 * np.arange(order) + order + 1) / (2 * order))
    if kind == "bandstop":
        w1, w2 = (k * math.tan(math.pi * f / fs) for f in fc)
        q = (w2 - w1) / s / 2
        root = np.sqrt(q * q - w1 * w2 + 0j)
        p = np.concatenate([q + root, q - root])
        zc = (k + 1j * math.sqrt(w1 * w2)) / (k - 1j * math.sqrt(w1 * w2))
        num = np.array([1.0, -2 * zc.real, 1.0])
        at = 1.0
    else:
        w = k * math.tan(math.pi * fc / fs)
        p = w * s if kind == "low" else w / s
        num = np.array([1.0, 2.0, 1.0]) if kind == "low" else np.array([1.0, -2.0, 1.0])
        at = 1.0 if kind == "low" else -1.0
    z = (k + p) / (k - p)
    sections = [np.array([1.0, -2 * c.real, abs(c) ** 2]) for c in z[z.imag > 1e-12]]
    real = np.sort(z[np.abs(z.imag) <= 1e-12].real)
    first = [np.array([1.0, -r, 0.0]) for r in real]
    if kind == "bandstop":
        first = [np.array([1.0, -real[i] - real[i + 1], real[i] * real[i + 1]]) for i in range(0, len(real), 2)]
    out = []
    for den in sections + first:
        b = num if den[2] != 0 or kind == "bandstop" else np.array([1.0, num[1] / 2, 0.0])
        gain = np.polyval(den, at) / np.polyval(b, at)
        out.append(np.concatenate([b * gain, den]))
    return np.array(out)


def _state_space(sos: np.ndarray):
    """One linear system for the whole cascade: z' = A z + B x, y = C z + D x."""
    n = 2 * len(sos)
    a, b, c, d = np.zeros((n, n)), np.zeros(n), np.zeros(n), 1.0
    for i, (b0, b1, b2, _, a1, a2) in enumerate(sos):
        r = slice(2 * i, 2 * i + 2)
        gain = np.array([b1 - a1 * b0, b2 - a2 * b0])
        a[r, :] += np.outer(gain, c)
        a[r, r] += np.array([[-a1, 1.0], [-a2, 0.0]])
        b[r] = gain * d
        c = b0 * c
        c[2 * i] += 1.0
        d *= b0
    return a, b, c, d


def _steady(sys) -> np.ndarray:
    """State of a unit input that has settled."""
    a, b, _, _ = sys
    return np.linalg.solve(np.eye(len(b)) - a, b)


def _run(x: np.ndarray, sys, size: int, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filter ``x`` from state ``z``, ``size`` samples per matrix product; returns the state after it too."""
    a, b, c, d = sys
    m = len(b)
    obs = np.empty((size, m))
    row = c.copy()
    for i in range(size):
        obs[i] = row
        row = row @ a
    imp = np.concatenate([[d], obs[:-1] @ b])
    i, j = np.indices((size, size))
    toep = np.where(i >= j, imp[np.abs(i - j)], 0.0)
    ctrl = np.empty((size, m))
    col = b.copy()
    for i in range(size - 1, -1, -1):
        ctrl[i] = col
        col = a @ col
    step = np.linalg.matrix_power(a, size)
    full = len(x) // size * size
    xb = x[:full].reshape(-1, size)
    free, push = xb @ toep.T, xb @ ctrl
    out = np.empty(len(x))
    for r in range(len(xb)):
        out[r * size:(r + 1) * size] = free[r] + obs @ z
        z = step @ z + push[r]
    rest = x[full:]
    if len(rest):
        out[full:] = toep[:len(rest), :len(rest)] @ rest + obs[:len(rest)] @ z
        z = np.linalg.matrix_power(a, len(rest)) @ z + rest @ ctrl[size - len(rest):]
    return out, z


def zero_phase(x: np.ndarray, sos: np.ndarray, pad: int) -> np.ndarray:
    """Forward and backward pass with odd extension by ``pad`` samples."""
    sys = _state_space(sos)
    ext = np.concatenate([2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2:-pad - 2:-1]])
    rest = _steady(sys)
    y, _ = _run(ext, sys, _PRODUCT, rest * ext[0])
    y, _ = _run(y[::-1], sys, _PRODUCT, rest * y[-1])
    return y[::-1][pad:len(y) - pad]


def _carried(sys, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``A^n``, and the map of a block's first forward state to what it adds to the backward state after ``n`` samples."""
    a, b, c, _ = sys
    m = len(b)
    power, gram = np.eye(m), np.zeros((m, m))
    for bit in bin(n)[2:]:
        gram, power = gram + power @ gram @ power, power @ power
        if bit == "1":
            gram, power = gram + power @ np.outer(b, c) @ power, a @ power
    return power, gram


class _Piece:
    """The own rows of a block, extended oddly where it begins or ends its segment."""

    def __init__(self, pdf: pd.DataFrame, pad: int):
        own = pdf["__own"].to_numpy(bool)
        x = pdf["__v"].to_numpy(float)
        a, b = int(own.argmax()), int(own.argmax() + own.sum())
        self.own, self.x, self.first, self.last = own, x, a == 0, b == len(x)
        head = 2 * x[0] - x[pad:0:-1] if self.first else x[:0]
        tail = 2 * x[-1] - x[-2:-pad - 2:-1] if self.last else x[:0]
        self.ext = np.concatenate([head, x[a:b], tail])
        self.inner = slice(len(head), len(head) + b - a)


def compose_states(pieces: pd.DataFrame, sys) -> tuple[np.ndarray, np.ndarray]:
    """True first states of the forward and the backward pass of each block of one segment, in order of the blocks.

    ``pieces`` holds per block its length ``n``, first input ``x0``, the end states ``forward`` and ``backward`` of both
    passes from the zero state, and the last output ``y1`` of the forward one.
    """
    maps = [_carried(sys, int(n)) for n in pieces["n"]]
    rest = _steady(sys)
    z = rest * pieces["x0"].iloc[0]
    ahead = []
    for (power, _), end in zip(maps, pieces["forward"]):
        ahead.append(z)
        z = power @ z + np.asarray(end)
    a, _, c, _ = sys
    w = rest * (pieces["y1"].iloc[-1] + c @ np.linalg.matrix_power(a, int(pieces["n"].iloc[-1]) - 1) @ ahead[-1])
    back = []
    for (power, gram), end, z in zip(maps[::-1], pieces["backward"].iloc[::-1], ahead[::-1]):
        back.append(w)
        w = power @ w + np.asarray(end) + gram @ z
    return np.array(ahead), np.array(back[::-1])


def pad_length(order: int, kind: str) -> int:
    return 3 * ((2 if kind == "bandstop" else 1) * order + 1)


def filter_blocks(df: DataFrame, keys: Sequence[str], t: str, value: str, fs: Column, fc, kind: str = "low",
                  order: int = 6, index: str = "idx", block: int = BLOCK_ROWS, min_segment: int = 0, longest: int | None = None) -> DataFrame:
    """Filter each contiguous, regularly sampled segment named by ``keys``; ``index`` is its position.

    ``fs`` is the sampling frequency column (constant per segment), ``fc`` the cut-off(s) in the same unit.
    Segments of at most ``min_segment`` rows stay as they are. Blocks have ``block`` rows and see a few of the rows
    around them, for the odd extension at the ends. ``longest`` is a bound of the segments' lengths, if the caller has one:
    without a segment of more than one block there is nothing to compose.
    """
    pad = pad_length(order, kind)
    edge = max(pad, min_segment)
    if block <= edge:
        raise ValueError(f"blocks must have more than {edge} rows")
    d = df.select(*keys, F.col(t).alias("__t"), F.col(value).alias("__v"), F.col(index).cast("long").alias("__i"), fs.cast("double").alias("__fs"))
    group = [*keys, "__block"]
    types = dict(d.dtypes)
    typed = ", ".join(f"`{k}` {types[k]}" for k in keys)
    rows = f"{typed}, __t {types['__t']}, __v double"

    def dealt(x: DataFrame) -> DataFrame:
        # sorted partitions: one Arrow batch holds many short segments, one long block spans many batches
        return spread(x, group).sortWithinPartitions(*group, "__i")

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, keys):
            x = pdf["__v"].to_numpy(float)
            if len(x) > edge:
                x = zero_phase(x, butterworth(order, kind, float(pdf["__fs"].iloc[0]), fc), pad)
            yield pdf[[*keys, "__t"]].assign(__v=x)

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from in_batches(whole(batches))

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, group):
            if not pdf["__own"].any():
                continue
            p = _Piece(pdf, pad)
            sys = _state_space(butterworth(order, kind, float(pdf["__fs"].iloc[0]), fc))
            zero = np.zeros(len(sys[1]))
            y, forward = _run(p.ext, sys, _PRODUCT, zero)
            _, backward = _run(y[::-1], sys, _PRODUCT, zero)
            yield pdf[[*group, "__fs"]].iloc[:1].assign(n=len(p.ext), x0=p.ext[0], y1=y[-1], forward=[forward], backward=[backward])

    def states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, keys):
            ahead, back = compose_states(pdf, _state_space(butterworth(order, kind, float(pdf["__fs"].iloc[0]), fc)))
            yield pdf[group].assign(z=list(ahead), w=list(back))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, group):
            state, pdf = pdf.iloc[0], pdf.iloc[1:]
            if state["z"] is None or not pdf["__own"].any():
                continue  # rows around a block that has no own ones
            p = _Piece(pdf, pad)
            sys = _state_space(butterworth(order, kind, float(pdf["__fs"].iloc[0]), fc))
            y, _ = _run(p.ext, sys, _PRODUCT, np.asarray(state["z"], float))
            y, _ = _run(y[::-1], sys, _PRODUCT, np.asarray(state["w"], float))
            yield pdf.loc[p.own, [*keys, "__t"]].assign(__v=y[::-1][p.inner])

    single = d
    if longest is None or longest > block:
        long = d.where(F.col("__i") >= block).select(*keys).distinct()
        single = d.join(long, list(keys), "left_anti")
    out = spread(single, keys).sortWithinPartitions(*keys, "__i").mapInPandas(short, rows)
    if longest is None or longest > block:
        cut = in_blocks(d.join(long, list(keys), "left_semi"), "__i", edge, block)
        summed = dealt(cut).mapInPandas(ends, f"{typed}, __block long, __fs double, n long, x0 double, y1 double, forward array<double>, backward array<double>")
        known = spread(summed, keys).sortWithinPartitions(*group).mapInPandas(states, f"{typed}, __block long, z array<double>, w array<double>")
        none = F.lit(None).cast("array<double>")
        # a block's states stand before its rows
        both = cut.select(*group, "__t", "__v", "__i", "__fs", "__own", none.alias("z"), none.alias("w")).unionByName(
            known.select(*group, F.lit(None).cast(types["__t"]).alias("__t"), F.lit(None).cast("double").alias("__v"), F.lit(-1).cast("long").alias("__i"),
                         F.lit(None).cast("double").alias("__fs"), F.lit(False).alias("__own"), "z", "w"))
        out = out.unionByName(dealt(both).mapInPandas(run, rows))
    return out.withColumnsRenamed({"__t": t, "__v": value})


def _long(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    stack = ", ".join(f"'{v}', CAST({v} AS DOUBLE)" for v in values)
    return df.selectExpr(*keys, f"stack({len(values)}, {stack}) AS (var, v)")


def _wide(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col("var") == v, F.col("v"))).alias(v) for v in values])


def segments(df: DataFrame, series: Sequence[str], value: str, t: str = "t_us",
             width: float | None = TIME_CHUNK) -> DataFrame:
    """Rows of contiguous valid segments: ``seg`` names the segment, ``idx`` the position in it."""
    ok = F.col(value).isNotNull()
    d = ordered(df, series, [t], width, index="__i", cum={"__true": ok.cast("long")})
    d = d.where(ok).withColumn("seg", F.col("__i") - F.col("__true"))
    ends = d.groupBy(*series, "seg").agg(F.min("__i").alias("__first"), F.count(F.lit(1)).alias("seg_len"))
    return attach(d, ends, [*series, "seg"]).withColumn("idx", F.col("__i") - F.col("__first")).drop("__i", "__true", "__first")


def lowpass(df: DataFrame, series: Sequence[str], values: Sequence[str] | None = None, cutoff_days: float = 2.0,
            order: int = 6, t: str = "t_us", min_rows: int = 100, min_segment: int = 50, min_valid: float = 0.1,
            width: float | None = TIME_CHUNK) -> DataFrame:
    """Gap-aware zero-phase low-pass on the native sampling.

    A record passes unchanged below ``min_rows`` rows, without a valid interval or with the cut-off at or
    above Nyquist; a variable below the valid share, and a segment of at most ``min_segment`` rows, too.
    Other columns than keys, time and values are dropped.
    """
    values = list(values or [v for v in FILTER_VARS if v in df.columns])
    series = list(series)
    fc = 1.0 / (cutoff_days * 86400.0)
    d = ordered(df.select(*series, t), series, [t], width, lag={"__p": F.col(t)})
    dt = percentiles(d, series, (F.col(t) - F.col("__p")) / 1e6, {"__dt": 0.5})
    n = df.groupBy(*series).agg(F.count(F.lit(1)).alias("__n"), *[F.count(v).alias(f"__ok_{v}") for v in values])
    info = n.join(dt, series, "left")
    fits = (F.col("__n") >= min_rows) & (F.col("__dt") > 0) & (F.lit(fc) < 0.5 / F.when(F.col("__dt") > 0, F.col("__dt")))
    share = F.array(*[F.when(F.col(f"__ok_{v}") >= min_valid * F.col("__n"), F.lit(v)) for v in values])
    info = info.select(*series, "__n", "__dt", F.when(F.coalesce(fits, F.lit(False)), share).otherwise(
        F.array().cast("array<string>")).alias("__use"))
    # one row per record, read by three branches of the plan
    info = materialize(info, "records")
    longest = info.agg(F.max("__n")).first()[0] or 0
    long = attach(_long(df, [*series, t], values), info.drop("__n"), series)
    use = F.array_contains(F.array_compact("__use"), F.col("var"))
    # a segment is named by the last null before it
    seg = ordered(long.where(use), [*series, "var"], [t], width, index="idx", last_valid={"seg": (F.col(t), F.col("v").isNull())})
    seg = seg.where(F.col("v").isNotNull()).withColumn("seg", F.coalesce("seg", F.lit(-1 << 62)))
    done = filter_blocks(seg, [*series, "var", "seg"], t, "v", 1.0 / F.col("__dt"), fc, "low", order, min_segment=min_segment, longest=longest)
    keep = [*series, t, "var", "v"]
    same = long.where(~use | F.col("v").isNull()).select(*keep)
    return _wide(done.select(*keep).unionByName(same), [*series, t], values)


def filter_attributes(cutoff_days: float = 2.0, order: int = 6) -> dict[str, str]:
    """Attributes that record the filtering."""
    return {"time_filtering_applied": f"butterworth low-pass, {cutoff_days} days, order {order}",
            "time_filtering_cutoff_days": str(cutoff_days), "time_filtering_order": str(order),
            "processing_step": "time_filtered"}


def apply_filter(df: DataFrame, series: Sequence[str], values: Sequence[str], filter_type: str | None, **kw) -> DataFrame:
    """Dispatch by type: low-pass and detide filter, any other type leaves the data unchanged."""
    return lowpass(df, series, values, **kw) if filter_type in ("lowpass", "detide") else df


def butter_filter(df: DataFrame, series: Sequence[str], value: str, sr: float, cutoff, kind: str = "low",
                  order: int = 6, axis: str = "t_us", width: float | None = TIME_CHUNK) -> DataFrame:
    """Generic zero-phase filter of null-free series at sampling rate ``sr``; low, high or bandstop."""
    if kind not in ("low", "high", "bandstop"):
        raise ValueError(f"unknown filter kind {kind!r}")
    d = ordered(df.select(*series, axis, value), series, [axis], width, index="idx")
    fc = tuple(cutoff) if kind == "bandstop" else float(cutoff)
    return filter_blocks(d, list(series), axis, value, F.lit(float(sr)), fc, kind, order)


def legacy_lowpass(df: DataFrame, series: Sequence[str], values: Sequence[str], cutoff_days: float = 2.0,
                   order: int = 6, t: str = "t_us", width: float | None = TIME_CHUNK) -> DataFrame:
    """Low-pass with the interval of the first two samples.

    Series of at most ``3 * order`` rows stay as they are; one null makes the filtered series null.
    """
    series = list(series)
    fc = 1.0 / (cutoff_days * 86400.0)
    d = ordered(df.select(*series, t, *values), series, [t], width, index="idx", count="__n",
                lead={"__tn": F.col(t)}, total={f"__bad_{v}": F.col(v).isNull().cast("long") for v in values})
    dt = d.where("idx = 0").select(*series, ((F.col("__tn") - F.col(t)) / 1e6).alias("__dt"))
    d = attach(d, dt, series)
    bad = F.map_from_arrays(F.array(*[F.lit(v) for v in values]), F.array(*[F.col(f"__bad_{v}") for v in values]))
    stack = ", ".join(f"'{v}', CAST({v} AS DOUBLE)" for v in values)
    d = d.withColumn("__bad", bad).selectExpr(*series, t, "idx", "__n", "__dt", "__bad", f"stack({len(values)}, {stack}) AS (var, v)")
    whole = F.element_at("__bad", F.col("var")) == 0
    short = F.col("__n") <= 3 * order
    done = filter_blocks(d.where(whole & ~short), [*series, "var"], t, "v", 1.0 / F.col("__dt"), fc, "low", order)
    keep = [*series, t, "var", "v"]
    rest = d.where(~whole | short).withColumn("v", F.when(short, F.col("v")))
    return _wide(done.select(*keep).unionByName(rest.select(*keep)), [*series, t], values)


def power_spectrum(df: DataFrame, series: Sequence[str], value: str, t: str = "t_us", max_segment: int = 256,
                   min_rows: int = 100, width: float | None = TIME_CHUNK) -> DataFrame:
    """Welch power spectral density (Hann, half overlap, constant detrend); frequency in cycles per hour.

    Each overlapping segment of at most ``max_segment`` samples is one small group; segments are averaged
    by a plain aggregate.
    """
    series = list(series)
    d = ordered(df.where(F.col(value).isNotNull()).select(*series, t, value), series, [t], width, index="__i",
                count="__n", lag={"__p": F.col(t)})
    d = d.where(F.col("__n") > min_rows)
    dt = percentiles(d, series, (F.col(t) - F.col("__p")) / 3.6e9, {"__dt": 0.5})
    d = attach(d, dt, series)
    d = d.withColumn("__len", F.least(F.lit(max_segment), F.floor(F.col("__n") / 4)).cast("long"))
    d = d.withColumn("__step", F.col("__len") - F.floor(F.col("__len") / 2))
    nseg = F.floor((F.col("__n") - F.floor(F.col("__len") / 2)) / F.col("__step"))
    j0 = F.greatest(F.ceil((F.col("__i") - F.col("__len") + 1) / F.col("__step")), F.lit(0).cast("long"))
    j1 = F.least(F.floor(F.col("__i") / F.col("__step")), nseg - 1)
    d = d.where(j0 <= j1).withColumn("__seg", F.explode(F.sequence(j0, j1)))

    group = [*series, "__seg"]

    def density(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf[value].to_numpy(float)
        n, fs = len(x), 1.0 / float(pdf["__dt"].iloc[0])
        win = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
        p = np.abs(np.fft.rfft((x - x.mean()) * win)) ** 2 / (fs * (win * win).sum())
        p[1:(None if n % 2 else -1)] *= 2
        first = {k: pdf[k].iloc[0] for k in series}
        return pd.DataFrame({**first, "bin": np.arange(len(p)), "freq": np.fft.rfftfreq(n, 1 / fs), "p": p})

    types = dict(df.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in series] + ["bin long", "freq double", "p double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from in_batches(density(g) for g in whole_groups(batches, group))

    # sorted partitions: one Arrow batch holds many segments
    s = spread(d, group).sortWithinPartitions(*group, "__i").mapInPandas(run, schema)
    s = s.groupBy(*series, "bin").agg(F.avg("freq").alias("freq_per_hour"), F.avg("p").alias("psd"))
    return s.withColumn("period_days", F.when(F.col("freq_per_hour") > 0, 1.0 / (F.col("freq_per_hour") * 24)))
