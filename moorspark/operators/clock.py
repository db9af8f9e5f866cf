"""Clock-offset analysis between the instruments of a mooring."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorspark.functions.text import fixed
from moorspark.operators.ordered import BLOCK_ROWS, TIME_CHUNK, attach, changes, spread, whole_batches
from moorspark.operators.series import every_nth


def provisional_offsets(times: DataFrame, group: str = "mooring") -> DataFrame:
    """Seconds after the earliest start and (negative) before the latest end of the group."""
    w = Window.partitionBy(group)
    return times.withColumn("start_off0", (F.col("start_us") - F.min("start_us").over(w)) / 1e6).withColumn(
        "end_off0", (F.col("end_us") - F.max("end_us").over(w)) / 1e6)


def consensus(times: DataFrame, group: str = "mooring", bin_seconds: float = 60.0) -> DataFrame:
    """Mark the members of the fullest start-offset bin (ties: lowest) in ``in_consensus``.

    Members need both times; when none has both, the start alone counts.
    """
    d = provisional_offsets(times, group).withColumn("__b", F.floor(F.col("start_off0") / bin_seconds))
    n = d.where("__b IS NOT NULL").groupBy(group, "__b").agg(
        F.count(F.lit(1)).alias("__n"), F.count("end_us").alias("__both"))
    best = n.groupBy(group).agg(F.max_by(F.struct("__b", "__both"), F.struct(F.col("__n"), -F.col("__b"))).alias("__best"))
    d = attach(d, best, [group], "left")
    ok = (F.col("__b") == F.col("__best.__b")) & ((F.col("__best.__both") == 0) | F.col("end_us").isNotNull())
    return d.withColumn("in_consensus", F.coalesce(ok, F.lit(False))).drop("__b", "__best")


def timing_offsets(times: DataFrame, group: str = "mooring", bin_seconds: float = 60.0) -> DataFrame:
    """Offsets of start and end against the consensus references, their mean, difference and drift per day."""
    d = consensus(times, group, bin_seconds)
    m = F.col("in_consensus")
    ref = d.groupBy(group).agg(F.min(F.when(m, F.col("start_us"))).alias("ref_start_us"),
                               F.max(F.when(m, F.col("end_us"))).alias("ref_end_us"))
    d = attach(d, ref, [group])
    s, e = (F.col("start_us") - F.col("ref_start_us")) / 1e6, (F.col("end_us") - F.col("ref_end_us")) / 1e6
    dur = (F.col("end_us") - F.col("start_us")) / 1e6
    return d.withColumns({
        "start_offset": s, "end_offset": e, "avg_offset": (s + e) / 2.0, "diff_offset": s - e,
        "drift_per_day": (e - s) / F.when(dur > 0, dur) * 86400.0})


def suggest_reference(offsets: DataFrame, group: str = "mooring") -> DataFrame:
    """Level with the smallest absolute average offset (ties: lowest level); none finite: level 0."""
    a = F.abs("avg_offset")
    b = offsets.groupBy(group).agg(F.min_by(F.struct("level", "serial", "avg_offset"),
                                            F.when(a.isNotNull(), F.struct(a, F.col("level")))).alias("b"),
                                   F.min_by("serial", "level").alias("s0"))
    none = F.col("b").isNull()
    return b.select(group, F.coalesce(F.col("b.level"), F.lit(0)).cast("long").alias("ref_level"),
                    F.coalesce(F.col("b.serial"), F.col("s0")).alias("ref_serial"), F.col("b.avg_offset").alias("offset_seconds"),
                    F.when(none, "fallback").otherwise("smallest absolute average timing offset").alias("reason"))


def lag_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Counts and sums ``n, sx, sy, sxx, syy, sxy`` over the pairs ``x[i], y[j]`` for ``i - j`` from ``1 - len(y)`` up; NaN is missing.

    Records stand along the last axis, any number of them beside each other.
    """
    nx, ny = x.shape[-1], y.shape[-1]
    size = 1 << max(1, (nx + ny - 2).bit_length())
    mx, my = ~np.isnan(x), ~np.isnan(y)
    x, y = np.where(mx, x, 0.0), np.where(my, y, 0.0)
    fx = [np.fft.rfft(v, size) for v in (mx.astype(float), x, x * x)]
    fy = [np.conj(np.fft.rfft(v, size)) for v in (my.astype(float), y, y * y)]
    out = [np.fft.irfft(fx[i] * fy[j], size) for i, j in ((0, 0), (1, 0), (0, 1), (2, 0), (0, 2), (1, 1))]
    # negative lags stand at the end of the circle
    out = [np.concatenate([v[..., size - ny + 1:], v[..., :nx]], -1) for v in out]
    out[0] = np.rint(out[0])
    return np.stack(out, -1)


#: padded cells of the records that are transformed at once
_CELLS = 1 << 18


def _tile_sums(pdf: pd.DataFrame, series: Sequence[str], names: Sequence[str]) -> Iterator[pd.DataFrame]:
    """:func:`lag_sums` of each tile ``(series, __bx, __by)`` of a frame sorted by them; tiles of like length go together."""
    keys = [*series, "__bx", "__by"]
    new = changes(pdf, keys)
    start = np.flatnonzero(new)
    tile = np.cumsum(new) - 1
    first, pos, v = pdf["__first"].to_numpy(bool), pdf["__i"].to_numpy(np.int64), pdf["__v"].to_numpy(float)
    base, long = [], []
    for side in (first, ~first):
        lo, hi = np.full(len(start), np.iinfo(np.int64).max), np.full(len(start), np.iinfo(np.int64).min)
        np.minimum.at(lo, tile[side], pos[side])
        np.maximum.at(hi, tile[side], pos[side])
        base.append(lo)
        long.append(np.where(lo <= hi, hi - lo + 1, 0))
    lags = pdf["__lag"].to_numpy(np.int64)[start]
    # a tile with one side alone has no pairs
    both = (long[0] > 0) & (long[1] > 0)
    width = np.ceil(np.log2(np.maximum(np.maximum(*long), 1))).astype(int)
    for w in np.unique(width[both]):
        of = np.flatnonzero(both & (width == w))
        per = max(1, _CELLS >> int(w))
        for a in range(0, len(of), per):
            some = of[a: a + per]
            at = np.full(len(start), -1)
            at[some] = np.arange(len(some))
            sides = []
            for side, lo in zip((first, ~first), base):
                z = np.full((len(some), 1 << int(w)), np.nan)
                r = np.flatnonzero(side & (at[tile] >= 0))
                z[at[tile[r]], pos[r] - lo[tile[r]]] = v[r]
                sides.append(z)
            sums = lag_sums(*sides)
            lag = np.arange(sums.shape[1]) - (1 << int(w)) + 1
            shift = (base[0] - base[1])[some][:, None]
            ok = (lag > -long[1][some][:, None]) & (lag < long[0][some][:, None]) & (np.abs(lag + shift) <= lags[some][:, None])
            g, c = np.nonzero(ok)
            out = {k: pdf[k].to_numpy()[start[some]][g] for k in series}
            out["lag"] = lag[c] + shift[g, 0]
            out.update({n: sums[g, c, i] for i, n in enumerate(names)})
            yield pd.DataFrame(out).astype({"lag": "int64", "n": "int64"})


def lag_correlation(pairs: DataFrame, series: Sequence[str], x: str, y: str, index: str, max_lag: str | int,
                    min_overlap: int = 10, block: int = BLOCK_ROWS) -> DataFrame:
    """Pearson correlation of ``x[k]`` with ``y[k - lag]`` for every lag of ``[-max_lag, max_lag]``.

    Null pairs are dropped; fewer than ``min_overlap`` pairs or zero variance give null. Positions and lags are tiled: a
    task correlates one block of x with one block of y by FFT, so it holds twice ``block`` rows whatever the record
    and the lags; a plain aggregate adds the sums.
    """
    series = list(series)
    lag = F.lit(max_lag).cast("long") if isinstance(max_lag, int) else F.col(max_lag).cast("long")
    d = pairs.select(*series, F.col(index).cast("long").alias("__i"), F.col(x).cast("double").alias("__x"),
                     F.col(y).cast("double").alias("__y"), lag.alias("__lag"))
    mean = d.groupBy(*series).agg(F.coalesce(F.avg("__x"), F.lit(0.0)).alias("__mx"), F.coalesce(F.avg("__y"), F.lit(0.0)).alias("__my"))
    d = attach(d, mean, series).withColumn("__x", F.col("__x") - F.col("__mx")).withColumn("__y", F.col("__y") - F.col("__my"))
    own = F.floor(F.col("__i") / block)
    # the other side's blocks that a lag can reach from anywhere in this block
    reach = F.sequence(own - F.ceil((F.col("__lag") + block - 1) / block) + 1, own + F.ceil((F.col("__lag") + block - 1) / block) - 1)
    reach = F.when(F.col("__lag") > 0, reach).otherwise(F.array(own))
    xs = d.select(*series, "__lag", "__i", F.lit(True).alias("__first"), F.col("__x").alias("__v"), own.alias("__bx"), F.explode(reach).alias("__by"))
    ys = d.select(*series, "__lag", "__i", F.lit(False).alias("__first"), F.col("__y").alias("__v"), own.alias("__by"), F.explode(reach).alias("__bx"))

    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_batches(batches, [*series, "__bx", "__by"]):
            yield from _tile_sums(pdf, series, names)

    types = dict(pairs.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in series]
                       + ["lag long", "n long", "sx double", "sy double", "sxx double", "syy double", "sxy double"])
    tile = [*series, "__bx", "__by"]
    p = spread(xs.unionByName(ys), tile).sortWithinPartitions(*tile).mapInPandas(sums, schema)
    # every lag has a row, also where no pair lies
    every = d.groupBy(*series).agg(F.max("__lag").alias("__lag")).select(*series, F.explode(F.sequence(-F.col("__lag"), F.col("__lag"))).alias("lag"),
                                                                         F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(c) for c in names[1:]])
    s = p.unionByName(every).groupBy(*series, "lag").agg(*[F.sum(c).alias(c) for c in names])
    n = F.when(F.col("n") >= min_overlap, F.col("n"))
    vx, vy = F.col("sxx") - F.col("sx") * F.col("sx") / n, F.col("syy") - F.col("sy") * F.col("sy") / n
    scale = F.sqrt(F.when((vx > 1e-12 * F.col("sxx")) & (vy > 1e-12 * F.col("syy")), vx * vy))
    return s.select(*series, "lag", "n", ((F.col("sxy") - F.col("sx") * F.col("sy") / n) / scale).alias("corr"))


def pair_with_reference(stacked: DataFrame, reference: DataFrame, value: str, group: str = "mooring",
                        index: str = "k") -> DataFrame:
    """Each level's samples beside the reference level's sample at the same grid position."""
    ref = attach(stacked.select(group, index, "level", F.col(value).alias("x")),
                 reference.select(group, F.col("ref_level").alias("level")), [group, "level"]).drop("level")
    return stacked.select(group, "level", index, F.col(value).alias("y")).join(ref, [group, index])


def best_lag(stacked: DataFrame, reference: DataFrame, level_offsets: DataFrame, value: str, sub_sample: int = 5,
             group: str = "mooring", t: str = "t_us", width: float = TIME_CHUNK) -> DataFrame:
    """Lag of highest correlation per level and the clock offset it implies.

    ``stacked`` has every grid time of every level; ``level_offsets`` gives ``(group, level, clock_offset)``
    and is joined with the grid step ``step_us`` of the group.
    """
    sub = every_nth(stacked.select(group, "level", t, value, "step_us"), [group, "level"], sub_sample, [t], width, "k")
    n = sub.groupBy(group).agg((F.floor((F.max("k") + 1) / 5)).alias("max_lag"), F.max("step_us").alias("step_us"))
    pairs = attach(pair_with_reference(sub.drop("step_us"), reference, value, group), n, [group])
    c = lag_correlation(pairs, [group, "level"], "x", "y", "k", "max_lag")
    best = c.where("corr IS NOT NULL").groupBy(group, "level").agg(
        F.max_by(F.struct("lag", "corr"), F.struct(F.round("corr", 12), -F.col("lag"))).alias("b"))
    d = attach(attach(best, n, [group]), level_offsets, [group, "level"])
    return d.select(group, "level", F.col("b.lag").alias("lag"), F.col("b.corr").alias("max_corr"),
                    (F.col("b.lag") * sub_sample * F.col("step_us") / 1e6 + F.coalesce("clock_offset", F.lit(0))).alias("recommended_clock_offset"))


def offset_summary(offsets: DataFrame) -> DataFrame:
    """One text line per level; consensus members carry ``REF``. The entry to add to a clock is negated."""
    return offsets.withColumn("recommended_clock_offset", -F.col("avg_offset")).withColumn(
        "summary", F.format_string(
            "Level %d (#%d): start %ss end %ss avg %ss diff %ss drift %ss/day%s", F.col("level") + 1, "serial",
            *[fixed(c, 1, sign=True) for c in ("start_offset", "end_offset", "avg_offset", "diff_offset")], fixed("drift_per_day", 3, sign=True),
            F.when(F.col("in_consensus"), " REF").otherwise("")))


def correlation_summary(best: DataFrame) -> DataFrame:
    return best.withColumn("summary", F.format_string(
        "Level %d: max corr = %.3f @lag %d --> clock_offset: %.0fs", F.col("level") + 1, "max_corr", "lag", "recommended_clock_offset"))
