"""Ordered-series building blocks that never put a whole series into one task.

An axis (time in microseconds, pressure, ...) is cut into chunks of fixed width. Windows run inside
``(series, chunk)``; a summary with one row per chunk carries the edge rows, counts and sums across chunk
borders, and is joined back. The result equals the plain window over the whole series, while a series that
holds a large share of all rows is spread over as many tasks as it has chunks.

The input is computed once: rows and summary read one exchange (:func:`shared`), so that a chain of operators grows by
one exchange per operator instead of doubling what lies below.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
#: Default chunk of a time axis. A 16-Hz record has 1.4 million samples a day.
TIME_CHUNK = DAY_US
#: Default chunk of a pressure axis (dbar).
PRES_CHUNK = 1000.0
#: Rows of one block of :func:`in_blocks`.
BLOCK_ROWS = 1 << 17

#: A record: serials recur, an instrument is deployed again on other moorings.
RECORD = ("mooring", "serial")

_CH = "__chunk"


def _struct(cols: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in cols.items()])


#: no chunk has this number
_NO_CHUNK = -(1 << 63) + 1


def _whole_row(df: DataFrame, chunk: Column) -> Column:
    """True, but needs every column of ``df`` as far as the optimizer can see; at run time one comparison a row."""
    cols = [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return (chunk != F.lit(_NO_CHUNK)) | (F.hash(*cols) != 0)


def shared(df: DataFrame, part: Sequence[str], chunk: str) -> tuple[DataFrame, DataFrame, Column]:
    """``df`` dealt by ``part``, for two readers of one exchange: ``(rows, rows to aggregate, aggregate that keeps them alike)``.

    Spark uses an exchange again only if both readers want the same columns and filters of it. So keys are made non-null
    first (the null test a join adds is then there already), the first frame is to be filtered by the last
    expression *after* its windows, and the second one has to count it. ``part`` must not hold nulls.
    """
    d = df.where(reduce(operator.and_, [F.col(k).isNotNull() for k in part])).repartition(*part)
    return d, d, _whole_row(df, F.col(chunk))


def _no_null(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """Series keys that raise where they are null: an inner join would drop such rows without a word."""
    lost = F.raise_error(F.lit(f"null in a series key ({', '.join(keys)})"))
    return {k: F.coalesce(F.col(k), lost.cast(df.schema[k].dataType)) for k in keys}


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    width: float | None,
    *,
    lag: dict[str, Column] | None = None,
    lead: dict[str, Column] | None = None,
    index: str | None = None,
    count: str | None = None,
    cum: dict[str, Column] | None = None,
    total: dict[str, Column] | None = None,
    last_valid: dict[str, tuple[Column, Column]] | None = None,
    next_valid: dict[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Add neighbour, position and running columns along an ordered axis.

    ``order[0]`` is the numeric axis, further names break ties. ``width=None`` skips the chunking and is
    for groups with a physical bound (the levels of one profile).

    A null in a series key raises.

    * ``lag`` / ``lead``: value of the expression at the previous / next row
    * ``index`` / ``count``: 0-based position / number of rows of the series
    * ``cum`` / ``total``: inclusive running sum / sum over the series (nulls count as 0)
    * ``last_valid`` / ``next_valid``: ``{name: (value, condition)}``; the value at the nearest row at or
      before / at or after this one where the condition holds
    """
    keys, order = list(keys), list(order)
    lag, lead, cum, total = lag or {}, lead or {}, cum or {}, total or {}
    last_valid, next_valid = last_valid or {}, next_valid or {}
    chunked = width is not None
    # rows without an axis value sort first, as in a plain window
    if chunked:
        d = df.withColumns({**_no_null(df, keys), _CH: F.coalesce(F.floor(F.col(order[0]) / F.lit(width)), F.lit(-1 << 62))})
        d, again, whole_row = shared(d, [*keys, _CH], _CH)
    else:
        d = df
    part = keys + ([_CH] if chunked else [])
    w = Window.partitionBy(*part).orderBy(*order)
    wpre = w.rowsBetween(Window.unboundedPreceding, 0)
    wdesc = Window.partitionBy(*part).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(
        Window.unboundedPreceding, 0)
    wall = Window.partitionBy(*part)
    at = F.struct(*order)
    cum = {n: F.coalesce(c, F.lit(0)) for n, c in cum.items()}
    total = {n: F.coalesce(c, F.lit(0)) for n, c in total.items()}

    inner: dict[str, Column] = {}
    if lag:
        inner["__lag"] = F.lag(_struct(lag)).over(w)
    if lead:
        inner["__lead"] = F.lead(_struct(lead)).over(w)
    if index:
        inner["__rn"] = F.row_number().over(w).cast("long") - 1
    for n, c in cum.items():
        inner[f"__cum_{n}"] = F.sum(c).over(wpre)
    for n, (v, ok) in last_valid.items():
        inner[f"__lv_{n}"] = F.last(F.when(ok, F.struct(v.alias("v"))), ignorenulls=True).over(wpre)
    for n, (v, ok) in next_valid.items():
        inner[f"__nv_{n}"] = F.last(F.when(ok, F.struct(v.alias("v"))), ignorenulls=True).over(wdesc)
    if not chunked:
        if count:
            inner["__n"] = F.count(F.lit(1)).over(wall)
        for n, c in total.items():
            inner[f"__tot_{n}"] = F.sum(c).over(wall)
    out = d.select("*", *[c.alias(n) for n, c in inner.items()])

    if chunked:
        out = out.where(whole_row)
        aggs = [F.count(F.when(whole_row, True)).alias("__cn")]
        if lag:
            aggs.append(F.max_by(_struct(lag), at).alias("__cl"))
        if lead:
            aggs.append(F.min_by(_struct(lead), at).alias("__cf"))
        for n, c in {**total, **cum}.items():
            aggs.append(F.sum(c).alias(f"__cs_{n}"))
        for n, (v, ok) in last_valid.items():
            aggs.append(F.max_by(F.struct(v.alias("v")), F.when(ok, at)).alias(f"__clv_{n}"))
        for n, (v, ok) in next_valid.items():
            aggs.append(F.min_by(F.struct(v.alias("v")), F.when(ok, at)).alias(f"__cnv_{n}"))
        we = Window.partitionBy(*keys).orderBy(_CH)
        before = we.rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy(*keys).orderBy(F.col(_CH).desc()).rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy(*keys)
        sel = [F.col(k) for k in part]
        if lag:
            sel.append(F.lag("__cl").over(we).alias("__elag"))
        if lead:
            sel.append(F.lead("__cf").over(we).alias("__elead"))
        if index:
            sel.append(F.coalesce(F.sum("__cn").over(before), F.lit(0)).alias("__eidx"))
        if count:
            sel.append(F.sum("__cn").over(whole).alias("__n"))
        for n in cum:
            sel.append(F.coalesce(F.sum(f"__cs_{n}").over(before), F.lit(0)).alias(f"__ecum_{n}"))
        for n in total:
            sel.append(F.sum(f"__cs_{n}").over(whole).alias(f"__tot_{n}"))
        for n in last_valid:
            sel.append(F.last(f"__clv_{n}", ignorenulls=True).over(before).alias(f"__elv_{n}"))
        for n in next_valid:
            sel.append(F.last(f"__cnv_{n}", ignorenulls=True).over(after).alias(f"__env_{n}"))
        edges = again.groupBy(*part).agg(*aggs).select(*sel)
        out = out.join(edges, part)

    cols = [F.col(c) for c in df.columns]
    if lag:
        s = F.coalesce("__lag", "__elag") if chunked else F.col("__lag")
        cols += [s[n].alias(n) for n in lag]
    if lead:
        s = F.coalesce("__lead", "__elead") if chunked else F.col("__lead")
        cols += [s[n].alias(n) for n in lead]
    if index:
        cols.append((F.col("__rn") + F.col("__eidx") if chunked else F.col("__rn")).alias(index))
    if count:
        cols.append(F.col("__n").alias(count))
    for n in cum:
        c = F.col(f"__cum_{n}")
        cols.append((c + F.col(f"__ecum_{n}") if chunked else c).alias(n))
    for n in total:
        cols.append(F.col(f"__tot_{n}").alias(n))
    for n in last_valid:
        s = F.coalesce(f"__lv_{n}", f"__elv_{n}") if chunked else F.col(f"__lv_{n}")
        cols.append(s["v"].alias(n))
    for n in next_valid:
        s = F.coalesce(f"__nv_{n}", f"__env_{n}") if chunked else F.col(f"__nv_{n}")
        cols.append(s["v"].alias(n))
    return out.select(*cols)


def in_blocks(df: DataFrame, index: str, half: int | Column, block: int | Column = BLOCK_ROWS) -> DataFrame:
    """Copy each row into every block of ``block`` consecutive rows whose rows may look at it.

    ``half`` and ``block`` may be columns that are constant within a series.

    Adds ``__block`` and ``__own``; a row is its block's own once and a border copy elsewhere, so a frame
    of ``half`` rows either side is complete inside ``(series, __block)``.
    """
    i = F.col(index)
    return df.withColumn(
        "__block",
        F.explode(F.sequence(F.floor(F.greatest(i - half, F.lit(0).cast("long")) / block), F.floor((i + half) / block))),
    ).withColumn("__own", F.floor(i / block) == F.col("__block"))


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    width: float | None,
    half: int,
    aggs: dict[str, Callable[[object], Column]],
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Centred row frames of ``2*half+1`` rows; ``aggs`` maps output names to ``window -> Column``."""
    d = in_blocks(ordered(df, keys, order, width, index="__i"), "__i", half, block)
    w = Window.partitionBy(*keys, "__block").orderBy("__i").rowsBetween(-half, half)
    d = d.select("*", *[f(w).alias(n) for n, f in aggs.items()])
    return d.where("__own").drop("__i", "__block", "__own")


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    axis: str,
    width: int,
    span: int,
    aggs: dict[str, Callable[[object], Column]],
) -> DataFrame:
    """Range frames over ``[axis - span, axis]``; rows are copied into the chunks that look back at them."""
    x = F.col(axis)
    d = df.withColumn(
        "__block", F.explode(F.sequence(F.floor(x / width), F.floor((x + span) / width)))
    ).withColumn("__own", F.floor(x / width) == F.col("__block"))
    w = Window.partitionBy(*keys, "__block").orderBy(axis).rangeBetween(-span, 0)
    d = d.select("*", *[f(w).alias(n) for n, f in aggs.items()])
    return d.where("__own").drop("__block", "__own")


def trailing_extremes(df: DataFrame, keys: Sequence[str], axis: str, span: int, value: Column, low: str, high: str) -> DataFrame:
    """Least and greatest ``value`` over ``[axis - span, axis]`` at a cost per row that does not depend on the frame.

    Buckets are ``span`` wide, so a frame is the beginning of the row's bucket and the end of the one before. Each row is
    copied into the next bucket, moved by ``span``: running extremes along the axis give the beginning, those against it
    over the moved rows the end. Both run over one exchange.
    """
    if span <= 0:
        raise ValueError("span must be positive")
    x, own = F.col(axis), F.col("__own")
    b = F.floor(x / span)
    d = df.withColumn("__block", F.explode(F.array(b, b + 1))).withColumn("__own", F.col("__block") == b)
    d = d.withColumn("__moved", F.when(own, x).otherwise(x + span))
    ahead = Window.partitionBy(*keys, "__block").orderBy(axis).rangeBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(*keys, "__block").orderBy(F.col("__moved").desc()).rangeBetween(Window.unboundedPreceding, 0)
    mine, before = F.when(own, value), F.when(~own, value)
    d = d.select("*", F.least(F.min(mine).over(ahead), F.min(before).over(back)).alias(low), F.greatest(F.max(mine).over(ahead), F.max(before).over(back)).alias(high))
    return d.where(own).drop("__block", "__own", "__moved")


def sorted_median(arr: Column) -> Column:
    """Median of a sorted array column (mean of the two middles for an even size)."""
    n = F.size(arr)
    lo = F.get(arr, F.floor((n - 1) / 2).cast("int"))
    hi = F.get(arr, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (lo + hi) / 2)


def value_counts(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """``(keys, __qv, __qc)``: how often each value occurs per key; nulls are left out."""
    d = df.select(*keys, value.cast("double").alias("__qv")).where("__qv IS NOT NULL AND NOT isnan(__qv)")
    return d.groupBy(*keys, "__qv").agg(F.count(F.lit(1)).alias("__qc"))


def percentiles(df: DataFrame, keys: Sequence[str], value: Column, probs: dict[str, float],
                count: str | None = None) -> DataFrame:
    """Exact linear-interpolated percentiles per key, one row per key that has a value."""
    return percentiles_of_counts(value_counts(df, keys, value), keys, probs, count)


def percentiles_of_counts(v: DataFrame, keys: Sequence[str], probs: dict[str, float], count: str | None = None) -> DataFrame:
    """Percentiles from pre-aggregated values.

    A monotone bin of the value (about 1.7e-4 wide, relative above 1 and absolute below) gives per-key
    cumulative counts, so only the bins that contain a wanted rank are sorted. No task sees more of one key
    than one bin.
    """
    keys = list(keys)
    gk = keys
    if not gk:
        v, gk = v.withColumn("__qk", F.lit(1)), ["__qk"]
    v = v.withColumn("__qb", F.floor(F.signum("__qv") * F.log1p(F.abs("__qv")) * 5909.0).cast("long"))
    wb = Window.partitionBy(*gk).orderBy("__qb").rowsBetween(Window.unboundedPreceding, 0)
    bins = (
        v.groupBy(*gk, "__qb").agg(F.sum("__qc").alias("__qbc"))
        .withColumn("__qhi", F.sum("__qbc").over(wb))
        .withColumn("__qn", F.sum("__qbc").over(Window.partitionBy(*gk)))
        .withColumn("__qlo", F.col("__qhi") - F.col("__qbc"))
    )
    pos = {n: F.lit(float(p)) * (F.col("__qn") - 1) for n, p in probs.items()}
    ranks = [f(c) for c in pos.values() for f in (F.floor, F.ceil)]
    hit = None
    for r in ranks:
        h = (r >= F.col("__qlo")) & (r < F.col("__qhi"))
        hit = h if hit is None else hit | h
    need = bins.where(hit).select(*gk, "__qb", "__qlo", "__qn")
    ws = Window.partitionBy(*gk, "__qb").orderBy("__qv").rowsBetween(Window.unboundedPreceding, 0)
    s = v.join(need, gk + ["__qb"]).withColumn("__qvhi", F.col("__qlo") + F.sum("__qc").over(ws))
    s = s.withColumn("__qvlo", F.col("__qvhi") - F.col("__qc"))

    def pick(r: Column) -> Column:
        return F.max(F.when((r >= F.col("__qvlo")) & (r < F.col("__qvhi")), F.col("__qv")))

    aggs = [F.max("__qn").alias("__qn")]
    for n, c in pos.items():
        aggs += [pick(F.floor(c)).alias(f"__qa_{n}"), pick(F.ceil(c)).alias(f"__qz_{n}")]
    s = s.groupBy(*gk).agg(*aggs)
    out = [F.col(k) for k in keys]
    for n, c in pos.items():
        a, z = F.col(f"__qa_{n}"), F.col(f"__qz_{n}")
        out.append((a + (z - a) * (c - F.floor(c))).alias(n))
    if count:
        out.append(F.col("__qn").alias(count))
    return s.select(*out)


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join per-key results back to the rows.

    No broadcast hint: the optimizer broadcasts when the measured size is below its threshold, else the
    sort-merge join is split at skewed keys by adaptive execution.
    """
    if not keys:
        raise ValueError("per-key results need a key")
    return df.join(small, list(keys), how)


def unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The rows of a configuration table; a key that occurs twice raises, since a join would double its samples."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn(keys[0], F.when(n == 1, F.col(keys[0])).otherwise(F.raise_error(F.lit(f"{what}: key {', '.join(keys)} occurs more than once")).cast(df.schema[keys[0]].dataType)))


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash-partition for a Python kernel into as many tasks as the session's shuffles have.

    Small input would else be coalesced by size into a task or two, although the kernels are bound by CPU.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def whole_groups(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Groups of rows with equal keys from batches sorted by them (a group may span batches)."""
    pending: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        cols = [pdf[k].to_numpy() for k in keys]
        cut = np.zeros(len(pdf) - 1, dtype=bool)
        for c in cols:
            cut |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(cut) + 1), len(pdf)]
        if pending and any(pending[-1][k].iloc[-1] != c[0] for k, c in zip(keys, cols)):
            yield pd.concat(pending, ignore_index=True)
            pending = []
        for a, b in zip(edges[:-2], edges[1:-1]):
            yield pd.concat([*pending, pdf.iloc[a:b]], ignore_index=True) if pending else pdf.iloc[a:b]
            pending = []
        pending.append(pdf.iloc[edges[-2]:])
    if pending:
        yield pd.concat(pending, ignore_index=True)


def changes(pdf: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """True at the first row of each run of equal keys."""
    new = np.zeros(len(pdf), dtype=bool)
    new[:1] = True
    for k in keys:
        c = pdf[k].to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return new


def whole_batches(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Batches sorted by the keys, cut anew so that no group of rows with equal keys spans two; many small groups stay in one."""
    pending: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        if pending and any(pending[-1][k].iloc[-1] != pdf[k].iloc[0] for k in keys):
            yield pd.concat(pending, ignore_index=True)
            pending = []
        last = int(np.flatnonzero(changes(pdf, keys))[-1])
        if last:
            yield pd.concat([*pending, pdf.iloc[:last]], ignore_index=True)
            pending = []
        pending.append(pdf.iloc[last:])
    if pending:
        yield pd.concat(pending, ignore_index=True)


def in_batches(frames: Iterator[pd.DataFrame], rows: int = 20_000) -> Iterator[pd.DataFrame]:
    """Join small frames, so that a task does not send one Arrow batch per group."""
    held: list[pd.DataFrame] = []
    n = 0
    for f in frames:
        held.append(f)
        n += len(f)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def explode_range(df: DataFrame, first: Column, last: Column, name: str, step: int = 4096) -> DataFrame:
    """One row per integer of ``[first, last]`` (none when empty), built from short arrays only."""
    d = df.withColumn("__k0", first.cast("long")).withColumn("__k1", last.cast("long"))
    d = d.where("__k0 <= __k1").withColumn("__kb", F.explode(F.sequence("__k0", "__k1", F.lit(step).cast("long"))))
    d = d.withColumn(name, F.explode(F.sequence("__kb", F.least(F.col("__k1"), F.col("__kb") + (step - 1)))))
    return d.drop("__k0", "__k1", "__kb")
