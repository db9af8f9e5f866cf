"""Whole processing steps over many moorings, each with a status row for every configured instrument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.operators import clean, clock, deployment, grid, meta, stats
from moorspark.operators.ordered import RECORD, attach
from moorspark.session import materialize
from moorspark.sources import sinks


def instrument_status(instr: DataFrame, given: DataFrame, result: DataFrame) -> DataFrame:
    """Samples before and after a step per instrument: ``ok``, ``emptied`` or ``no data``; ``not configured`` for records that only the samples name."""
    n = given.groupBy(*RECORD).agg(F.count(F.lit(1)).alias("n_in"))
    m = result.groupBy(*RECORD).agg(F.count(F.lit(1)).alias("n_out"))
    d = instr.select(*RECORD, F.lit(True).alias("__known")).join(n, list(RECORD), "full").join(m, list(RECORD), "left")
    d = d.select(*RECORD, "__known", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_in", "n_out")])
    status = F.when(F.col("__known").isNull(), "not configured").when(F.col("n_out") > 0, "ok").when(F.col("n_in") > 0, "emptied").otherwise("no data")
    return d.withColumn("status", status).drop("__known")


def stage2_step(obs: DataFrame, instr: DataFrame, deploy: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw records of many moorings to clock-corrected, trimmed ones: ``(records, status, report per mooring)``.

    With a ``path`` the records replace those of their series there and are read back, so that later steps do not shift them again.
    """
    d = meta.drop_working(clean.shift_and_trim(clean.within_bounds(obs, instr, deploy), instr, deploy))
    if path:
        sinks.write_stage(d, path, "replace")
        d = sinks.read_stage(d.sparkSession, path)
    return d, instrument_status(instr, obs, d), stats.batch_report(instr, d)


def clock_step(records: DataFrame, instr: DataFrame, value: str, bin_seconds: float = 60.0, sub_sample: int = 5,
               **find) -> tuple[DataFrame, DataFrame]:
    """Clock analysis of whole moorings: ``(offsets by deployment times, best lag against the suggested reference)``.

    Deployment times of each record give timing offsets; the level with the smallest one is the reference of the lag
    correlation on the common grid.
    """
    series = list(RECORD)
    lv = grid.levels(instr)
    found = deployment.find_deployment(records, series, value, **find)
    times = attach(lv.select(*series, "level"), found.select(*series, "start_us", "end_us"), series, "left")
    offsets = clock.timing_offsets(materialize(times, "times"), bin_seconds=bin_seconds)
    st = stats.sampling_stats(records, series)
    g = grid.common_grid(st)
    cells = grid.interpolate(records, g, series, ["mooring"], [value], whole_grid=True)
    # the gridded product is read several times by the lag analysis
    stacked = materialize(attach(cells.join(lv.select(*series, "level"), series), g.select("mooring", "step_us"), ["mooring"]), "gridded")
    reference = clock.suggest_reference(offsets).select("mooring", "ref_level")
    best = clock.best_lag(stacked, reference, lv.select("mooring", "level", "clock_offset"), value, sub_sample)
    return offsets, best


def product_status(instr: DataFrame, product: DataFrame, values: Sequence[str]) -> DataFrame:
    """Valid cells per configured instrument and variable of a gridded product."""
    n = product.groupBy(*RECORD).agg(*[F.count(v).alias(f"n_{v}") for v in values])
    return instr.select(*RECORD).join(n, list(RECORD), "left").fillna(0, [f"n_{v}" for v in values])
