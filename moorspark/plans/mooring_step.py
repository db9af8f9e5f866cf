"""The whole first mooring step: filter, common grid, interpolation, stacking, instrument codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from moorspark.operators import filters, grid, meta, stats


def mooring_step(obs: DataFrame, instr: DataFrame, values: Sequence[str], filter_type: str | None = None,
                 **filter_args) -> DataFrame:
    """Stage-2 records of many moorings to one gridded, stacked table.

    The filter runs on the native sampling, before any interpolation.
    """
    series = ["mooring", "serial"]
    if filter_type:
        obs = filters.apply_filter(obs, series, values, filter_type, **filter_args)
    st = stats.sampling_stats(obs, series)
    g = grid.interpolate(obs, grid.common_grid(st), series, ["mooring"], values, whole_grid=True)
    lv = grid.levels(instr, st)
    d = grid.stack_levels(g, lv, values)
    return meta.encode_instruments(d, lv)
