"""Quality-flag vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the flag codes used by the tests.
GOOD, NOT_EVALUATED, SUSPECT, FAIL, MISSING = 1, 2, 3, 4, 9
#: Further codes of gridded products.
NOMINAL, INTERPOLATED = 7, 8

#: Meanings in the two vocabularies.
IOC = {1: "good", 2: "not_evaluated", 3: "suspect", 4: "bad", 9: "missing"}
OCEANSITES = {0: "unknown", 1: "good_data", 2: "probably_good_data", 3: "potentially_correctable_bad_data", 4: "bad_data",
              7: "nominal_value", 8: "interpolated_value", 9: "missing_value"}
#: OceanSITES code of each IOC code.
IOC_TO_OCEANSITES = {1: 1, 2: 0, 3: 2, 4: 4, 9: 9}

#: Fixed order of the rollup, worst first.
PRECEDENCE = (FAIL, SUSPECT, GOOD, NOT_EVALUATED, MISSING)


def _map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def meaning(flag: Column, vocabulary: dict[int, str] = IOC) -> Column:
    return F.try_element_at(_map(vocabulary), flag.cast("int"))


def to_oceansites(flag: Column) -> Column:
    return F.try_element_at(_map(IOC_TO_OCEANSITES), flag.cast("int"))


def rollup(*flags: Column) -> Column:
    """Worst flag by the fixed precedence; missing tests are ignored."""
    rank = _map({f: len(PRECEDENCE) - i for i, f in enumerate(PRECEDENCE)})
    back = _map({len(PRECEDENCE) - i: f for i, f in enumerate(PRECEDENCE)})
    best = F.array_max(F.array(*[F.try_element_at(rank, f.cast("int")) for f in flags]))
    return F.try_element_at(back, best)


def gridded_flag(value: Column, span: Column, max_span: float | None = None) -> Column:
    """Flag of a gridded cell: missing, interpolated (beyond ``max_span`` if given) or good."""
    far = span > (0 if max_span is None else max_span)
    return F.when(value.isNull(), MISSING).when(F.coalesce(far, F.lit(False)), INTERPOLATED).otherwise(GOOD)
