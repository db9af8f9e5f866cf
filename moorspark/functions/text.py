"""Text conversions: positions, durations, times and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed list of the tags a raw file name may carry.
FILE_TAGS = ("_000", "_001", "_002")


def degrees(text: Column) -> Column:
    """``deg min hemisphere`` to decimal degrees; south and west are negative."""
    p = F.split(F.trim(text), "\\s+")
    v = F.get(p, F.lit(0)).try_cast("double") + F.get(p, F.lit(1)).try_cast("double") / 60
    return F.when(F.upper(F.get(p, F.lit(2))).isin("S", "W"), -v).otherwise(v)


def degree_text(value: Column, axis: str) -> Column:
    """Decimal degrees to ``DD MM.mmm H`` (latitude) or ``DDD MM.mmm H`` (longitude)."""
    pos, neg, width = ("N", "S", 2) if axis == "lat" else ("E", "W", 3)
    a = F.abs(value)
    d = F.floor(a)
    m = (a - d) * 60
    return F.concat(F.format_string(f"%0{width}d", d.cast("int")), F.lit(" "), F.format_string("%06.3f", m), F.lit(" "),
                    F.when(value >= 0, pos).otherwise(neg))


def iso_duration(seconds: Column) -> Column:
    """Seconds as a duration in the largest whole unit, rounded down after rounding to seconds."""
    s = F.rint(seconds).cast("long")

    def unit(n: int, pre: str, suf: str) -> Column:
        return F.concat(F.lit(pre), F.floor(s / n).cast("string"), F.lit(suf))

    return (F.when(s >= 86400, unit(86400, "P", "D")).when(s >= 3600, unit(3600, "PT", "H"))
            .when(s >= 60, unit(60, "PT", "M")).otherwise(unit(1, "PT", "S")))


def is_utc_text(text: Column) -> Column:
    """True for ``YYYY-MM-DDTHH:MM:SSZ`` and ``YYYY/MM/DDTHH:MM:SSZ`` with a valid date and time."""
    shape = text.rlike(r"^\d{4}([-/])\d{1,2}\1\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}Z$")
    ok = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(text, "/", "-"), "[TZ]", " "), F.lit("yyyy-M-d H:m:s ")).isNotNull()
    return F.coalesce(shape & ok, F.lit(False))


def data_mode(source: Column, history: Column) -> Column:
    """P, D or R from the file name, then from the history text; P without a clue."""
    s, h = F.lower(source), F.lower(history)
    return (F.when(s.rlike(r"\.(raw|use)$"), "P").when(s.rlike(r"\.microcat$"), "D")
            .when(h.contains("realtime") | h.contains("real-time"), "R").when(h.contains("prelim"), "P")
            .when(h.contains("delayed"), "D").otherwise("P"))


def file_tag(name: Column) -> Column:
    out = F.lit("")
    for tag in reversed(FILE_TAGS):
        out = F.when(name.contains(tag), tag).otherwise(out)
    return F.coalesce(out, F.lit(""))


def stage_name(mooring: Column, serial: Column, file_type: Column, source: Column, suffix: str = "raw") -> Column:
    """``{mooring}_{serial}{tag}_{suffix}``; only one file type carries a tag."""
    tag = F.when(file_type == "adcp-matlab", file_tag(source)).otherwise("")
    return F.concat(mooring.cast("string"), F.lit("_"), serial.cast("string"), tag, F.lit(f"_{suffix}"))


def mooring_name(mooring: Column, suffix: str = "", filtered: str = "") -> Column:
    """``{mooring}_mooring{suffix}{_filter}``."""
    return F.concat(mooring.cast("string"), F.lit("_mooring" + suffix + (f"_{filtered}" if filtered else "")))


def path_metadata(path: Column, mooring: Column) -> tuple[Column, Column]:
    """(instrument, serial) from ``{instrument}/{mooring}_{serial}_raw``; a serial that is no integer is null."""
    p = F.split(path, "/")
    stem = F.regexp_replace(F.regexp_replace(F.element_at(p, -1), r"\.[^.]*$", ""), "_raw$", "")
    prefix = F.concat(mooring, F.lit("_"))
    serial = F.when(F.startswith(stem, prefix), F.expr("0"))
    rest = F.substring(stem, F.length(prefix) + 1, F.length(stem))
    serial = F.when(F.startswith(stem, prefix), rest.try_cast("long"))
    return F.try_element_at(p, F.lit(-2)), serial


def fixed(c: Column | str, digits: int, sign: bool = False) -> Column:
    """A double with so many decimals, rounded by its exact value as ``printf`` does, ties to even.

    ``format_string`` rounds the shortest decimal text of the double instead, so 0.15 (in binary a little less) becomes 0.2.
    """
    p = "0." + "0" * digits
    return F.call_function("format_number", F.col(c) if isinstance(c, str) else c, F.lit(f"+{p};-{p}" if sign else p))
