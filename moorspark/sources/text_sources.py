"""CTD text, delimited logger files, mooring configuration and calibration logs."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moorspark.sources.rodb import file_key, read_rodb, text_lines

#: Short names of the format and the canonical variables.
CNV_NAMES = {
    "temperature": ("t090C", "tv290C", "t190C", "t090"),
    "conductivity": ("cond0mS/cm", "c0mS/cm", "cond0S/m", "c0S/m"),
    "pressure": ("prdM", "prDM", "prM", "pr"),
    "salinity": ("sal00", "sal11"),
}
JULIAN = ("timeJV2", "timeJ", "timeJV1")
#: Factor to the canonical unit (mS/cm) of names in another unit.
CNV_FACTORS = {"cond0S/m": 10.0, "c0S/m": 10.0}


def _column(short: str) -> str:
    """Column name of a variable without a canonical one."""
    return re.sub(r"\W+", "_", short).strip("_")


def _columns(shorts: Sequence[str], taken: Sequence[str]) -> dict[str, str]:
    """Column name per short name; names that clash when cleaned, or with ``taken`` ones, are numbered in order of the short names."""
    used, out = {t.lower() for t in taken}, {}
    for short in shorts:
        base = _column(short) or "column"
        name, n = base, 1
        while name.lower() in used:
            n += 1
            name = f"{base}_{n}"
        used.add(name.lower())
        out[short] = name
    return out


def read_cnv(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """CTD text: preamble of ``*`` and ``#`` lines, then columns named by the preamble.

    Time is the day of the year (day 1 = 1 January) in the year of ``start_time``; the bad flag is null. Known
    variables get canonical names and units (conductivity in mS/cm); every other column keeps its short name, with
    signs as underscores and numbered where two names become one, and is null in the records that lack it.
    """
    d = text_lines(spark, paths).select("file", F.trim("value").alias("line")).where("line <> ''")
    pre = F.startswith("line", F.lit("*")) | F.startswith("line", F.lit("#"))
    h = d.where(pre)
    idx = F.regexp_extract("line", r"^# name (\d+) = ", 1).try_cast("int")
    short = F.regexp_extract("line", r"^# name \d+ = ([^:]+):", 1)
    h = h.groupBy("file").agg(
        F.map_from_entries(F.collect_set(F.when(idx.isNotNull(), F.struct(F.trim(short), idx)))).alias("names"),
        F.max(F.nullif(F.regexp_extract("line", r"^# bad_flag = (\S+)", 1), F.lit(""))).try_cast("double").alias("bad"),
        F.max(F.nullif(F.regexp_extract("line", r"^# start_time = \w+ \d+ (\d{4})", 1), F.lit(""))).try_cast("int").alias("year"))
    known = {s for names in CNV_NAMES.values() for s in names} | set(JULIAN)
    # the short names of all preambles: some dozens
    found = h.select(F.explode(F.map_keys("names")).alias("s")).distinct().collect()
    others = {n: [s] for s, n in _columns(sorted(r.s for r in found if r.s not in known), ["file", "time", "t_us", *CNV_NAMES]).items()}
    d = d.where(~pre).select("file", F.split("line", "\\s+").alias("v")).join(h, "file")

    def one(short: str) -> Column:
        v = F.get("v", F.try_element_at("names", F.lit(short))).try_cast("double")
        return F.when(F.col("bad").isNull() | (v != F.col("bad")), v * CNV_FACTORS[short] if short in CNV_FACTORS else v)

    def value(shorts: Sequence[str]) -> Column:
        # the first of the names that the record has, even if its value is bad
        first = F.coalesce(*[F.when(F.try_element_at("names", F.lit(s)).isNotNull(), F.lit(s)) for s in shorts])
        out = F.lit(None).cast("double")
        for s in shorts:
            out = F.when(first == s, one(s)).otherwise(out)
        return out

    us = F.round((value(JULIAN) - 1) * 86_400_000_000).cast("long")
    t0 = F.unix_micros(F.make_timestamp_ntz(F.col("year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("timestamp"))
    names = {**CNV_NAMES, **others}
    d = d.select("file", (t0 + us).alias("t_us"), *[value(s).alias(n) for n, s in names.items()])
    return d.select("file", F.timestamp_micros("t_us").cast("timestamp_ntz").alias("time"), "t_us", *names)


def _delimited(spark: SparkSession, paths: Sequence[str] | str, schema_map: dict[str, str], time_columns: Sequence[str],
               time_format: str, sep: str, header_regex: str | None) -> DataFrame:
    d = spark.read.text(paths).select(file_key().alias("file"), F.col("value").alias("line")).where("trim(line) <> ''")
    if header_regex:
        d = d.where(~F.col("line").rlike(header_regex))
    d = d.withColumn("v", F.split(F.trim("line"), sep))
    parts = [F.trim(F.get("v", F.lit(int(c)))) for c in time_columns]
    time = F.try_to_timestamp(F.concat_ws(" ", *parts), F.lit(time_format)).cast("timestamp_ntz")
    return d.select("file", "line", time.alias("time"), *[F.trim(F.get("v", F.lit(int(p)))).try_cast("double").alias(n) for p, n in schema_map.items()])


def read_delimited(spark: SparkSession, paths: Sequence[str] | str, schema_map: dict[str, str], time_columns: Sequence[str],
                   time_format: str, sep: str = ",", header_regex: str | None = None) -> DataFrame:
    """Logger text with one row per sample.

    ``schema_map`` maps 0-based column positions (as text) to canonical names; the time is the joined
    ``time_columns`` (positions) in ``time_format``. Lines that match ``header_regex`` are headers; those whose time
    cannot be read are the rows of :func:`unreadable_lines`.
    """
    return _delimited(spark, paths, schema_map, time_columns, time_format, sep, header_regex).where("time IS NOT NULL").drop("line")


def unreadable_lines(spark: SparkSession, paths: Sequence[str] | str, schema_map: dict[str, str], time_columns: Sequence[str],
                     time_format: str, sep: str = ",", header_regex: str | None = None) -> DataFrame:
    """Quarantine of :func:`read_delimited`: ``file, line, reason`` of the lines that give no sample."""
    d = _delimited(spark, paths, schema_map, time_columns, time_format, sep, header_regex)
    return d.where("time IS NULL").select("file", "line", F.lit("time cannot be read").alias("reason"))


_INSTRUMENT = ("serial long, instrument string, label string, depth double, file_type string, filename string, clock_offset long, "
               "start_time string, end_time string")
_CONFIG = ("file string, mooring string, waterdepth double, longitude double, latitude double, deployment_time string, recovery_time string, "
           "deployment_latitude string, deployment_longitude string, seabed_latitude string, seabed_longitude string, directory string, "
           f"ship string, cruise string, year int, instruments array<struct<{', '.join(p.replace(' ', ': ') for p in _INSTRUMENT.split(', '))}>>")
_TEXT = ("deployment_time", "recovery_time", "deployment_latitude", "deployment_longitude", "seabed_latitude", "seabed_longitude", "directory",
         "ship", "cruise")


def _clean(v, kind):
    if v is None:
        return None
    if kind == "text":
        return v.isoformat() if hasattr(v, "isoformat") else str(v)
    try:
        return kind(v)
    except (TypeError, ValueError):
        return None


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import yaml

    for pdf in batches:
        rows = []
        for file, body in zip(pdf["file"], pdf["value"]):
            for doc in yaml.safe_load_all(body):
                if not isinstance(doc, dict) or "name" not in doc:
                    continue
                inst = [
                    {"serial": _clean(i.get("serial"), int), "instrument": _clean(i.get("instrument"), "text"), "label": _clean(i.get("label"), "text"),
                     "depth": _clean(i.get("depth"), float), "file_type": _clean(i.get("file_type"), "text"), "filename": _clean(i.get("filename"), "text"),
                     "clock_offset": _clean(i.get("clock_offset"), int), "start_time": _clean(i.get("start_time"), "text"), "end_time": _clean(i.get("end_time"), "text")}
                    for i in doc.get("instruments") or []]
                rows.append((file, str(doc["name"]), _clean(doc.get("waterdepth"), float), _clean(doc.get("longitude"), float), _clean(doc.get("latitude"), float),
                             *[_clean(doc.get(k), "text") for k in _TEXT], _clean(doc.get("year"), int), inst))
        names = ["file", "mooring", "waterdepth", "longitude", "latitude", *_TEXT, "year", "instruments"]
        out = pd.DataFrame(rows, columns=names)
        out["year"] = out["year"].astype("Int32")
        yield out


def read_config(spark: SparkSession, paths: Sequence[str] | str) -> tuple[DataFrame, DataFrame]:
    """Mooring configuration files to ``(deployment, instrument)``.

    Missing keys are null; ``position`` keeps the order of the instrument list.
    """
    raw = spark.read.text(paths, wholetext=True).select(file_key().alias("file"), "value")
    cfg = raw.mapInPandas(_parse, _CONFIG)
    ts = {c: F.col(c).try_cast("timestamp_ntz") for c in ("deployment_time", "recovery_time")}
    dep = cfg.drop("instruments").withColumns(ts)
    ins = cfg.select("mooring", F.posexplode("instruments").alias("position", "i")).select("mooring", "position", "i.*")
    return dep, ins.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in ("start_time", "end_time")})


def read_calibration_log(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Calibration logs to ``(file, var, pre, post, applied)``; absent offsets are null, absent flags false."""
    d = text_lines(spark, paths).select("file", F.lower(F.trim("value")).alias("line"))
    var = F.regexp_extract("line", r"^(conductivity|temperature|pressure)\b[^:]*:", 1)
    nums = F.regexp_extract("line", r":\s*(\S+)\s+(\S+)", 1), F.regexp_extract("line", r":\s*(\S+)\s+(\S+)", 2)
    flag = F.regexp_extract("line", r"^average (conductivity|temperature|pressure) applied\?\s*([yn])", 1)
    yes = F.regexp_extract("line", r"^average \w+ applied\?\s*([yn])", 1) == "y"
    d = d.select("file", F.nullif(F.when(var != "", var).otherwise(flag), F.lit("")).alias("var"), nums[0].try_cast("double").alias("a"),
                 nums[1].try_cast("double").alias("b"), F.when(flag != "", yes).alias("y")).where("var IS NOT NULL")
    return d.groupBy("file", "var").agg(F.max("a").alias("pre"), F.max("b").alias("post"), F.coalesce(F.max("y"), F.lit(False)).alias("applied"))


def load(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Records from several files or folders, read by suffix; an unknown suffix raises."""
    names = {"T": "temperature", "C": "conductivity", "P": "pressure"}
    groups: dict[str, list[str]] = {}
    for p in paths:
        suffix = p.rstrip("/").rsplit(".", 1)[-1].lower()
        kind = {"parquet": "parquet", "raw": "rodb", "use": "rodb", "microcat": "rodb", "cnv": "cnv"}.get(suffix)
        if kind is None:
            raise ValueError(f"unknown suffix of {p}")
        groups.setdefault(kind, []).append(p)
    parts = []
    if "parquet" in groups:
        parts.append(spark.read.parquet(*groups["parquet"]))
    if "rodb" in groups:
        parts.append(read_rodb(spark, groups["rodb"]).withColumnsRenamed(names))
    if "cnv" in groups:
        parts.append(read_cnv(spark, groups["cnv"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
