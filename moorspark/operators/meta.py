"""Renaming, metadata defaults, attributes and the variable catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moorspark.functions import text
from moorspark.operators.ordered import RECORD, attach

#: Derived variables and coordinates dropped by file type.
DERIVED = {
    "sbe-cnv": ("potential_temperature", "julian_days_offset", "density", "depth", "latitude", "longitude"),
    "sbe-asc": ("potential_temperature", "julian_days_offset", "density", "depth", "latitude", "longitude"),
}
#: Working variables dropped on the way.
WORKING_STAGE2 = ("timeS",)
WORKING_STEP1 = ("timeS", "density", "potential_temperature", "julian_days_offset")
#: Names of the text format and of the product.
RENAME = {"T": "TEMP", "C": "CNDC", "P": "PRES", "Latitude": "LATITUDE", "Longitude": "LONGITUDE"}
#: Defaults of the deployment attributes.
DEPLOYMENT_DEFAULTS = {
    "longitude": 0.0, "latitude": 0.0, "deployment_latitude": "00 00.000 N", "deployment_longitude": "000 00.000 W",
    "deployment_time": "YYYY-mm-ddTHH:MM:ss", "seabed_latitude": "00 00.000 N", "seabed_longitude": "000 00.000 W",
    "recovery_time": "YYYY-mm-ddTHH:MM:ss",
}
#: Vocabulary attributes of the core variables.
VOCABULARY = {
    "TEMP": {"standard_name": "sea_water_temperature", "units": "degree_Celsius", "valid_min": "-5", "valid_max": "42"},
    "PRES": {"standard_name": "sea_water_pressure", "units": "dbar", "valid_min": "0", "valid_max": "11000"},
    "CNDC": {"standard_name": "sea_water_conductivity", "units": "mS cm-1", "valid_min": "0", "valid_max": "80"},
    "LATITUDE": {"standard_name": "latitude", "units": "degrees_north", "valid_min": "-90.0", "valid_max": "90.0"},
    "LONGITUDE": {"standard_name": "longitude", "units": "degrees_east", "valid_min": "-180.0", "valid_max": "180.0"},
}
#: Sensor templates.
SENSORS = {
    "TOOL0017": ("SBE 37 MicroCat SM-CT", "Serial interface, optional pressure, internally powered"),
    "TOOL0018": ("SBE 37 MicroCat SMP-CT", "Serial interface + pump, optional pressure, internally powered"),
    "TOOL0019": ("SBE 37 MicroCat IMP-CT", "Inductive Modem + pump, optional pressure, internally powered"),
    "TOOL0022": ("SBE 37 MicroCat IM-CT", "Inductive Modem, optional pressure, internally powered"),
    "TOOL0634": ("SBE 37 MicroCat SMP-CT-IDO", "SMP-CT with membrane-type Integrated Dissolved Oxygen sensor"),
}
#: Candidate names of the coordinates, best first.
TIME_NAMES = ("TIME", "time", "Time", "DATETIME", "datetime", "date")
PRESSURE_NAMES = ("PRES_ADJUSTED", "PRESSURE", "pressure", "PRES", "PRES_INTERPOLATED",
                  "DEPTH_ADJUSTED", "DEPTH", "depth", "Depth", "DEPTH_INTERPOLATED")
#: Own wording of the history entry.
FALLBACK_NOTE = "instrument details read from the file name"


def drop_derived(df: DataFrame, file_type: str) -> DataFrame:
    """Drop what the file type derives; unknown types stay untouched."""
    return df.drop(*DERIVED.get(file_type, ()))


def drop_working(df: DataFrame, names: Sequence[str] = WORKING_STAGE2) -> DataFrame:
    return df.drop(*names)


def rename(df: DataFrame, names: dict[str, str] = RENAME) -> DataFrame:
    """Rename by map and drop the date columns of the text format."""
    return df.drop("YY", "MM", "DD", "HH").withColumnsRenamed(names)


def with_deployment(df: DataFrame, deploy: DataFrame) -> DataFrame:
    """Attach deployment attributes with defaults; missing text times get the placeholder."""
    have = [c for c in deploy.columns if c != "mooring"]
    d = attach(df, deploy.withColumnsRenamed({c: f"__{c}" for c in have}), ["mooring"])
    out = {}
    for name, default in DEPLOYMENT_DEFAULTS.items():
        if name in have:
            c = F.col(f"__{name}")
            if isinstance(default, str) and dict(deploy.dtypes)[name].startswith("timestamp"):
                c = F.date_format(c.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
            out[name] = F.coalesce(c, F.lit(default))
        else:
            out[name] = F.lit(default)
    out.update({n: F.col(f"__{n}") for n in have if n not in out})
    return d.withColumns(out).drop(*[f"__{c}" for c in have])


def with_instrument(df: DataFrame, instr: DataFrame, key: Sequence[str] = RECORD) -> DataFrame:
    """Attach instrument metadata with defaults; start and end fall back to the deployment's times."""
    d = df.join(instr.withColumnsRenamed({c: f"__{c}" for c in instr.columns if c not in key}), list(key), "left")

    def have(n: str) -> Column:
        return F.col(f"__{n}") if n in instr.columns else F.lit(None)

    out = {"serial_number": F.coalesce(F.col("serial"), F.lit(0)), "instr_depth": F.coalesce(have("depth"), F.lit(0.0)),
           "instrument": F.coalesce(have("instrument"), F.lit("Unknown")),
           "clock_offset": F.coalesce(have("clock_offset"), F.lit(0)),
           "start_time": F.coalesce(have("start_time"), F.col("deployment_time")),
           "end_time": F.coalesce(have("end_time"), F.col("recovery_time"))}
    return d.withColumns(out).drop(*[f"__{c}" for c in instr.columns if c not in key])


def fill_metadata(df: DataFrame, path: str = "path", mooring: str = "mooring_name") -> DataFrame:
    """Fill missing instrument and serial: dataset, then configuration (``cfg_``), then the path.

    A value taken from the path is noted in ``history``.
    """
    inst, serial = text.path_metadata(F.col(path), F.col(mooring))
    from_path = (F.col("cfg_instrument").isNull() & inst.isNotNull()) | (F.col("cfg_serial").isNull() & serial.isNotNull())
    note = F.when(from_path, F.lit(FALLBACK_NOTE))
    return df.withColumns({
        "instrument": F.coalesce("instrument", "cfg_instrument", inst),
        "serial_number": F.coalesce(F.col("serial_number"), F.col("cfg_serial"), serial),
        "instr_depth": F.coalesce("instr_depth", "cfg_depth", F.lit(0.0)),
        "history": F.when(F.col("history").isNull() & note.isNull(), F.lit(None)).otherwise(F.concat_ws("; ", "history", note))})


def vocabulary(spark) -> DataFrame:
    rows = [(v, k, x) for v, a in VOCABULARY.items() for k, x in a.items()]
    return spark.createDataFrame(rows, "var string, key string, value string")


def with_vocabulary(variables: DataFrame) -> DataFrame:
    """Vocabulary attributes of each known variable; unknown variables have none."""
    return variables.join(F.broadcast(vocabulary(variables.sparkSession)), "var")


def split_mooring(name: Column) -> tuple[Column, Column]:
    """(platform, deployment) at the first underscore; ``unknown`` without one."""
    p = F.split(name, "_", 2)
    return F.get(p, F.lit(0)), F.coalesce(F.get(p, F.lit(1)), F.lit("unknown"))


def dataset_attributes(meta: DataFrame, median_dt_s: DataFrame, project: dict[str, str] | None = None) -> DataFrame:
    """Attributes of each dataset from its header row ``(dataset_id, mooring_name, serial, lat, lon, depth,
    start, end, source_file, history)``; project values win where given."""
    project = project or {}
    plat, dep = split_mooring(F.col("mooring_name"))
    mode = F.lit(project["data_mode"]) if "data_mode" in project else text.data_mode(F.col("source_file"), F.col("history"))
    d = meta.join(median_dt_s, "dataset_id", "left")
    out = {
        "title": F.concat(F.lit("Time series from "), "mooring_name", F.lit(", instrument "), F.col("serial").cast("string")),
        "time_coverage_start": F.regexp_replace("start", "/", "-"), "time_coverage_end": F.regexp_replace("end", "/", "-"),
        "geospatial_lat_min": F.col("lat"), "geospatial_lat_max": F.col("lat"), "geospatial_lon_min": F.col("lon"),
        "geospatial_lon_max": F.col("lon"), "geospatial_vertical_min": F.col("depth"), "geospatial_vertical_max": F.col("depth"),
        "platform_code": plat, "deployment_code": dep, "data_mode": mode,
        "id": F.concat_ws("_", F.lit("OS"), plat, dep, F.col("serial").cast("string"), mode),
        "time_coverage_resolution": F.when(F.col("dt_s").isNotNull(), text.iso_duration(F.col("dt_s"))),
        "QC_indicator": F.lit("unknown"),
    }
    out.update({k: F.lit(v) for k, v in project.items() if k not in ("id", "data_mode")})
    return d.select("dataset_id", *[c.alias(n) for n, c in out.items()])


def sensor_rows(meta: DataFrame, attrs: DataFrame) -> DataFrame:
    """One sensor row per dataset from the template its attributes name (else the default template)."""
    spark = meta.sparkSession
    tpl = spark.createDataFrame([(k, *v) for k, v in SENSORS.items()], "template string, sensor_model string, comment string")
    code = F.regexp_extract("value", r"^SDN:L22::(TOOL.*)$", 1)
    named = attrs.where(code != "").groupBy("dataset_id").agg(F.min_by(code, "ord").alias("named"))
    known = list(SENSORS)
    t = F.when(F.col("named").isin(known), F.col("named")).otherwise("TOOL0018")
    d = meta.join(named, "dataset_id", "left").withColumn("template", t)
    # five fixed templates
    return d.join(F.broadcast(tpl), "template").select(
        "dataset_id", F.concat(F.lit("SENSOR_CTD_"), F.col("serial").cast("string")).alias("sensor"), "template", "sensor_model",
        F.lit("Sea-Bird").alias("sensor_manufacturer"), F.concat(F.lit("SDN:L22::"), "template").alias("sensor_SeaVoX_L22_code"),
        F.col("serial").cast("string").alias("sensor_serial_number"), F.col("start").alias("sensor_data_start_date"),
        F.col("end").alias("sensor_data_end_date"), "comment")


def union_attributes(attrs: DataFrame, group: Sequence[str], wins: str = "last") -> DataFrame:
    """One value per scope, variable and key over all datasets of a group."""
    f = F.max_by if wins == "last" else F.min_by
    return attrs.groupBy(*group, "scope", "var", "key").agg(f("value", "ord").alias("value"))


def common_attributes(attrs: DataFrame, group: Sequence[str]) -> DataFrame:
    """Attributes that every dataset of the group has, all with the same value."""
    n = attrs.select(*group, "dataset_id").distinct().groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    a = attrs.groupBy(*group, "key").agg(F.count(F.lit(1)).alias("__c"), F.min("value").alias("value"), F.max("value").alias("__z"))
    d = attach(a, n, group)
    return d.where((F.col("__c") == F.col("__n")) & (F.col("value") == F.col("__z"))).select(*group, "key", "value")


def _rank(names: Sequence[str]) -> Column:
    m = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    return F.try_element_at(m, F.col("var"))


def resolve_names(variables: DataFrame) -> DataFrame:
    """Time and pressure (else depth) variable of each dataset with their dimensions; null when unresolved.

    Without a known name the first datetime variable is the time.
    """
    me = F.struct("var", "dims")
    is_time = F.startswith("dtype", F.lit("datetime64"))
    a = variables.groupBy("dataset_id").agg(
        F.min_by(me, _rank(TIME_NAMES)).alias("t"), F.min_by(me, F.when(is_time, F.col("pos"))).alias("t2"),
        F.min_by(me, _rank(PRESSURE_NAMES)).alias("p"))
    t = F.coalesce("t", "t2")
    a = a.select("dataset_id", t.alias("t"), "p")
    tdim = F.get(F.col("t.dims"), F.lit(0))
    pdim = F.when(F.size("p.dims") > 1, F.get(F.filter("p.dims", lambda x: ~x.eqNullSafe(tdim)), F.lit(0))).otherwise(F.get("p.dims", F.lit(0)))
    return a.select("dataset_id", F.col("t.var").alias("time_key"), F.col("p.var").alias("pres_key"), tdim.alias("time_dim"), pdim.alias("pres_dim"))


def missing_variables(variables: DataFrame, required: Sequence[str]) -> DataFrame:
    """Datasets that lack required variables, with the missing names in the given order."""
    has = [F.max((F.col("var") == r).cast("int")).alias(f"__{i}") for i, r in enumerate(required)]
    a = variables.groupBy("dataset_id").agg(*has)
    lack = F.array_compact(F.array(*[F.when(F.col(f"__{i}") == 0, F.lit(r)) for i, r in enumerate(required)]))
    return a.select("dataset_id", F.array_join(lack, ", ").alias("missing")).where("missing <> ''")


def variable_inventory(variables: DataFrame, attrs: DataFrame) -> DataFrame:
    """Name, dimension (``string`` when not one-dimensional), units, comment, standard name and type."""
    keys = ("units", "comment", "standard_name")
    p = attrs.where(F.col("key").isin(*keys)).groupBy("dataset_id", "var").agg(
        *[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in keys])
    one = F.when(F.size("dims") == 1, F.get("dims", F.lit(0))).otherwise("string")
    one = F.when(F.startswith(one, F.lit("str")), "string").otherwise(one)
    w = Window.partitionBy("dataset_id").orderBy("dims", "name")
    d = variables.join(p, ["dataset_id", "var"], "left").select(
        "dataset_id", one.alias("dims"), F.col("var").alias("name"), *[F.coalesce(k, F.lit("")).alias(k) for k in keys], "dtype")
    return d.withColumn("position", F.row_number().over(w))


def attribute_inventory(attrs: DataFrame) -> DataFrame:
    """Attribute, value and the type its text can be read as."""
    v = F.col("value")
    t = F.when(v.try_cast("long").isNotNull(), "int").when(v.try_cast("double").isNotNull(), "float").otherwise("str")
    return attrs.select("dataset_id", F.col("key").alias("attribute"), "value", t.alias("type"))


def encode_instruments(df: DataFrame, level_table: DataFrame, group: str = "mooring") -> DataFrame:
    """Codes 1..k of the instrument names in order of first appearance, with the lists that explain them."""
    first = level_table.groupBy(group, "instrument").agg(F.min("level").alias("__f"))
    w = Window.partitionBy(group).orderBy("__f")
    codes = first.withColumn("instrument_code", F.row_number().over(w).cast("long"))
    # distinct instrument types of one mooring
    m = F.sort_array(F.collect_list(F.struct("__f", "instrument")))
    names = first.groupBy(group).agg(m.alias("__m"))
    names = names.select(
        group, F.array_join(F.transform("__m", lambda s: F.replace(s["instrument"], F.lit(" "), F.lit("_"))), " ").alias("instrument_meanings"),
        F.array_join(F.transform("__m", lambda s: s["instrument"]), ", ").alias("instrument_names"))
    return attach(attach(df, codes.drop("__f"), [group, "instrument"]), names, [group])
