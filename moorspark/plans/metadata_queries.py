"""Queries of the renaming, metadata and catalogue operators."""

from pyspark.sql import functions as F

from moorspark.functions import text
from moorspark.operators import grid, meta
from moorspark.operators.series import sampling_interval
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import deploy, instr, obs, oracle, table, us

O3 = "temp cond pres"


def loaded(spark, sf):
    """Samples as a reader would give them, with derived and working variables."""
    d = obs(spark, sf)
    return d.withColumns({"density": 1000 + F.col("pres") / 100, "potential_temperature": F.col("temp") - 0.01,
                          "julian_days_offset": F.col("t_us") / 8.64e10, "timeS": F.col("t_us") / 1e6, "latitude": F.lit(26.5),
                          "longitude": F.lit(-76.7), "depth": F.col("pres")})


@query("b1_drop_derived", oracle("obs", f"SELECT event_id, serial, t_us, CAST(t_us / 1e6 AS DOUBLE) AS \"timeS\", {q6(*O3.split())} FROM obs"))
def _(spark, sf):
    d = meta.drop_derived(loaded(spark, sf), "sbe-cnv").drop("mooring", "time", "kind")
    return rounded(d, " ".join(c for c in d.columns if c not in O3.split()), O3)


@query("b2_drop_working", oracle("obs", f"SELECT event_id, serial, t_us, CAST(26.5 AS DOUBLE) AS latitude, CAST(-76.7 AS DOUBLE) AS longitude, {q6('depth', *O3.split())} FROM (SELECT *, pres AS depth FROM obs)"))
def _(spark, sf):
    d = meta.drop_working(loaded(spark, sf), meta.WORKING_STEP1).drop("mooring", "time", "kind")
    o = ["depth", *O3.split()]
    return rounded(d, " ".join(c for c in d.columns if c not in o), " ".join(o))


@query("b3_rename", oracle("obs", """SELECT event_id, round(temp, 6) + 0.0 AS "TEMP", round(cond, 6) + 0.0 AS "CNDC", round(pres, 6) + 0.0 AS "PRES" FROM obs"""))
def _(spark, sf):
    d = obs(spark, sf).withColumnsRenamed({"temp": "T", "cond": "C", "pres": "P"}).withColumn("YY", F.year("time")).withColumn("HH", F.hour("time"))
    d = meta.rename(d)
    return d.select("event_id", *[(F.round(c, 6) + 0.0).alias(c) for c in ("TEMP", "CNDC", "PRES")] + [c for c in d.columns if c in ("YY", "HH")])


@query("b4_deployment_attributes", oracle("instr deploy", """SELECT serial, CAST(0.0 AS DOUBLE) AS longitude, '00 00.000 N' AS seabed_latitude, strftime(deployment_time, '%Y-%m-%dT%H:%M:%S') AS deployment_time,
 coalesce(strftime(recovery_time, '%Y-%m-%dT%H:%M:%S'), 'YYYY-mm-ddTHH:MM:ss') AS recovery_time FROM instr i JOIN deploy d ON d.mooring = i.mooring"""))
def _(spark, sf):
    d = meta.with_deployment(instr(spark, sf), deploy(spark, sf))
    return d.select("serial", "longitude", "seabed_latitude", "deployment_time", "recovery_time")


@query("b5_instrument_metadata", oracle("instr obs deploy", """SELECT event_id, o.serial AS serial_number, coalesce(CASE WHEN o.serial % 3 <> 0 THEN depth END, 0) AS instr_depth, coalesce(CASE WHEN o.serial % 4 <> 0 THEN instrument END, 'Unknown') AS instrument,
 coalesce(CASE WHEN o.serial % 5 <> 0 THEN clock_offset END, 0) AS clock_offset, epoch_us(deployment_time) AS start_us FROM obs o JOIN deploy d ON d.mooring = o.mooring LEFT JOIN instr i ON i.serial = o.serial AND i.mooring = o.mooring"""))
def _(spark, sf):
    s = F.col("serial")
    i = instr(spark, sf).withColumns({"depth": F.when(s % 3 != 0, F.col("depth")), "instrument": F.when(s % 4 != 0, F.col("instrument")),
                                                      "clock_offset": F.when(s % 5 != 0, F.col("clock_offset"))})
    d = meta.with_instrument(obs(spark, sf).join(deploy(spark, sf), "mooring"), i)
    return d.select("event_id", "serial_number", "instr_depth", "instrument", "clock_offset", us("start_time").alias("start_us"))


def described(spark, sf):
    """Instruments with some metadata missing in the dataset, some in the configuration, and their file path."""
    s = F.col("serial")
    name = F.concat(F.lit("m"), F.col("mooring").cast("string"), F.lit("_2024"))
    tail = F.when(s % 6 == 5, "x").otherwise("")
    return instr(spark, sf).select(
        "serial", name.alias("mooring_name"), F.concat(F.lit("proc/"), "instrument", F.lit("/"), name, F.lit("_"), s.cast("string"), tail, F.lit("_raw.nc")).alias("path"),
        F.when(s % 2 == 0, F.col("instrument")).alias("instrument"), F.when(s % 3 != 0, F.lit("cfg")).alias("cfg_instrument"),
        F.when(s % 4 == 0, s).alias("serial_number"), F.when(s % 5 != 0, s + 1000).alias("cfg_serial"), F.when(s % 2 == 1, F.col("depth")).alias("instr_depth"),
        F.when(s % 3 == 1, F.lit(7.0)).alias("cfg_depth"), F.when(s % 7 == 0, F.lit("earlier")).alias("history"))


@query("b6_fill_metadata", oracle("instr", """SELECT serial, coalesce(CASE WHEN serial % 2 = 0 THEN instrument END, CASE WHEN serial % 3 <> 0 THEN 'cfg' END, instrument) AS instrument,
 coalesce(CASE WHEN serial % 4 = 0 THEN serial END, CASE WHEN serial % 5 <> 0 THEN serial + 1000 END, CASE WHEN serial % 6 <> 5 THEN serial END) AS serial_number,
 coalesce(CASE WHEN serial % 2 = 1 THEN depth END, CASE WHEN serial % 3 = 1 THEN 7.0 END, 0) AS instr_depth,
 CASE WHEN serial % 3 = 0 OR serial % 5 = 0 AND serial % 6 <> 5 THEN CASE WHEN serial % 7 = 0 THEN 'earlier; ' ELSE '' END || 'instrument details read from the file name'
 WHEN serial % 7 = 0 THEN 'earlier' END AS history FROM instr"""))
def _(spark, sf):
    d = meta.fill_metadata(described(spark, sf))
    return d.select("serial", "instrument", "serial_number", "instr_depth", "history")


@query("b7_path_metadata", oracle("instr", "SELECT serial, instrument AS path_instrument, CASE WHEN serial % 6 <> 5 THEN serial END AS path_serial FROM instr"))
def _(spark, sf):
    i, s = text.path_metadata(F.col("path"), F.col("mooring_name"))
    return described(spark, sf).select("serial", i.alias("path_instrument"), s.alias("path_serial"))


@query("b8_output_names", oracle("instr", """SELECT serial, CASE WHEN serial % 2 = 0 THEN CASE serial % 3 WHEN 0 THEN '_000' WHEN 1 THEN '_001' ELSE '' END ELSE '' END AS tag,
 mooring || '_' || serial || CASE WHEN serial % 2 = 0 THEN CASE serial % 3 WHEN 0 THEN '_000' WHEN 1 THEN '_001' ELSE '' END ELSE '' END || '_raw' AS stage1, mooring || '_mooring_use_lowpass' AS step1 FROM instr"""))
def _(spark, sf):
    s = F.col("serial")
    ft = F.when(s % 2 == 0, "adcp-matlab").otherwise("sbe-cnv")
    src = F.concat(F.lit("data"), F.when(s % 3 == 0, "_000").when(s % 3 == 1, "_001").otherwise("_9"), F.lit(".mat"))
    d = instr(spark, sf)
    return d.select("serial", F.when(ft == "adcp-matlab", text.file_tag(src)).otherwise("").alias("tag"),
                    text.stage_name(F.col("mooring"), s, ft, src).alias("stage1"), text.mooring_name(F.col("mooring"), "_use", "lowpass").alias("step1"))


#: Fixed values, restated for the checking engine.
VOCABULARY = """('TEMP', 'standard_name', 'sea_water_temperature'), ('TEMP', 'units', 'degree_Celsius'), ('TEMP', 'valid_min', '-5'), ('TEMP', 'valid_max', '42'),
 ('PRES', 'standard_name', 'sea_water_pressure'), ('PRES', 'units', 'dbar'), ('PRES', 'valid_min', '0'), ('PRES', 'valid_max', '11000'),
 ('CNDC', 'standard_name', 'sea_water_conductivity'), ('CNDC', 'units', 'mS cm-1'), ('CNDC', 'valid_min', '0'), ('CNDC', 'valid_max', '80')"""


@query("b9_vocabulary", oracle("obs", """SELECT serial, var, key, value FROM (SELECT DISTINCT serial, CASE kind WHEN 'view' THEN 'TEMP' WHEN 'click' THEN 'PRES' WHEN 'error' THEN 'CNDC' ELSE kind END AS var FROM obs)
 JOIN (VALUES """ + VOCABULARY + ") t(v, key, value) ON v = var"))
def _(spark, sf):
    k = F.col("kind")
    v = obs(spark, sf).select("serial", F.when(k == "view", "TEMP").when(k == "click", "PRES").when(k == "error", "CNDC").otherwise(k).alias("var")).distinct()
    return meta.with_vocabulary(v).select("serial", "var", "key", "value")


def headers(spark, sf):
    s, m = F.col("serial"), F.col("mooring")
    return instr(spark, sf).select(
        s.alias("dataset_id"), F.when(m == 0, "solo").otherwise(F.concat(F.lit("mr"), m.cast("string"), F.lit("_9_2024"))).alias("mooring_name"), "serial",
        (20.0 + m).alias("lat"), (-70.0 - m).alias("lon"), "depth", F.lit("2024/01/02T00:00:00Z").alias("start"), F.lit("2024/01/29T00:00:00Z").alias("end"),
        F.concat(F.lit("r"), F.when(s % 4 == 0, ".raw").when(s % 4 == 1, ".microcat").otherwise(".dat")).alias("source_file"),
        F.when(s % 3 == 0, "Delayed mode").when(s % 3 == 1, "real-time feed").alias("history"))


MODE = "CASE WHEN serial % 4 = 0 THEN 'P' WHEN serial % 4 = 1 THEN 'D' WHEN serial % 3 = 0 THEN 'D' WHEN serial % 3 = 1 THEN 'R' ELSE 'P' END"


@query("b10_dataset_attributes", oracle("instr obs", f"""SELECT serial AS dataset_id, 'Time series from ' || nm || ', instrument ' || serial AS title, '2024-01-02T00:00:00Z' AS time_coverage_start, CASE WHEN mooring = 0 THEN 'solo' ELSE 'mr' || mooring END AS platform_code,
 CASE WHEN mooring = 0 THEN 'unknown' ELSE '9_2024' END AS deployment_code, 'OS_' || CASE WHEN mooring = 0 THEN 'solo_unknown' ELSE 'mr' || mooring || '_9_2024' END || '_' || serial || '_' || {MODE} AS id, {MODE} AS data_mode,
 CASE WHEN dt >= 86400 THEN 'P' || CAST(floor(dt / 86400) AS BIGINT) || 'D' WHEN dt >= 3600 THEN 'PT' || CAST(floor(dt / 3600) AS BIGINT) || 'H' END AS time_coverage_resolution, depth AS geospatial_vertical_min, 'PROJ' AS project
 FROM (SELECT *, CASE WHEN mooring = 0 THEN 'solo' ELSE 'mr' || mooring || '_9_2024' END AS nm FROM instr) i LEFT JOIN (SELECT serial AS s, round_even(quantile_cont(d, 0.5), 0) AS dt FROM (SELECT serial,
 (t_us - lag(t_us) OVER (PARTITION BY serial ORDER BY t_us)) // 1000000 AS d FROM obs) WHERE d > 0 GROUP BY 1) ON s = serial"""))
def _(spark, sf):
    dt = sampling_interval(obs(spark, sf), ["serial"]).withColumnRenamed("serial", "dataset_id")
    d = meta.dataset_attributes(headers(spark, sf), dt, {"project": "PROJ"})
    return d.select("dataset_id", "title", "time_coverage_start", "platform_code", "deployment_code", "id", "data_mode", "time_coverage_resolution", "geospatial_vertical_min", "project")


@query("b11_data_mode", oracle("instr", f"SELECT serial, {MODE} AS data_mode FROM instr"))
def _(spark, sf):
    return headers(spark, sf).select("serial", text.data_mode(F.col("source_file"), F.col("history")).alias("data_mode"))


@query("b13_sensor_rows", oracle("instr", """SELECT serial AS dataset_id, 'SENSOR_CTD_' || serial AS sensor, CASE WHEN instrument = 'sbe56' THEN 'TOOL0022' ELSE 'TOOL0018' END AS template,
 CASE WHEN instrument = 'sbe56' THEN 'SBE 37 MicroCat IM-CT' ELSE 'SBE 37 MicroCat SMP-CT' END AS sensor_model, CAST(serial AS VARCHAR) AS sensor_serial_number, '2024/01/02T00:00:00Z' AS sensor_data_start_date FROM instr"""))
def _(spark, sf):
    a = instr(spark, sf).select(F.col("serial").alias("dataset_id"), F.lit(1).alias("ord"), F.when(F.col("instrument") == "sbe56", "SDN:L22::TOOL0022").otherwise("other").alias("value"))
    d = meta.sensor_rows(headers(spark, sf), a)
    return d.select("dataset_id", "sensor", "template", "sensor_model", "sensor_serial_number", "sensor_data_start_date")


@query("b14_position_decimal", oracle("obs", f"""SELECT event_id, {q6('lat', 'lon')} FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END * (event_id % 90 + CAST(event_id % 60 AS DOUBLE) / 60) AS lat,
 CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END * (event_id % 180 + CAST(event_id % 60 AS DOUBLE) / 60) AS lon FROM obs)"""))
def _(spark, sf):
    e = F.col("event_id")
    lat = F.format_string("%02d %02d.000 %s", e % 90, e % 60, F.when(e % 2 == 0, "N").otherwise("S"))
    lon = F.format_string("%03d %02d.000 %s", e % 180, e % 60, F.when(e % 3 == 0, "w").otherwise("E"))
    return rounded(obs(spark, sf).select("event_id", text.degrees(lat).alias("lat"), text.degrees(lon).alias("lon")), "event_id", "lat lon")


@query("b15_position_text", oracle("obs", """SELECT event_id, printf('%02d', CAST(floor(abs(v)) AS INT)) || ' ' || printf('%06.3f', (abs(v) - floor(abs(v))) * 60) || CASE WHEN v >= 0 THEN ' N' ELSE ' S' END AS lat,
 printf('%03d', CAST(floor(abs(2 * v)) AS INT)) || ' ' || printf('%06.3f', (abs(2 * v) - floor(abs(2 * v))) * 60) || CASE WHEN v >= 0 THEN ' E' ELSE ' W' END AS lon FROM (SELECT event_id, CAST(event_id % 640 - 320 AS DOUBLE) / 4 AS v FROM obs)"""))
def _(spark, sf):
    v = (F.col("event_id") % 640 - 320).cast("double") / 4
    return obs(spark, sf).select("event_id", text.degree_text(v, "lat").alias("lat"), text.degree_text(v * 2, "lon").alias("lon"))


@query("b16_iso_duration", oracle("obs", """SELECT event_id, CASE WHEN s >= 86400 THEN 'P' || s // 86400 || 'D' WHEN s >= 3600 THEN 'PT' || s // 3600 || 'H' WHEN s >= 60 THEN 'PT' || s // 60 || 'M' ELSE 'PT' || s || 'S' END AS duration
 FROM (SELECT event_id, CAST(round_even(temp * temp * temp * 10, 0) AS BIGINT) AS s FROM obs)"""))
def _(spark, sf):
    t = F.col("temp")
    return obs(spark, sf).select("event_id", text.iso_duration(t * t * t * 10).alias("duration"))


@query("b17_utc_text", oracle("obs", "SELECT event_id, event_id % 5 IN (0, 1) AS valid FROM obs"))
def _(spark, sf):
    e, t = F.col("event_id") % 5, F.col("time").cast("timestamp")
    s = (F.when(e == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(e == 1, F.date_format(t, "yyyy/MM/dd'T'HH:mm:ss'Z'"))
         .when(e == 2, F.date_format(t, "yyyy-MM-dd HH:mm:ss")).when(e == 3, F.date_format(t, "yyyy-13-dd'T'HH:mm:ss'Z'")))
    return obs(spark, sf).select("event_id", text.is_utc_text(s).alias("valid"))


def attributes(spark, sf):
    """Attribute rows of the records, from the event properties."""
    return table(spark, sf, "events").select(
        (F.col("user_id") % 5).alias("mooring"), F.col("user_id").alias("dataset_id"), F.lit("global").alias("scope"), F.lit("").alias("var"),
        F.col("event_type").alias("key"), F.get_json_object("props", "$.k").alias("value"), F.col("event_id").alias("ord"))


@query("b18_union_attributes", """SELECT user_id % 5 AS mooring, event_type AS key, arg_max(json_extract_string(props, '$.k'), event_id) AS value, arg_min(json_extract_string(props, '$.k'), event_id) AS first_value FROM events GROUP BY 1, 2""")
def _(spark, sf):
    a = attributes(spark, sf)
    last = meta.union_attributes(a, ["mooring"]).select("mooring", "key", "value")
    first = meta.union_attributes(a, ["mooring"], "first").select("mooring", "key", F.col("value").alias("first_value"))
    return last.join(first, ["mooring", "key"])


@query("b19_common_attributes", """WITH a AS (SELECT c_nationkey AS g, c_custkey AS d, 'nation' AS key, CAST(c_nationkey AS VARCHAR) AS value FROM customer UNION ALL SELECT c_nationkey, c_custkey, 'segment', c_mktsegment FROM customer
 UNION ALL SELECT c_nationkey, c_custkey, 'positive', 'yes' FROM customer WHERE c_acctbal > 0) SELECT CAST(g AS BIGINT) AS g, key, min(value) AS value FROM a JOIN (SELECT c_nationkey AS n, count(*) AS c FROM customer GROUP BY 1) ON n = g GROUP BY g, key, c
 HAVING count(*) = c AND count(DISTINCT value) = 1""")
def _(spark, sf):
    c = table(spark, sf, "customer")
    kv = F.array_compact(F.array(
        F.struct(F.lit("nation").alias("key"), F.col("c_nationkey").cast("string").alias("value")), F.struct(F.lit("segment").alias("key"), F.col("c_mktsegment").alias("value")),
        F.when(F.col("c_acctbal") > 0, F.struct(F.lit("positive").alias("key"), F.lit("yes").alias("value")))))
    a = c.select(F.col("c_nationkey").cast("long").alias("g"), F.col("c_custkey").alias("dataset_id"), F.explode(kv).alias("kv")).select("g", "dataset_id", "kv.key", "kv.value")
    return meta.common_attributes(a, ["g"])


def catalogue(spark, sf):
    """Variables of one dataset per part, in five shapes."""

    def var(pos, name, dims, dtype):
        return F.struct(F.lit(pos).alias("pos"), F.lit(name).alias("var"), F.array(*[F.lit(d) for d in dims]).alias("dims"), F.lit(dtype).alias("dtype"))

    p = F.col("p_size") % 5
    v = (F.when(p == 0, F.array(var(0, "TEMP", ["TIME", "PRES"], "float64"), var(1, "TIME", ["TIME"], "datetime64[ns]"), var(2, "PRES", ["TIME", "PRES"], "float64")))
         .when(p == 1, F.array(var(0, "depth", ["z"], "float64"), var(1, "time", ["time"], "datetime64[ns]")))
         .when(p == 2, F.array(var(0, "DEPTH", ["d"], "float64"), var(1, "obs_time", ["obs"], "datetime64[ns]"), var(2, "pressure", ["obs"], "float64")))
         .when(p == 3, F.array(var(0, "CNDC", ["string3", "x"], "float64"))).otherwise(
             F.array(var(0, "date", ["t"], "object"), var(1, "TEMP", ["t"], "float64"), var(2, "PRES_INTERPOLATED", ["p"], "float64"))))
    return table(spark, sf, "part").select(F.col("p_partkey").cast("long").alias("dataset_id"), F.explode(v).alias("v")).select("dataset_id", "v.*")


@query("b20_resolve_names", """SELECT CAST(p_partkey AS BIGINT) AS dataset_id, CASE p_size % 5 WHEN 0 THEN 'TIME' WHEN 1 THEN 'time' WHEN 2 THEN 'obs_time' WHEN 4 THEN 'date' END AS time_key,
 CASE p_size % 5 WHEN 0 THEN 'PRES' WHEN 1 THEN 'depth' WHEN 2 THEN 'pressure' WHEN 4 THEN 'PRES_INTERPOLATED' END AS pres_key, CASE p_size % 5 WHEN 0 THEN 'TIME' WHEN 1 THEN 'time' WHEN 2 THEN 'obs' WHEN 4 THEN 't' END AS time_dim,
 CASE p_size % 5 WHEN 0 THEN 'PRES' WHEN 1 THEN 'z' WHEN 2 THEN 'obs' WHEN 4 THEN 'p' END AS pres_dim FROM part""")
def _(spark, sf):
    return meta.resolve_names(catalogue(spark, sf))


@query("b21_missing_variables", """SELECT CAST(p_partkey AS BIGINT) AS dataset_id, CASE p_size % 5 WHEN 0 THEN 'CNDC' WHEN 1 THEN 'TEMP, PRES, CNDC' WHEN 2 THEN 'TEMP, PRES, CNDC' WHEN 3 THEN 'TEMP, PRES' ELSE 'PRES, CNDC' END AS missing FROM part""")
def _(spark, sf):
    return meta.missing_variables(catalogue(spark, sf), ["TEMP", "PRES", "CNDC"])


@query("b22_variable_inventory", """WITH v(k, name, dims, dtype, units, position) AS (VALUES (0, 'TEMP', 'string', 'float64', 'degree_Celsius', 3), (0, 'TIME', 'TIME', 'datetime64[ns]', '', 1), (0, 'PRES', 'string', 'float64', 'dbar', 2),
 (1, 'depth', 'z', 'float64', '', 2), (1, 'time', 'time', 'datetime64[ns]', '', 1), (2, 'DEPTH', 'd', 'float64', '', 1), (2, 'obs_time', 'obs', 'datetime64[ns]', '', 2), (2, 'pressure', 'obs', 'float64', '', 3),
 (3, 'CNDC', 'string', 'float64', '', 1), (4, 'date', 't', 'object', '', 3), (4, 'TEMP', 't', 'float64', 'degree_Celsius', 2), (4, 'PRES_INTERPOLATED', 'p', 'float64', '', 1))
 SELECT CAST(p_partkey AS BIGINT) AS dataset_id, dims, name, units, CASE WHEN name = 'TEMP' THEN 'sea_water_temperature' ELSE '' END AS standard_name, dtype, position FROM part JOIN v ON k = p_size % 5""")
def _(spark, sf):
    v = catalogue(spark, sf)
    n = F.col("var")
    kv = F.when(n == "TEMP", F.array(F.struct(F.lit("units").alias("key"), F.lit("degree_Celsius").alias("value")), F.struct(F.lit("standard_name").alias("key"), F.lit("sea_water_temperature").alias("value")))).when(
        n == "PRES", F.array(F.struct(F.lit("units").alias("key"), F.lit("dbar").alias("value"))))
    a = v.select("dataset_id", "var", F.explode(kv).alias("kv")).select("dataset_id", "var", "kv.*")
    return meta.variable_inventory(v, a).drop("comment")


@query("b22_attribute_inventory", """SELECT event_id AS dataset_id, event_type AS attribute, json_extract_string(props, '$.k') AS value, 'int' AS type FROM events""")
def _(spark, sf):
    a = attributes(spark, sf).withColumn("dataset_id", F.col("ord"))
    return meta.attribute_inventory(a)


@query("b23_instrument_codes", oracle("instr", """SELECT serial, row_number() OVER (PARTITION BY mooring ORDER BY fl) AS instrument_code, names AS instrument_names FROM (SELECT mooring, instrument, min(level) AS fl FROM lv GROUP BY 1, 2) f
 JOIN (SELECT mooring AS m, string_agg(instrument, ', ' ORDER BY fl) AS names FROM (SELECT mooring, instrument, min(level) AS fl FROM lv GROUP BY 1, 2) GROUP BY 1) ON m = mooring JOIN lv USING (mooring, instrument)""".replace(
    "row_number() OVER (PARTITION BY mooring ORDER BY fl)", "dense_rank() OVER (PARTITION BY mooring ORDER BY fl)"),
    "lv AS (SELECT *, row_number() OVER (PARTITION BY mooring ORDER BY position) AS level FROM instr)"))
def _(spark, sf):
    lv = grid.levels(instr(spark, sf))
    return meta.encode_instruments(lv, lv).select("serial", "instrument_code", "instrument_names")
