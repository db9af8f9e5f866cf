from datetime import datetime

import pytest
from pyspark.sql import functions as F

from moorspark.functions.text import degrees
from moorspark.sources import rodb, sinks, text_sources

USE = """SerialNumber = 90017
Columns = HH:DD:MM:YY:P:T:O2:U
Latitude = 04 30.000 S
Mooring = harbour_test
Mooring = pier_3
Longitude = 012 15.000 E
Start_Time = 06:30
Start_Date = 2031/11/09
  6.50028  9 11 2031  12.5  18.2500  210.75  -0.1250
  7.00028  9 11 2031  12.7  -9999.0  211.00  -999.0

 23.75028 30 11 2031  13.1  17.5000  -9999.0   0.5000
"""
INFO = """Columns = RCMC1:serialnumber:depth
Mooring = pier_3
  -999   41   7
    15   42   9
"""
CNV = """* a preamble of our own
# name 0 = timeJ: day of the year
# name 1 = sbeox0ML/L: oxygen
# name 2 = c0S/m: conductivity in siemens
# name 3 = t090C: temperature
# name 4 = prDM: pressure
# name 5 = nbin: scans per bin
# bad_flag = -7.5e+10
# start_time = Mar 02 2033 01:02:03
*END*
"""
YAML = """name: pier_3
waterdepth: 48
latitude: -4.5
recovery_time: '2031-12-24T05:06:07'
deployment_time: '2031-11-09T06:30:00'
instruments:
- instrument: logger
  serial: 42
- depth: 7.5
  clock_offset: -45
  serial: 41
  instrument: thermistor
"""
LOG = """Operator: someone
Pressure [dbar]: 0.7500 1.2500
Average pressure applied? n
Conductivity [mS/cm] : -0.0040 0.0090
Average conductivity applied? Y
General pressure trend applied? y
Average temperature applied? N
"""


def put(tmp_path, name, body):
    p = tmp_path / name
    p.write_text(body)
    return str(p)


def test_record_text(spark, tmp_path):
    f = put(tmp_path, "a.use", USE)
    d = rodb.read_rodb(spark, f)
    assert set(d.columns) == {"file", "time", "t_us", "P", "T", "O2", "U"}
    got = d.orderBy("t_us").collect()
    assert [r.time for r in got] == [datetime(2031, 11, 9, 6, 30), datetime(2031, 11, 9, 7), datetime(2031, 11, 30, 23, 45)]
    assert [(r.P, r["T"], r.O2, r.U) for r in got] == [(12.5, 18.25, 210.75, -0.125), (12.7, None, 211.0, -999.0), (13.1, 17.5, None, 0.5)]
    h = rodb.read_header(spark, f).collect()[0]
    assert h.header["MOORING"] == "pier_3" and h.start_time == datetime(2031, 11, 9, 6, 30)
    assert (h.latitude, h.longitude) == (-4.5, 12.25)


def test_info_table_and_missing_time(spark, tmp_path):
    f = put(tmp_path, "info.dat", INFO)
    got = rodb.read_table(spark, f, ["depth", "serialnumber", "RCMC1"]).orderBy("depth").collect()
    assert [(r.depth, r.serialnumber, r.RCMC1) for r in got] == [(7.0, 41.0, None), (9.0, 42.0, 15.0)]
    assert rodb.read_rodb(spark, f, ["depth"]).where("time IS NOT NULL").count() == 0


def test_header_positions(spark):
    r = spark.range(1).select(degrees(F.lit("12 30 S")).alias("a"), degrees(F.lit("45 15 W")).alias("b")).collect()[0]
    assert (r.a, r.b) == (-12.5, -45.25)


def test_text_round_trip_in_pieces(spark, tmp_path):
    base = datetime(2020, 1, 1)
    rows = [(f, 60_000_000 * 30 * i, 10 + i / 1000, 35 + i / 100) for f, n in (("big", 500), ("small", 3)) for i in range(n)]
    t0 = int((base - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    d = spark.createDataFrame(rows, "file string, o long, T double, C double").withColumn("time", F.timestamp_micros(F.col("o") + t0).cast("timestamp_ntz"))
    h = spark.createDataFrame([("big", "m_1", 5.5), ("small", "m_2", -6.25)], "file string, Mooring string, Latitude double")
    p = str(tmp_path / "out.use")
    rodb.write_rodb(d, h, p, ["T", "C"])
    got = rodb.read_rodb(spark, p, ["T", "C"])
    a = sorted((r.file, r.time, r.T, r.C) for r in got.collect())
    b = sorted((r.file, r.time, round(r.T, 4), round(r.C, 4)) for r in d.collect())
    assert a == b
    assert {(r.file, r.header["MOORING"], r.latitude) for r in rodb.read_header(spark, p).collect()} == {("big", "m_1", 5.5), ("small", "m_2", -6.25)}


def test_ctd_text(spark, tmp_path):
    body = CNV + "".join(f" {61 + i / 96:.6f}  {5 + i / 50:.3f} 4.29140 {15 - i / 10:.2f} {3 * i}.5 {i}\n" for i in range(40)) + " 62.0 -7.5e+10 4.0 -7.5e+10 1 2\n"
    got = text_sources.read_cnv(spark, put(tmp_path, "x.cnv", body))
    assert set(got.columns) == {"file", "time", "t_us", "temperature", "conductivity", "pressure", "salinity", "sbeox0ML_L", "nbin"}
    rows = got.orderBy("t_us", "pressure").collect()
    assert len(rows) == 41 and rows[0].time == datetime(2033, 3, 2) and rows[0].conductivity == pytest.approx(42.914)
    assert sum(r.temperature is None and r.sbeox0ML_L is None for r in rows) == 1 and {r.salinity for r in rows} == {None}
    from moorspark.functions.seawater import practical_salinity

    s = got.limit(1).select(practical_salinity(F.lit(42.914), F.lit(15.0 * 1.0), F.lit(0.0)).alias("s")).collect()[0].s
    assert s == pytest.approx(35, abs=0.01)


def test_both_conductivity_units_in_one_call(spark, tmp_path):
    a = put(tmp_path, "a.cnv", CNV + "61.5 1 4.0 2 3 4\n")
    b = put(tmp_path, "b.cnv", CNV.replace("c0S/m", "c0mS/cm") + "61.5 1 40.5 2 3 4\n")
    assert sorted(r.conductivity for r in text_sources.read_cnv(spark, [a, b]).collect()) == [40.0, 40.5]


def test_delimited_and_its_quarantine(spark, tmp_path):
    f = put(tmp_path, "r.dat", "% logger 9\n17.25|04 Jul 2032|23-59\nx|05 Jul 2032|00-09\n18|later|00-19\n\nnothing\n")
    args = {"0": "temperature"}, ["1", "2"], "dd MMM yyyy HH-mm", "[|]", "^%"
    got = text_sources.read_delimited(spark, f, *args).orderBy("time").collect()
    assert [(r.time, r.temperature) for r in got] == [(datetime(2032, 7, 4, 23, 59), 17.25), (datetime(2032, 7, 5, 0, 9), None)]
    assert sorted(r.line for r in text_sources.unreadable_lines(spark, f, *args).collect()) == ["18|later|00-19", "nothing"]


def test_config(spark, tmp_path):
    dep, ins = text_sources.read_config(spark, put(tmp_path, "m.yaml", YAML))
    d = dep.collect()[0]
    assert (d.mooring, d.waterdepth, d.latitude, d.longitude) == ("pier_3", 48.0, -4.5, None) and d.recovery_time == datetime(2031, 12, 24, 5, 6, 7)
    i = ins.orderBy("position").collect()
    assert [(r.position, r.serial, r.clock_offset, r.depth) for r in i] == [(0, 42, None, None), (1, 41, -45, 7.5)]


def test_calibration_log(spark, tmp_path):
    got = {r["var"]: (r.pre, r.post, r.applied) for r in text_sources.read_calibration_log(spark, put(tmp_path, "c.txt", LOG)).collect()}
    assert got == {"conductivity": (-0.004, 0.009, True), "temperature": (None, None, False), "pressure": (0.75, 1.25, False)}


def test_load_by_suffix(spark, tmp_path):
    a, b = put(tmp_path, "a.use", USE), put(tmp_path, "b.cnv", CNV + "61.5 1 4.0 2 3 4\n")
    got = text_sources.load(spark, [a, b])
    assert got.count() == 4 and {"temperature", "salinity", "U", "O2", "nbin"} <= set(got.columns)
    assert got.where("U IS NOT NULL").count() == 3 and got.where("conductivity = 40").count() == 1
    with pytest.raises(ValueError, match="unknown suffix"):
        text_sources.load(spark, [a, "x.nc"])


def test_stage_sink(spark, tmp_path):
    p = str(tmp_path / "stage")
    d = spark.createDataFrame([(m, s, datetime(2020, 1, 1 + i), float(i), 7) for m in (1, 2) for s in (5, 6) for i in range(3)], "mooring long, serial long, time timestamp_ntz, temperature double, status long")
    sinks.write_stage(d, p)
    sinks.write_stage(d.where("mooring = 1"), p)
    got = spark.read.parquet(p)
    assert got.count() == 12 and dict(got.dtypes)["temperature"] == "float" and dict(got.dtypes)["status"] == "smallint"
    for _ in range(2):
        sinks.write_stage(d.where("mooring = 1").limit(1), p, "replace")
        assert spark.read.parquet(p).count() == 12 - 3 + 1
    with pytest.raises(ValueError):
        sinks.write_stage(d, p, "append")


def test_product_sink(spark, tmp_path):
    d = spark.createDataFrame([("OS_a", 1, None)], "id string, v long, comment string")
    sinks.write_products(d, str(tmp_path / "p"), text_columns=["comment"])
    assert spark.read.parquet(str(tmp_path / "p" / "id=OS_a")).collect()[0].comment == ""
    with pytest.raises(Exception, match="product without id"):
        sinks.write_products(spark.createDataFrame([(None, 1)], "id string, v long"), str(tmp_path / "q"))


def test_columns_that_clean_to_one_name_are_numbered():
    names = text_sources._columns(["AB/C", "ab-c", "ab_c_2", "pressure", "time", "??"], ["file", "time", "t_us", "pressure"])
    assert names == {"AB/C": "AB_C", "ab-c": "ab_c_2", "ab_c_2": "ab_c_2_2", "pressure": "pressure_2", "time": "time_2", "??": "column"}


def test_calibration_logs_in_a_bundle_give_what_their_files_give(spark, tmp_path):
    logs = {"a": LOG, "b": LOG.replace("0.7500", "-3.5"), "c d": "Temperature [C]: 0.1 0.2\n"}
    for name, body in logs.items():
        (tmp_path / "plain" / f"file={name}").mkdir(parents=True)
        put(tmp_path / "plain" / f"file={name}", "log.txt", body)
    p = str(tmp_path / "bundle")
    rodb.write_lines(spark.createDataFrame(list(logs.items()), "file string, value string").coalesce(1), p)
    got = [sorted(tuple(r) for r in text_sources.read_calibration_log(spark, x).collect()) for x in (p, str(tmp_path / "plain" / "file=a"))]
    assert [r for r in got[0] if r[0] == "a"] == got[1]
    assert {r[0] for r in got[0]} == set(logs) and ("c d", "temperature", 0.1, 0.2, False) in got[0]
    # files grow with the text, not with the records
    assert len(list((tmp_path / "bundle").glob("part-*"))) == 1


def test_many_products_share_files(spark, tmp_path):
    p = str(tmp_path / "p")
    d = spark.range(600).select(F.concat(F.lit("OS_"), (F.col("id") % 300).cast("string")).alias("id"), F.col("id").alias("v"), F.lit(None).cast("string").alias("comment"))
    sinks.write_products(d, p, text_columns=["comment"], folders=False)
    assert len(list((tmp_path / "p").glob("*/part-*"))) <= sinks.BUCKETS + 4
    sinks.write_products(d.where("v = 7 OR v = 1000").withColumn("v", F.lit(-1).cast("long")), p, text_columns=["comment"], folders=False)
    got = sorted((r.id, r.v, r.comment) for r in spark.read.parquet(p).collect())
    assert got == sorted([(f"OS_{v % 300}", v, "") for v in range(600) if v % 300 != 7] + [("OS_7", -1, "")])


def test_a_stage_of_many_series_has_few_files(spark, tmp_path):
    p = str(tmp_path / "stage")
    d = spark.range(500).select((F.col("id") % 2).alias("mooring"), F.when(F.col("id") < 499, F.col("id")).alias("serial"), F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz").alias("time"), F.col("id").alias("v"))
    sinks.write_stage(d, p)
    assert len(list((tmp_path / "stage").glob("*/part-*"))) <= sinks.BUCKETS + 4
    sinks.write_stage(d.where("v IN (3, 499)").withColumn("v", -F.col("v")), p, "replace")
    assert sorted(r.v for r in sinks.read_stage(spark, p).collect()) == sorted([v for v in range(500) if v not in (3, 499)] + [-3, -499])
    assert set(sinks.read_stage(spark, p).columns) == {"mooring", "serial", "time", "v"}


def test_places_of_columns_are_found_once_a_record_and_numbers_read_once_a_line(spark, tmp_path):
    path = str(tmp_path / "r.use")
    d = spark.sql("SELECT 'a' AS file, TIMESTAMP_NTZ '2024-01-02 03:30:00' AS time, 1.5D AS T, 2.5D AS C, -99.999D AS P, 4D AS U")
    rodb.write_rodb(d, spark.sql("SELECT 'a' AS file, 7 AS Mooring"), path, ["T", "C", "P", "U"])
    out = rodb.read_rodb(spark, path)
    assert [(r["T"], r["C"], r["U"], r["time"].hour, r["time"].minute) for r in out.collect()] == [(1.5, 2.5, 4.0, 3, 30)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_position(") == 8 and plan.count("transform(") <= 2
