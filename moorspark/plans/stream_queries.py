"""Queries of the streaming operators."""

from pyspark.sql import functions as F

from moorspark.operators.ordered import DAY_US
from moorspark.plans.qc_queries import GROSS
from moorspark.plans.registry import q6, query, rounded
from moorspark.plans.standin import obs, oracle
from moorspark.session import scratch_path
from moorspark.streaming import streams


def arrivals(spark, sf):
    """Records as a stream of files, one range of time per file, that arrive in the order of time."""
    path = scratch_path(spark, "arrivals")
    d = obs(spark, sf).select("mooring", "serial", "time", "temp", "cond")
    d.repartitionByRange("time").write.parquet(path)
    in_name_order(spark, path)
    return streams.read_stream(spark, path, d.schema, max_files=3)


def in_name_order(spark, path):
    """Date the files of a folder in the order of their names, a second apart: tasks end in any order, and a stream takes the oldest file first."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f for f in fs.listStatus(p) if f.getPath().getName().startswith("part-")), key=lambda f: f.getPath().getName())
    last = max((f.getModificationTime() for f in files), default=0)
    for back, f in enumerate(reversed(files)):
        fs.setTimes(f.getPath(), last - 1000 * back, -1)


@query("o1_stream_qc", oracle("obs", f"""SELECT mooring, serial, t_us, {GROSS.format(v='temp')} AS range_flag, coalesce(abs(temp - p) > 5, false) AS spike,
 CASE WHEN temp IS NULL THEN 9 WHEN abs(temp - p) / (nullif(t_us - tp, 0) / 1e6) IS NULL THEN 2 WHEN abs(temp - p) / (nullif(t_us - tp, 0) / 1e6) > 0.0002 THEN 3 ELSE 1 END AS rate_flag, {q6('temp')} FROM
 (SELECT *, lag(temp) OVER w AS p, lag(t_us) OVER w AS tp FROM obs WINDOW w AS (PARTITION BY mooring, serial ORDER BY t_us, temp NULLS FIRST))"""))
def _(spark, sf):
    d = streams.stream_qc(arrivals(spark, sf), ["mooring", "serial"], "temp", (0.5, 15), (0.1, 25), 5.0, 0.0002, scratch_path(spark, "qc"), scratch_path(spark, "qc-log"))
    return rounded(d, "mooring serial t_us range_flag spike rate_flag", "temp")


@query("o2_stream_means", oracle("obs", f"""SELECT mooring, serial, w AS t_us, n, {q6('temp', 'cond')} FROM (SELECT mooring, serial, CAST(t_us // {DAY_US // 2} * {DAY_US // 2} AS BIGINT) AS w, count(*) AS n, avg(temp) AS temp, avg(cond) AS cond
 FROM obs GROUP BY 1, 2, 3)"""))
def _(spark, sf):
    d = streams.stream_means(arrivals(spark, sf), ["mooring", "serial"], ["temp", "cond"], scratch_path(spark, "means"), scratch_path(spark, "means-log"))
    return rounded(d, "mooring serial t_us n", "temp cond")
