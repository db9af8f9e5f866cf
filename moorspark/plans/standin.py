"""Stand-in views: the engine's canonical tables derived from the star-schema test tables.

Every view exists twice, as a DataFrame (:func:`views`) and as SQL text for the checking engine
(:func:`oracle`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moorspark.session import materialize


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def us(c: str):
    """Microseconds since the epoch of a TIMESTAMP_NTZ column (session time zone UTC)."""
    return F.unix_micros(F.col(c).cast("timestamp"))


def ntz(c):
    """TIMESTAMP_NTZ from microseconds."""
    return F.timestamp_micros(c).cast("timestamp_ntz")


def redeployed():
    """1 from the day on which every instrument goes to the next mooring, so that serials recur on several."""
    return F.when(F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'"), 1).otherwise(0)


def obs(spark, sf) -> DataFrame:
    v = F.col("value")
    u = F.col("user_id")
    return table(spark, sf, "events").select(
        F.col("event_id").cast("long").alias("event_id"),
        u.cast("long").alias("serial"),
        ((u + redeployed()) % 5).cast("long").alias("mooring"),
        us("ts").alias("t_us"),
        F.col("ts").alias("time"),
        F.col("event_type").alias("kind"),
        (v / 10.0).alias("temp"),
        (30 + v / 20.0).alias("cond"),
        (100.0 + 10.0 * F.floor(u / 5.0) + (F.col("event_id") % 100) / 10.0).cast("double").alias("pres"),
    )


def instr(spark, sf) -> DataFrame:
    u, d = F.col("serial"), F.col("d")
    return (
        table(spark, sf, "events").select(F.col("user_id").cast("long").alias("serial"), redeployed().cast("long").alias("d")).distinct()
        .select(
            u,
            ((u + d) % 5).alias("mooring"),
            # the list runs upwards: position and depth rank are opposite
            (F.row_number().over(Window.partitionBy((u + d) % 5).orderBy(F.desc("serial"))).cast("long") - 1).alias("position"),
            (100.0 + 10.0 * F.floor(u / 5.0) + 4 * d).cast("double").alias("depth"),
            (((u * 37) % 11 - 5) * 60 + 30 * d).alias("clock_offset"),
            F.when(u % 3 == 0, "microcat").when(u % 3 == 1, "sbe56").otherwise("aquadopp").alias("instrument"),
        )
    )


def configured(spark, sf) -> DataFrame:
    """The instruments and, for each seventh serial, one more in the configuration that has no samples."""
    i = instr(spark, sf)
    return i.unionByName(i.where("serial % 7 = 2").withColumns({"serial": F.col("serial") + 1_000_000, "position": F.col("position") + 1_000_000}))


def deploy(spark, sf) -> DataFrame:
    return spark.sql(
        "SELECT CAST(m AS BIGINT) AS mooring,"
        " TIMESTAMP_NTZ '2024-01-02 00:00:00' + m * INTERVAL '1' HOUR AS deployment_time,"
        " CASE WHEN m < 4 THEN TIMESTAMP_NTZ '2024-01-29 00:00:00' - m * INTERVAL '1' HOUR END AS recovery_time"
        " FROM VALUES (0),(1),(2),(3),(4) v(m)"
    )


def prof(spark, sf) -> DataFrame:
    li, od = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    # both sides are dealt by order: a broadcast would hold all orders in every task, and a partial aggregation before the
    # exchange a whole split of a file, since nearly every row is a group
    return (
        li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey)
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.round(F.avg(25 - F.col("l_quantity").cast("double") * 0.4), 6).alias("temp"),
            F.round(F.avg(34 + 20 * F.col("l_discount").cast("double")), 6).alias("salt"),
            F.max("o_orderdate").cast("timestamp_ntz").alias("time"),
            F.max(F.col("o_custkey") % 25).cast("double").alias("lat"),
            F.max(F.col("o_custkey") % 5).cast("long").alias("site"),
        )
        .select(
            F.col("l_orderkey").cast("long").alias("profile_id"),
            (200.0 * F.col("l_linenumber")).cast("double").alias("pres"),
            "temp", "salt", "time", "lat", "site",
        )
    )


def calib(spark, sf) -> DataFrame:
    k, b = F.col("s_suppkey"), F.col("s_acctbal").cast("double")
    return table(spark, sf, "supplier").select(
        k.cast("long").alias("serial"),
        (b / 100000).alias("pre"),
        (b / 100000 + (k % 7 - 3) * 0.001).cast("double").alias("post"),
        (k % 3 != 0).alias("applied"),
    )


def raw(spark, sf) -> DataFrame:
    """Samples to be calibrated."""
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("long").alias("serial"),
        F.col("l_orderkey").cast("long").alias("okey"),
        F.col("l_linenumber").cast("long").alias("line"),
        us_date("l_shipdate").alias("t_us"),
        (F.col("l_extendedprice").cast("double") / 1000).alias("v"),
        F.col("l_quantity").cast("double").alias("q"),
    )


def us_date(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def stage2(spark, sf) -> DataFrame:
    """Clock-shifted, trimmed samples of every instrument."""
    from moorspark.operators import clean

    return clean.shift_and_trim(obs(spark, sf), instr(spark, sf), deploy(spark, sf)).select(
        "event_id", "mooring", "serial", "t_us", "time", "kind", "temp", "cond", "pres", "depth", "instrument")


def stored(view, spark, sf) -> DataFrame:
    """A view as a stored table, as each processing stage leaves it for the next one.

    Operators read their input more than once; a view with joins would be evaluated each time.
    """
    return materialize(view(spark, sf), view.__name__)


_SQL = {
    "obs": """SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS serial,
 CAST((user_id + CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END) % 5 AS BIGINT) AS mooring, epoch_us(ts) AS t_us, ts AS time, event_type AS kind,
 value / 10.0 AS temp, 30 + value / 20.0 AS cond,
 CAST(100 + 10 * FLOOR(user_id / 5.0) + (event_id % 100) / 10.0 AS DOUBLE) AS pres FROM events""",
    "instr": """SELECT CAST(user_id AS BIGINT) AS serial, CAST((user_id + d) % 5 AS BIGINT) AS mooring,
 row_number() OVER (PARTITION BY (user_id + d) % 5 ORDER BY user_id DESC) - 1 AS position,
 CAST(100 + 10 * FLOOR(user_id / 5.0) + 4 * d AS DOUBLE) AS depth,
 CAST(((user_id * 37) % 11 - 5) * 60 + 30 * d AS BIGINT) AS clock_offset,
 CASE user_id % 3 WHEN 0 THEN 'microcat' WHEN 1 THEN 'sbe56' ELSE 'aquadopp' END AS instrument
 FROM (SELECT DISTINCT user_id, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END AS d FROM events)""",
    "configured": """SELECT serial, mooring, position, depth, clock_offset, instrument FROM instr UNION ALL
 SELECT serial + 1000000, mooring, position + 1000000, depth, clock_offset, instrument FROM instr WHERE serial % 7 = 2""",
    "deploy": """SELECT CAST(m AS BIGINT) AS mooring,
 TIMESTAMP '2024-01-02 00:00:00' + m * INTERVAL '1' HOUR AS deployment_time,
 CASE WHEN m < 4 THEN TIMESTAMP '2024-01-29 00:00:00' - m * INTERVAL '1' HOUR END AS recovery_time
 FROM (VALUES (0),(1),(2),(3),(4)) v(m)""",
    "prof": """SELECT CAST(l_orderkey AS BIGINT) AS profile_id, CAST(200 * l_linenumber AS DOUBLE) AS pres,
 round(AVG(25 - CAST(l_quantity AS DOUBLE) * 0.4), 6) AS temp, round(AVG(34 + 20 * CAST(l_discount AS DOUBLE)), 6) AS salt,
 CAST(MAX(o_orderdate) AS TIMESTAMP) AS time, CAST(MAX(o_custkey % 25) AS DOUBLE) AS lat,
 CAST(MAX(o_custkey % 5) AS BIGINT) AS site
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_linenumber""",
    "calib": """SELECT CAST(s_suppkey AS BIGINT) AS serial, CAST(s_acctbal AS DOUBLE) / 100000 AS pre,
 CAST(CAST(s_acctbal AS DOUBLE) / 100000 + (s_suppkey % 7 - 3) * 0.001 AS DOUBLE) AS post,
 s_suppkey % 3 <> 0 AS applied FROM supplier""",
    "raw": """SELECT CAST(l_suppkey AS BIGINT) AS serial, CAST(l_orderkey AS BIGINT) AS okey,
 CAST(l_linenumber AS BIGINT) AS line, epoch_us(CAST(l_shipdate AS TIMESTAMP)) AS t_us,
 CAST(l_extendedprice AS DOUBLE) / 1000 AS v, CAST(l_quantity AS DOUBLE) AS q FROM lineitem""",
    "stage2": """SELECT event_id, o.mooring, o.serial, t_us + clock_offset * 1000000 AS t_us,
 time + clock_offset * INTERVAL '1' SECOND AS time, kind, temp, cond, pres, depth, instrument
 FROM obs o JOIN instr i ON o.serial = i.serial AND o.mooring = i.mooring JOIN deploy d ON o.mooring = d.mooring
 WHERE (deployment_time IS NULL OR time + clock_offset * INTERVAL '1' SECOND >= deployment_time)
 AND (recovery_time IS NULL OR time + clock_offset * INTERVAL '1' SECOND <= recovery_time)""",
}
_DEPS = {"stage2": ["obs", "instr", "deploy"], "configured": ["instr"]}


def oracle(names: str, select: str, ctes: str = "") -> str:
    """SQL text: the named views, further CTEs, then the query."""
    need: list[str] = []

    def add(n: str) -> None:
        for m in _DEPS.get(n, []):
            add(m)
        if n not in need:
            need.append(n)

    for n in names.split():
        add(n)
    parts = [f"{n} AS ({_SQL[n]})" for n in need]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + select
