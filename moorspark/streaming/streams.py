"""Streaming quality control and down-sampling on file streams.

A micro-batch is worked off by the same distributed operators as a batch job; what has to wait is kept as tables in one folder
per micro-batch, so a batch that is run again after a failure gives the same files. A row is final once the watermark
(latest time seen less the allowed delay) has passed it; until then later rows may be ordered in before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorspark.operators.ordered import TIME_CHUNK, ordered
from moorspark.operators.qc import gross_range

HOUR_US = 3_600_000_000
_FLUSHED = "flushed"
#: micro-batches after which tables kept by changes are written whole
WHOLE_EVERY = 64


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Records arriving as Parquet files."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def _last_batch(spark: SparkSession, path: str) -> int | None:
    """Number of the last micro-batch whose state is complete."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/state")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    done = [int(s.getPath().getName()) for s in fs.listStatus(p) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{s.getPath()}/mark/_SUCCESS"))]
    return max(done, default=None)


def _work_off(stream: DataFrame, rows: Callable[[DataFrame], DataFrame], step: Callable[[DataFrame, dict[str, DataFrame] | None, int], tuple[DataFrame, dict[str, DataFrame]]],
              end: str, path: str, checkpoint: str, delay_us: int, latest: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """Run ``step`` over what is available and return all output rows.

    ``rows`` shapes a batch, ``end`` is the column that the watermark must have passed; ``step`` gets the rows, the
    tables of the batch before and the watermark, and returns the final rows and the tables to keep. Rows that come
    after the watermark has passed them go to ``path``/late. At the end of the run everything still open is given out
    too; that part is written anew by the next run.

    A table named in ``latest`` is kept by changes: a batch writes the rows it touched, and ``step`` gets the rows of all
    batches since the table was last written whole, by the function that leaves the latest row of each key. So what a batch writes grows with the batch.
    """
    spark = stream.sparkSession
    latest = latest or {}

    def state(n: int | None) -> tuple[dict[str, DataFrame] | None, int, int]:
        if n is None:
            return None, -(1 << 62), 0
        mark = spark.read.parquet(f"{path}/state/{n}/mark").first()
        since = {t: mark["since"] if t in latest else n for t in mark["tables"]}
        return {t: spark.read.parquet(*[f"{path}/state/{m}/{t}" for m in range(a, n + 1)]) for t, a in since.items()}, mark["watermark"], mark["since"]

    def batch(new: DataFrame, n: int) -> None:
        before, passed, since = state(n - 1 if n else None)
        rows(new).write.mode("overwrite").parquet(f"{path}/state/{n}/rows")
        mine = spark.read.parquet(f"{path}/state/{n}/rows")
        mine.where(F.col(end) <= passed).write.mode("overwrite").parquet(f"{path}/late/batch={n}")
        top = mine.agg(F.max("t_us")).first()[0]
        mark = max(passed, top - delay_us) if top is not None else passed
        out, keep = step(mine.where(F.col(end) > passed), before, mark)
        out.write.mode("overwrite").parquet(f"{path}/out/batch={n}")
        whole = n - since >= WHOLE_EVERY
        for t, d in keep.items():
            if whole and t in latest:
                d = latest[t](before[t].unionByName(d))
            d.write.mode("overwrite").parquet(f"{path}/state/{n}/{t}")
        spark.createDataFrame([(mark, list(keep), n if whole else since)], "watermark long, tables array<string>, since long").coalesce(1).write.mode("overwrite").parquet(f"{path}/state/{n}/mark")

    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    before, _, _ = state(_last_batch(spark, path))
    none = rows(spark.createDataFrame([], stream.schema))
    out, _ = step(none, before, 1 << 62)
    out.write.mode("overwrite").parquet(f"{path}/out/batch={_FLUSHED}")
    return spark.read.schema(out.schema).option("recursiveFileLookup", "true").parquet(f"{path}/out")


def stream_qc(stream: DataFrame, keys: Sequence[str] | str, value: str, suspect: tuple[float, float], fail: tuple[float, float], spike: float, rate: float,
              path: str, checkpoint: str, time: str = "time", delay_us: int = HOUR_US, width: int = TIME_CHUNK) -> DataFrame:
    """Gross range per row, spike and rate against the previous sample of the series.

    A series is named by one or more ``keys``: a serial alone would compare samples across deployments. Kept between batches:
    rows that the watermark has not passed, and the last final sample of each series, written for the series of the batch alone.
    Output: keys, ``t_us``, value, ``range_flag``, ``spike``, ``rate_flag``; equal times are ordered by value,
    and there is no rate between them.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)

    def newest(d: DataFrame) -> DataFrame:
        return d.groupBy(*keys).agg(F.max_by(F.struct("t_us", value), F.struct("t_us", value)).alias("l")).select(*keys, "l.*")

    def rows(d: DataFrame) -> DataFrame:
        return d.select(*keys, F.unix_micros(F.col(time).cast("timestamp")).alias("t_us"), F.col(value).cast("double").alias(value))

    def step(new: DataFrame, before: dict[str, DataFrame] | None, mark: int) -> tuple[DataFrame, dict[str, DataFrame]]:
        every = new.unionByName(before["open"]) if before else new
        final = every.where(F.col("t_us") <= mark)
        d = final.withColumn("__old", F.lit(False))
        if before:
            touched = before["last"].join(final.select(*keys).distinct(), keys, "left_semi")
            d = d.unionByName(newest(touched).withColumn("__old", F.lit(True)))
        last = newest(d)
        d = ordered(d, keys, ["t_us", value], width, lag={"__pt": F.col("t_us"), "__pv": F.col(value)}).where(~F.col("__old"))
        dv = F.abs(F.col(value) - F.col("__pv"))
        r = dv / (F.nullif(F.col("t_us") - F.col("__pt"), F.lit(0)) / 1e6)
        flag = F.when(F.col(value).isNull(), 9).when(r.isNull(), 2).when(r > rate, 3).otherwise(1)
        out = d.select(*keys, "t_us", value, gross_range(F.col(value), suspect, fail).cast("int").alias("range_flag"),
                       F.coalesce(dv > spike, F.lit(False)).alias("spike"), flag.cast("int").alias("rate_flag"))
        return out, {"open": every.where(F.col("t_us") > mark), "last": last}

    return _work_off(stream, rows, step, "t_us", path, checkpoint, delay_us, {"last": newest})


def stream_means(stream: DataFrame, keys: Sequence[str], values: Sequence[str], path: str, checkpoint: str, every_us: int = 12 * HOUR_US,
                 time: str = "time", delay_us: int = HOUR_US) -> DataFrame:
    """Tumbling-window means per series: one row per window, also for those still open when the stream ends.

    Kept between batches: counts and sums of the windows that the watermark has not passed.
    """
    sums = [*(f"__s_{v}" for v in values), *(f"__n_{v}" for v in values)]

    def rows(d: DataFrame) -> DataFrame:
        t = F.unix_micros(F.col(time).cast("timestamp"))
        start = F.floor(t / every_us).cast("long") * every_us
        return d.select(*keys, t.alias("t_us"), start.alias("__w"), (start + every_us).alias("__end"), *[F.col(v).cast("double").alias(v) for v in values])

    def step(new: DataFrame, before: dict[str, DataFrame] | None, mark: int) -> tuple[DataFrame, dict[str, DataFrame]]:
        part = new.groupBy(*keys, "__w", "__end").agg(F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(f"__s_{v}") for v in values], *[F.count(v).alias(f"__n_{v}") for v in values])
        if before:
            part = part.unionByName(before["open"]).groupBy(*keys, "__w", "__end").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums])
        out = part.where(F.col("__end") <= mark).select(*keys, F.col("__w").alias("t_us"), "n", *[(F.col(f"__s_{v}") / F.nullif(F.col(f"__n_{v}"), F.lit(0))).alias(v) for v in values])
        return out, {"open": part.where(F.col("__end") > mark)}

    return _work_off(stream, rows, step, "__end", path, checkpoint, delay_us)
