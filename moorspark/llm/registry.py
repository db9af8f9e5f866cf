"""Names of the runnable queries of this folder."""

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with an optional SQL restatement."""

    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


#: SQL text that lower-cases A-Z alone, for ``{}``.
LOWER_SQL = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def bounded(spark):
    """The session with Arrow batches of few rows: texts are long, and a batch stands in memory on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def documents(spark, sf_dir: str):
    """The documents table with the columns the operators read."""
    return bounded(spark).read.parquet(f"{sf_dir}/documents.parquet")
