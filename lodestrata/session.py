"""Session defaults used by tests, the bench and interactive work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lodestrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with AQE on; ``master`` is only set where none is given by the launcher."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the Parquet tables of a data folder; any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt out evenly to as many tasks as a shuffle has, for work that takes long on small rows: a scan cuts its files by bytes, and a million short rows are one task's."""
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism))


def short_batches(spark: SparkSession, rows: int = 2_000, size: int = 8 << 20) -> None:
    """Bounds the rows and bytes of an Arrow batch in this session, so that batches of long texts stay small in memory.

    Results are lazy and read the settings when they run, so the session keeps the lower bounds;
    smaller ones that it already has stay.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key)
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
