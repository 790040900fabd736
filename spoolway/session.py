"""Session settings used by the tests, the bench and stand-alone jobs."""

from pyspark.sql import SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName("spoolway")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
