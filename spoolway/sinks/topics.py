"""Append records to a topic table.

Layout below a root folder: ``log/batch=N/topic=T/partition=P`` holds the records of a
batch, and ``sinks.commitlog`` tells which batches are committed. Readers see these
only. A batch that was committed under a key stays as it is: writing it again does nothing.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolway.functions import codec
from spoolway.operators.skew import ROWS_PER_TASK, broadcast_small, numbered
from spoolway.schema import COMMIT, DEFAULT_PARTITIONS, HEADERS, POSITION_KEYS, TOPIC
from spoolway.sinks.commitlog import BATCHES_PER_TOKEN, CommitLog, Conflict, Head

#: How often an append is planned anew because others committed meanwhile.
TRIES = 20


def next_offsets(spark: SparkSession, root: str) -> DataFrame:
    """Where the next record of each topic partition goes, one row per topic partition."""
    log = CommitLog(spark, root)
    return log.next_offsets(log.head())


def edges(spark: SparkSession, root: str) -> DataFrame:
    """First and next offset of each topic partition, from the commit rows alone."""
    log = CommitLog(spark, root)
    return log.edges(log.head())


def default_partition(key: Column, order: Sequence[str], partitions: int) -> Column:
    """By key; records without a key are spread by their order columns."""
    spread = F.xxhash64(*order)
    return F.pmod(F.when(key.isNull(), spread).otherwise(F.xxhash64(key)), F.lit(partitions)).cast("int")


def place(
    records: DataFrame,
    order: Sequence[str],
    partitions: int = DEFAULT_PARTITIONS,
    partitioner: Column | None = None,
    base: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Give each record its partition and offset; ``order`` is a total order of whole numbers."""
    where = partitioner if partitioner is not None else default_partition(F.col("key"), order, partitions)
    placed = numbered(
        records.withColumn("partition", where.cast("int")), POSITION_KEYS, order, "_position", rows_per_task
    )
    start = F.lit(0).cast("bigint")
    if base is not None:
        placed = placed.join(broadcast_small(base), POSITION_KEYS, "left")
        start = F.coalesce(F.col("next_offset"), start)
    return placed.withColumn("offset", start + F.col("_position") - 1).drop("_position", "next_offset")


def as_topic(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of a topic row, with the promoted columns; missing ones become null."""
    if "headers" not in df.columns:
        df = df.withColumn("headers", F.lit(None).cast(HEADERS))
    if "timestamp" not in df.columns:
        df = df.withColumn("timestamp", F.lit(None).cast("timestamp"))
    return df.withColumns(codec.promoted()).select(*[F.col(f.name).cast(f.dataType) for f in TOPIC.fields], *keep)


def batch_path(root: str, batch: int) -> str:
    return f"{root}/log/batch={batch}"


def write_batch(placed: DataFrame, root: str, batch: int, keep: Sequence[str] = ()) -> DataFrame:
    """Write placed records as one batch and return its commit rows, not yet committed.

    Rows come from ``place`` in offset order, so a file spans few offsets and their
    bounds prune. Columns named by ``keep`` are stored too; topic readers skip them.
    """
    folder = batch_path(root, batch)
    writer = as_topic(placed, keep).write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_TASK)
    writer.partitionBy(*POSITION_KEYS).parquet(folder)
    return (
        placed.sparkSession.read.schema(TOPIC)
        .parquet(folder)
        .groupBy(*POSITION_KEYS)
        .agg(
            F.min("offset").alias("first_offset"),
            (F.max("offset") + 1).alias("next_offset"),
            F.count(F.lit(1)).alias("records"),
        )
        .select(F.lit("out").alias("kind"), F.lit(None).cast("string").alias("group_id"), *COMMIT.names[2:])
    )


def commit_batch(
    rows: DataFrame,
    root: str,
    batch: int,
    at: Head | None = None,
    group: str | None = None,
    token: int | None = None,
    key: int | None = None,
) -> int:
    """Make a batch visible, planned on the state ``at`` (the present one by default)."""
    log = CommitLog(rows.sparkSession, root)
    return log.commit(rows, batch, at or log.head(), group, token, key)


def append(
    records: DataFrame,
    root: str,
    order: Sequence[str],
    partitions: int = DEFAULT_PARTITIONS,
    partitioner: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    key: int | None = None,
    keep: Sequence[str] = (),
) -> int | None:
    """Append records behind all that is committed; returns the batch, None if ``key`` was committed before.

    If another writer commits first, offsets are given anew, so appends of any number
    of writers neither overlap nor leave gaps.
    """
    log = CommitLog(records.sparkSession, root)
    batch = None
    for attempt in range(TRIES):
        at = log.head()
        if key is not None and at.has(key):
            return None
        batch = log.new_token() * BATCHES_PER_TOKEN if batch is None else batch
        placed = place(records, order, partitions, partitioner, log.next_offsets(at), rows_per_task)
        rows = write_batch(placed, root, batch, keep)
        try:
            log.commit(rows, batch, at, key=key)
            return batch
        except Conflict:
            if attempt == TRIES - 1:
                raise


def append_topic(
    records: DataFrame,
    root: str,
    batch: int | None,
    order: Sequence[str],
    partitions: int = DEFAULT_PARTITIONS,
    partitioner: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> None:
    """Append ``topic, key, value[, headers, timestamp]`` rows, under the key ``batch`` if one is given.

    A retry under a key that was committed leaves the table as it is.
    """
    append(records, root, order, partitions, partitioner, rows_per_task, batch)


def typed_append(records: DataFrame, key: Column | None = None, value: Column | None = None) -> DataFrame:
    """Encode user columns to the key and value of a record."""
    encoders = {name: column for name, column in (("key", key), ("value", value)) if column is not None}
    return records.withColumns(encoders)
