"""Consumer-group positions: the ledger, commit batches and resuming from a commit."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolway.operators.skew import ROWS_PER_TASK, numbered
from spoolway.schema import COMMIT_BATCH, POSITION_KEYS
from spoolway.sources.topics import from_positions

GROUP_KEYS = ["group_id", *POSITION_KEYS]


def commit_ledger(offsets: DataFrame) -> DataFrame:
    """The position of each group in every topic partition it has committed to."""
    return offsets.groupBy(*GROUP_KEYS).agg(F.max("next_offset").alias("next_offset"))


def commit_batches(offsets: DataFrame, size: int = COMMIT_BATCH, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Number the commit batch of each offset: ``size`` offsets per group and topic partition."""
    placed = numbered(offsets, GROUP_KEYS, ["offset"], "_position", rows_per_task)
    return placed.withColumn("commit_batch", F.call_function("div", F.col("_position") - 1, F.lit(size))).drop(
        "_position"
    )


def batch_commits(batches: DataFrame) -> DataFrame:
    """What each commit batch commits, for every topic partition in it."""
    return batches.groupBy(*GROUP_KEYS, "commit_batch").agg(
        F.max("next_offset").alias("next_offset"), F.count(F.lit(1)).alias("records")
    )


def start_positions(edges: DataFrame, ledger: DataFrame, group_id: str, reset: str = "latest") -> DataFrame:
    """``(topic, partition, start)`` of a group: its commit, else the first or the next offset.

    ``edges(topic, partition, first_offset, next_offset)`` comes from the commit rows
    of a topic table, so no record is read for it.
    """
    edge = "next_offset" if reset == "latest" else "first_offset"
    own = ledger.where(F.col("group_id") == group_id).select(*POSITION_KEYS, F.col("next_offset").alias("committed"))
    return edges.join(own, POSITION_KEYS, "left").select(*POSITION_KEYS, F.coalesce("committed", edge).alias("start"))


def resume(df: DataFrame, edges: DataFrame, ledger: DataFrame, group_id: str, reset: str = "latest") -> DataFrame:
    """What a group has still to read; partitions it never committed follow ``reset``."""
    return from_positions(df, start_positions(edges, ledger, group_id, reset))
