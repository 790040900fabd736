"""Recovery: the newest matching snapshot of each id, then the events after it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoolway.operators.journal import deleted_to
from spoolway.operators.skew import ROWS_PER_TASK, entity_keys, skew_join
from spoolway.schema import JOURNAL_TOPIC, SNAPSHOT_TOPIC


def of_journal(snapshots: DataFrame, journal_topic: str = JOURNAL_TOPIC, snapshot_topic: str = SNAPSHOT_TOPIC) -> DataFrame:
    """Snapshots with the topic of the journal beside their own: the same tenant's prefix, the other name."""
    if "topic" not in snapshots.columns:
        return snapshots
    own = F.expr(f"left(topic, length(topic) - {len(snapshot_topic)})")
    beside = F.when(F.endswith("topic", F.lit(snapshot_topic)), F.concat(own, F.lit(journal_topic))).otherwise(F.col("topic"))
    return snapshots.withColumn("topic", beside)


def recovery_tail(
    journal: DataFrame,
    index: DataFrame,
    snapshots: DataFrame,
    marks: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Events each id has to replay: after its snapshot, and after what is deleted.

    The index tells which ids are hot, by their highest sequence number. Snapshots and
    marks with a topic, which is the journal's, hold for that topic only.
    """
    ids = entity_keys(journal, index)

    def bound(df: DataFrame, column: str) -> DataFrame:
        found = df.select(*entity_keys(df), F.col(column).alias("_after"))
        on = entity_keys(found, index)
        # what speaks of every topic is told apart by the topics that have the id
        return found.select(*ids, "_after") if on == ids else found.join(index.select(*ids), on).select(*ids, "_after")

    start = bound(snapshots, "seq_nr")
    if marks is not None:
        start = start.unionByName(bound(deleted_to(marks), "deleted_to_seq_nr"))
    start = start.groupBy(*ids).agg(F.max("_after").alias("_after"))
    hot = index.where(F.col("highest_seq_nr") > rows_per_task).select(*ids).collect()
    joined = skew_join(journal, start, ids, "left", hot=hot)
    return joined.where(F.col("seq_nr") > F.coalesce("_after", F.lit(0))).drop("_after")


def recover_all(
    journal: DataFrame,
    index: DataFrame,
    snapshots: DataFrame,
    marks: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    **state: Column,
) -> DataFrame:
    """One row per indexed topic and id: its snapshot's number, the length of its tail and the folded tail.

    Snapshots belong to the journal with their tenant's prefix.
    """
    snapshots, ids = of_journal(snapshots), entity_keys(journal, index)
    tail = recovery_tail(journal, index, snapshots, marks, rows_per_task)
    folded = tail.groupBy(*ids).agg(
        F.count(F.lit(1)).alias("tail_events"), *[column.alias(name) for name, column in state.items()]
    )
    chosen = snapshots.select(*entity_keys(snapshots), F.col("seq_nr").alias("snapshot_seq"))
    zero = F.lit(0).cast("bigint")
    return (
        index.select(*ids, "highest_seq_nr")
        .join(chosen, entity_keys(index, chosen), "left")
        .join(folded, ids, "left")
        .withColumns({"snapshot_seq": F.coalesce("snapshot_seq", zero), "tail_events": F.coalesce("tail_events", zero)})
    )
