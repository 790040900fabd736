"""Consume, process and commit, with the three delivery promises."""

import itertools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spoolway import files
from spoolway.operators.skew import broadcast_small
from spoolway.schema import COMMIT, COMMIT_INTERVAL, DEFAULT_PARTITIONS, POSITION_KEYS
from spoolway.sinks.commitlog import BATCHES_PER_TOKEN, LINE, CommitLog, Conflict
from spoolway.sinks.topics import TRIES, commit_batch, place, write_batch
from spoolway.sources.subscriptions import Subscription
from spoolway.sources.topics import read_topics


def consumed_rows(df: DataFrame, group_id: str) -> DataFrame:
    """The commit rows of the offsets a batch consumed: every topic partition in it."""
    return (
        df.groupBy(*POSITION_KEYS)
        .agg(
            F.min("offset").alias("first_offset"),
            (F.max("offset") + 1).alias("next_offset"),
            F.count(F.lit(1)).alias("records"),
        )
        .select(F.lit("in").alias("kind"), F.lit(group_id).alias("group_id"), *COMMIT.names[2:])
    )


def group_positions(spark: SparkSession, root: str) -> DataFrame:
    """The ledger: each group's next offset in each topic partition."""
    log = CommitLog(spark, root)
    return log.positions(log.head())


def unread(df: DataFrame, positions: DataFrame, group_id: str) -> DataFrame:
    """Records that the group has not committed yet, whichever query or checkpoint read them."""
    own = positions.where(F.col("group_id") == group_id).select(*POSITION_KEYS, F.col("next_offset").alias("_next"))
    joined = df.join(broadcast_small(own), POSITION_KEYS, "left")
    return joined.where(F.col("offset") >= F.coalesce("_next", F.lit(0))).select(*df.columns)


def start(stream: DataFrame, process: Callable, checkpoint: str, every: str | None) -> StreamingQuery:
    """Run ``process`` on each micro-batch, again and again or, without ``every``, on what there is."""
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


class GroupWriter:
    """A group's one writer to a table: starting another one takes the right to commit away from this."""

    def __init__(self, spark: SparkSession, root: str, group_id: str):
        self.root, self.group_id = root, group_id
        self.token = CommitLog(spark, root).new_token(group_id)
        self.numbers = itertools.count(self.token * BATCHES_PER_TOKEN)

    def commit(self, df: DataFrame, make: Callable[[DataFrame, CommitLog, object, int], DataFrame | None]) -> bool:
        """Commit what the group has not read yet; False if that is nothing.

        ``make`` gets these records, the log, its state and the batch's number, and returns commit
        rows of what it wrote. If others commit meanwhile, it is called again on the new state.
        """
        log = CommitLog(df.sparkSession, self.root)
        # records are numbered, written and counted; a lost block is read again
        df = df.persist()
        try:
            for attempt in range(TRIES):
                at, number = log.head(), next(self.numbers)
                fresh = df if at.seq < 0 else unread(df, log.positions(at), self.group_id)
                rows = consumed_rows(fresh, self.group_id)
                produced = make(fresh, log, at, number)
                rows = rows if produced is None else produced.unionByName(rows)
                try:
                    return commit_batch(rows, self.root, number, at, self.group_id, self.token) > at.seq
                except Conflict:
                    if attempt == TRIES - 1:
                        raise
            return False
        finally:
            df.unpersist()


def exactly_once(
    stream: DataFrame,
    root: str,
    group_id: str,
    transform: Callable[[DataFrame], DataFrame],
    order: Sequence[str],
    checkpoint: str,
    partitions: int = DEFAULT_PARTITIONS,
    partitioner: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Consume, transform and produce; output and consumed offsets are one commit.

    What a group has consumed is known from the table, not from the checkpoint: a repeated
    micro-batch and a new checkpoint produce only what is missing. The records have to
    come in the order of their offsets, as ``stream_topics`` and Kafka give them. Any
    number of groups may write to a root at a time; of one group the newest query may
    commit, an older one fails.
    """
    writer = GroupWriter(stream.sparkSession, root, group_id)

    def process(df: DataFrame, batch: int) -> None:
        def make(fresh, log, at, number):
            placed = place(transform(fresh), order, partitions, partitioner, log.next_offsets(at))
            return write_batch(placed, root, number)

        writer.commit(df, make)

    return start(stream, process, checkpoint, every)


def at_most_once(
    stream: DataFrame,
    root: str,
    group_id: str,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Commit first, process second; a batch that failed in between is not tried again."""
    writer = GroupWriter(stream.sparkSession, root, group_id)

    def commit_then_process(df: DataFrame, batch: int) -> None:
        found = []

        def make(fresh, log, at, number):
            # the state's files are named, so these records stay the same after the commit
            found.append(fresh)

        if writer.commit(df, make):
            process(found[-1], batch)

    return start(stream, commit_then_process, checkpoint, every)


def commit_flow(
    stream: DataFrame,
    root: str,
    group_id: str,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = COMMIT_INTERVAL,
) -> StreamingQuery:
    """Process first, commit second: at least once. ``process`` sees what the group has not committed.

    A batch holds what arrived within ``every``; ``records_per_batch`` of the stream closes it earlier.
    """
    writer = GroupWriter(stream.sparkSession, root, group_id)

    def process_then_commit(df: DataFrame, batch: int) -> None:
        def make(fresh, log, at, number):
            process(fresh, batch)

        writer.commit(df, make)

    return start(stream, process_then_commit, checkpoint, every)


def follow_commits(
    spark: SparkSession,
    root: str,
    process: Callable[[SparkSession, list[int], int], None],
    checkpoint: str,
    commits_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Follow a topic table by its commits; ``process`` gets the session and the new batches, in their order."""
    reader = spark.readStream.schema(LINE)
    if commits_per_trigger:
        # a commit is one file
        reader = reader.option("maxFilesPerTrigger", commits_per_trigger)
    lines = reader.json(f"{files.qualified(spark, root)}/commits")
    stream = lines.where((F.col("kind") == "batch") & (F.col("records") > 0))

    def batches(df: DataFrame, batch: int) -> None:
        # one row per commit
        found = [row["batch"] for row in sorted(df.select("seq", "batch").collect())]
        if found:
            process(df.sparkSession, found, batch)

    return start(stream, batches, checkpoint, every)


def for_each_committed(
    spark: SparkSession,
    root: str,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    subscription: Subscription | None = None,
    batches_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Hand over the records of the batches committed since the last call, read in the JVM.

    Unlike ``stream_topics`` it is for sinks only, but takes its limit with any trigger.
    """

    def read_batches(session: SparkSession, found: list[int], batch: int) -> None:
        process(read_topics(session, root, subscription, found), batch)

    return follow_commits(spark, root, read_batches, checkpoint, batches_per_trigger, every)
