"""Read topic tables, in batch and as streams."""

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway import files
from spoolway.functions import codec
from spoolway.operators.skew import ROWS_PER_TASK, running_totals, skew_join
from spoolway.schema import POSITION_KEYS, TOPIC
from spoolway.sinks.commitlog import Generation, Head, head, newest_generation, runs_of, without
from spoolway.sources.committed import CommittedTopics
from spoolway.sources.subscriptions import Assignment, AssignmentWithOffset, Subscription, Topics

MAX_POSITIONS = 10_000
#: More batches than these are read from the log as a whole, by a predicate on their numbers.
MAX_FOLDERS = 256
STORED = T.StructType([*TOPIC.fields, T.StructField("batch", T.LongType())])


def _located(df: DataFrame, located: bool) -> DataFrame:
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")] if located else []
    return df.select(*TOPIC.names, *where)


def _read_log(spark: SparkSession, root: str, runs: Sequence[tuple[int, int]], located: bool) -> DataFrame | None:
    """Records of the batches in these runs; up to ``MAX_FOLDERS`` batches only their own folders are listed."""
    if not runs:
        return None
    reader = spark.read.schema(STORED)
    if sum(last - first + 1 for first, last in runs) <= MAX_FOLDERS:
        folders = [f"{root}/log/batch={batch}" for first, last in runs for batch in range(first, last + 1)]
        return _located(reader.option("basePath", f"{root}/log").parquet(*folders), located)
    visible = reduce(Column.__or__, [F.col("batch").between(*run) for run in runs])
    return _located(reader.parquet(f"{root}/log").where(visible), located)


def read_state(spark: SparkSession, root: str, at: Head, generation: Generation, located: bool = False) -> DataFrame:
    """All records committed up to a state: those of a generation, and the batches that it does not hold.

    The generation must have been looked up after the state.
    """
    parts = [_read_log(spark, root, without(at.runs, generation.runs), located)]
    if generation.path:
        # one folder per topic and partition, whatever the number of batches
        parts.insert(0, _located(spark.read.schema(TOPIC).parquet(generation.path), located))
    parts = [part for part in parts if part is not None]
    if not parts:
        more = T.StructType.fromDDL("file string, row bigint").fields if located else []
        return spark.createDataFrame([], T.StructType([*TOPIC.fields, *more]))
    return reduce(DataFrame.unionByName, parts)


def read_topics(
    spark: SparkSession,
    root: str,
    subscription: Subscription | None = None,
    batches: list[int] | None = None,
    located: bool = False,
) -> DataFrame:
    """All committed records of the subscribed topics, or those of the given batches.

    ``located`` adds where a record is stored, as ``file`` and ``row``.
    """
    root = files.qualified(spark, root)
    if batches is None:
        at = head(root)
        df = read_state(spark, root, at, newest_generation(root), located)
    else:
        nothing = Head(-1, None, -1, (), tuple(runs_of(batches)), (), 0)
        df = read_state(spark, root, nothing, Generation(-1, -1, None, ()), located)
    return df if subscription is None else df.where(subscription.predicate())


def stream_topics(
    spark: SparkSession,
    root: str,
    subscription: Subscription | None = None,
    commits_per_batch: int | None = None,
    records_per_batch: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Committed records of the subscribed topics as commits arrive, in their order.

    A micro-batch takes all commits there are, or closes once it has so many commits or
    records; then ``checkpoint`` has to name the query's checkpoint folder, next to which the
    reader notes its position, and a trigger has to go on (``availableNow`` takes one batch).
    """
    options = {"root": files.qualified(spark, root)}
    if isinstance(subscription, Topics):
        options["topics"] = json.dumps(list(subscription.names))
    elif isinstance(subscription, Assignment):
        options["pairs"] = json.dumps([list(pair) for pair in subscription.pairs])
    elif isinstance(subscription, AssignmentWithOffset):
        options["pairs"] = json.dumps([[t, p] for t, p, _ in subscription.triples])
    if commits_per_batch or records_per_batch:
        if checkpoint is None:
            raise ValueError("a limited stream needs its query's checkpoint folder")
        limits = {"commits": commits_per_batch, "records": records_per_batch}
        options |= {name: str(limit) for name, limit in limits.items() if limit}
        options["progress"] = files.qualified(spark, f"{checkpoint.rstrip('/')}-admitted.json")
    spark.dataSource.register(CommittedTopics)
    df = spark.readStream.format(CommittedTopics.name()).options(**options).load()
    return df if subscription is None else df.where(subscription.predicate())


def from_kafka(df: DataFrame) -> DataFrame:
    """Rows of the Kafka source as topic rows; of repeated header names the last one stays."""
    last_wins = F.aggregate(
        F.coalesce(F.col("headers"), F.array()),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<binary>")),
        lambda seen, h: F.map_concat(
            F.map_filter(seen, lambda name, _: name != h["key"]),
            F.map_from_arrays(F.array(h["key"]), F.array(h["value"])),
        ),
    )
    rows = df.withColumns({"key": codec.decode_string(F.col("key")), "headers": last_wins})
    return rows.withColumns(codec.promoted()).select(*TOPIC.names)


def kafka_topics(spark: SparkSession, servers: str, subscription: Subscription, stream: bool = False) -> DataFrame:
    """The same rows from a broker, where the Kafka source is deployed."""
    reader = spark.readStream if stream else spark.read
    options = {"kafka.bootstrap.servers": servers, "includeHeaders": "true", **subscription.kafka_options()}
    return from_kafka(reader.format("kafka").options(**options).load())


def committable(df: DataFrame, group_id: str) -> DataFrame:
    """Records with the value a consumer group commits after them."""
    return df.withColumns({"group_id": F.lit(group_id), "next_offset": F.col("offset") + 1})


def typed_scan(df: DataFrame, key: Column | None = None, value: Column | None = None) -> DataFrame:
    """Decode key and value by user expressions, such as ``from_json``."""
    decoders = {name: column for name, column in (("key", key), ("value", value)) if column is not None}
    return df.withColumns(decoders)


def from_positions(df: DataFrame, positions: DataFrame, inclusive: bool = True, others: str = "drop") -> DataFrame:
    """Records at or after ``positions(topic, partition, start)``, one row per topic partition.

    Partitions without a position are dropped or, with ``others="keep"``, read whole.
    The positions also become literals, so that the scan lists only their folders;
    a larger table than ``MAX_POSITIONS`` is joined instead.
    """
    wanted = positions.select(*POSITION_KEYS, "start")
    rows = wanted.limit(MAX_POSITIONS + 1).collect()
    how = "inner" if others == "drop" else "left"
    if len(rows) <= MAX_POSITIONS:
        if others == "drop":
            df = df.where(Assignment([(r["topic"], r["partition"]) for r in rows]).predicate())
        joined = df.join(F.broadcast(df.sparkSession.createDataFrame(rows, wanted.schema)), POSITION_KEYS, how)
    else:
        joined = skew_join(df, wanted, POSITION_KEYS, how)
    after = F.col("offset") >= F.col("start") if inclusive else F.col("offset") > F.col("start")
    return joined.where(F.coalesce(after, F.lit(others == "keep"))).select(*df.columns)


def partition_running(df: DataFrame, totals: dict[str, Column], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Each topic partition as its own stream: running totals in offset order."""
    return running_totals(df, POSITION_KEYS, ["offset"], totals, rows_per_task)


def partition_segments(
    df: DataFrame, process: Callable, schema: T.StructType | str, rows_per_segment: int = ROWS_PER_TASK
) -> DataFrame:
    """Run ``process(batches)`` over offset-ordered stretches of single topic partitions.

    A partition is handed over as stretches of ``rows_per_segment`` offsets, so that
    a large one is worked on by many tasks.
    """
    segment = F.floor(F.col("offset") / F.lit(rows_per_segment))
    return (
        df.withColumn("segment", segment)
        .repartition(*POSITION_KEYS, "segment")
        .sortWithinPartitions(*POSITION_KEYS, "segment", "offset")
        .mapInPandas(process, schema)
    )
