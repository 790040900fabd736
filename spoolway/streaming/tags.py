"""A tag index beside a topic table, kept up by a stream: events by tag, clustered by a hash of the tag.

Each micro-batch adds one delta, ``log/batch=N/tag_bucket=B``, with a commit of its own
in the index's commit log; the consumed offsets stand in the same commit. Queries read one
bucket of the deltas that are committed, and of the newest generation that took older ones in.
"""

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spoolway import files
from spoolway.operators.journal import decode_journal, tag_bucket, tag_records
from spoolway.operators.skew import ROWS_PER_TASK
from spoolway.schema import COMMIT, TOPIC
from spoolway.sinks.commitlog import CommitLog, Conflict, generation_path, head, newest_generation, without
from spoolway.sinks.topics import batch_path
from spoolway.sources.topics import MAX_FOLDERS, from_positions
from spoolway.streaming.delivery import GroupWriter, start

GROUP = "tag-index"


def _rows(spark: SparkSession, folders: list[str], base: str) -> DataFrame:
    """Index rows below these folders; the schema is that of decoded events, so no file is opened for it."""
    events = decode_journal(spark.createDataFrame([], TOPIC)).schema
    more = [T.StructField(name, T.StringType()) for name in ("tag", "tag_topic")]
    schema = T.StructType([*events.fields, *more, T.StructField("tag_bucket", T.IntegerType())])
    return spark.read.schema(schema).option("basePath", base).parquet(*folders)


def _write(rows: DataFrame, folder: str) -> None:
    """By bucket and stretch of offsets, so that a tag which most events carry is written by many tasks."""
    stretch = F.floor(F.col("offset") / F.lit(ROWS_PER_TASK))
    dealt = rows.repartition("tag_bucket", "topic", "partition", stretch)
    dealt.sortWithinPartitions("tag_bucket", "tag", "topic", "partition", "offset").write.mode("overwrite").partitionBy("tag_bucket").parquet(folder)


def maintain_tags(
    stream: DataFrame, path: str, checkpoint: str, buckets: int = 64, prefix: str = "", every: str | None = None
) -> StreamingQuery:
    """Follow a topic table's stream and index its tagged events.

    A micro-batch that is repeated, also under a new checkpoint, adds only events that the
    index has not got. ``buckets`` has to stay the same.
    """
    writer = GroupWriter(stream.sparkSession, path, GROUP)

    def index(df: DataFrame, batch: int) -> None:
        def make(fresh, log, at, number):
            tagged = tag_records(decode_journal(fresh), prefix).withColumn("tag_bucket", tag_bucket(F.col("tag"), buckets))
            folder = batch_path(log.root, number)
            _write(tagged, folder)
            # one row for the delta; the records tell readers whether there is anything
            zero = F.lit(0).cast("bigint")
            written = fresh.sparkSession.read.parquet(folder) if files.data_files(folder) else tagged.limit(0)
            counted = written.agg(F.count(F.lit(1)).alias("records")).where("records > 0")
            row = {"kind": F.lit("out"), "group_id": F.lit(None).cast("string"), "topic": F.lit("tags"), "partition": F.lit(0)}
            row |= {"first_offset": zero, "next_offset": zero, "records": F.col("records")}
            return counted.select(*[row[name].alias(name) for name in COMMIT.names])

        writer.commit(df, make)

    return start(stream, index, checkpoint, every)


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """The whole index; a filter on ``tag_bucket`` reads the folders of these buckets only."""
    root = files.qualified(spark, path)
    at = head(root)
    generation = newest_generation(root)
    parts = [] if generation.path is None else [_rows(spark, [generation.path], generation.path)]
    runs = without(at.runs, generation.runs)
    if sum(last - first + 1 for first, last in runs) <= MAX_FOLDERS:
        folders = [batch_path(root, batch) for first, last in runs for batch in range(first, last + 1)]
        parts += [_rows(spark, folders, f"{root}/log").drop("batch")] if folders else []
    else:
        visible = reduce(lambda a, b: a | b, [F.col("batch").between(*run) for run in runs])
        parts.append(_rows(spark, [f"{root}/log"], f"{root}/log").where(visible).drop("batch"))
    if not parts:
        return _empty(spark)
    return reduce(DataFrame.unionByName, parts)


def _empty(spark: SparkSession) -> DataFrame:
    events = tag_records(decode_journal(spark.createDataFrame([], TOPIC)))
    return events.withColumn("tag_bucket", F.lit(0))


def events_by_tag(spark: SparkSession, path: str, tag: str, after: DataFrame | None = None, buckets: int = 64) -> DataFrame:
    """Events that carry the tag, after the given positions, out of the tag's bucket alone."""
    rows = read_tags(spark, path)
    found = rows.where((F.col("tag_bucket") == tag_bucket(F.lit(tag), buckets)) & (F.col("tag") == tag))
    events = found.drop("tag", "tag_topic", "tag_bucket")
    return events if after is None else from_positions(events, after, inclusive=False, others="keep")


def compact_tags(spark: SparkSession, path: str) -> int:
    """Merge all deltas into a generation with few files a bucket; queries under way keep the old ones."""
    log = CommitLog(spark, path)
    before, at = newest_generation(log.root), log.head()
    number, name = before.number + 1, uuid.uuid4().hex
    _write(read_tags(spark, path), f"{log.root}/generations/{name}")
    manifest = {"upto": at.seq, "path": name, "runs": at.runs}
    if not files.put_if_absent(spark, generation_path(log.root, number), json.dumps(manifest).encode()):
        raise Conflict(f"generation {number} of {path} is taken")
    log.summarise()
    return number
