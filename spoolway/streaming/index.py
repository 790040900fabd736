"""Keep the journal index up to date from a stream of records."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spoolway.operators.journal import INDEX_SUFFIX, compact_latest, decode_index, decode_journal, encode_index, journal_index, merge_index
from spoolway.schema import DEFAULT_PARTITIONS, ENTITY
from spoolway.sinks.topics import place, write_batch
from spoolway.sources.topics import read_topics
from spoolway.streaming.delivery import GroupWriter, start


def maintain_index(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write one partial index per batch; a repeated batch replaces its own."""

    def write(df: DataFrame, batch: int) -> None:
        journal_index(decode_journal(df)).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return start(stream, write, checkpoint, every)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return merge_index(spark.read.parquet(path).drop("batch"))


def maintain_index_topic(
    stream: DataFrame, root: str, checkpoint: str, partitions: int = DEFAULT_PARTITIONS, every: str | None = None
) -> StreamingQuery:
    """Keep the compacted index topics below ``root`` up to date, one beside each journal topic.

    A micro-batch's entries are merged with the last entry of each of its ids, and appended in one
    commit with the offsets consumed: a repeated micro-batch, or a new checkpoint, changes nothing.
    """
    writer = GroupWriter(stream.sparkSession, root, "index-topic")

    def index(df: DataFrame, batch: int) -> None:
        def make(fresh, log, at, number):
            added = journal_index(decode_journal(fresh))
            topics = read_topics(fresh.sparkSession, root).where(F.endswith("topic", F.lit(INDEX_SUFFIX)))
            known = decode_index(compact_latest(topics)).join(added.select(*ENTITY), ENTITY, "left_semi")
            records = encode_index(merge_index(added.unionByName(known))).withColumn("order", F.xxhash64("topic", "key"))
            return write_batch(place(records, ["order"], partitions, base=log.next_offsets(at)), root, number)

        writer.commit(df, make)

    return start(stream, index, checkpoint, every)
