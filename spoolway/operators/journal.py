"""The event journal: append, decode, index, logical delete, replay and tag tables."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from spoolway.functions import codec, naming
from spoolway.operators.skew import ROWS_PER_TASK, entity_keys, join_few, numbered, skew_join
from spoolway.schema import (
    CONTENT_TYPE,
    JOURNAL_TOPIC,
    MANIFEST,
    MAX_LONG,
    OPAQUE_TYPE,
    SEQ_NR,
    SERIALIZER_ID,
    TAGS,
    TIMESTAMP,
    WRITER_UUID,
)

INDEX_FIELDS = ["highest_seq_nr", "partition", "first_offset", "last_offset", "deleted_to_seq_nr", "tags", "last_updated"]

# The names of an index entry's body, and the end of an index topic's name.
INDEX_NAMES = {
    "highest_seq_nr": "HighestSequenceNr",
    "partition": "Partition",
    "first_offset": "FirstOffset",
    "last_offset": "LastOffset",
    "deleted_to_seq_nr": "DeletedToSequenceNr",
    "tags": "Tags",
    "last_updated": "LastUpdated",
}
INDEX_SUFFIX = "-index"
INDEX_BODY = (
    "HighestSequenceNr bigint, Partition int, FirstOffset bigint, LastOffset bigint, "
    "DeletedToSequenceNr bigint, Tags array<string>, LastUpdated string"
)
INDEX_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# Event columns that go into a record's key, value and headers.
ENCODED_FIELDS = [
    "persistence_id",
    "seq_nr",
    "payload",
    "tags",
    "manifest",
    "writer_uuid",
    "ticks",
    "content_type",
    "serializer_id",
]


def validate(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split events into accepted and rejected ones; an atomic write passes or fails as a whole.

    The rejected events carry a ``reason`` of their own or ``atomic write rejected``.
    """
    reason = (
        F.when(F.col("persistence_id").isNull() | (F.col("persistence_id") == ""), "no persistence id")
        .when(F.col("seq_nr").isNull() | (F.col("seq_nr") < 1), "no sequence number")
        .when(F.col("payload").isNull(), "no payload")
    )
    checked = events.withColumn("reason", reason)
    # a null atomic id matches nothing here: such an event is a write of its own
    failed = checked.where(F.col("reason").isNotNull() & F.col("atomic_id").isNotNull()).select("atomic_id").distinct()
    judged = join_few(checked, failed.withColumn("_failed", F.lit(True)), ["atomic_id"], "left")
    fails = F.col("_failed").isNotNull() | F.col("reason").isNotNull()
    accepted = judged.where(~fails).drop("_failed", "reason")
    rejected = judged.where(fails).drop("_failed")
    return accepted, rejected.withColumn("reason", F.coalesce("reason", F.lit("atomic write rejected")))


def write_results(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per atomic write: null for success, else a reason."""
    written = accepted.select("atomic_id", F.lit(None).cast("string").alias("reason"))
    failed = rejected.where(F.col("reason") != "atomic write rejected").select("atomic_id", "reason")
    return (
        written.unionByName(failed)
        .groupBy("atomic_id")
        .agg(F.min("reason").alias("error"))
    )


def encode_events(events: DataFrame, topic: str | Column = JOURNAL_TOPIC) -> DataFrame:
    """Events as records of a journal topic.

    Reads ``persistence_id, seq_nr, payload binary, tags, manifest, writer_uuid,
    ticks`` and, where given, ``serializer_id`` and ``content_type``. Other columns stay.
    """
    columns = events.columns
    content_type = F.col("content_type") if "content_type" in columns else F.lit(OPAQUE_TYPE)
    serializer = F.col("serializer_id") if "serializer_id" in columns else F.lit(None).cast("int")
    headers = codec.build_headers(
        {
            CONTENT_TYPE: codec.encode_string(content_type),
            SERIALIZER_ID: codec.encode_int(serializer),
            MANIFEST: codec.encode_string(F.col("manifest")),
            SEQ_NR: codec.encode_long(F.col("seq_nr")),
            WRITER_UUID: codec.encode_string(F.col("writer_uuid")),
            TIMESTAMP: codec.encode_long(F.col("ticks")),
            TAGS: F.when(F.size("tags") > 0, codec.encode_tags(F.col("tags"))),
        }
    )
    return events.select(
        "*",
        (topic if isinstance(topic, Column) else F.lit(topic)).alias("topic"),
        F.col("persistence_id").alias("key"),
        F.col("payload").alias("value"),
        headers.alias("headers"),
        codec.ticks_to_timestamp(F.col("ticks")).alias("timestamp"),
    ).drop(*ENCODED_FIELDS)


def decode_journal(records: DataFrame) -> DataFrame:
    """The journal events among topic records; records without a sequence number are skipped."""
    ticks = codec.decode_long(codec.header(TIMESTAMP))
    return records.where(F.col("seq_nr").isNotNull()).select(
        "topic",
        "partition",
        "offset",
        F.coalesce("key", F.lit("")).alias("persistence_id"),
        "seq_nr",
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.coalesce(codec.decode_string(codec.header(MANIFEST)), F.lit("")).alias("manifest"),
        codec.decode_int(codec.header(SERIALIZER_ID)).alias("serializer_id"),
        codec.content_format().alias("format"),
        F.coalesce(codec.decode_string(codec.header(WRITER_UUID)), F.lit("")).alias("writer_uuid"),
        F.coalesce(ticks, F.lit(0).cast("bigint")).alias("ticks"),
        "timestamp",
        F.col("value").alias("payload"),
    )


def journal_index(journal: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """One row per topic and persistence id; built by partial aggregates, so hot ids do not gather.

    Tenants have journal topics of their own, in which the same id is another entity. Reads neither headers nor payloads.
    """
    # by id and tag first: after it only an id's distinct tags are left
    index = (
        journal.withColumn("tag", F.explode_outer("tags"))
        .groupBy("topic", "persistence_id", "tag")
        .agg(
            F.max("seq_nr").alias("highest_seq_nr"),
            F.min("partition").alias("partition"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.max("timestamp").alias("last_updated"),
        )
        .groupBy("topic", "persistence_id")
        .agg(
            F.max("highest_seq_nr").alias("highest_seq_nr"),
            F.min("partition").alias("partition"),
            F.min("first_offset").alias("first_offset"),
            F.max("last_offset").alias("last_offset"),
            F.max("last_updated").alias("last_updated"),
            F.array_sort(F.collect_set("tag")).alias("tags"),
        )
    )
    deleted = F.lit(0).cast("bigint")
    if marks is not None:
        index = index.join(deleted_to(marks), entity_keys(index, marks), "left")
        deleted = F.coalesce("deleted_to_seq_nr", deleted)
    return index.withColumn("deleted_to_seq_nr", deleted).select("topic", "persistence_id", *INDEX_FIELDS)


def _union_of(tags: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(tags)))).alias("tags")


def encode_index(index: DataFrame) -> DataFrame:
    """Index rows as records of the compacted index topic beside each journal topic, with a JSON body."""
    fields = [F.col(name).alias(stored) for name, stored in INDEX_NAMES.items() if name != "last_updated"]
    updated = F.date_format("last_updated", INDEX_TIME).alias(INDEX_NAMES["last_updated"])
    body = F.to_json(F.struct(*fields, updated), {"ignoreNullFields": "false"})
    return index.select(
        F.concat("topic", F.lit(INDEX_SUFFIX)).alias("topic"),
        F.col("persistence_id").alias("key"),
        codec.encode_string(body).alias("value"),
    )


def decode_index(records: DataFrame) -> DataFrame:
    """Index rows out of records of index topics, latest ones if the records are compacted."""
    parsed = F.from_json(codec.decode_string(F.col("value")), INDEX_BODY)
    columns = {name: F.col(f"_entry.{stored}") for name, stored in INDEX_NAMES.items()}
    columns["last_updated"] = F.to_timestamp(columns["last_updated"], INDEX_TIME)
    return (
        records.where(F.col("key").isNotNull() & (F.length("value") > 0))
        .withColumn("_entry", parsed)
        .select(
            F.regexp_replace("topic", f"{INDEX_SUFFIX}$", "").alias("topic"),
            F.col("key").alias("persistence_id"),
            *[columns[name].alias(name) for name in INDEX_FIELDS],
        )
    )


def mark_deleted(index: DataFrame, marks: DataFrame) -> DataFrame:
    """Index rows to append for delete marks: those of the marked ids, deleted at least as far as before."""
    wanted = deleted_to(marks).withColumnRenamed("deleted_to_seq_nr", "_to")
    marked = index.join(wanted, entity_keys(index, wanted)).withColumn("deleted_to_seq_nr", F.greatest("deleted_to_seq_nr", "_to"))
    return marked.select(*index.columns)


def merge_index(entries: DataFrame) -> DataFrame:
    """One row per id out of partial index rows, for instance one per streamed batch."""
    return (
        entries.groupBy("topic", "persistence_id")
        .agg(
            F.max("highest_seq_nr").alias("highest_seq_nr"),
            F.min("partition").alias("partition"),
            F.min("first_offset").alias("first_offset"),
            F.max("last_offset").alias("last_offset"),
            F.max("deleted_to_seq_nr").alias("deleted_to_seq_nr"),
            _union_of("tags"),
            F.max("last_updated").alias("last_updated"),
        )
        .select("topic", "persistence_id", *INDEX_FIELDS)
    )


def compact_latest(records: DataFrame) -> DataFrame:
    """The last record of each topic and key; null keys and empty values are left out, and do not delete."""
    kept = records.where(F.col("key").isNotNull() & (F.col("size") > 0))
    by = [c for c in ("topic", "key") if c in records.columns]
    rest = [c for c in records.columns if c not in by]
    last = kept.groupBy(*by).agg(F.max_by(F.struct(*rest), F.col("offset")).alias("_last"))
    return last.select(*by, "_last.*").select(*records.columns)


def lookup_index(index: DataFrame, ids: DataFrame) -> DataFrame:
    """Index rows of the requested ids, in their topic if one is given; ids without events keep a row of nulls."""
    return ids.join(index, entity_keys(ids, index), "left")


def highest_seq_nr(index: DataFrame, ids: DataFrame) -> DataFrame:
    highest = index.groupBy(*entity_keys(index, ids)).agg(F.max("highest_seq_nr").alias("highest_seq_nr"))
    found = lookup_index(highest, ids)
    return found.withColumn("highest_seq_nr", F.coalesce("highest_seq_nr", F.lit(0).cast("bigint")))


def deleted_to(marks: DataFrame) -> DataFrame:
    """How far each id is deleted; a later, lower mark does not bring events back."""
    return marks.groupBy(*entity_keys(marks)).agg(F.max("to_seq_nr").alias("deleted_to_seq_nr"))


def visible_events(journal: DataFrame, marks: DataFrame) -> DataFrame:
    """Events that are not logically deleted."""
    joined = skew_join(journal, deleted_to(marks), entity_keys(journal, marks), "left")
    return joined.where(F.col("seq_nr") > F.coalesce("deleted_to_seq_nr", F.lit(0))).drop("deleted_to_seq_nr")


def where_indexed(entries: Sequence[Row], undeleted: bool = False) -> Column:
    """Where the records of these index rows are: topic, partition and offsets of each, past what is deleted there."""

    def place(entry: Row) -> Column:
        found = (
            (F.col("topic") == entry["topic"])
            & (F.col("partition") == entry["partition"])
            & F.col("offset").between(entry["first_offset"], entry["last_offset"])
        )
        return found & (F.col("seq_nr") > entry["deleted_to_seq_nr"]) if undeleted else found

    return reduce(Column.__or__, [place(entry) for entry in entries], F.lit(False))


def replay(
    records: DataFrame,
    index: DataFrame,
    persistence_id: str,
    from_seq: int = 1,
    to_seq: int = MAX_LONG,
    most: int = MAX_LONG,
) -> DataFrame:
    """Events of one id in offset order; its index rows, one per topic, bound the scan by literals.

    Each topic has its own delete mark. With several topics their events come one topic
    after the other; ``most`` counts them all.
    """
    entries = index.where((F.col("persistence_id") == persistence_id) & (F.col("deleted_to_seq_nr") < to_seq)).collect()
    if not entries:
        return decode_journal(records.where(F.lit(False)))
    events = records.where(
        where_indexed(entries, undeleted=True)
        & (F.col("key") == persistence_id)
        & F.col("seq_nr").between(from_seq, to_seq)
    )
    ordered = decode_journal(events).orderBy("topic", "offset")
    # the limit is the caller's own count of events
    return ordered if most == MAX_LONG else ordered.limit(most)


def bulk_replay(
    journal: DataFrame, index: DataFrame, requests: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Replay every id of ``requests([topic, ]persistence_id, from_seq, to_seq, most)`` at once.

    A request without a topic is one to each topic that has the id.
    """
    ids = entity_keys(journal, index)
    known = index.select(*ids, "deleted_to_seq_nr")
    bounds = requests.join(known, entity_keys(requests, known)).select(
        *ids,
        F.greatest(F.col("from_seq"), F.col("deleted_to_seq_nr") + 1).alias("_from"),
        F.col("to_seq").alias("_to"),
        F.col("most").alias("_most"),
    )
    events = skew_join(journal, bounds, ids, "inner", rows_per_task).where(
        F.col("seq_nr").between(F.col("_from"), F.col("_to"))
    )
    counted = numbered(events, ids, ["partition", "offset"], "_position", rows_per_task)
    return counted.where(F.col("_position") <= F.col("_most")).select(*journal.columns)


def tag_union(known: DataFrame, added: DataFrame) -> DataFrame:
    """Union of two ``([topic, ]persistence_id, tags)`` tables; a missing or null list keeps the other."""
    ids = entity_keys(known, added)
    empty = F.array().cast("array<string>")
    joined = known.join(added.select(*ids, F.col("tags").alias("_added")), ids, "full_outer")
    merged = F.array_union(F.coalesce("tags", empty), F.coalesce("_added", empty))
    return joined.select(*ids, F.array_sort(merged).alias("tags"))


def tag_records(journal: DataFrame, prefix: str = "") -> DataFrame:
    """One row per event and tag, with the name of the tag's topic."""
    return journal.withColumn("tag", F.explode("tags")).withColumn("tag_topic", naming.tag_topic_name(F.col("tag"), prefix))


def write_tag_table(journal: DataFrame, path: str, buckets: int = 64, prefix: str = "") -> None:
    """Store events by tag, clustered by a hash of the tag.

    Rows of one tag are spread by their offset as well, so a tag that most events
    carry is written by many tasks.
    """
    rows = tag_records(journal, prefix).withColumn("tag_bucket", tag_bucket(F.col("tag"), buckets))
    stretch = F.floor(F.col("offset") / F.lit(ROWS_PER_TASK))
    rows.repartition("tag_bucket", "partition", stretch).sortWithinPartitions("tag_bucket", "tag").write.mode(
        "overwrite"
    ).partitionBy("tag_bucket").parquet(path)


def read_tag_table(spark: SparkSession, path: str, tag: str, buckets: int = 64) -> DataFrame:
    """Events of one tag; only the folder of its bucket is read."""
    table = spark.read.parquet(path)
    return table.where((F.col("tag_bucket") == tag_bucket(F.lit(tag), buckets)) & (F.col("tag") == tag))


def tag_bucket(tag: Column, buckets: int = 64) -> Column:
    return F.pmod(F.xxhash64(tag), F.lit(buckets)).cast("int")
