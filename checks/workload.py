"""Topics made of the given tables: the input of the registered queries.

* ``akka-journal``: one record per ``events`` row, keyed by user. Every 50th is a
  foreign record without a sequence number, some of them without key or body.
* ``acme-akka-journal``: the ``conversations`` turns, a second tenant's journal.
* ``akka-snapshots``: saves and tombstones that follow from the events.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolway.functions import codec, payload
from spoolway.operators import journal as J
from spoolway.operators import snapshots as S
from spoolway.operators.skew import numbered
from spoolway.schema import JOURNAL_TOPIC, JSON_TYPE, OPAQUE_TYPE, SNAPSHOT_TOPIC
from spoolway.scratch import fresh_dir
from spoolway.sinks.topics import append_topic
from spoolway.sources.subscriptions import Topics
from spoolway.sources.topics import read_topics

TENANT = "acme-"
PARTITIONS = 16
THREE_DAYS = 3 * 86_400 * 10_000_000

_stored: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with the plain columns that records are made of."""
    return table(spark, sf_dir, "events").withColumnRenamed("value", "amount").withColumns(
        {
            "persistence_id": F.concat(F.lit("user-"), F.col("user_id").cast("string")),
            "part": F.pmod("user_id", F.lit(PARTITIONS)).cast("int"),
            "cents": F.round(F.col("amount") * 100).cast("bigint"),
            # the event id adds what ticks have beyond microseconds
            "ticks": codec.ntz_micros(F.col("ts")) * 10 + codec.UNIX_EPOCH_TICKS + F.col("event_id") % 10,
            "foreign": F.col("event_id") % 50 == 0,
        }
    )


def journal_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that belong to the journal, numbered per user; read from the stored table of them."""
    return spark.read.parquet(f"{topics_root(spark, sf_dir)}/events")


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = events(spark, sf_dir).where(~F.col("foreign"))
    return numbered(own, ["user_id"], ["event_id"], "seq_nr").withColumns(
        {
            "tags": F.array_compact(F.array("event_type", F.when(F.col("amount") > 50, "high"))),
            "writer_uuid": F.md5(F.col("user_id").cast("string").cast("binary")),
            "manifest": F.concat(F.lit("Shop.Events."), F.initcap("event_type")),
            "content_type": F.when(F.col("event_type") == "error", OPAQUE_TYPE).otherwise(JSON_TYPE),
            "serializer_id": F.when(F.col("event_type") == "error", F.col("user_id") % 7 - 3).cast("int"),
            "payload": event_payload(),
        }
    )


def event_payload() -> Column:
    """Errors are opaque bytes; the others are JSON behind a registry frame."""
    body = payload.encode_json({"EventId": F.col("event_id"), "cents": F.col("cents"), "props": F.col("props")})
    framed = codec.frame(event_schema_id(F.col("event_type")), codec.encode_string(body))
    return F.when(F.col("event_type") == "error", codec.encode_string(F.col("props"))).otherwise(framed)


def event_schema_id(event_type: Column) -> Column:
    return 1000 + F.length(event_type)


def journal_records(spark: SparkSession, sf_dir: str, numbered_events: DataFrame) -> DataFrame:
    own = J.encode_events(numbered_events)
    foreign = events(spark, sf_dir).where("foreign").select(
        "event_id",
        F.col("part"),
        F.lit(JOURNAL_TOPIC).alias("topic"),
        F.when(F.col("event_id") % 100 != 0, F.col("persistence_id")).alias("key"),
        F.when(F.col("event_id") % 150 != 0, F.encode("props", "UTF-8")).otherwise(F.lit(b"")).alias("value"),
        F.lit(None).cast("map<string,binary>").alias("headers"),
        codec.ticks_to_timestamp(F.col("ticks")).alias("timestamp"),
    )
    return own.select(*foreign.columns).unionByName(foreign)


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("persistence_id"),
        (F.col("turn") + 1).alias("seq_nr"),
        F.array("role").alias("tags"),
        codec.encode_string(payload.encode_json({"role": F.col("role"), "text": F.col("text")})).alias("payload"),
        F.lit("Chat.Turn").alias("manifest"),
        F.lit("chat").alias("writer_uuid"),
        (codec.UNIX_EPOCH_TICKS + F.col("conv_id") * 1000 + F.col("turn")).alias("ticks"),
        F.lit(JSON_TYPE).alias("content_type"),
    )
    return J.encode_events(turns, TENANT + JOURNAL_TOPIC)


def snapshot_actions(own: DataFrame) -> dict[str, DataFrame]:
    """Saves and deletes that follow from the journal; ``sub`` orders those of one event."""
    round_seq = F.col("seq_nr") - F.col("seq_nr") % 10
    body = codec.encode_string(payload.encode_json({"EventId": F.col("event_id"), "cents": F.col("cents")}))
    saves = own.where(F.col("seq_nr") % 10 == 0).withColumn("sub", F.lit(0))
    resaves = (
        own.where((F.col("event_type") == "purchase") & (F.col("seq_nr") % 9 == 0) & (F.col("seq_nr") > 10))
        .withColumn("seq_nr", round_seq)
        .withColumn("sub", F.lit(3))
    )
    saved_at = own.where(F.col("seq_nr") % 10 == 0).select(
        "persistence_id", F.col("seq_nr").alias("round_seq"), F.col("ticks").alias("save_ticks")
    )
    stale = F.lit(1).cast("bigint")
    seq_deletes = (
        own.where((F.col("event_type") == "error") & (F.col("seq_nr") % 7 == 0))
        .withColumn("round_seq", round_seq)
        .join(saved_at, ["persistence_id", "round_seq"], "left")
        .withColumn(
            "ticks",
            F.when(F.col("seq_nr") % 3 == 0, F.lit(0).cast("bigint"))
            .when(F.col("seq_nr") % 3 == 1, F.coalesce("save_ticks", stale))
            .otherwise(stale),
        )
        .withColumn("seq_nr", F.col("round_seq"))
        .withColumn("sub", F.lit(1))
    )
    range_deletes = (
        own.where((F.col("event_type") == "signup") & (F.col("seq_nr") % 13 == 0))
        .withColumns(
            {
                "min_seq": F.col("seq_nr") - 25,
                "max_seq": F.when(F.col("seq_nr") % 5 != 0, F.col("seq_nr")),
                "min_ticks": F.when(F.col("seq_nr") % 3 == 0, F.col("ticks") - 2 * THREE_DAYS),
                "max_ticks": F.when(F.col("seq_nr") % 2 == 1, F.col("ticks") - THREE_DAYS),
            }
        )
        .withColumn("sub", F.lit(2))
    )
    return {
        "saves": saves.unionByName(resaves).withColumns(
            {
                "payload": body,
                "manifest": F.lit("Shop.State"),
                "content_type": F.lit(JSON_TYPE),
                "serializer_id": F.lit(None).cast("int"),
            }
        ),
        "seq_deletes": seq_deletes,
        "range_deletes": range_deletes,
    }


def snapshot_records(numbered_events: DataFrame) -> DataFrame:
    actions = snapshot_actions(numbered_events)
    columns = ["event_id", "sub", "part", "topic", "key", "value", "headers", "timestamp"]
    encoded = [
        S.encode_saves(actions["saves"]),
        S.encode_seq_deletes(actions["seq_deletes"]),
        S.encode_range_deletes(actions["range_deletes"]),
    ]
    stamped = [df.withColumn("timestamp", F.lit(None).cast("timestamp")).select(*columns) for df in encoded]
    return stamped[0].unionByName(stamped[1]).unionByName(stamped[2])


def delete_marks(journal: DataFrame) -> DataFrame:
    """Marks that mostly rise; one in a while goes back."""
    first_tag = F.get("tags", 0)
    rising = journal.where((first_tag == "error") & (F.col("seq_nr") % 11 == 0)).select(
        "persistence_id", (F.col("seq_nr") - 20).alias("to_seq_nr")
    )
    back = journal.where((first_tag == "view") & (F.col("seq_nr") % 17 == 0)).select(
        "persistence_id", F.floor(F.col("seq_nr") / 4).alias("to_seq_nr")
    )
    return rising.unionByName(back)


def _fingerprint(spark: SparkSession, sf_dir: str) -> int:
    """Changes when a file of the two tables does."""
    paths = [f"{sf_dir}/{name}.parquet" for name in ("events", "conversations")]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.agg(F.bit_xor(F.xxhash64("path", "modificationTime", "length"))).head()[0]


def topics_root(spark: SparkSession, sf_dir: str) -> str:
    """The stored topic table of an input; written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, _fingerprint(spark, sf_dir))
    if key not in _stored:
        root = fresh_dir(spark, "topics")
        _numbered_events(spark, sf_dir).write.parquet(f"{root}/events")
        own = spark.read.parquet(f"{root}/events")
        append_topic(journal_records(spark, sf_dir, own), root, 0, ["event_id"], partitioner=F.col("part"))
        append_topic(
            conversation_records(spark, sf_dir),
            root,
            1,
            ["conv_id", "turn"],
            partitioner=F.pmod("conv_id", F.lit(8)),
        )
        append_topic(snapshot_records(own), root, 2, ["event_id", "sub"], partitioner=F.col("part"))
        _stored[key] = root
    return _stored[key]


def _beside(spark: SparkSession, root: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table next to the topics, written when the first query asks for it."""
    key = (root, name)
    if key not in _stored:
        make().write.parquet(f"{root}/{name}")
        _stored[key] = f"{root}/{name}"
    return spark.read.parquet(_stored[key])


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journal index, as kept next to the journal."""
    root = topics_root(spark, sf_dir)
    return _beside(spark, root, "index", lambda: J.journal_index(journal(spark, sf_dir), marks(spark, sf_dir)))


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _beside(spark, topics_root(spark, sf_dir), "marks", lambda: delete_marks(journal(spark, sf_dir)))


def journal_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_topics(spark, topics_root(spark, sf_dir), Topics([JOURNAL_TOPIC]))


def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.decode_journal(journal_topic(spark, sf_dir))


def snapshot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot log, with the place at which each record is stored."""
    records = read_topics(spark, topics_root(spark, sf_dir), Topics([SNAPSHOT_TOPIC]), located=True)
    return S.decode_snapshot_log(records)
