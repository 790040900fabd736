"""The registered queries: every operator over the whole given tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import folds
from checks import workload as W
from spoolway.functions import codec, naming, payload
from spoolway.operators import commits as C
from spoolway.operators import fold, schemas
from spoolway.operators import journal as J
from spoolway.operators import produce as P
from spoolway.operators import snapshots as S
from spoolway.operators.skew import numbered
from spoolway.plans import readjournal as R
from spoolway.plans import recovery
from spoolway.schema import (
    CONTENT_TYPE,
    JOURNAL_TOPIC,
    JSON_TYPE,
    MANIFEST,
    OPAQUE_TYPE,
    POSITION_KEYS,
    SEQ_NR,
    SNAPSHOT_TOPIC,
    TAGS,
    WRITER_UUID,
)
from spoolway.scratch import fresh_dir
from spoolway.sinks import generations as GEN
from spoolway.sinks import topics as SINK
from spoolway.sinks.topics import append_topic, place, write_batch
from spoolway.sources import topics as SRC
from spoolway.sources.subscriptions import Assignment, AssignmentWithOffset, TopicPattern, Topics
from spoolway.streaming import control, delivery, ordered, tags
from spoolway.streaming import fold as live
from spoolway.streaming.index import maintain_index, maintain_index_topic, read_index

Query = Callable[[SparkSession, str], DataFrame]

TENANT_JOURNAL = W.TENANT + JOURNAL_TOPIC
GROUP = "billing"
RECORD = ["topic", "partition", "offset", "key"]
EVENT = ["persistence_id", "seq_nr", "partition", "offset"]
BODY = "eventId bigint, cents bigint, props string"

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def csv(tags: str = "tags"):
    return F.array_join(tags, ",").alias("tags_csv")


# --- scans ---


@query
def topic_scan(spark, sf):
    return SRC.read_topics(spark, W.topics_root(spark, sf), Topics([JOURNAL_TOPIC, TENANT_JOURNAL])).select(*RECORD)


@query
def topic_pattern_scan(spark, sf):
    return SRC.read_topics(spark, W.topics_root(spark, sf), TopicPattern(r"(.+-)?akka-journal")).select(*RECORD)


@query
def assigned_scan(spark, sf):
    pairs = Assignment([(JOURNAL_TOPIC, 3), (JOURNAL_TOPIC, 7), (TENANT_JOURNAL, 2)])
    return SRC.read_topics(spark, W.topics_root(spark, sf), pairs).select(*RECORD)


@query
def assigned_from_offset(spark, sf):
    start = AssignmentWithOffset([(JOURNAL_TOPIC, 3, 100), (JOURNAL_TOPIC, 7, 0), (TENANT_JOURNAL, 2, 10)])
    return SRC.read_topics(spark, W.topics_root(spark, sf), start).select(*RECORD)


@query
def resume_from_commit(spark, sf):
    records = W.journal_topic(spark, sf)
    done = SRC.committable(records.where((F.col("seq_nr") <= 20) & (F.col("partition") < 12)), GROUP)
    edges = SINK.edges(spark, W.topics_root(spark, sf)).where(F.col("topic") == JOURNAL_TOPIC)
    return C.resume(records, edges, C.commit_ledger(done), GROUP, reset="earliest").select(*RECORD)


@query
def resume_from_latest(spark, sf):
    records = W.journal_topic(spark, sf)
    done = SRC.committable(records.where((F.col("seq_nr") <= 20) & (F.col("partition") < 12)), GROUP)
    edges = SINK.edges(spark, W.topics_root(spark, sf)).where(F.col("topic") == JOURNAL_TOPIC)
    return C.resume(records, edges, C.commit_ledger(done), GROUP, reset="latest").select(*RECORD)


@query
def committable_scan(spark, sf):
    return SRC.committable(W.journal_topic(spark, sf), GROUP).select("group_id", *POSITION_KEYS, "offset", "next_offset")


@query
def per_partition_running(spark, sf):
    totals = {"records": F.lit(1).cast("bigint"), "seq_total": F.coalesce("seq_nr", F.lit(0).cast("bigint"))}
    return SRC.partition_running(W.journal_topic(spark, sf), totals).select(*RECORD, *totals)


@query
def external_offset_scan(spark, sf):
    records = W.journal_topic(spark, sf)
    halfway = F.call_function("div", F.max("offset") + 1, F.lit(2)).alias("start")
    known = records.where(F.col("partition") % 2 == 0).groupBy(*POSITION_KEYS).agg(halfway)
    return SRC.from_positions(records, known).select(*RECORD)


@query
def at_most_once(spark, sf):
    stream = SRC.stream_topics(spark, W.topics_root(spark, sf), Topics([JOURNAL_TOPIC]))
    work = fresh_dir(spark, "at-most-once")

    def process(df: DataFrame, batch: int) -> None:
        df.select(*RECORD).write.mode("overwrite").parquet(f"{work}/out/batch={batch}")

    control.wait(delivery.at_most_once(stream, f"{work}/ledger", GROUP, process, f"{work}/checkpoint"))
    return spark.read.parquet(f"{work}/out").select(*RECORD)


@query
def read_committed_scan(spark, sf):
    """Three batches, the second of which never commits; the third brings its rows again."""
    root = fresh_dir(spark, "read-committed")
    rows = W.events(spark, sf).select(
        "event_id", "event_type", "part", F.lit("audit").alias("topic"), F.col("persistence_id").alias("key"),
        F.encode("props", "UTF-8").alias("value"),
    )
    partitioner = F.col("part")
    append_topic(rows.where("event_type in ('purchase', 'click')"), root, 0, ["event_id"], partitioner=partitioner)
    write_batch(place(rows.where("event_type = 'error'"), ["event_id"], partitioner=partitioner), root, 1)
    later = rows.where("event_type not in ('purchase', 'click')")
    append_topic(later, root, 2, ["event_id"], partitioner=partitioner)
    return SRC.read_topics(spark, root).select(*RECORD, codec.decode_string(F.col("value")).alias("value_text"))


@query
def compacted_scan(spark, sf):
    """Three batches, a compaction before the last one, and a folder without a commit."""
    root = fresh_dir(spark, "compacted")
    rows = W.events(spark, sf).select(
        "event_id", "part", F.lit("audit").alias("topic"), F.col("persistence_id").alias("key"), F.encode("props", "UTF-8").alias("value")
    )
    third = F.floor(F.col("event_id") * 3 / (rows.agg(F.max("event_id")).head()[0] + 1))
    for batch in range(3):
        append_topic(rows.where(third == batch), root, batch, ["event_id"], partitioner=F.col("part"))
        if batch == 1:
            write_batch(place(rows.where("event_id < 5"), ["event_id"]), root, 99)
            GEN.compact(spark, root)
    return SRC.read_topics(spark, root).select(*RECORD)


@query
def typed_scan(spark, sf):
    records = W.journal_topic(spark, sf).where(F.col("seq_nr").isNotNull() & (codec.content_format() == "json"))
    typed = SRC.typed_scan(
        records,
        key=F.regexp_extract("key", r"^user-(\d+)$", 1).cast("bigint"),
        value=payload.decode_json(F.col("value"), BODY),
    )
    return typed.select(
        F.col("key").alias("user_id"), F.col("value.eventId").alias("event_id"), "value.cents", "value.props"
    )


# --- sinks, produce flows, commits ---


@query
def append_roundtrip(spark, sf):
    """Order within a key survives; orders in process have no key."""
    root = fresh_dir(spark, "append")
    orders = W.table(spark, sf, "orders")
    records = orders.select(
        "o_orderkey",
        F.lit("orders").alias("topic"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("key"),
        F.encode(F.col("o_orderkey").cast("string"), "UTF-8").alias("value"),
    )
    append_topic(records, root, 0, ["o_orderkey"])
    stored = SRC.read_topics(spark, root).withColumn("order_key", codec.decode_string(F.col("value")).cast("bigint"))
    # a key sits in one partition, so its offsets order it; records without a key have no order
    keyed = numbered(stored.where("key is not null"), ["key"], ["partition", "offset"], "key_position")
    loose = stored.where("key is null").withColumn("key_position", F.lit(None).cast("bigint"))
    return keyed.unionByName(loose).select("key", "order_key", "key_position")


@query
def produce_single(spark, sf):
    customers = W.table(spark, sf, "customer")
    envelopes = customers.select(F.col("c_custkey").alias("envelope_id"), F.col("c_name").alias("pass_through"))
    records = customers.select(
        F.col("c_custkey").alias("envelope_id"),
        F.lit(0).alias("pos"),
        F.lit("customers").alias("topic"),
        F.col("c_custkey").cast("string").alias("key"),
        F.encode("c_mktsegment", "UTF-8").alias("value"),
    )
    results = P.produce(
        envelopes, records, fresh_dir(spark, "single"), 0, partitioner=F.pmod("envelope_id", F.lit(16))
    )
    return results.select("envelope_id", "topic", "partition", "offset", "pass_through")


def _order_results(spark, sf, name):
    orders, lines = W.table(spark, sf, "orders"), W.table(spark, sf, "lineitem")
    envelopes = orders.select(F.col("o_orderkey").alias("envelope_id"), F.col("o_custkey").alias("pass_through"))
    # line numbers repeat within an order, so the whole line makes up the position
    records = lines.select(
        F.col("l_orderkey").alias("envelope_id"),
        (F.col("l_linenumber") * F.lit(10**18) + F.col("l_partkey") * 10**8 + F.col("l_suppkey")).alias("pos"),
        F.lit("lines").alias("topic"),
        F.col("l_partkey").cast("string").alias("key"),
        F.encode("l_returnflag", "UTF-8").alias("value"),
        "l_partkey",
    )
    return P.produce(envelopes, records, fresh_dir(spark, name), 0, partitioner=F.pmod("l_partkey", F.lit(16)))


@query
def produce_multi(spark, sf):
    results = _order_results(spark, sf, "multi").where("kind = 'record'")
    return results.select("envelope_id", "pos", "topic", "partition", "offset", "pass_through")


@query
def produce_passthrough(spark, sf):
    counted = (
        _order_results(spark, sf, "passthrough")
        .groupBy("envelope_id", "pass_through")
        .agg(F.count("topic").alias("records"))
    )
    kind = F.when(F.col("records") == 0, "pass_through").when(F.col("records") == 1, "single").otherwise("multi")
    return counted.withColumn("kind", kind)


@query
def produce_arrays(spark, sf):
    """Envelopes that arrive as one row: a customer's record once or twice, or not at all."""
    customers = W.table(spark, sf, "customer")

    def record(suffix: str):
        return F.struct(
            F.lit("letters").alias("topic"),
            F.concat(F.col("c_custkey").cast("string"), F.lit(suffix)).alias("key"),
            F.encode("c_name", "UTF-8").alias("value"),
        )

    records = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.array(record("-a"), record("-b")))
        .when(F.col("c_acctbal") > 0, F.array(record("-a")))
        .otherwise(F.array().cast("array<struct<topic:string,key:string,value:binary>>"))
    )
    envelopes = customers.select(
        F.col("c_custkey").alias("envelope_id"), F.col("c_name").alias("pass_through"), records.alias("records")
    )
    results = P.produce(
        envelopes.select("envelope_id", "pass_through"),
        P.explode_records(envelopes),
        fresh_dir(spark, "arrays"),
        0,
        partitioner=F.pmod("envelope_id", F.lit(16)),
    )
    offsets = F.array_join(F.transform("results", lambda r: r["offset"].cast("string")), ",")
    return P.regroup(results).select("envelope_id", "pass_through", offsets.alias("offsets_csv"))


@query
def exactly_once(spark, sf):
    stream = SRC.stream_topics(spark, W.topics_root(spark, sf), Topics([JOURNAL_TOPIC]))
    work = fresh_dir(spark, "exactly-once")

    running = delivery.exactly_once(
        stream, f"{work}/out", GROUP, _high_events, ["source_partition", "source_offset"], f"{work}/checkpoint"
    )
    control.wait(running)
    stored = J.decode_journal(SRC.read_topics(spark, f"{work}/out"))
    return stored.select("persistence_id", "seq_nr", "ticks", csv())


def _high_events(df: DataFrame) -> DataFrame:
    return df.where(F.array_contains("tags", "high")).select(
        F.lit("high-events").alias("topic"), "key", "value", "headers", "timestamp",
        F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"),
    )


def _run_group(spark, sf, out, checkpoint):
    stream = SRC.stream_topics(spark, W.topics_root(spark, sf), Topics([JOURNAL_TOPIC]))
    order = ["source_partition", "source_offset"]
    run = delivery.exactly_once(stream, out, GROUP, _high_events, order, checkpoint, partitioner=F.col("source_partition"))
    control.wait(run)


@query
def new_checkpoint(spark, sf):
    """A group that loses its checkpoint and reads everything again produces nothing twice."""
    work = fresh_dir(spark, "new-checkpoint")
    for checkpoint in ("first", "second"):
        _run_group(spark, sf, f"{work}/out", f"{work}/{checkpoint}")
    stored = J.decode_journal(SRC.read_topics(spark, f"{work}/out"))
    return stored.select("persistence_id", "seq_nr", "ticks", csv())


@query
def append_after_group(spark, sf):
    """A plain append to what a group has produced goes on behind it."""
    work = fresh_dir(spark, "after-group")
    _run_group(spark, sf, f"{work}/out", f"{work}/checkpoint")
    errors = W.events(spark, sf).where("event_type = 'error'").select(
        "event_id", "part", F.lit("high-events").alias("topic"), F.col("persistence_id").alias("key"), F.encode("props", "UTF-8").alias("value")
    )
    append_topic(errors, f"{work}/out", 0, ["event_id"], partitioner=F.col("part"))
    return SRC.read_topics(spark, f"{work}/out").select(*RECORD)


@query
def two_groups(spark, sf):
    """Two groups copy the journal to one output, one after the other, under one ledger."""
    work = fresh_dir(spark, "two-groups")
    for group, wanted in (("first", F.array_contains("tags", "high")), ("second", F.lit(True))):

        def copies(df: DataFrame, group: str = group, wanted: Column = wanted) -> DataFrame:
            return df.where(wanted).select(
                F.lit(group).alias("topic"), "key", "value", "headers", "timestamp",
                F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"),
            )

        stream = SRC.stream_topics(spark, W.topics_root(spark, sf), Topics([JOURNAL_TOPIC]))
        control.wait(
            delivery.exactly_once(
                stream, f"{work}/out", group, copies, ["source_partition", "source_offset"], f"{work}/{group}",
                partitioner=F.col("source_partition"),
            )
        )
    written = SRC.read_topics(spark, f"{work}/out").groupBy(*POSITION_KEYS).agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("offset").alias("offsets"), F.max("offset").alias("last_offset")
    )
    consumed = delivery.group_positions(spark, f"{work}/out").where(F.col("topic") == JOURNAL_TOPIC)
    consumed = consumed.select(F.col("group_id").alias("topic"), "partition", F.col("next_offset").alias("consumed_to"))
    return consumed.join(written, POSITION_KEYS, "left").select(
        F.col("topic").alias("group_id"), "partition", "consumed_to",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("records", "offsets")], "last_offset",
    )


@query
def commit_ledger(spark, sf):
    return C.commit_ledger(SRC.committable(SRC.read_topics(spark, W.topics_root(spark, sf)), GROUP))


@query
def commit_flow(spark, sf):
    stream = SRC.stream_topics(spark, W.topics_root(spark, sf), TopicPattern(".*akka-journal"))
    work = fresh_dir(spark, "commit-flow")

    def process(df: DataFrame, batch: int) -> None:
        df.select(*RECORD).write.mode("overwrite").parquet(f"{work}/out/batch={batch}")

    control.wait(delivery.commit_flow(stream, f"{work}/ledger", GROUP, process, f"{work}/checkpoint", every=None))
    return delivery.group_positions(spark, f"{work}/ledger")


@query
def commit_batches(spark, sf):
    offsets = SRC.committable(W.journal_topic(spark, sf), GROUP)
    return C.batch_commits(C.commit_batches(offsets, size=100))


@query
def drain(spark, sf):
    stream = SRC.stream_topics(spark, W.topics_root(spark, sf), Topics([JOURNAL_TOPIC])).select(*RECORD)
    work = fresh_dir(spark, "drain")
    running = control.tail(stream, f"{work}/out", f"{work}/checkpoint")
    control.drain_and_shutdown(running)
    return spark.read.schema(stream.schema).parquet(f"{work}/out")


@query
def typed_append(spark, sf):
    root = fresh_dir(spark, "typed-append")
    body = payload.encode_json({"OrderKey": F.col("o_orderkey"), "status": F.col("o_orderstatus")})
    encoded = SINK.typed_append(
        W.table(spark, sf, "orders").withColumn("topic", F.lit("orders")),
        key=F.col("o_custkey").cast("string"),
        value=codec.frame(F.lit(7), codec.encode_string(body)),
    )
    append_topic(encoded.select("o_orderkey", "topic", "key", "value"), root, 0, ["o_orderkey"])
    stored = SRC.read_topics(spark, root)
    return stored.select(
        "key",
        codec.frame_schema_id(F.col("value")).alias("schema_id"),
        codec.decode_string(codec.frame_payload(F.col("value"))).alias("body"),
    )


# --- journal ---


def _atomic_events(spark, sf):
    """Three events of a user make an atomic write; an event under three units has no payload."""
    own = W.journal_events(spark, sf)
    return own.withColumns(
        {
            "atomic_id": F.concat("persistence_id", F.lit("/"), F.floor((F.col("seq_nr") - 1) / 3).cast("string")),
            "payload": F.when(F.col("cents") >= 300, F.col("payload")),
        }
    )


@query
def journal_append(spark, sf):
    root = fresh_dir(spark, "journal-append")
    accepted, _ = J.validate(_atomic_events(spark, sf))
    append_topic(J.encode_events(accepted), root, 0, ["event_id"], partitioner=F.col("part"))
    stored = J.decode_journal(SRC.read_topics(spark, root))
    return stored.select(*EVENT, "ticks", "writer_uuid", "manifest", "serializer_id", csv())


@query
def journal_append_results(spark, sf):
    return J.write_results(*J.validate(_atomic_events(spark, sf)))


@query
def journal_index(spark, sf):
    index = J.journal_index(W.journal(spark, sf), W.marks(spark, sf))
    return index.select(
        "persistence_id", "highest_seq_nr", "partition", "first_offset", "last_offset", "deleted_to_seq_nr", csv(),
        F.unix_micros("last_updated").alias("last_micros"),
    )


@query
def journal_index_live(spark, sf):
    work = fresh_dir(spark, "index")
    stream = SRC.stream_topics(spark, W.topics_root(spark, sf), Topics([JOURNAL_TOPIC]))
    control.wait(maintain_index(stream, f"{work}/index", f"{work}/checkpoint"))
    return read_index(spark, f"{work}/index").select(
        "persistence_id", "highest_seq_nr", "partition", "first_offset", "last_offset", csv()
    )


@query
def index_topic_live(spark, sf):
    """The index topic as a stream keeps it, read again from the start by a second checkpoint."""
    work = fresh_dir(spark, "index-topic-live")
    for checkpoint in ("first", "second"):
        stream = SRC.stream_topics(spark, W.topics_root(spark, sf), Topics([JOURNAL_TOPIC]))
        control.wait(maintain_index_topic(stream, f"{work}/index", f"{work}/{checkpoint}"))
    index = J.decode_index(J.compact_latest(SRC.read_topics(spark, f"{work}/index")))
    return index.select("topic", "persistence_id", "highest_seq_nr", "partition", "first_offset", "last_offset", csv())


def _index_topic(spark, sf) -> DataFrame:
    """The index topic: every entry, then those of the deleted ids again with their marks."""
    root = fresh_dir(spark, "index-topic")
    index = J.journal_index(W.journal(spark, sf))
    for batch, entries in enumerate((index, J.mark_deleted(index, W.marks(spark, sf)))):
        records = J.encode_index(entries).withColumn("order", F.xxhash64("topic", "key"))
        append_topic(records, root, batch, ["order"])
    return SRC.read_topics(spark, root)


@query
def index_topic_roundtrip(spark, sf):
    index = J.decode_index(J.compact_latest(_index_topic(spark, sf)))
    return index.select(
        "topic", "persistence_id", "highest_seq_nr", "partition", "first_offset", "last_offset", "deleted_to_seq_nr", csv(),
        F.unix_micros("last_updated").alias("last_micros"),
    )


@query
def delete_marks_roundtrip(spark, sf):
    """Events left by the marks as they stand in the index topic."""
    index = J.decode_index(J.compact_latest(_index_topic(spark, sf)))
    marks = index.select("persistence_id", F.col("deleted_to_seq_nr").alias("to_seq_nr"))
    return J.visible_events(W.journal(spark, sf), marks).select("persistence_id", "seq_nr", "partition", "offset")


@query
def compact_latest(spark, sf):
    return J.compact_latest(W.journal_topic(spark, sf)).select("key", "partition", "offset", "seq_nr")


def _customer_ids(spark, sf):
    return W.table(spark, sf, "customer").select(
        F.concat(F.lit("user-"), F.col("c_custkey").cast("string")).alias("persistence_id"), "c_nationkey"
    )


@query
def index_lookup(spark, sf):
    ids = _customer_ids(spark, sf).select("persistence_id")
    return J.lookup_index(W.index(spark, sf), ids).select(
        "persistence_id", "highest_seq_nr", "partition", "first_offset", "last_offset"
    )


@query
def highest_seq_nr(spark, sf):
    return J.highest_seq_nr(W.index(spark, sf), _customer_ids(spark, sf).select("persistence_id"))


@query
def logical_delete(spark, sf):
    return J.visible_events(W.journal(spark, sf), W.marks(spark, sf)).select(*EVENT)


def _busiest_id(index: DataFrame) -> str:
    return index.orderBy(F.desc("highest_seq_nr"), "persistence_id").select("persistence_id").head()[0]


@query
def replay(spark, sf):
    index = W.index(spark, sf)
    found = J.replay(W.journal_topic(spark, sf), index, _busiest_id(index), from_seq=3, most=40)
    return found.select(*EVENT, "ticks", "writer_uuid")


@query
def bulk_replay(spark, sf):
    nation = F.col("c_nationkey").cast("bigint")
    requests = _customer_ids(spark, sf).select(
        "persistence_id",
        (nation % 5 + 1).alias("from_seq"),
        (nation + 30).alias("to_seq"),
        (nation + 10).alias("most"),
    )
    return J.bulk_replay(W.journal(spark, sf), W.index(spark, sf), requests).select(*EVENT)


def _with_cents(journal: DataFrame) -> DataFrame:
    parsed = payload.decode_json(F.col("payload"), BODY)
    return journal.withColumn("cents", F.when(F.col("format") == "json", parsed["cents"]))


@query
def fold_state(spark, sf):
    return fold.fold_state(
        _with_cents(W.journal(spark, sf)),
        events=F.count(F.lit(1)),
        high_events=F.count_if(F.array_contains("tags", "high")),
        json_cents=F.coalesce(F.sum("cents"), F.lit(0).cast("bigint")),
        last_manifest=F.max_by("manifest", "offset"),
    ).drop("topic")


@query
def fold_udf(spark, sf):
    """Longest run of consecutive events tagged ``high``, by user code in offset order."""
    rows = W.journal(spark, sf).select(
        "persistence_id", "offset", F.array_contains("tags", "high").cast("bigint").alias("high")
    )
    folded = fold.fold_events(rows, folds.NO_RUN, folds.add_events, folds.join_runs, folds.RUN)
    return folded.select("persistence_id", "events", "longest")


@query
def fold_live(spark, sf):
    """The same fold, kept up to date while the journal grows by three batches."""
    work = fresh_dir(spark, "fold-live")
    own = W.journal_events(spark, sf)
    third = F.floor(F.col("event_id") * 3 / (own.agg(F.max("event_id")).head()[0] + 1))

    def high_flags(journal: DataFrame) -> DataFrame:
        return journal.select(
            "persistence_id", "offset", F.array_contains("tags", "high").cast("bigint").alias("high")
        )

    for batch in range(3):
        records = J.encode_events(own.where(third == batch))
        append_topic(records, f"{work}/topics", batch, ["event_id"], partitioner=F.col("part"))
    following = live.maintain_fold(
        spark, f"{work}/topics", f"{work}/states", f"{work}/checkpoint", high_flags, folds.NO_RUN, folds.add_events,
        folds.join_runs, folds.RUN, batches_per_trigger=1,
    )
    control.wait(following)
    states = live.read_fold(spark, f"{work}/states", folds.NO_RUN, folds.join_runs, folds.RUN)
    return states.select("persistence_id", "events", "longest")


@query
def two_tenants(spark, sf):
    """The same ids in two tenants' topics, with marks and snapshots of their own."""
    root = fresh_dir(spark, "two-tenants")
    tenant = F.when(F.col("event_id") % 3 == 0, W.TENANT).otherwise("")
    own = W.events(spark, sf).where(~F.col("foreign")).withColumn("tenant", tenant)
    own = numbered(own, ["tenant", "user_id"], ["event_id"], "seq_nr").withColumns(
        {
            "tags": F.array("event_type"),
            "manifest": F.lit("Shop.Event"),
            "writer_uuid": F.lit("w"),
            "payload": F.encode("props", "UTF-8"),
            "journal_topic": naming.topic_name(JOURNAL_TOPIC, F.col("tenant")),
        }
    )
    journal = J.encode_events(own, F.col("journal_topic")).select("event_id", "part", "topic", "key", "value", "headers", "timestamp")
    to = F.when((F.col("tenant") == "") & (F.col("event_type") == "error") & (F.col("seq_nr") % 5 == 0), F.col("seq_nr") - 3)
    to = F.when((F.col("tenant") != "") & (F.col("event_type") == "view") & (F.col("seq_nr") % 7 == 0), F.col("seq_nr") - 2).otherwise(to)
    marks = own.select(F.col("journal_topic").alias("topic"), "persistence_id", to.alias("to_seq_nr")).where("to_seq_nr is not null")
    saves = S.encode_saves(own.where("seq_nr % 4 = 0"))
    deletes = own.where("event_type = 'click' and seq_nr % 4 = 1 and seq_nr > 1").withColumns({"seq_nr": F.col("seq_nr") - 1, "ticks": F.lit(0).cast("bigint")})
    log = [df.withColumn("topic", naming.topic_name(SNAPSHOT_TOPIC, F.col("tenant"))) for df in (saves, S.encode_seq_deletes(deletes))]
    columns = ["event_id", "part", "topic", "key", "value", "headers"]
    append_topic(journal, root, 0, ["event_id"], partitioner=F.col("part"))
    append_topic(log[0].select(*columns).unionByName(log[1].select(*columns)), root, 1, ["event_id"], partitioner=F.col("part"))

    events = J.decode_journal(SRC.read_topics(spark, root, TopicPattern(f".*{JOURNAL_TOPIC}")))
    index = J.journal_index(events, marks)
    requests = index.select(
        "persistence_id", F.lit(1).cast("bigint").alias("from_seq"), F.lit(10**9).cast("bigint").alias("to_seq"), F.lit(6).cast("bigint").alias("most")
    ).distinct()
    keys = ["topic", "persistence_id"]
    live = S.live_keys(S.decode_snapshot_log(SRC.read_topics(spark, root, TopicPattern(f".*{SNAPSHOT_TOPIC}"), located=True)))
    recovered = recovery.recover_all(events, index, S.newest(live), marks)
    for name, found in (("visible", J.visible_events(events, marks)), ("replayed", J.bulk_replay(events, index, requests))):
        counted = found.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        recovered = recovered.join(counted, keys, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return recovered


@query
def tag_union(spark, sf):
    journal = W.journal(spark, sf)
    early = J.journal_index(journal.where("seq_nr <= 10")).select("persistence_id", "tags")
    late = J.journal_index(journal.where("seq_nr > 5")).select("persistence_id", "tags")
    return J.tag_union(early, late).select("persistence_id", csv())


@query
def tag_topic(spark, sf):
    path = fresh_dir(spark, "tags")
    J.write_tag_table(W.journal(spark, sf), path, prefix=W.TENANT)
    return spark.read.parquet(path).select("tag", "tag_topic", *EVENT)


@query
def tenant_scan(spark, sf):
    records = SRC.read_topics(spark, W.topics_root(spark, sf))
    own = records.where(F.col("topic") == naming.topic_name(JOURNAL_TOPIC, W.TENANT))
    return J.decode_journal(own).select("topic", *EVENT, csv(), payload.json_text(F.col("payload")).alias("body"))


# --- queries over the journal ---


@query
def events_by_id(spark, sf):
    index = W.index(spark, sf)
    found = R.events_by_id(W.journal_topic(spark, sf), _busiest_id(index), from_seq=2, index=index)
    return found.select(*EVENT, "ticks", csv())


@query
def events_by_id_undeleted(spark, sf):
    index = W.index(spark, sf)
    found = R.events_by_id(
        W.journal_topic(spark, sf), _busiest_id(index), index=index, hide_deleted=W.marks(spark, sf)
    )
    return found.select(*EVENT)


def _drained(spark, sf, name, select):
    stream = SRC.stream_topics(spark, W.topics_root(spark, sf), Topics([JOURNAL_TOPIC]))
    work = fresh_dir(spark, name)
    return control.drain(select(stream).select(*EVENT, "ticks", csv()), f"{work}/out", f"{work}/checkpoint")


@query
def events_by_id_live(spark, sf):
    wanted = _busiest_id(W.index(spark, sf))
    return _drained(spark, sf, "by-id", lambda stream: R.select_by_id(stream, wanted, from_seq=2))


@query
def events_by_id_ordered(spark, sf):
    """A live query by id that gives numbers in order though files hold the later half first, and ends at its last number."""
    work = fresh_dir(spark, "ordered")
    wanted = _busiest_id(W.index(spark, sf))
    own = W.journal_events(spark, sf).where(F.col("persistence_id") == wanted)
    last = own.agg(F.max("seq_nr")).head()[0]
    # the last number that is asked for is missing, but a later one is there
    asked = last - 1
    for batch, rows in enumerate((own.where(f"seq_nr > {last // 2} and seq_nr <> {asked}"), own.where(f"seq_nr <= {last // 2}"))):
        append_topic(J.encode_events(rows), f"{work}/topics", batch, ["event_id"], partitioner=F.col("part"))
    checkpoint = f"{work}/checkpoint"
    stream = SRC.stream_topics(spark, f"{work}/topics", commits_per_batch=1, checkpoint=checkpoint)
    events = R.select_by_id(stream, wanted).select("topic", "persistence_id", "seq_nr", "ticks", csv())
    control.tail_until(ordered.in_order(events, 2, asked, wait=30.0), f"{work}/out", checkpoint, asked)
    return spark.read.parquet(f"{work}/out").where(~F.col("end")).select("persistence_id", "seq_nr", "ticks", "tags_csv")


@query
def events_by_tag(spark, sf):
    return R.events_by_tag(W.journal_topic(spark, sf), "high").select(*EVENT, "ticks", csv())


@query
def events_by_tag_live(spark, sf):
    return _drained(spark, sf, "by-tag", lambda stream: R.select_by_tag(stream, "high"))


@query
def tag_index(spark, sf):
    """Events of a tag out of an index that a stream keeps, with a merge of its deltas in between."""
    work = fresh_dir(spark, "tag-index")
    own = W.journal_events(spark, sf)
    half = own.agg(F.max("event_id")).head()[0] // 2
    for batch, rows in enumerate((own.where(F.col("event_id") <= half), own.where(F.col("event_id") > half))):
        append_topic(J.encode_events(rows), f"{work}/topics", batch, ["event_id"], partitioner=F.col("part"))
        # the second run reads everything again, under a new checkpoint
        control.wait(tags.maintain_tags(SRC.stream_topics(spark, f"{work}/topics"), f"{work}/index", f"{work}/checkpoint-{batch}"))
        if batch == 0:
            tags.compact_tags(spark, f"{work}/index")
    return tags.events_by_tag(spark, f"{work}/index", "high").select("persistence_id", "seq_nr", "partition", "ticks", csv())


@query
def all_events(spark, sf):
    found = R.all_events(W.journal_topic(spark, sf))
    return found.select(*EVENT, "ticks", "manifest", "serializer_id", "format", "writer_uuid", csv())


@query
def all_events_live(spark, sf):
    return _drained(spark, sf, "all", R.select_all)


@query
def events_after_offset(spark, sf):
    records = W.journal_topic(spark, sf)
    third = F.call_function("div", F.max("offset") + 1, F.lit(3)).alias("start")
    seen = records.where("partition < 10").groupBy(*POSITION_KEYS).agg(third)
    return R.events_by_tag(records, "high", after=seen).select(*EVENT)


# --- snapshots ---


@query
def snapshot_save(spark, sf):
    saves = W.snapshot_log(spark, sf).where("kind = 'save'")
    return saves.select(
        "persistence_id", "seq_nr", "ticks", "partition", "offset", payload.json_text(F.col("payload")).alias("body")
    )


SNAPSHOT = ["persistence_id", "seq_nr", "ticks", "offset"]


@query
def snapshot_delete_seq(spark, sf):
    return S.live_keys(W.snapshot_log(spark, sf).where("kind <> 'del_range'")).select(*SNAPSHOT)


@query
def snapshot_delete_range(spark, sf):
    return S.live_keys(W.snapshot_log(spark, sf).where("kind <> 'del_seq'")).select(*SNAPSHOT)


@query
def snapshot_live_set(spark, sf):
    return S.live_snapshots(W.snapshot_log(spark, sf)).select(*SNAPSHOT)


@query
def snapshot_load(spark, sf):
    criteria = _customer_ids(spark, sf).select(
        "persistence_id",
        F.lit(11).cast("bigint").alias("min_seq"),
        (F.col("c_nationkey").cast("bigint") * 2 + 20).alias("max_seq"),
    )
    return S.load_snapshots(W.snapshot_log(spark, sf), criteria).select(*SNAPSHOT)


@query
def recover_all(spark, sf):
    best = S.newest(S.live_keys(W.snapshot_log(spark, sf)))
    return recovery.recover_all(
        _with_cents(W.journal(spark, sf)),
        W.index(spark, sf),
        best,
        W.marks(spark, sf),
        tail_cents=F.sum("cents"),
        first_tail_seq=F.min("seq_nr"),
        last_manifest=F.max_by("manifest", "offset"),
    ).drop("topic")


# --- envelopes and payloads ---


def _signed():
    """The event id made to cover both signs and all bytes."""
    return (F.col("event_id") % 2001 - 1000) * 4611686018427387


@query
def encode_headers(spark, sf):
    return W.events(spark, sf).select(
        "event_id",
        F.hex(codec.encode_long(_signed())).alias("long_hex"),
        F.hex(codec.encode_int((F.col("event_id") % 2001 - 1000).cast("int") * 2147483)).alias("int_hex"),
        F.hex(codec.encode_string(F.col("props"))).alias("string_hex"),
    )


@query
def decode_headers(spark, sf):
    headers = codec.build_headers(
        {
            "long": codec.encode_long(_signed()),
            "int": codec.encode_int((F.col("event_id") % 2001 - 1000).cast("int") * 2147483),
            "string": F.when(F.col("event_type") != "view", codec.encode_string(F.col("props"))),
        }
    )
    return (
        W.events(spark, sf)
        .select("event_id", headers.alias("headers"))
        .select(
            "event_id",
            codec.decode_long(codec.header("long")).alias("long_value"),
            codec.decode_int(codec.header("int")).alias("int_value"),
            codec.decode_string(codec.header("string")).alias("string_value"),
        )
    )


@query
def tags_codec(spark, sf):
    """Blanks go, empty tags go, and a comma splits a tag."""
    tags = F.array(
        F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")),
        F.when(F.col("amount") > 50, F.lit("high,value")).otherwise(F.lit(" ")),
        F.concat(F.lit("user "), F.col("user_id").cast("string")),
    )
    decoded = codec.decode_tags(codec.encode_tags(tags))
    return W.events(spark, sf).select("event_id", F.array_join(decoded, "|").alias("tags"), F.size(decoded).alias("n"))


@query
def header_project(spark, sf):
    records = W.journal_topic(spark, sf)
    return records.select(
        "partition",
        "offset",
        codec.decode_string(codec.header(CONTENT_TYPE)).alias("content_type"),
        codec.decode_long(codec.header(SEQ_NR)).alias("seq_header"),
        codec.decode_string(codec.header(MANIFEST)).alias("manifest"),
        codec.decode_string(codec.header(WRITER_UUID)).alias("writer_uuid"),
        F.array_join(codec.decode_tags(codec.header(TAGS)), ",").alias("tags_csv"),
    )


@query
def ticks_codec(spark, sf):
    ts = codec.ticks_to_timestamp(F.col("ticks"))
    return W.events(spark, sf).select(
        "event_id", "ticks", F.unix_micros(ts).alias("micros"), codec.ticks_from_timestamp(ts).alias("whole_ticks")
    )


@query
def content_type_split(spark, sf):
    kind = (
        F.when(F.col("event_type") == "purchase", "Application/X-Protobuf")
        .when(F.col("event_type") == "error", OPAQUE_TYPE)
        .when(F.col("event_type") == "click", JSON_TYPE)
    )
    headers = codec.build_headers({CONTENT_TYPE: codec.encode_string(kind)})
    return W.events(spark, sf).select("event_id", codec.content_format(headers).alias("format"))


@query
def wire_frame(spark, sf):
    framed = codec.frame(F.col("user_id") * 65537, codec.encode_string(F.col("props")))
    return (
        W.events(spark, sf)
        .select("event_id", framed.alias("value"))
        .select(
            "event_id",
            codec.is_framed(F.col("value")).alias("framed"),
            codec.frame_schema_id(F.col("value")).alias("schema_id"),
            codec.decode_string(codec.frame_payload(F.col("value"))).alias("body"),
        )
    )


@query
def json_decode(spark, sf):
    """Typed by manifest where the type is known, else generic."""
    known = {"Shop.Events.Purchase": BODY, "Shop.Events.Click": BODY}
    journal = W.journal(spark, sf).where("format = 'json'")
    typed = payload.decode_by_manifest(journal, known)
    generic = payload.decode_json(F.col("payload"))
    return typed.select(
        "persistence_id",
        "seq_nr",
        F.col("data.Shop_Events_Purchase.cents").alias("purchase_cents"),
        F.col("data.Shop_Events_Click.eventId").alias("click_event_id"),
        F.try_variant_get(generic, "$.eventId", "bigint").alias("event_id"),
        F.try_variant_get(generic, "$.props", "string").alias("props"),
    )


@query
def json_encode(spark, sf):
    text = payload.encode_json(
        {"EventId": F.col("event_id"), "user_id": F.col("user_id"), "EventType": F.col("event_type"), "URLValue": F.col("props"),
         "ID": F.when(F.col("event_id") % 3 > 0, F.col("event_id"))}
    )
    return W.events(spark, sf).select("event_id", text.alias("body"))


@query
def derive_schemas(spark, sf):
    payloads = W.events(spark, sf).select(
        F.concat(F.lit("Shop.Events."), F.initcap("event_type")).alias("manifest"), F.col("props").alias("json")
    )
    return schemas.derive_schemas(schemas.observed_fields(payloads))


@query
def subject_names(spark, sf):
    strategy = F.element_at(
        F.array(*[F.lit(s) for s in ("topic-name", "record-name", "topic-record-name", "other")]),
        (F.col("user_id") % 4 + 1).cast("int"),
    )
    record = F.concat(F.lit("Shop.Events."), F.initcap("event_type"))
    return W.events(spark, sf).select("event_id", naming.subject_name(strategy, JOURNAL_TOPIC, record).alias("subject"))


def _subject():
    return naming.subject_name("record-name", JOURNAL_TOPIC, F.col("event_type"))


def _registry(spark, sf):
    """One schema version per distinct (event type, length of props) seen; views are missing."""
    seen = W.events(spark, sf).where("event_type <> 'view'").groupBy(_subject().alias("subject")).agg(
        F.countDistinct(F.length("props")).alias("versions")
    )
    return seen.select(
        "subject", F.explode(F.sequence(F.lit(1), F.col("versions").cast("int"))).alias("version"), "versions"
    ).select(
        "subject",
        "version",
        (F.length("subject") * 100 + F.col("version")).alias("id"),
        F.lit("JSON").alias("type"),
        F.concat(F.lit("v"), F.col("version").cast("string")).alias("schema"),
    )


@query
def resolve_schema(spark, sf):
    records = W.events(spark, sf).select("event_id", _subject().alias("subject"))
    return schemas.resolve_schema(records, _registry(spark, sf))


@query
def register_schemas(spark, sf):
    wanted = W.events(spark, sf).select(
        _subject().alias("subject"),
        F.lit("JSON").alias("type"),
        F.concat(F.lit("v"), F.length("props").cast("string")).alias("schema"),
    )
    return schemas.register_schemas(wanted, _registry(spark, sf))


@query
def event_serialize(spark, sf):
    encoded = J.encode_events(W.journal_events(spark, sf))
    return encoded.select(
        "event_id",
        "key",
        codec.decode_string(codec.header(CONTENT_TYPE)).alias("content_type"),
        codec.decode_string(codec.header(MANIFEST)).alias("manifest"),
        codec.decode_long(codec.header(SEQ_NR)).alias("seq_nr"),
        F.array_join(codec.decode_tags(codec.header(TAGS)), ",").alias("tags_csv"),
        F.when(codec.is_framed(F.col("value")), codec.frame_schema_id(F.col("value"))).alias("schema_id"),
        payload.json_text(F.col("value")).alias("body"),
    )


@query
def snapshot_decode(spark, sf):
    best = S.load_snapshots(W.snapshot_log(spark, sf))
    state = payload.decode_json(F.col("payload"), BODY)
    return best.select(
        "persistence_id", "seq_nr", "manifest", "format", state["eventId"].alias("event_id"), state["cents"].alias("cents")
    )
