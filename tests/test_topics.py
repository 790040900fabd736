import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.operators import commits as C
from spoolway.operators import produce as P
from spoolway.schema import SEQ_NR, TAGS, TOPIC
from spoolway.sinks import topics as SINK
from spoolway.sources import topics as SRC
from spoolway.sources.subscriptions import Assignment, AssignmentWithOffset, TopicPattern, Topics
from spoolway.functions import codec


def records(spark, n=200, topic="t", start=0):
    return spark.range(start, start + n).select(
        "id",
        F.lit(topic).alias("topic"),
        F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("key"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("value"),
    )


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("topics"))
    for batch, topic in enumerate(["akka-a", "akka-b", "other"]):
        SINK.append_topic(records(spark, topic=topic), root, batch, ["id"], 4, F.col("id") % 4)
    return root


def content(df):
    return sorted((r.topic, r.partition, r.offset, r.key, bytes(r.value)) for r in df.collect())


def files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan.toString())
    return scans, df.select("*").inputFiles()


def test_scan_by_name_and_pattern(spark, root):
    assert SRC.read_topics(spark, root, Topics(["akka-a", "other"])).count() == 400
    assert SRC.read_topics(spark, root, TopicPattern("akka-.*")).count() == 400
    # the whole name has to match
    assert SRC.read_topics(spark, root, TopicPattern("akka")).count() == 0
    assert SRC.read_topics(spark, root).count() == 600


def test_assignments_prune_folders(spark, root):
    df = SRC.read_topics(spark, root, Assignment([("akka-a", 1), ("akka-b", 2)]))
    assert {(r.topic, r.partition) for r in df.collect()} == {("akka-a", 1), ("akka-b", 2)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "topic" in plan.split("PartitionFilters")[1]
    metrics = [p for p in plan_nodes(df) if "FileScan" in p.nodeName() or "Scan parquet" in p.nodeName()]
    assert metrics[0].metrics().apply("numFiles").value() == 2


def plan_nodes(df):
    def walk(node):
        yield node
        children = node.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            yield from walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            yield from walk(node.plan())

    return list(walk(df._jdf.queryExecution().executedPlan()))


def test_assigned_offset_is_inclusive_and_reaches_the_scan(spark, root):
    df = SRC.read_topics(spark, root, AssignmentWithOffset([("akka-a", 1, 48), ("akka-b", 0, 0)]))
    got = {(r.topic, r.partition, r.offset) for r in df.collect()}
    assert got == {("akka-a", 1, 48), ("akka-a", 1, 49)} | {("akka-b", 0, o) for o in range(50)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "offset" in plan.split("PushedFilters")[1] if "PushedFilters" in plan else "offset" in plan


def test_positions_prune_and_keep_others(spark, root):
    df = SRC.read_topics(spark, root, Topics(["akka-a"]))
    positions = spark.createDataFrame([("akka-a", 2, 10)], "topic string, partition int, start bigint")
    assert {r.offset for r in SRC.from_positions(df, positions).collect()} == set(range(10, 50))
    after = SRC.from_positions(df, positions, inclusive=False, others="keep").collect()
    assert {r.offset for r in after if r.partition == 2} == set(range(11, 50))
    assert sum(r.partition != 2 for r in after) == 150


def test_many_positions_are_joined(spark, root, monkeypatch):
    df = SRC.read_topics(spark, root, Topics(["akka-a"]))
    positions = spark.createDataFrame([("akka-a", p, 5) for p in range(4)], "topic string, partition int, start bigint")
    want = content(SRC.from_positions(df, positions))
    monkeypatch.setattr(SRC, "MAX_POSITIONS", 2)
    assert content(SRC.from_positions(df, positions)) == want and len(want) == 180


def test_a_repeated_batch_repeats_its_offsets(spark, tmp_path):
    root = str(tmp_path / "t")
    SINK.append_topic(records(spark), root, 0, ["id"], 3)
    SINK.append_topic(records(spark, start=200), root, 1, ["id"], 3)
    before = content(SRC.read_topics(spark, root))
    for batch, start in ((1, 200), (0, 0)):
        SINK.append_topic(records(spark, start=start), root, batch, ["id"], 3)
        assert content(SRC.read_topics(spark, root)) == before
    assert {len(rows) for rows in by_partition(before)} and all(
        [o for *_, o in rows] == list(range(len(rows))) for rows in by_partition(before)
    )


def by_partition(rows):
    parts = {}
    for topic, partition, offset, *_ in rows:
        parts.setdefault((topic, partition), []).append((topic, partition, offset))
    return [sorted(p, key=lambda r: r[2]) for p in parts.values()]


@pytest.mark.parametrize("rows_per_task", [10_000, 20])
def test_offsets_follow_the_order_however_they_are_split(spark, tmp_path, rows_per_task):
    root = str(tmp_path / "t")
    SINK.append_topic(records(spark, 500).repartition(5), root, 0, ["id"], 2, F.col("id") % 2, rows_per_task)
    got = sorted((r.partition, r.offset, int(bytes(r.value))) for r in SRC.read_topics(spark, root).collect())
    assert got == [(p, o, 2 * o + p) for p in range(2) for o in range(250)]


def test_uncommitted_batches_are_invisible(spark, tmp_path):
    root = str(tmp_path / "t")
    assert SRC.read_topics(spark, root).count() == 0
    SINK.append_topic(records(spark, 10), root, 0, ["id"], 1)
    rows = SINK.write_batch(SINK.place(records(spark, 10, start=10), ["id"], 1), root, 1)
    assert SRC.read_topics(spark, root).count() == 10
    SINK.commit_batch(rows, root, 1)
    assert SRC.read_topics(spark, root).count() == 20


def test_keys_share_a_partition_and_missing_keys_spread(spark):
    keyed = SINK.place(records(spark).drop("offset"), ["id"], 8).groupBy("key").agg(F.countDistinct("partition").alias("n"))
    assert {r.n for r in keyed.collect()} == {1}
    loose = SINK.place(records(spark).withColumn("key", F.lit(None).cast("string")), ["id"], 8)
    assert loose.select("partition").distinct().count() == 8


def test_writing_adds_no_sort_after_the_offsets(spark, tmp_path):
    placed = SINK.place(records(spark), ["id"], 4)
    plan = SINK.as_topic(placed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1


def test_kafka_rows_become_topic_rows(spark):
    kafka = T.StructType.fromDDL(
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp,"
        " timestampType int, headers array<struct<key:string,value:binary>>"
    )
    headers = [(SEQ_NR, (5).to_bytes(8, "big")), (TAGS, b"x"), (TAGS, b"a, b")]
    rows = [(b"id", b"body", "t", 1, 9, None, 0, headers), (None, b"", "t", 1, 10, None, 0, None)]
    first, second = SRC.from_kafka(spark.createDataFrame(rows, kafka)).orderBy("offset").collect()
    assert (first.key, first.seq_nr, first.tags, first.size) == ("id", 5, ["a", "b"], 4)
    assert (second.key, second.seq_nr, second.size) == (None, None, 0)


def test_kafka_options():
    assert Topics(["a", "b"]).kafka_options() == {"subscribe": "a,b"}
    assert TopicPattern("akka-.*").kafka_options() == {"subscribePattern": "akka-.*"}
    assert Assignment([("a", 0), ("a", 1)]).kafka_options() == {"assign": '{"a": [0, 1]}'}
    assert AssignmentWithOffset([("a", 0, 42)]).kafka_options() == {
        "assign": '{"a": [0]}',
        "startingOffsets": '{"a": {"0": 42}}',
    }


def test_the_committed_value_is_the_next_offset(spark):
    row = spark.createDataFrame([("test-topic", 0, 42, "key1")], "topic string, partition int, offset bigint, key string")
    got = SRC.committable(row, "g").head()
    assert (got.group_id, got.next_offset) == ("g", 43)


def test_every_partition_of_a_batch_is_committed(spark):
    rows = [("t", p, o) for p in range(3) for o in range(5)]
    offsets = SRC.committable(spark.createDataFrame(rows, "topic string, partition int, offset bigint"), "g")
    assert {(r.partition, r.next_offset) for r in C.commit_ledger(offsets).collect()} == {(0, 5), (1, 5), (2, 5)}
    batched = C.batch_commits(C.commit_batches(offsets, size=2)).collect()
    assert {(r.partition, r.commit_batch, r.next_offset, r.records) for r in batched} == {
        (p, b, min(2 * b + 2, 5), min(2, 5 - 2 * b)) for p in range(3) for b in range(3)
    }


def test_resume(spark, root):
    df = SRC.read_topics(spark, root, Topics(["akka-a"]))
    edges = SINK.edges(spark, root).where("topic = 'akka-a'")
    ledger = spark.createDataFrame(
        [("g", "akka-a", 0, 30), ("other", "akka-a", 1, 49)], "group_id string, topic string, partition int, next_offset bigint"
    )
    latest = {(r.partition, r.offset) for r in C.resume(df, edges, ledger, "g").collect()}
    assert latest == {(0, o) for o in range(30, 50)}
    earliest = {(r.partition, r.offset) for r in C.resume(df, edges, ledger, "g", "earliest").collect()}
    assert earliest == latest | {(p, o) for p in (1, 2, 3) for o in range(50)}


def test_partition_running_and_segments(spark, root):
    df = SRC.read_topics(spark, root, Topics(["akka-a"]))
    got = SRC.partition_running(df, {"n": F.lit(1).cast("bigint")}, rows_per_task=7).collect()
    assert all(r.n == r.offset + 1 for r in got) and len(got) == 200

    def count(batches):
        for batch in batches:
            yield batch.groupby(["partition", "segment"], as_index=False).agg(
                first=("offset", "min"), last=("offset", "max"), ordered=("offset", lambda o: o.is_monotonic_increasing)
            )[["partition", "segment", "first", "last", "ordered"]]

    schema = "partition int, segment bigint, first bigint, last bigint, ordered boolean"
    segments = SRC.partition_segments(df.select("topic", "partition", "offset"), count, schema, 20).collect()
    assert sorted((r.partition, r.segment, r.first, r.last) for r in segments) == [
        (p, s, 20 * s, min(20 * s + 19, 49)) for p in range(4) for s in range(3)
    ]
    assert all(r.ordered for r in segments)


def test_typed_append_and_scan(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "hello"), (2, "world")], "n int, word string")
    typed = SINK.typed_append(
        rows.withColumn("topic", F.lit("t")), key=F.col("n").cast("string"), value=F.encode(F.to_json(F.struct("word")), "UTF-8")
    )
    SINK.append_topic(typed, root, 0, ["n"], 1)
    got = SRC.typed_scan(
        SRC.read_topics(spark, root), key=F.col("key").cast("int"), value=F.from_json(F.decode("value", "UTF-8"), "word string")
    )
    assert sorted((r.key, r.value.word) for r in got.collect()) == [(1, "hello"), (2, "world")]


def test_headers_survive(spark, tmp_path):
    root = str(tmp_path / "t")
    headers = codec.build_headers(
        {"content-type": codec.encode_string(F.lit("application/json")), "custom-header": codec.encode_string(F.lit("test-value"))}
    )
    row = spark.range(1).select("id", F.lit("t").alias("topic"), F.lit("k").alias("key"), F.encode(F.lit('{"msg":"test"}'), "UTF-8").alias("value"), headers.alias("headers"))
    SINK.append_topic(row, root, 0, ["id"], 1)
    got = SRC.read_topics(spark, root).head()
    assert {k: bytes(v) for k, v in got.headers.items()} == {"content-type": b"application/json", "custom-header": b"test-value"}
    assert SRC.read_topics(spark, root).schema.names == TOPIC.names


def test_produce_single_multi_and_pass_through(spark, tmp_path):
    root = str(tmp_path / "t")
    envelopes = spark.createDataFrame([(1, 42), (2, 7), (3, 9)], "envelope_id bigint, pass_through int")
    record = "envelope_id bigint, pos bigint, topic string, key string, value binary"
    rows = [(1, 0, "out", "a", b"1"), (1, 1, "out", "b", b"2"), (2, 0, "out", "a", b"3")]
    results = P.produce(envelopes, spark.createDataFrame(rows, record), root, 0, 1)
    got = sorted((r.envelope_id, r.pass_through, r.kind, r.topic, r.offset) for r in results.collect())
    assert got == [(1, 42, "record", "out", 0), (1, 42, "record", "out", 1), (2, 7, "record", "out", 2),
                   (3, 9, "pass_through", None, None)]
    grouped = {r.envelope_id: [(x.topic, x.partition, x.offset) for x in r.results] for r in P.regroup(results).collect()}
    assert grouped == {1: [("out", 0, 0), ("out", 0, 1)], 2: [("out", 0, 2)], 3: []}
    assert [bytes(r.value) for r in SRC.read_topics(spark, root).orderBy("offset").collect()] == [b"1", b"2", b"3"]
