import re

import pytest
from pyspark.sql import functions as F

from spoolway import schema as S
from spoolway.functions import codec, naming, payload

LONGS = [0, 1, -1, -(2**63), 2**63 - 1, 255, 256, -256, 3**39]
INTS = [0, 1, -1, -(2**31), 2**31 - 1, 255, -65536]
STRINGS = ["", " ", "plain", "tab\there", "žluť, 日本", "\x00", "\U0001f9f5 thread"]


def test_long_round_trip_is_big_endian(spark):
    df = spark.createDataFrame([(v,) for v in LONGS], "v bigint").withColumn("b", codec.encode_long(F.col("v")))
    for row in df.withColumn("back", codec.decode_long(F.col("b"))).collect():
        assert bytes(row.b) == row.v.to_bytes(8, "big", signed=True)
        assert row.back == row.v


def test_int_round_trip_is_big_endian(spark):
    df = spark.createDataFrame([(v,) for v in INTS], "v int").withColumn("b", codec.encode_int(F.col("v")))
    for row in df.withColumn("back", codec.decode_int(F.col("b"))).collect():
        assert bytes(row.b) == row.v.to_bytes(4, "big", signed=True)
        assert row.back == row.v


def test_string_round_trip(spark):
    df = spark.createDataFrame([(v,) for v in STRINGS], "v string")
    rows = df.withColumn("back", codec.decode_string(codec.encode_string(F.col("v")))).collect()
    assert all(row.back == row.v for row in rows)


@pytest.mark.parametrize(
    "text, tags",
    [
        ("red,green,deep blue", ["red", "green", "deep blue"]),
        ("", []),
        (" red,  green ,deep blue   ", ["red", "green", "deep blue"]),
        (",,a,\t,b", ["a", "b"]),
    ],
)
def test_tags(spark, text, tags):
    df = spark.createDataFrame([(text, tags)], "text string, tags array<string>")
    row = df.select(
        codec.decode_tags(codec.encode_string(F.col("text"))).alias("decoded"),
        codec.decode_tags(codec.encode_tags(F.col("tags"))).alias("again"),
    ).head()
    assert row.decoded == tags and row.again == tags


def test_a_comma_splits_a_tag(spark):
    df = spark.createDataFrame([(["a,b"],)], "tags array<string>")
    assert df.select(codec.decode_tags(codec.encode_tags(F.col("tags")))).head()[0] == ["a", "b"]


def test_header_names():
    # fixed values: names on the wire
    assert (S.SEQ_NR, S.MANIFEST, S.TAGS, S.WRITER_UUID, S.TIMESTAMP) == (
        "akka-seq-nr",
        "akka-manifest",
        "akka-tags",
        "akka-writer-uuid",
        "akka-timestamp",
    )
    assert (S.SERIALIZER_ID, S.SNAPSHOT_SEQ_NR, S.SNAPSHOT_TIMESTAMP) == (
        "akka-serializer-id",
        "akka-snapshot-seq-nr",
        "akka-snapshot-timestamp",
    )


def test_ticks_span_all_years(spark):
    values = [0, 1, S.UNIX_EPOCH_TICKS - 1, S.UNIX_EPOCH_TICKS, S.UNIX_EPOCH_TICKS + 19, S.MAX_TICKS]
    df = spark.createDataFrame([(v,) for v in values], "t bigint")
    rows = df.select("t", codec.ticks_to_timestamp(F.col("t")).cast("string").alias("ts"),
                     codec.ticks_to_micros(F.col("t")).alias("us")).collect()
    assert rows[0].ts == "0001-01-01 00:00:00" and rows[-1].ts == "9999-12-31 23:59:59.999999"
    assert [r.us for r in rows] == [(v - S.UNIX_EPOCH_TICKS) // 10 for v in values]


def test_zoneless_time_does_not_follow_the_session_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.123456' as ts")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(codec.ntz_micros(F.col("ts"))).head()[0] == 1710037800123456
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_frame(spark):
    df = spark.createDataFrame([(7, b"{}"), (2**31 - 1, b""), (300, b"\x00\x00")], "id int, body binary")
    framed = df.withColumn("value", codec.frame(F.col("id"), F.col("body")))
    for row in framed.select(
        "*", codec.frame_schema_id(F.col("value")).alias("i"), codec.frame_payload(F.col("value")).alias("p")
    ).collect():
        assert bytes(row.value) == b"\x00" + row.id.to_bytes(4, "big") + bytes(row.body)
        assert (row.i, bytes(row.p)) == (row.id, bytes(row.body))


def test_content_type_dispatch(spark):
    kinds = {"application/x-protobuf": "protobuf", "APPLICATION/X-PROTOBUF": "protobuf", "application/json": "json",
             "application/x-hyperion": "opaque", None: "json"}
    df = spark.createDataFrame([(k,) for k in kinds], "kind string")
    headers = codec.build_headers({S.CONTENT_TYPE: codec.encode_string(F.col("kind"))})
    for row in df.select("kind", codec.content_format(headers).alias("format")).collect():
        assert row.format == kinds[row.kind]


def test_names(spark):
    row = spark.range(1).select(
        naming.topic_name("akka-journal", "north.").alias("a"),
        naming.topic_name("akka-journal").alias("b"),
        naming.tag_topic_name("red", "t-").alias("c"),
        naming.subject_name("topic-name", "t", "R").alias("d"),
        naming.subject_name("record-name", "t", "R").alias("e"),
        naming.subject_name("recordname", "t", "R").alias("f"),
    ).head()
    assert tuple(row) == ("north.akka-journal", "akka-journal", "t-akka-journal-tag-red", "t-value", "R", "t-R")


def test_camel_case():
    assert [payload.camel_case(n) for n in ("EventId", "event_id", "id", "someURL", "URLValue", "ID", "")] == [
        "eventId", "event_id", "id", "someURL", "urlValue", "id", ""
    ]


def test_codecs_stay_in_the_jvm(spark):
    df = spark.range(1).select(
        codec.decode_long(codec.encode_long(F.col("id"))), codec.decode_tags(codec.encode_tags(F.array(F.lit("a"))))
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow", plan)
