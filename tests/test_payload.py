import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.functions import codec, payload
from spoolway.operators import journal as J
from spoolway.operators import schemas as R


def test_json_encode_is_compact_and_camel_case(spark):
    df = spark.createDataFrame([(1, "x")], "EventId int, user_name string")
    text = df.select(payload.encode_json({"EventId": F.col("EventId"), "user_name": F.col("user_name")})).head()[0]
    assert text == '{"eventId":1,"user_name":"x"}'
    nulls = df.select(payload.encode_json({"URLValue": F.lit(None).cast("string"), "ID": F.col("EventId")})).head()[0]
    assert nulls == '{"urlValue":null,"id":1}'


def test_json_decode_with_and_without_a_type(spark):
    body = b'{"a":1,"b":["x"]}'
    rows = [(body,), (b"\x00\x00\x00\x00\x07" + body,)]
    df = spark.createDataFrame(rows, "value binary").select(
        payload.decode_json(F.col("value"), "a int, b array<string>").alias("typed"),
        payload.decode_json(F.col("value")).alias("generic"),
    )
    for row in df.select("typed", F.try_variant_get("generic", "$.b[0]", "string").alias("b0")).collect():
        assert (row.typed.a, row.typed.b, row.b0) == (1, ["x"], "x")


def test_one_journal_may_hold_json_protobuf_and_opaque_records(spark):
    kinds = {"application/json": "json", "application/x-protobuf": "protobuf", "application/x-hyperion": "opaque"}
    rows = [(k, f"{{\"a\":{i}}}".encode(), i + 1) for i, k in enumerate(kinds)]
    events = spark.createDataFrame(rows, "content_type string, payload binary, seq_nr bigint").select(
        "*", F.lit("p").alias("persistence_id"), F.array().cast("array<string>").alias("tags"), F.lit("M.A").alias("manifest"),
        F.lit("w").alias("writer_uuid"), F.lit(10**17).alias("ticks"), F.lit(-3).alias("serializer_id"),
    )
    records = J.encode_events(events).withColumns({**codec.promoted(), "partition": F.lit(0), "offset": F.lit(0)})
    journal = J.decode_journal(records)
    got = payload.decode_by_manifest(journal, {"M.A": "a int"}).orderBy("seq_nr").collect()
    assert [r.format for r in got] == list(kinds.values())
    assert [r.data.M_A.a if r.data.M_A else None for r in got] == [0, None, None]
    assert {r.serializer_id for r in got} == {-3} and {r.writer_uuid for r in got} == {"w"}


def protobuf_schema() -> str:
    """A one-message file: ``shop.Event { int64 event_id = 1; int64 cents = 2; string props = 3; }``."""
    from google.protobuf import descriptor_pb2

    kinds = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(name="shop.proto", package="shop", syntax="proto3")
    message = file.message_type.add(name="Event")
    for number, (name, kind) in enumerate(
        [("event_id", kinds.TYPE_INT64), ("cents", kinds.TYPE_INT64), ("props", kinds.TYPE_STRING)], start=1
    ):
        message.field.add(name=name, number=number, type=kind, label=kinds.LABEL_OPTIONAL)
    return payload.schema_reference(file.SerializeToString())


def test_protobuf_round_trip(spark):
    pytest.importorskip("google.protobuf")

    fields = T.StructType.fromDDL("event_id bigint, cents bigint, props string")
    rows = [(1, -5, "x"), (2**62, 0, "\U0001f600" * 100), (3, None, None)]
    df = spark.createDataFrame(rows, fields)
    coded = payload.encode_protobuf(df, protobuf_schema(), "shop.Event", fields.names).select("payload")
    back = payload.decode_protobuf(coded, protobuf_schema(), "shop.Event", fields)
    got = sorted((r.event_id, r.cents, r.props) for r in back.collect())
    assert got == [(1, -5, "x"), (3, 0, ""), (2**62, 0, "\U0001f600" * 100)]


def test_schemas_are_derived_from_every_payload(spark):
    rows = [("a.B", '{"n":1,"s":"x","t":true,"o":{"z":1},"d":1.5}'), ("a.B", '{"n":2.5,"s":null,"l":[1]}'), ("C", '{"m":1}'),
            ("C", '{"m":"x"}')]
    fields = R.observed_fields(spark.createDataFrame(rows, "manifest string, json string"))
    documents = {r.manifest: json.loads(r.schema) for r in R.derive_schemas(fields).collect()}
    assert documents["a.B"] == {
        "$schema": "http://json-schema.org/draft-07/schema#",
        "title": "B",
        "type": "object",
        "properties": {"d": {"type": "number"}, "l": {"type": "object"}, "n": {"type": "number"}, "o": {"type": "object"},
                       "s": {"type": "string"}, "t": {"type": "boolean"}},
        "required": ["d", "l", "n", "o", "s", "t"],
    }
    assert documents["C"]["properties"] == {"m": {"type": "object"}}
    kinds = {f.name: f.dataType for f in R.spark_type(json.dumps(documents["a.B"]))}
    assert kinds["n"] == T.DoubleType() and kinds["s"] == T.StringType() and kinds["o"] == T.VariantType()


def test_schema_document_of_a_type():
    fields = T.StructType.fromDDL(
        "EventId bigint, small smallint, price decimal(9,2), ratio float, at timestamp, ok boolean, tags array<string>, name string"
    )
    document = json.loads(R.schema_document("Sale", fields))
    assert {n: p["type"] for n, p in document["properties"].items()} == {
        "eventId": "integer", "small": "integer", "price": "number", "ratio": "number", "at": "string", "ok": "boolean",
        "tags": "object", "name": "string",
    }
    assert document["title"] == "Sale" and document["required"] == list(document["properties"])


def test_registry(spark):
    schemas = spark.createDataFrame(
        [("s", 1, 10, "JSON", "v1"), ("s", 2, 11, "JSON", "v2"), ("r", 1, 12, "JSON", "w1")],
        "subject string, version int, id int, type string, schema string",
    )
    records = spark.createDataFrame([("s",), ("r",), ("q",)], "subject string")
    assert {r.subject: r.schema_id for r in R.resolve_schema(records, schemas).collect()} == {"s": 11, "r": 12, "q": None}
    assert [r.subject for r in R.unresolved(records, schemas).collect()] == ["q"]
    wanted = spark.createDataFrame([("s", "JSON", "v1"), ("s", "JSON", "v3"), ("q", "JSON", "x"), ("q", "JSON", "x")], "subject string, type string, schema string")
    added = sorted((r.subject, r.version, r.id, r.schema) for r in R.register_schemas(wanted, schemas).collect())
    assert added == [("q", 1, 13, "x"), ("s", 3, 14, "v3")]
    assert R.register_schemas(spark.createDataFrame([("z", "JSON", "y")], wanted.schema), schemas.where("id < 0")).head().id == 1
