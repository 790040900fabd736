"""Payload codecs: JSON in the JVM, protobuf by Arrow batches."""

import base64
import string
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.functions import codec

# JSON-schema type names and their Spark types.
JSON_KINDS = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "number": T.DoubleType(),
    "boolean": T.BooleanType(),
    "object": T.VariantType(),
}


def camel_case(name: str) -> str:
    """``EventId`` becomes ``eventId``, ``URLValue`` ``urlValue``, ``ID`` ``id``; ``event_id`` stays.

    The capitals at the front are lowered, but not the last of several with a word after it.
    """
    capitals = len(name) - len(name.lstrip(string.ascii_uppercase))
    if 1 < capitals < len(name):
        capitals -= 1
    return name[:capitals].lower() + name[capitals:]


def encode_json(fields: Mapping[str, Column]) -> Column:
    """Compact JSON text of the given fields, with names in camel case; nulls are written."""
    named = F.struct(*[column.alias(camel_case(name)) for name, column in fields.items()])
    return F.to_json(named, {"ignoreNullFields": "false"})


def json_text(value: Column) -> Column:
    """JSON text of a value, without its registry frame if there is one."""
    return codec.decode_string(F.when(codec.is_framed(value), codec.frame_payload(value)).otherwise(value))


def decode_json(value: Column, schema: T.StructType | str | None = None) -> Column:
    """A struct of the known type, else a variant."""
    text = json_text(value)
    return F.try_parse_json(text) if schema is None else F.from_json(text, schema)


def decode_by_manifest(journal: DataFrame, types: Mapping[str, T.StructType | str]) -> DataFrame:
    """One column ``data`` of structs, each manifest parsed by its own type, in one pass."""
    parsed = [
        F.when((F.col("format") == "json") & (F.col("manifest") == manifest), decode_json(F.col("payload"), schema))
        .alias(manifest.replace(".", "_"))
        for manifest, schema in types.items()
    ]
    return journal.withColumn("data", F.struct(*parsed))


def schema_reference(file_descriptor: bytes) -> str:
    """The text stored as a protobuf type's schema: its file descriptor in base64."""
    return base64.b64encode(file_descriptor).decode("ascii")


def _message_class(reference: str, message: str):
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    file = descriptor_pb2.FileDescriptorProto.FromString(base64.b64decode(reference))
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(message))


def decode_protobuf(df: DataFrame, reference: str, message: str, schema: T.StructType, column: str = "payload") -> DataFrame:
    """Add the fields of one message type, read from ``column``; the base64 text is its schema."""
    names = schema.names

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = _message_class(reference, message)
        for batch in batches:
            messages = [None if data is None else parser.FromString(bytes(data)) for data in batch[column]]
            # as objects: a null payload gives null fields, and whole numbers stay exact
            yield batch.assign(
                **{name: pd.Series([m and getattr(m, name) for m in messages], dtype=object, index=batch.index) for name in names}
            )

    return df.mapInPandas(parse, T.StructType([*df.schema.fields, *schema.fields]))


def encode_protobuf(df: DataFrame, reference: str, message: str, fields: list[str], column: str = "payload") -> DataFrame:
    """Add ``column`` with the message made of the named fields; null fields stay unset."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factory = _message_class(reference, message)
        for batch in batches:
            rows = batch[fields].to_dict("records")
            yield batch.assign(
                **{
                    column: [
                        factory(**{k: v for k, v in row.items() if not pd.isna(v)}).SerializeToString() for row in rows
                    ]
                }
            )

    return df.mapInPandas(build, T.StructType([*df.schema.fields, T.StructField(column, T.BinaryType())]))
