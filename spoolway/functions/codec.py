"""Header, tag, tick and frame codecs as column expressions; all of them run in the JVM."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from spoolway.schema import CONTENT_TYPE, SEQ_NR, TAGS, UNIX_EPOCH_TICKS


def encode_long(value: Column) -> Column:
    """8 bytes, big-endian, two's complement."""
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))


def decode_long(data: Column) -> Column:
    return F.conv(F.hex(data), 16, -10).cast("bigint")


def encode_int(value: Column) -> Column:
    """4 bytes, big-endian, two's complement."""
    return F.unhex(F.right(F.lpad(F.hex(value.cast("bigint")), 16, "0"), F.lit(8)))


def decode_int(data: Column) -> Column:
    digits = F.hex(data)
    # conv works on 64 bits, so a set sign bit has to be carried to the upper half
    extended = F.when(F.substring(digits, 1, 1) >= "8", F.concat(F.lit("FFFFFFFF"), digits)).otherwise(digits)
    return F.conv(extended, 16, -10).cast("int")


def encode_string(value: Column) -> Column:
    return F.encode(value, "UTF-8")


def decode_string(data: Column) -> Column:
    return F.decode(data, "UTF-8")


def encode_tags(tags: Column) -> Column:
    return encode_string(F.array_join(tags, ","))


def split_tags(text: Column) -> Column:
    trimmed = F.transform(F.split(text, ","), lambda tag: F.btrim(tag, F.lit(" \t\r\n")))
    return F.filter(trimmed, lambda tag: tag != "")


def decode_tags(data: Column) -> Column:
    return split_tags(decode_string(data))


def header(name: str, headers: str | Column = "headers") -> Column:
    """Header bytes, or null where the record has no such header."""
    column = F.col(headers) if isinstance(headers, str) else headers
    return F.element_at(column, F.lit(name))


def promoted() -> dict[str, Column]:
    """The topic columns that repeat parts of a record's headers and value."""
    return {
        "seq_nr": decode_long(header(SEQ_NR)),
        "tags": decode_tags(header(TAGS)),
        "size": F.octet_length("value"),
    }


def build_headers(values: Mapping[str, Column]) -> Column:
    """A header map without the entries whose value is null."""
    entries = F.array(*[F.struct(F.lit(name).alias("key"), value.alias("value")) for name, value in values.items()])
    return F.map_from_entries(F.filter(entries, lambda entry: entry["value"].isNotNull()))


def ticks_from_timestamp(ts: Column) -> Column:
    return F.unix_micros(ts) * 10 + F.lit(UNIX_EPOCH_TICKS)


def ticks_to_micros(ticks: Column) -> Column:
    """Unix microseconds, rounded towards the past (ticks are ten times finer)."""
    since_epoch = ticks - F.lit(UNIX_EPOCH_TICKS)
    return F.call_function("div", since_epoch - F.pmod(since_epoch, F.lit(10)), F.lit(10))


def ticks_to_timestamp(ticks: Column) -> Column:
    return F.timestamp_micros(ticks_to_micros(ticks))


def ntz_micros(ts: Column) -> Column:
    """Unix microseconds of a zone-less timestamp read as UTC, whatever the session zone is."""
    seconds = (ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")
    return (seconds.cast("decimal(20,6)") * 1000000).cast("bigint")


def frame(schema_id: Column, payload: Column) -> Column:
    """Registry frame: a zero byte, the 4-byte schema id, the payload."""
    return F.concat(F.unhex(F.lit("00")), encode_int(schema_id), payload)


def is_framed(value: Column) -> Column:
    return (F.octet_length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == "00")


def frame_schema_id(value: Column) -> Column:
    return decode_int(F.substring(value, 2, 4))


def frame_payload(value: Column) -> Column:
    return F.substring(value, F.lit(6), F.octet_length(value))


def content_format(headers: str | Column = "headers") -> Column:
    """``protobuf``, ``opaque`` or, as the default, ``json``."""
    kind = F.lower(decode_string(header(CONTENT_TYPE, headers)))
    return F.when(kind.contains("protobuf"), "protobuf").when(kind.contains("hyperion"), "opaque").otherwise("json")
