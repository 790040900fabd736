"""Schema registry as a table ``schemas(subject, version, id, type, schema)``."""

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.functions.payload import JSON_KINDS, camel_case
from spoolway.operators.skew import MAX_SMALL_ROWS, skew_join
from spoolway.scratch import stored

# Fixed value: the dialect named in derived documents.
JSON_SCHEMA_DIALECT = "http://json-schema.org/draft-07/schema#"


def latest_schemas(schemas: DataFrame) -> DataFrame:
    """The highest version of each subject."""
    return (
        schemas.groupBy("subject")
        .agg(F.max_by(F.struct("id", "version", "type", "schema"), F.col("version")).alias("_last"))
        .select("subject", "_last.*")
    )


def resolve_schema(records: DataFrame, schemas: DataFrame) -> DataFrame:
    """Add the current schema id and type of each record's ``subject``; unknown subjects get nulls."""
    current = latest_schemas(schemas).select(
        "subject", F.col("id").alias("schema_id"), F.col("type").alias("schema_type")
    )
    if current.limit(MAX_SMALL_ROWS + 1).count() <= MAX_SMALL_ROWS:
        return records.join(F.broadcast(current), "subject", "left")
    return skew_join(records, current, ["subject"], "left")


def unresolved(records: DataFrame, schemas: DataFrame) -> DataFrame:
    """Subjects in use that have no schema."""
    return records.select("subject").distinct().join(schemas, "subject", "left_anti")


def register_schemas(wanted: DataFrame, schemas: DataFrame) -> DataFrame:
    """Rows to add for ``wanted(subject, type, schema)`` that are not registered yet.

    Versions go on from the subject's last one and ids from the highest one, in the
    order of subject and text. The tables hold one row per schema, not per event.
    """
    new = wanted.distinct().join(schemas.select("subject", "schema"), ["subject", "schema"], "left_anti")
    versions = schemas.groupBy("subject").agg(F.max("version").alias("_version"))
    top = schemas.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).head()["top"]
    ranked = _in_order(new, ["subject", "schema"], "_rank")
    first = ranked.groupBy("subject").agg(F.min("_rank").alias("_first"))
    return (
        ranked.join(first, "subject")
        .join(versions, "subject", "left")
        .select(
            "subject",
            (F.coalesce("_version", F.lit(0)) + F.col("_rank") - F.col("_first") + 1).cast("int").alias("version"),
            (F.lit(top) + F.col("_rank")).cast("int").alias("id"),
            "type",
            "schema",
        )
    )


def _in_order(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number all rows from 1 in a total order: by ranges, each numbered on its own, and their offsets."""
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    offsets, total = [], 0
    # a row for each range, so for each task of the shuffle
    for row in ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).orderBy("_range").collect():
        offsets.append((row["_range"], total))
        total += row["n"]
    start = df.sparkSession.createDataFrame(offsets, "_range int, _start bigint")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = ranged.withColumn("_within", within).join(F.broadcast(start), "_range")
    return placed.withColumn(name, F.col("_start") + F.col("_within")).drop("_range", "_start", "_within")


def json_kind(variant_type: Column) -> Column:
    """JSON-schema type name for a type name given by ``schema_of_variant``."""
    return (
        F.when(variant_type == "STRING", "string")
        .when(variant_type == "BOOLEAN", "boolean")
        .when(variant_type == "BIGINT", "integer")
        .when(variant_type.startswith("DECIMAL") | (variant_type == "DOUBLE"), "number")
        .otherwise("object")
    )


def observed_fields(payloads: DataFrame) -> DataFrame:
    """``(manifest, field, kind)`` of all JSON payloads in ``payloads(manifest, json)``.

    Every payload is read. Integers widen to numbers, any other mix to ``object``;
    nulls do not count.
    """
    fields = payloads.select(
        "manifest", F.explode(F.from_json("json", T.MapType(T.StringType(), T.VariantType()))).alias("field", "value")
    )
    kinds = fields.withColumn("_type", F.schema_of_variant("value")).where(F.col("_type") != "VOID")
    kinds = kinds.select("manifest", "field", json_kind(F.col("_type")).alias("kind"))
    distinct = kinds.groupBy("manifest", "field").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
    kind = (
        F.when(F.size("kinds") == 1, F.element_at("kinds", 1))
        .when(F.array_join("kinds", ",") == "integer,number", "number")
        .otherwise("object")
    )
    return distinct.select("manifest", "field", kind.alias("kind"))


def derive_schemas(fields: DataFrame) -> DataFrame:
    """One JSON-schema document per manifest out of ``(manifest, field, kind)``; all fields required."""
    # the fields of one type, not its events
    entries = F.array_sort(F.collect_list(F.struct("field", "kind")))
    typed = F.transform("entries", lambda e: F.struct(e["field"].alias("key"), F.struct(e["kind"].alias("type")).alias("value")))
    document = F.struct(
        F.lit(JSON_SCHEMA_DIALECT).alias("$schema"),
        F.element_at(F.split("manifest", r"\."), -1).alias("title"),
        F.lit("object").alias("type"),
        F.map_from_entries(typed).alias("properties"),
        F.transform("entries", lambda e: e["field"]).alias("required"),
    )
    return (
        fields.groupBy("manifest").agg(entries.alias("entries")).select("manifest", F.to_json(document).alias("schema"))
    )


def schema_document(name: str, fields: T.StructType) -> str:
    """JSON-schema document of a Spark type, in the form that ``derive_schemas`` gives."""

    def kind(data_type: T.DataType) -> str:
        if isinstance(data_type, (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType)):
            return "string"
        if isinstance(data_type, T.IntegralType):
            return "integer"
        if isinstance(data_type, (T.FractionalType, T.DecimalType)):
            return "number"
        return "boolean" if isinstance(data_type, T.BooleanType) else "object"

    names = [camel_case(field.name) for field in fields]
    document = {
        "$schema": JSON_SCHEMA_DIALECT,
        "title": name,
        "type": "object",
        "properties": {n: {"type": kind(field.dataType)} for n, field in zip(names, fields)},
        "required": names,
    }
    return json.dumps(document, separators=(",", ":"))


def spark_type(document: str) -> T.StructType:
    """Spark schema of a derived JSON-schema document."""
    properties: Mapping[str, Mapping[str, str]] = json.loads(document)["properties"]
    return T.StructType([T.StructField(name, JSON_KINDS[p["type"]]) for name, p in properties.items()])
