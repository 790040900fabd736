"""Produce envelopes: none, one or many records each, with data passed through to the results."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.operators.skew import ROWS_PER_SORT, skew_join
from spoolway.schema import DEFAULT_PARTITIONS, POSITION_KEYS, TOPIC
from spoolway.sinks.commitlog import CommitLog
from spoolway.sinks.topics import append, batch_path


def explode_records(envelopes: DataFrame) -> DataFrame:
    """Envelopes with a ``records`` array as one row per record, numbered by ``pos``."""
    return envelopes.select("envelope_id", F.posexplode("records").alias("pos", "record")).select(
        "envelope_id", "pos", "record.*"
    )


def produce(
    envelopes: DataFrame,
    records: DataFrame,
    root: str,
    batch: int | None = None,
    partitions: int = DEFAULT_PARTITIONS,
    partitioner: Column | None = None,
) -> DataFrame:
    """Append the records and return one row per result.

    ``envelopes(envelope_id, pass_through)`` and ``records(envelope_id, pos, topic,
    key, value[, headers])`` are kept apart, so an envelope may have any number of
    records. Records are produced in the order of (envelope_id, pos). An envelope
    without records gives one row without a topic.
    """
    spark = envelopes.sparkSession
    order = ["envelope_id", "pos"]
    number = append(records, root, order, partitions, partitioner, key=batch, keep=order)
    if number is None:
        # a retry: the results of the first time
        number = CommitLog(spark, root).batch_of(batch)

    columns = ["envelope_id", "pos", *POSITION_KEYS, "offset"]
    schema = T.StructType([*TOPIC.fields, *[records.schema[name] for name in order]])
    written = spark.read.schema(schema).parquet(batch_path(root, number)).select(*columns)
    # both sides may be large, so a task's share is a number of rows whatever the shuffle partitions
    found = written.count()
    tasks = -(-found // ROWS_PER_SORT) if found > ROWS_PER_SORT else None
    produced = skew_join(written, envelopes, ["envelope_id"], tasks=tasks).withColumn("kind", F.lit("record"))
    with_records = records.select("envelope_id").distinct()
    if tasks is None:
        passed = envelopes.join(with_records, "envelope_id", "left_anti")
    else:
        passed = envelopes.repartition(tasks, "envelope_id").join(with_records.repartition(tasks, "envelope_id"), "envelope_id", "left_anti")
    return produced.unionByName(passed.withColumn("kind", F.lit("pass_through")), allowMissingColumns=True)


def regroup(results: DataFrame) -> DataFrame:
    """Results as one row per envelope; for envelopes that came as one row with an array."""
    found = F.collect_list(
        F.when(F.col("pos").isNotNull(), F.struct("pos", "topic", "partition", "offset"))
    )
    ordered = F.transform(
        F.array_sort(found), lambda r: F.struct(r["topic"].alias("topic"), r["partition"].alias("partition"), r["offset"].alias("offset"))
    )
    return results.groupBy("envelope_id", "pass_through").agg(ordered.alias("results"))
