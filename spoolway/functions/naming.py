"""Topic and subject names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from spoolway.schema import TAG_TOPIC_PREFIX


def _column(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def topic_name(base: str | Column, prefix: str | Column = "") -> Column:
    """A tenant's topic: its prefix, which may be missing, then the base name."""
    return F.concat(F.coalesce(_column(prefix), F.lit("")), _column(base))


def tag_topic_name(tag: str | Column, prefix: str | Column = "") -> Column:
    return topic_name(F.concat(F.lit(TAG_TOPIC_PREFIX), _column(tag)), prefix)


def subject_name(strategy: str | Column, topic: str | Column, record: str | Column) -> Column:
    """Registry subject of a record's value; unknown strategies mean topic and record."""
    strategy, topic, record = _column(strategy), _column(topic), _column(record)
    return (
        F.when(strategy == "topic-name", F.concat(topic, F.lit("-value")))
        .when(strategy == "record-name", record)
        .otherwise(F.concat(topic, F.lit("-"), record))
    )
