"""Queries over a journal topic: by id, by tag and all events.

The ``select_`` functions fit batch and stream. They filter topic rows on stored
columns first, so that the filters reach the scan, and decode what is left.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolway.operators.journal import decode_journal, visible_events, where_indexed
from spoolway.schema import MAX_LONG
from spoolway.sources.topics import from_positions


def select_by_id(
    records: DataFrame, persistence_id: str, from_seq: int = 0, to_seq: int = MAX_LONG, partition: int | None = None
) -> DataFrame:
    found = records.where((F.col("key") == persistence_id) & F.col("seq_nr").between(from_seq, to_seq))
    return decode_journal(found if partition is None else found.where(F.col("partition") == partition))


def select_by_tag(records: DataFrame, tag: str) -> DataFrame:
    return decode_journal(records.where(F.array_contains("tags", tag)))


def select_all(records: DataFrame) -> DataFrame:
    return decode_journal(records)


def events_by_id(
    records: DataFrame,
    persistence_id: str,
    from_seq: int = 0,
    to_seq: int = MAX_LONG,
    index: DataFrame | None = None,
    hide_deleted: DataFrame | None = None,
) -> DataFrame:
    """Events of one id by sequence number.

    With ``index`` only the id's partition and range of offsets in each topic are read. Deleted events are included
    unless ``hide_deleted`` gives the delete marks.
    """
    if index is not None:
        records = records.where(where_indexed(index.where(F.col("persistence_id") == persistence_id).collect()))
    events = select_by_id(records, persistence_id, from_seq, to_seq)
    if hide_deleted is not None:
        events = visible_events(events, hide_deleted.where(F.col("persistence_id") == persistence_id))
    return events.orderBy("topic", "seq_nr", "offset")


def events_by_tag(records: DataFrame, tag: str, after: DataFrame | None = None) -> DataFrame:
    """Events of all ids that carry the tag, after the given positions."""
    return select_by_tag(records if after is None else events_after(records, after), tag)


def all_events(records: DataFrame, after: DataFrame | None = None) -> DataFrame:
    return select_all(records if after is None else events_after(records, after))


def events_after(records: DataFrame, positions: DataFrame) -> DataFrame:
    """Records past ``positions(topic, partition, start)``; other partitions are read whole."""
    return from_positions(records, positions, inclusive=False, others="keep")
