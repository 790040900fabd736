"""Start, follow, drain and stop streaming queries."""

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spoolway.schema import REFRESH_INTERVAL


def tail(stream: DataFrame, path: str, checkpoint: str, every: str = REFRESH_INTERVAL) -> StreamingQuery:
    """Keep writing a live query's rows to a folder until stopped."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start(path)
    )


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Write what is available now, wait for the end and return the folder's rows."""
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )
    wait(query)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def drain_and_shutdown(query: StreamingQuery) -> None:
    """Finish what has arrived, then stop; a failure of the query is raised."""
    query.processAllAvailable()
    query.stop()
    wait(query)


def is_shutdown(query: StreamingQuery) -> bool:
    return not query.isActive


def wait(query: StreamingQuery) -> None:
    query.awaitTermination()
    failure = query.exception()
    if failure is not None:
        raise failure


def tail_until(stream: DataFrame, path: str, checkpoint: str, to_seq: int, every: str = REFRESH_INTERVAL) -> StreamingQuery:
    """Tail a by-id query and stop it once an event at or past ``to_seq`` was written."""
    query = tail(stream.observe("reached", F.max("seq_nr").alias("seq_nr")), path, checkpoint, every)
    highest = -1
    while query.isActive and highest < to_seq:
        for progress in query.recentProgress:
            seen = progress.observedMetrics.get("reached")
            highest = max(highest, seen["seq_nr"] if seen and seen["seq_nr"] is not None else -1)
        time.sleep(0.05)
    if query.isActive:
        query.stop()
    wait(query)
    return query
