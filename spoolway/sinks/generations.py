"""Compaction of a topic table: a new generation of its files, topic by topic.

``generations/G-.../topic=T/partition=P`` holds all records committed up to some commit
in few sorted files, and ``generations/_manifest/G.json`` switches to it in one step.
Readers plan on one manifest and the batches committed after it; whoever planned before
the switch goes on with the files named then, which stay until ``vacuum``.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolway import files
from spoolway.operators.skew import ROWS_PER_TASK
from spoolway.schema import POSITION_KEYS, TOPIC
from spoolway.sinks.commitlog import CommitLog, Conflict, commit_path, first_line, generation_path, newest_generation
from spoolway.sinks.topics import batch_path
from spoolway.sources.topics import read_state

#: Row groups are small enough, and keys have bloom filters, so that an id is found without an index.
ROW_GROUP_BYTES = 16 << 20
OPTIONS = {
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.bloom.filter.enabled#key": "true",
    "parquet.bloom.filter.adaptive.enabled#key": "true",
    "maxRecordsPerFile": str(ROWS_PER_TASK),
}


def compact(spark: SparkSession, root: str, row_group_bytes: int = ROW_GROUP_BYTES) -> int:
    """Write a generation of everything committed so far and switch to it; returns its number.

    Records keep their offsets. A topic partition is cut into stretches of offsets, so
    a large one is written by many tasks. Appends may go on meanwhile; of two
    compactions at a time the second one fails.
    """
    log = CommitLog(spark, root)
    before, at = newest_generation(log.root), log.head()
    number = before.number + 1
    name = f"{number:010d}-{uuid.uuid4().hex}"
    stretch = F.floor(F.col("offset") / F.lit(ROWS_PER_TASK)).alias("stretch")
    rows = read_state(spark, log.root, at, before).repartition(*POSITION_KEYS, stretch)
    writer = rows.sortWithinPartitions(*POSITION_KEYS, "offset").write.partitionBy(*POSITION_KEYS)
    writer.options(**(OPTIONS | {"parquet.block.size": str(row_group_bytes)})).parquet(f"{log.root}/generations/{name}")
    manifest = {"upto": at.seq, "path": name, "runs": at.runs}
    if not files.put_if_absent(spark, generation_path(log.root, number), json.dumps(manifest).encode()):
        raise Conflict(f"generation {number} of {root} is taken")
    # from now on the pointer leaves out the batches of this generation
    log.summarise()
    return number


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove generations but the newest ``keep``, and the batches that all of these hold; returns their folders.

    Run it when readers that planned on older files, and streams that have not come as
    far as the oldest kept generation, are done.
    """
    root = files.qualified(spark, root)
    manifests = files.names(f"{root}/generations/_manifest")[-keep:]
    if len(manifests) < keep:
        return []
    found = [json.loads(files.read(f"{root}/generations/_manifest/{name}")) for name in manifests]
    kept, mark = {x["path"] for x in found}, f"{root}/generations/_vacuumed.json"
    old = [f"{root}/generations/{name}" for name in files.names(f"{root}/generations") if name not in kept]
    done = json.loads(files.read(mark) or b'{"seq": -1}')["seq"]
    for seq in range(done + 1, found[0]["upto"] + 1):
        line = first_line(commit_path(root, seq))
        if line["records"]:
            old.append(batch_path(root, line["batch"]))
    for folder in old:
        files.remove(spark, folder)
    files.put(spark, mark, json.dumps({"seq": max(done, found[0]["upto"])}).encode())
    return old


def compacted_scan(spark: SparkSession, root: str) -> DataFrame:
    """The records of the newest generation alone; appends after it are missing."""
    newest = newest_generation(files.qualified(spark, root))
    if newest.path is None:
        return spark.createDataFrame([], TOPIC)
    return spark.read.schema(TOPIC).parquet(newest.path).select(*TOPIC.names)
