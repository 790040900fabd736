"""Topic tables as a stream of commits: a Python data source whose offset is the last commit.

A micro-batch holds the records of whole commits. Folders that were never committed, or
written by an attempt that another one replaced, have no commit and are never read.
"""

import json
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from spoolway import files
from spoolway.schema import TOPIC
from spoolway.sinks import commitlog

ROWS_PER_BATCH = 10_000
#: Bytes that are read ahead of each column; without it whole column chunks are held.
BUFFER_BYTES = 1 << 18


class TopicFile(InputPartition):
    """One parquet file of a topic partition."""

    def __init__(self, path: str, topic: str, partition: int):
        self.path, self.topic, self.partition = path, topic, partition


class CommittedTopics(DataSource):
    """Options: ``root`` (qualified), ``topics`` or ``pairs`` (JSON), ``commits`` and ``records`` per batch, ``progress``."""

    @classmethod
    def name(cls) -> str:
        return "committed_topics"

    def schema(self):
        return TOPIC

    def streamReader(self, schema) -> "CommitReader":
        return CommitReader(self.options)


class CommitReader(DataSourceStreamReader):
    def __init__(self, options):
        self.root = options["root"]
        self.topics = set(json.loads(options["topics"])) if "topics" in options else None
        self.pairs = {tuple(x) for x in json.loads(options["pairs"])} if "pairs" in options else None
        self.commits = int(options.get("commits", 0))
        self.records = int(options.get("records", 0))
        self.progress = options.get("progress")
        self.planned: int | None = None
        self.last = -1

    def initialOffset(self) -> dict:
        self.planned = -1
        return {"seq": -1}

    def latestOffset(self) -> dict:
        """The last commit, or the one at which a limited batch closes."""
        if self.last < 0:
            self.last = commitlog.head(self.root).seq
        while files.exists(commitlog.commit_path(self.root, self.last + 1)):
            self.last += 1
        if not self.commits and not self.records:
            return {"seq": self.last}
        if self.planned is None:
            # restarted: the engine does not tell where it is, so each planned end was noted down
            self.planned = json.loads(files.read(self.progress) or b'{"seq": -1}')["seq"]
        end, found = self.planned, 0
        if end < 0:
            # a generation is read as a whole
            end = min(self.last, commitlog.newest_generation(self.root).upto)
            found = int(end >= 0) and max(self.commits, self.records)
        while end < self.last and not (self.commits and end - self.planned >= self.commits) and not (self.records and found >= self.records):
            end += 1
            found += commitlog.first_line(commitlog.commit_path(self.root, end))["records"]
        return {"seq": end}

    def partitions(self, start: dict, end: dict) -> list[TopicFile]:
        first, last, found = start["seq"] + 1, end["seq"], []
        self.planned = last
        if self.progress:
            files.note(self.progress, json.dumps({"seq": last}).encode())
        if first == 0:
            generation = commitlog.newest_generation(self.root)
            if generation.path and generation.upto <= last:
                found += self._files(generation.path)
                first = generation.upto + 1
        for seq in range(first, last + 1):
            line = commitlog.first_line(commitlog.commit_path(self.root, seq))
            if line["records"]:
                found += self._files(f"{self.root}/log/batch={line['batch']}")
        return found

    def _files(self, folder: str) -> list[TopicFile]:
        found = []
        for name, _ in files.data_files(folder):
            keys = dict(part.split("=", 1) for part in name.split("/")[:-1])
            topic, partition = unquote(keys["topic"]), int(keys["partition"])
            if (self.topics is None or topic in self.topics) and (self.pairs is None or (topic, partition) in self.pairs):
                found.append(TopicFile(f"{folder}/{name}", topic, partition))
        return found

    def read(self, partition: TopicFile) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        system, inside = files.filesystem(partition.path)
        kinds = to_arrow_schema(TOPIC)
        stored = [f.name for f in TOPIC.fields if f.name not in ("topic", "partition")]
        with system.open_input_file(inside) as file:
            for batch in pq.ParquetFile(file, buffer_size=BUFFER_BYTES).iter_batches(ROWS_PER_BATCH, columns=stored):
                n = batch.num_rows
                given = {"topic": pa.repeat(partition.topic, n), "partition": pa.repeat(pa.scalar(partition.partition, pa.int32()), n)}
                columns = [given[f.name] if f.name in given else batch.column(f.name).cast(f.type) for f in kinds]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)
