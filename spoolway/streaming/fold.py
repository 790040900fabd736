"""Fold a growing journal to one state per id.

Partial states are kept in levels: a micro-batch adds a run of states at level 0, and
``RUNS_PER_LEVEL`` runs of a level are merged into one of the next. So after n batches an
id has a number of states that grows with log n, and each state is merged log n times.
"""

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spoolway import files
from spoolway.operators.fold import Merge, State, Step, fold_events, merge_states
from spoolway.operators.journal import decode_journal
from spoolway.schema import ENTITY
from spoolway.sinks.commitlog import Conflict, runs_of
from spoolway.sources.subscriptions import Subscription
from spoolway.sources.topics import read_topics
from spoolway.streaming.delivery import follow_commits

RUNS_PER_LEVEL = 8


class Levels:
    """The runs of states below a folder, oldest first, as the newest manifest names them."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, ids: list[str]):
        self.spark, self.path, self.schema = spark, files.qualified(spark, path), schema
        self.ids = [T.StructField(name, T.StringType()) for name in ids]

    def manifest(self) -> tuple[int, dict]:
        names = files.names(f"{self.path}/manifest")
        if not names:
            return -1, {"runs": [], "batches": []}
        return int(names[-1].split(".")[0]), json.loads(files.read(f"{self.path}/manifest/{names[-1]}"))

    def publish(self, number: int, manifest: dict) -> None:
        if not files.put_if_absent(self.spark, f"{self.path}/manifest/{number:012d}.json", json.dumps(manifest).encode()):
            raise Conflict(f"another writer keeps {self.path}")
        if number > 1:
            # readers plan on the newest one; the one before is left for those under way
            files.remove(self.spark, f"{self.path}/manifest/{number - 2:012d}.json")

    def write(self, states: DataFrame) -> str:
        name = uuid.uuid4().hex
        states.write.parquet(f"{self.path}/runs/{name}")
        return name

    def read(self, runs: list[dict]) -> DataFrame:
        """The states of some runs; ``position`` tells their order."""
        fields = T.StructType([*self.ids, *self.schema.fields])
        found = self.spark.createDataFrame([], T.StructType([*fields.fields, T.StructField("position", T.LongType())]))
        for position, run in enumerate(runs):
            states = self.spark.read.schema(fields).parquet(f"{self.path}/runs/{run['name']}")
            found = found.unionByName(states.withColumn("position", F.lit(position).cast("long")))
        return found


def maintain_fold(
    spark: SparkSession,
    root: str,
    path: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    zero: State,
    step: Step,
    merge: Merge,
    schema: T.StructType,
    subscription: Subscription | None = None,
    batches_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Follow a topic table's commits and keep partial states per id, in levels.

    Later commits hold later offsets, so runs join in the order of commits. Batches that
    were folded before, by a repeated micro-batch or under another checkpoint, are left out.
    ``prepare`` picks the journal columns that ``step`` needs, next to ``persistence_id`` and
    ``offset`` (and ``topic``, where ids of several topics are to be kept apart). ``zero``
    is neutral for ``merge``; a state to start from is given to ``read_fold``.
    """

    def fold(session: SparkSession, batches: list[int], batch: int) -> None:
        ids = [name for name in ENTITY if name in prepare(decode_journal(read_topics(session, root, None, []))).columns]
        levels = Levels(session, path, schema, ids)
        number, manifest = levels.manifest()
        seen = [tuple(run) for run in manifest["batches"]]
        fresh = [b for b in batches if not any(first <= b <= last for first, last in seen)]
        if not fresh:
            return
        events = prepare(decode_journal(read_topics(session, root, subscription, fresh)))
        runs = [*manifest["runs"], {"level": 0, "name": levels.write(fold_events(events, zero, step, merge, schema))}]
        gone = []
        while len(last := [r for r in runs if r["level"] == runs[-1]["level"]]) >= RUNS_PER_LEVEL:
            merged = merge_states(levels.read(last), "position", zero, merge, schema)
            runs = [*runs[: -len(last)], {"level": last[0]["level"] + 1, "name": levels.write(merged)}]
            gone += [r["name"] for r in last]
        replaced = {"runs": runs, "batches": runs_of(fresh, seen), "gone": gone, "ids": ids}
        levels.publish(number + 1, replaced)
        # runs that the manifest before the last one had replaced
        for name in manifest.get("gone", []):
            files.remove(session, f"{levels.path}/runs/{name}")

    return follow_commits(spark, root, fold, checkpoint, batches_per_trigger, every)


def read_fold(spark: SparkSession, path: str, initial: State, merge: Merge, schema: T.StructType) -> DataFrame:
    """The states reached so far, each from ``initial``."""
    _, manifest = Levels(spark, path, schema, []).manifest()
    levels = Levels(spark, path, schema, manifest.get("ids", ["persistence_id"]))
    return merge_states(levels.read(manifest["runs"]), "position", initial, merge, schema)
