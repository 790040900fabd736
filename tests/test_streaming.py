import threading
import time

import pytest
from pyspark.sql import functions as F

from spoolway.operators import journal as J
from spoolway.plans import readjournal as R
from spoolway.schema import TOPIC
from spoolway.sinks import topics as SINK
from spoolway.sources import topics as SRC
from spoolway.streaming import control, delivery, ordered, tags
from spoolway.streaming import fold as live_fold
from spoolway.streaming.index import maintain_index, maintain_index_topic, read_index


def events(spark, start, n):
    rows = spark.range(start, start + n).select(
        F.col("id").alias("n"),
        F.concat(F.lit("id"), (F.col("id") % 3).cast("string")).alias("persistence_id"),
        (F.floor(F.col("id") / 3) + 1).alias("seq_nr"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("payload"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("even"))).otherwise(F.array().cast("array<string>")).alias("tags"),
        F.lit("M").alias("manifest"),
        F.lit("w").alias("writer_uuid"),
        (F.col("id") + 10**17).alias("ticks"),
    )
    return J.encode_events(rows)


@pytest.fixture
def root(spark, tmp_path):
    root = str(tmp_path / "journal")
    for batch in range(3):
        SINK.append_topic(events(spark, 60 * batch, 60), root, batch, ["n"], 4)
    return root


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize(
    "select", [lambda df: R.select_by_id(df, "id1", 3, 20), lambda df: R.select_by_tag(df, "even"), R.select_all]
)
def test_a_live_query_drained_equals_the_finite_one(spark, root, tmp_path, select):
    columns = ["persistence_id", "seq_nr", "partition", "offset", "ticks"]
    # a folder without a commit, as a failed writer leaves it
    SINK.write_batch(SINK.place(events(spark, 500, 9), ["n"], 2), root, 7)
    stream = select(SRC.stream_topics(spark, root)).select(*columns)
    live = control.drain(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert rows(live, *columns) == rows(select(SRC.read_topics(spark, root)), *columns) != []


def test_a_live_query_goes_on_after_silence(spark, root, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = control.tail(R.select_all(SRC.stream_topics(spark, root)).select("persistence_id", "seq_nr"), out, checkpoint)
    query.processAllAvailable()
    assert not control.is_shutdown(query)
    SINK.append_topic(events(spark, 180, 60), root, 3, ["n"], 4)
    control.drain_and_shutdown(query)
    assert control.is_shutdown(query)
    assert spark.read.parquet(out).count() == 240


def test_a_by_id_query_ends_at_its_last_number(spark, root, tmp_path):
    stream = R.select_by_id(SRC.stream_topics(spark, root), "id0", 1, 70).select("persistence_id", "seq_nr")
    out = str(tmp_path / "out")

    def write_more():
        SINK.append_topic(events(spark, 180, 60), root, 3, ["n"], 4)

    writer = threading.Timer(2.0, write_more)
    writer.start()
    query = control.tail_until(stream, out, str(tmp_path / "checkpoint"), to_seq=70)
    writer.join()
    assert control.is_shutdown(query)
    assert rows(spark.read.parquet(out), "seq_nr") == [(s,) for s in range(1, 71)]


def test_a_failed_query_raises_on_shutdown(spark, root, tmp_path):
    def fail(df, batch):
        raise ValueError("boom")

    query = SRC.stream_topics(spark, root).writeStream.foreachBatch(fail).option(
        "checkpointLocation", str(tmp_path / "c")
    ).start()
    with pytest.raises(Exception, match="boom"):
        control.drain_and_shutdown(query)


def even_records(df):
    return df.where(F.array_contains("tags", "even")).select(
        F.lit("out").alias("topic"), "key", "value", "headers", "timestamp",
        F.col("partition").alias("p"), F.col("offset").alias("o"),
    )


class Once:
    """Fails a step at its first call."""

    def __init__(self, step, after):
        self.step, self.after, self.failed = step, after, False

    def __call__(self, *args, **kwargs):
        if not self.failed and self.after == 0:
            self.failed = True
            raise RuntimeError("executor lost")
        self.after -= 1
        return self.step(*args, **kwargs)


@pytest.mark.parametrize("step", ["place", "write_batch", "commit_batch"])
@pytest.mark.parametrize("after", [0, 1])
def test_exactly_once_survives_a_failure(spark, root, tmp_path, monkeypatch, step, after):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        stream = SRC.stream_topics(spark, root, commits_per_batch=1, checkpoint=checkpoint)
        query = delivery.exactly_once(stream, out, "g", even_records, ["p", "o"], checkpoint, partitions=2, every="0 seconds")
        control.drain_and_shutdown(query)

    monkeypatch.setattr(delivery, step, Once(getattr(delivery, step), after))
    with pytest.raises(Exception, match="executor lost"):
        run()
    run()
    produced = SRC.read_topics(spark, out)
    assert sorted(int(bytes(r.value)) for r in produced.collect()) == list(range(0, 180, 2))
    offsets = {}
    for r in produced.collect():
        offsets.setdefault(r.partition, []).append(r.offset)
    assert all(sorted(o) == list(range(len(o))) for o in offsets.values())
    source = SRC.read_topics(spark, root).groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
    ledger = delivery.group_positions(spark, out).where("group_id = 'g'")
    assert rows(ledger, "topic", "partition", "next_offset") == rows(source, "topic", "partition", "next_offset")


def test_at_most_once_does_not_repeat(spark, root, tmp_path):
    seen, work = [], str(tmp_path / "work")
    fail = Once(lambda: None, 1)

    def process(df, batch):
        fail()
        seen.extend(r.offset for r in df.select("offset").collect())

    def run():
        checkpoint = f"{work}/checkpoint"
        stream = SRC.stream_topics(spark, root, commits_per_batch=1, checkpoint=checkpoint)
        query = delivery.at_most_once(stream, f"{work}/ledger", "g", process, checkpoint, every="0 seconds")
        control.drain_and_shutdown(query)

    with pytest.raises(Exception, match="executor lost"):
        run()
    run()
    # the batch that failed is lost, nothing came twice, and the ledger covers it all
    assert 0 < len(seen) < 180
    assert rows(delivery.group_positions(spark, f"{work}/ledger"), "partition", "next_offset") == rows(
        SRC.read_topics(spark, root).groupBy("partition").agg((F.max("offset") + 1).alias("m")), "partition", "m"
    )


def test_commit_flow_passes_everything_and_commits_after(spark, root, tmp_path):
    seen, work = [], str(tmp_path / "work")

    def process(df, batch):
        assert delivery.group_positions(spark, f"{work}/ledger").isEmpty()
        seen.extend(df.select("offset").collect())

    stream = SRC.stream_topics(spark, root)
    control.wait(delivery.commit_flow(stream, f"{work}/ledger", "g", process, f"{work}/checkpoint", every=None))
    assert len(seen) == 180
    assert {r.group_id for r in delivery.group_positions(spark, f"{work}/ledger").collect()} == {"g"}


def test_groups_and_new_checkpoints_share_a_root(spark, root, tmp_path):
    out, batches = str(tmp_path / "out"), []
    for group, checkpoint in (("a", "1"), ("b", "2"), ("a", "3"), ("a", "1")):
        stream = SRC.stream_topics(spark, root)
        run = delivery.exactly_once(stream, out, group, even_records, ["p", "o"], str(tmp_path / checkpoint), partitions=2)
        control.wait(run)
        batches.append(SRC.read_topics(spark, out).count())
    # what a group has consumed it does not consume again, whatever the checkpoint
    assert batches == [90, 180, 180, 180]
    source = {(r.partition, r.m) for r in SRC.read_topics(spark, root).groupBy("partition").agg((F.max("offset") + 1).alias("m")).collect()}
    for group in ("a", "b"):
        ledger = delivery.group_positions(spark, out).where(F.col("group_id") == group)
        assert {(r.partition, r.next_offset) for r in ledger.collect()} == source
    # an append after the groups goes on behind them
    SINK.append_topic(events(spark, 0, 40).withColumn("topic", F.lit("out")), out, 0, ["n"], 2)
    produced = SRC.read_topics(spark, out).collect()
    offsets = {}
    for r in produced:
        offsets.setdefault(r.partition, []).append(r.offset)
    assert len(produced) == 220 and all(sorted(o) == list(range(len(o))) for o in offsets.values())


def test_a_new_checkpoint_produces_only_what_is_missing(spark, root, tmp_path):
    out = str(tmp_path / "out")
    for n, checkpoint in ((90, "1"), (120, "2")):
        query = delivery.exactly_once(SRC.stream_topics(spark, root), out, "g", even_records, ["p", "o"], str(tmp_path / checkpoint), partitions=2)
        control.wait(query)
        assert SRC.read_topics(spark, out).count() == n
        SINK.append_topic(events(spark, 180, 60), root, 3, ["n"], 4)


def test_a_replaced_writer_cannot_commit(spark, root, tmp_path):
    out = str(tmp_path / "out")
    older = delivery.exactly_once(SRC.stream_topics(spark, root), out, "g", even_records, ["p", "o"], str(tmp_path / "1"), partitions=2, every="1 second")
    older.processAllAvailable()
    newer = delivery.exactly_once(SRC.stream_topics(spark, root), out, "g", even_records, ["p", "o"], str(tmp_path / "2"), partitions=2, every="1 second")
    SINK.append_topic(events(spark, 180, 60), root, 3, ["n"], 4)
    newer.processAllAvailable()
    with pytest.raises(Exception, match="newer writer"):
        control.drain_and_shutdown(older)
    control.drain_and_shutdown(newer)
    produced = SRC.read_topics(spark, out)
    assert sorted(int(bytes(r.value)) for r in produced.collect()) == list(range(0, 240, 2))
    assert produced.select("partition", "offset").distinct().count() == 120


def test_two_groups_write_to_one_table_at_a_time(spark, root, tmp_path):
    out = str(tmp_path / "out")
    queries = [
        delivery.exactly_once(
            SRC.stream_topics(spark, root, commits_per_batch=1, checkpoint=str(tmp_path / g)), out, g, even_records, ["p", "o"],
            str(tmp_path / g), partitions=2, every="0 seconds",
        )
        for g in ("a", "b")
    ]
    for query in queries:
        control.drain_and_shutdown(query)
    offsets = {}
    for r in SRC.read_topics(spark, out).collect():
        offsets.setdefault(r.partition, []).append(r.offset)
    assert sum(map(len, offsets.values())) == 180
    assert all(sorted(o) == list(range(len(o))) for o in offsets.values())


def test_a_limited_stream_goes_on_after_a_restart(spark, root, tmp_path):
    for batch in range(3, 8):
        SINK.append_topic(events(spark, 60 * batch, 60), root, batch, ["n"], 4)
    seen, checkpoint = [], str(tmp_path / "c")

    def run(most=None, **limit):
        def process(df, batch):
            found = [int(bytes(r.value)) for r in df.select("value").collect()]
            if most is not None and len(seen) == most:
                raise RuntimeError("executor lost")
            seen.append(found)

        stream = SRC.stream_topics(spark, root, checkpoint=checkpoint, **limit)
        control.drain_and_shutdown(stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).start())

    with pytest.raises(Exception, match="executor lost"):
        run(2, commits_per_batch=2)
    run(commits_per_batch=2)
    assert [sorted(x) for x in seen] == [list(range(120 * k, 120 * k + 120)) for k in range(4)]
    for batch in range(8, 12):
        SINK.append_topic(events(spark, 60 * batch, 60), root, batch, ["n"], 4)
    run(records_per_batch=100)
    assert [len(x) for x in seen[4:]] == [120, 120] and sorted(sum(seen, [])) == list(range(720))


def test_committed_batches_are_streamed_once(spark, root, tmp_path):
    seen = []

    def process(df, batch):
        assert df.schema.names == TOPIC.names
        seen.extend(int(bytes(r.value)) for r in df.collect())

    SINK.write_batch(SINK.place(events(spark, 500, 9), ["n"], 2), root, 7)

    def run():
        control.wait(delivery.for_each_committed(spark, root, process, str(tmp_path / "c")))

    run()
    assert sorted(seen) == list(range(180))
    SINK.append_topic(events(spark, 180, 30), root, 3, ["n"], 4)
    run()
    assert sorted(seen) == list(range(210))


def test_streamed_index_equals_the_batch_index(spark, root, tmp_path):
    stream = SRC.stream_topics(spark, root)
    control.wait(maintain_index(stream, str(tmp_path / "index"), str(tmp_path / "checkpoint")))
    want = J.journal_index(J.decode_journal(SRC.read_topics(spark, root)))
    assert rows(read_index(spark, str(tmp_path / "index")), *want.columns) == rows(want, *want.columns)


def test_live_fold_joins_its_batches_in_order(spark, root, tmp_path):
    from checks import folds

    path, checkpoint = str(tmp_path / "states"), str(tmp_path / "checkpoint")

    def flags(journal):
        # a miss at every seventh number, so that runs go over the ends of batches
        return journal.select("persistence_id", "offset", (F.col("seq_nr") % 7 != 0).cast("bigint").alias("high"))

    def run():
        control.wait(
            live_fold.maintain_fold(
                spark, root, path, checkpoint, flags, folds.NO_RUN, folds.add_events, folds.join_runs, folds.RUN,
                batches_per_trigger=1,
            )
        )
        states = live_fold.read_fold(spark, path, folds.NO_RUN, folds.join_runs, folds.RUN)
        return rows(states, "persistence_id", "events", "longest", "trailing")

    assert run() == [(f"id{k}", 60, 6, 60 % 7) for k in range(3)]
    SINK.append_topic(events(spark, 180, 60), root, 3, ["n"], 4)
    assert run() == [(f"id{k}", 80, 6, 80 % 7) for k in range(3)]
    levels = live_fold.Levels(spark, path, folds.RUN, ["persistence_id"])
    assert [r["level"] for r in levels.manifest()[1]["runs"]] == [0] * 4


def test_states_of_many_batches_stay_few(spark, root, tmp_path, monkeypatch):
    from checks import folds

    monkeypatch.setattr(live_fold, "RUNS_PER_LEVEL", 2)
    for batch in range(3, 7):
        SINK.append_topic(events(spark, 60 * batch, 60), root, batch, ["n"], 4)
    path = str(tmp_path / "states")

    def flags(journal):
        return journal.select("topic", "persistence_id", "offset", (F.col("seq_nr") % 7 != 0).cast("bigint").alias("high"))

    levels = live_fold.Levels(spark, path, folds.RUN, ["topic", "persistence_id"])
    # the second run reads all commits again, under a new checkpoint
    for checkpoint in ("1", "2"):
        query = live_fold.maintain_fold(
            spark, root, path, str(tmp_path / checkpoint), flags, folds.NO_RUN, folds.add_events, folds.join_runs, folds.RUN, batches_per_trigger=1
        )
        control.wait(query)
        # seven batches are 4 + 2 + 1
        assert [r["level"] for r in levels.manifest()[1]["runs"]] == [2, 1, 0]
        states = live_fold.read_fold(spark, path, folds.NO_RUN, folds.join_runs, folds.RUN)
        assert rows(states, "topic", "persistence_id", "events", "longest", "trailing") == [("akka-journal", f"id{k}", 140, 6, 0) for k in range(3)]


def test_tag_index_equals_the_scan_after_failures(spark, root, tmp_path, monkeypatch):
    path, columns = str(tmp_path / "tags"), ["persistence_id", "seq_nr", "partition", "offset", "ticks"]

    def run(checkpoint="c"):
        control.wait(tags.maintain_tags(SRC.stream_topics(spark, root), path, str(tmp_path / checkpoint), buckets=4))

    monkeypatch.setattr(delivery, "commit_batch", Once(delivery.commit_batch, 0))
    with pytest.raises(Exception, match="executor lost"):
        run()
    run()
    want = rows(R.events_by_tag(SRC.read_topics(spark, root), "even"), *columns)
    assert rows(tags.events_by_tag(spark, path, "even", buckets=4), *columns) == want != []
    assert tags.events_by_tag(spark, path, "odd", buckets=4).count() == 0
    # another delta, a merge in between, and a new checkpoint that reads everything again
    held = tags.events_by_tag(spark, path, "even", buckets=4)
    tags.compact_tags(spark, path)
    SINK.append_topic(events(spark, 180, 60), root, 3, ["n"], 4)
    run("other")
    found = tags.events_by_tag(spark, path, "even", buckets=4)
    assert rows(found, *columns) == rows(R.events_by_tag(SRC.read_topics(spark, root), "even"), *columns)
    assert rows(held, *columns) == want
    filters = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]
    assert filters and all("tag_bucket" in f.split("]")[0] for f in filters)
    after = spark.createDataFrame([("akka-journal", p, 10) for p in range(4)], "topic string, partition int, start bigint")
    assert rows(tags.events_by_tag(spark, path, "even", after, 4), *columns) == [r for r in rows(found, *columns) if r[3] > 10]


def test_numbers_come_in_order_and_gaps_are_waited_for(spark, tmp_path):
    root, checkpoint = str(tmp_path / "j"), str(tmp_path / "c")
    given = [[5, 6, 3], [1, 3, 9], [2], [12]]
    schema = "n bigint, topic string, persistence_id string, seq_nr bigint, payload binary, tags array<string>, manifest string, writer_uuid string, ticks bigint"
    for batch, numbers in enumerate(given):
        rows_of = [(i, "akka-journal", pid, s, b"x", [], "M", "w", 10**17 + s) for i, (pid, s) in enumerate([(p, s) for p in ("a", "b") for s in numbers])]
        frame = spark.createDataFrame(rows_of, schema)
        SINK.append_topic(J.encode_events(frame.drop("topic")), root, batch, ["n"], 1)
    stream = SRC.stream_topics(spark, root, commits_per_batch=1, checkpoint=checkpoint)
    found = ordered.in_order(R.select_all(stream).select("topic", "persistence_id", "seq_nr", "ticks"), 1, 10, wait=10.0)
    seen = []

    def take(df, batch):
        seen.extend((r.persistence_id, r.seq_nr, r.end) for r in df.collect())

    query = found.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(processingTime="500 milliseconds").start()
    for _ in range(480):
        if sum(end for *_, end in seen) == 2 or not query.isActive:
            break
        time.sleep(0.25)
    query.stop()
    for pid in ("a", "b"):
        # 4, 7, 8 and 10 never come; 12 is past the end
        assert [(s, e) for p, s, e in seen if p == pid] == [(s, False) for s in (1, 2, 3, 5, 6, 9)] + [(10, True)]


def test_the_index_topic_is_kept_by_a_stream(spark, root, tmp_path):
    out = str(tmp_path / "index")
    for checkpoint in ("1", "2"):
        control.wait(maintain_index_topic(SRC.stream_topics(spark, root), out, str(tmp_path / checkpoint)))
        SINK.append_topic(events(spark, 180, 60), root, 3, ["n"], 4)
    got = J.decode_index(J.compact_latest(SRC.read_topics(spark, out)))
    want = J.journal_index(J.decode_journal(SRC.read_topics(spark, root)))
    assert rows(got, *want.columns) == rows(want, *want.columns)


def test_a_stream_reader_holds_few_bytes_of_a_file(tmp_path):
    """A file of one large row group is read through small buffers, not by whole column chunks."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema

    from spoolway.schema import TOPIC
    from spoolway.sources import committed

    n = 60_000
    kinds = [f for f in to_arrow_schema(TOPIC) if f.name not in ("topic", "partition")]
    given = {"offset": pa.array(range(n)), "value": pa.array([os.urandom(500) for _ in range(n)])}
    table = pa.table([given[f.name] if f.name in given else pa.nulls(n, f.type) for f in kinds], schema=pa.schema(kinds))
    pq.write_table(table, tmp_path / "x.parquet", row_group_size=n)
    del table, given
    before, most, rows = pa.total_allocated_bytes(), 0, 0
    reader = committed.CommitReader({"root": str(tmp_path)})
    for batch in reader.read(committed.TopicFile(str(tmp_path / "x.parquet"), "t", 3)):
        rows, most = rows + batch.num_rows, max(most, pa.total_allocated_bytes() - before)
    assert rows == n
    assert most < 20_000_000, most  # the column of values has 30 MB
