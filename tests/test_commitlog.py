"""The commit log, its summaries, and generations."""

import threading

import pytest
from pyspark.sql import functions as F

from spoolway import files
from spoolway.sinks import commitlog as L
from spoolway.sinks import generations as G
from spoolway.sinks import topics as SINK
from spoolway.sources import topics as SRC


def records(spark, n=40, topic="t", start=0):
    return spark.range(start, start + n).select(
        "id",
        F.lit(topic).alias("topic"),
        F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("key"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("value"),
    )


def content(df):
    return sorted((r.topic, r.partition, r.offset, r.key, bytes(r.value)) for r in df.collect())


def test_runs():
    assert L.runs_of([3, 1, 2, 9], [(4, 6)]) == [(1, 6), (9, 9)]
    assert L.without([(1, 9), (12, 12)], [(0, 2), (5, 6), (12, 20)]) == [(3, 4), (7, 9)]
    assert L.without([(1, 9)], []) == [(1, 9)] and L.without([(1, 9)], [(0, 20)]) == []


@pytest.mark.parametrize("remote", [False, True])
def test_a_name_is_taken_once(spark, tmp_path, remote, monkeypatch):
    if remote:
        # the way of other file systems, tried on the local one
        monkeypatch.setattr(files, "local_path", lambda path: None)
    path = str(tmp_path / "a" / "x.json")
    if remote:
        (tmp_path / "a").mkdir()
    assert files.put_if_absent(spark, path, b"1") and not files.put_if_absent(spark, path, b"2")
    assert open(path, "rb").read() == b"1"
    files.put(spark, path, b"3")
    assert open(path, "rb").read() == b"3" and [p.name for p in (tmp_path / "a").glob("*.json")] == ["x.json"]


def test_few_commit_files_are_read_however_many_there_are(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "COMMITS_PER_SUMMARY", 4)
    root, read = str(tmp_path / "t"), []
    plain = L.first_line
    monkeypatch.setattr(L, "first_line", lambda path: read.append(path) or plain(path))
    most = []
    for batch in range(14):
        read.clear()
        SINK.append_topic(records(spark, 6, start=6 * batch), root, batch, ["id"], 2)
        most.append(len(read))
    log = L.CommitLog(spark, root)
    at = log.head()
    assert at.seq == 13 and len(at.paths) < 4 and log.rows(at).select("batch").distinct().count() <= 5
    # a batch looks for its number, a token and, now and then, a summary: each goes over the commits after the last one
    assert max(most[6:]) <= 3 * 5 and max(most[10:]) <= max(most[4:8])
    assert [int(v) for *_, v in sorted(content(SRC.read_topics(spark, root)), key=lambda r: int(r[-1]))] == list(range(84))
    assert at.has(0) and at.has(13) and not at.has(14)
    offsets = {(r.topic, r.partition): r.next_offset for r in log.next_offsets(at).collect()}
    assert sum(offsets.values()) == 84
    # without the pointer all commits are read again
    files.remove(spark, f"{root}/commits/_last.json")
    assert {(r.topic, r.partition): r.next_offset for r in log.next_offsets(log.head()).collect()} == offsets


def test_writers_at_a_time_share_one_sequence(spark, tmp_path):
    root, errors = str(tmp_path / "t"), []

    def write(start):
        try:
            for k in range(3):
                SINK.append(records(spark, 20, start=start + 20 * k), root, ["id"], 2)
        except Exception as error:  # the thread's own
            errors.append(error)

    threads = [threading.Thread(target=write, args=(1000 * i,)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = content(SRC.read_topics(spark, root))
    assert not errors and len(found) == 180
    offsets = {}
    for _, p, o, *_ in found:
        offsets.setdefault(p, []).append(o)
    assert all(sorted(o) == list(range(len(o))) for o in offsets.values())


def test_an_old_token_cannot_commit(spark, tmp_path):
    root = str(tmp_path / "t")
    log = L.CommitLog(spark, root)
    old, new = log.new_token("g"), log.new_token("g")
    other = log.new_token("h")
    assert old < new < other and log.newest_token("g") == new
    rows = SINK.write_batch(SINK.place(records(spark), ["id"], 2), root, old * L.BATCHES_PER_TOKEN)
    with pytest.raises(L.Fenced):
        SINK.commit_batch(rows, root, old * L.BATCHES_PER_TOKEN, group="g", token=old)
    assert SRC.read_topics(spark, root).count() == 0
    at = log.head()
    assert SINK.commit_batch(rows, root, old * L.BATCHES_PER_TOKEN, at) == 0
    with pytest.raises(L.Conflict):
        SINK.commit_batch(rows, root, 1, at)


def test_generations(spark, tmp_path):
    root = str(tmp_path / "t")
    assert G.compacted_scan(spark, root).count() == 0
    for batch in range(3):
        SINK.append_topic(records(spark, 40, "a" if batch % 2 else "b", 40 * batch), root, batch, ["id"], 3)
    SINK.write_batch(SINK.place(records(spark, 9, start=900), ["id"], 2), root, 7)
    before = SRC.read_topics(spark, root)
    want = content(before)
    assert G.compact(spark, root) == 0
    assert content(SRC.read_topics(spark, root)) == content(G.compacted_scan(spark, root)) == want
    # a reader that planned before the switch reads its own files, also after the next one
    SINK.append_topic(records(spark, 40, "a", 200), root, 3, ["id"], 3)
    held = SRC.read_topics(spark, root)
    after = content(held)
    assert len(after) == 160 and content(before) == want
    assert G.compact(spark, root) == 1
    assert content(before) == want and content(held) == content(SRC.read_topics(spark, root)) == after
    # one file for each topic partition, and no batch is listed
    df = SRC.read_topics(spark, root)
    assert len(df.inputFiles()) == 6 and not any("/log/" in f for f in df.inputFiles())
    # a batch keeps its key, so a late retry does nothing
    SINK.append_topic(records(spark, 40, "a", 200), root, 3, ["id"], 3)
    assert content(SRC.read_topics(spark, root)) == after
    gone = G.vacuum(spark, root, keep=1)
    assert any("generations" in g for g in gone) and sum("/log/" in g for g in gone) == 4
    SINK.append_topic(records(spark, 10, "a", 300), root, 4, ["id"], 3)
    final = content(SRC.read_topics(spark, root))
    assert len(final) == 170 and {(r[0], r[1], r[2]) for r in final} >= {(r[0], r[1], r[2]) for r in after}
    assert len({(r[0], r[1], r[2]) for r in final}) == 170


def test_a_stream_starts_from_the_generation(spark, tmp_path):
    from spoolway.streaming import control

    root = str(tmp_path / "t")
    for batch in range(3):
        SINK.append_topic(records(spark, 40, start=40 * batch), root, batch, ["id"], 3)
    stream = SRC.stream_topics(spark, root).select("topic", "partition", "offset", "key", "value")
    first = control.tail(stream, str(tmp_path / "out"), str(tmp_path / "c"))
    first.processAllAvailable()
    G.compact(spark, root)
    SINK.append_topic(records(spark, 40, start=120), root, 3, ["id"], 3)
    control.drain_and_shutdown(first)
    G.vacuum(spark, root, keep=1)
    want = content(SRC.read_topics(spark, root))
    assert content(spark.read.parquet(str(tmp_path / "out"))) == want and len(want) == 160
    fresh = control.drain(SRC.stream_topics(spark, root).select("topic", "partition", "offset", "key", "value"), str(tmp_path / "o2"), str(tmp_path / "c2"))
    assert content(fresh) == want


def test_an_id_is_found_by_bloom_filters(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(40_000).select(
        "id", F.lit("t").alias("topic"), F.concat(F.lit("key-"), F.floor(F.col("id") / 10).cast("string")).alias("key"),
        F.encode(F.sha2(F.col("id").cast("string"), 256), "UTF-8").alias("value"),
    )
    # ids come in any order, so the bounds of a row group say nothing about them
    SINK.append_topic(rows.withColumn("n", F.xxhash64("id")), root, 0, ["n"], 1)
    G.compact(spark, root, row_group_bytes=64 << 10)

    def rows_read(df):
        assert df.count() in (0, 10)
        df.collect()
        node = df._jdf.queryExecution().executedPlan()
        while node.children().size():
            node = node.children().apply(0)
        return node.metrics().apply("numOutputRows").value()

    scan = SRC.read_topics(spark, root)
    assert rows_read(scan.where("key = 'key-17' ")) < 40_000 * 0.6
    assert rows_read(scan.where("key = 'key-17x'")) < 40_000 * 0.3
