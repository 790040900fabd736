import random

import pytest
from pyspark.sql import functions as F

from spoolway.operators import snapshots as S
from spoolway.schema import MAX_LONG, MAX_TICKS

LOG = (
    "persistence_id string, partition int, offset bigint, kind string, seq_nr bigint, ticks bigint,"
    " min_seq bigint, max_seq bigint, min_ticks bigint, max_ticks bigint, manifest string, format string, payload binary"
)


def random_log(seed, ids=25, actions=60, rising=False):
    rng = random.Random(seed)
    rows, offset = [], 0
    for n in range(ids):
        # one id has far more actions than the others
        for _ in range(actions * 15 if n == 0 else actions):
            offset += rng.randrange(1, 4)
            top = 2000 if n == 0 else 40
            number = rng.randrange(top)
            what = rng.random()
            seq, ticks = number, rng.choice([0, 1, 5, rng.randrange(100), rng.randrange(10**17)])
            if rising or n % 3 == 0:
                ticks = number * 10**13 + 7
            bounds = [None] * 4
            if what < 0.75:
                kind = "save"
            elif what < 0.85:
                kind, ticks = "del_seq", rng.choice([0, ticks])
            else:
                kind = "del_range"
                low, high = rng.choice([0, rng.randrange(top)]), rng.choice([MAX_LONG, rng.randrange(top)])
                first, last = rng.choice([0, ticks]), rng.choice([MAX_TICKS, ticks, rng.randrange(10**17)])
                seq = ticks = None
                # narrow on one side, so that some saves survive
                low = max(low, (0 if high == MAX_LONG else high) - rng.randrange(1, 30)) if rng.random() < 0.9 else low
                bounds = [low, high, first, last]
            body = str(offset).encode() if kind == "save" else b""
            rows.append((f"id{n}", n % 4, offset, kind, seq, ticks, *bounds, "M", "json", body))
    return rows


def fold(rows):
    """The sequential rule: a save overwrites, a tombstone removes what is live so far."""
    live = {}
    for pid, _, offset, kind, seq, ticks, low, high, first, last, *_ in sorted(rows, key=lambda r: r[2]):
        own = live.setdefault(pid, {})
        if kind == "save":
            own[seq] = (ticks, offset)
        elif kind == "del_seq":
            if seq in own and ticks in (0, own[seq][0]):
                del own[seq]
        else:
            for s in [s for s, (t, _) in own.items() if low <= s <= high and first <= t <= last]:
                del own[s]
    return {(pid, s, t, o) for pid, own in live.items() for s, (t, o) in own.items()}


# a small limit sends the busy id through the skewed path
@pytest.mark.parametrize(
    "seed, rising, rows_per_task",
    [(1, False, 10_000), (2, False, 10_000), (5, True, 10_000), (1, False, 64), (3, False, 64), (4, True, 64)],
)
def test_live_set_equals_the_sequential_fold(spark, seed, rising, rows_per_task, monkeypatch):
    if rows_per_task < 10_000:
        monkeypatch.setattr(S, "MAX_NODES_BROADCAST", 10)
    rows = random_log(seed, rising=rising)
    want = fold(rows)
    assert 0 < len(want) < sum(r[3] == "save" for r in rows)
    log = spark.createDataFrame(rows, LOG)
    got = S.live_snapshots(log, rows_per_task).collect()
    assert {(r.persistence_id, r.seq_nr, r.ticks, r.offset) for r in got} == want
    assert len(got) == len(want)
    assert all(bytes(r.payload) == str(r.offset).encode() for r in got)


def test_payloads_are_fetched_by_position(spark, tmp_path):
    rows = random_log(7, ids=8, actions=40)
    path = str(tmp_path / "bodies")
    headers = F.map_from_arrays(F.array(F.lit("akka-manifest"), F.lit("content-type")), F.array(F.encode("manifest", "UTF-8"), F.lit(b"application/json")))
    stored = spark.createDataFrame(rows, LOG).withColumns({"value": F.col("payload"), "headers": headers})
    stored.repartition(3).write.option("parquet.block.size", "4096").parquet(path)
    read = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    log = read.withColumn("topic", F.lit("akka-snapshots")).drop("value", "headers")
    found = S.live_snapshots(log)
    got = found.collect()
    assert {(r.persistence_id, r.seq_nr, r.ticks, r.offset) for r in got} == fold(rows) and len(got) == len(fold(rows))
    assert all(bytes(r.payload) == str(r.offset).encode() and (r.manifest, r.format) == ("M", "json") for r in got)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # only keys and places are dealt out
    plan = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in plan and plan.count("Exchange ") == 1


def test_one_id_in_two_topics_is_two_entities(spark):
    rows = random_log(3, ids=4)
    log = spark.createDataFrame(rows, LOG)
    others = [r for r in rows if r[3] != "del_range"]
    both = log.withColumn("topic", F.lit("akka-snapshots")).unionByName(
        spark.createDataFrame(others, LOG).withColumn("topic", F.lit("acme-akka-snapshots"))
    )
    got = {}
    for r in S.live_keys(both).collect():
        got.setdefault(r.topic, set()).add((r.persistence_id, r.seq_nr, r.ticks, r.offset))
    assert got == {"akka-snapshots": fold(rows), "acme-akka-snapshots": fold(others)}


def test_load_takes_the_highest_match_of_every_wanted_id(spark):
    rows = random_log(9)
    criteria = [(f"id{n}", 3, 25, 0, 10**16) for n in range(0, 30, 2)]
    bounds = "persistence_id string, min_seq bigint, max_seq bigint, min_ticks bigint, max_ticks bigint"
    got = S.load_snapshots(spark.createDataFrame(rows, LOG), spark.createDataFrame(criteria, bounds)).collect()
    want = {}
    for pid, low, high, first, last in criteria:
        hits = [(s, o) for p, s, t, o in fold(rows) if p == pid and low <= s <= high and first <= t <= last]
        want[pid] = max(hits) if hits else (None, None)
    assert {r.persistence_id: (r.seq_nr, r.offset) for r in got} == want


@pytest.mark.parametrize("low, high", [(0, MAX_LONG), (5, 5), (3, 17), (0, 0), (7, 6), (-4, 9), (2**61, MAX_LONG)])
def test_cover_is_exact(spark, low, high):
    df = spark.createDataFrame([(low, high)], "a bigint, b bigint")
    nodes = [(n.level, n.node) for n in df.select(S._cover(F.col("a"), F.col("b"))).head()[0]]
    spans = sorted((node << level, ((node + 1) << level) - 1) for level, node in nodes)
    first, last = max(low, 0), min(high, 2**62 - 1)
    if first > last:
        assert not spans
        return
    assert spans[0][0] == first and spans[-1][1] == last
    assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))


def records(spark, *frames):
    out = None
    for offset, df in enumerate(frames):
        row = df.select("key", "value", "headers").withColumns(
            {"partition": F.lit(0), "offset": F.lit(offset).cast("bigint"),
             "timestamp": F.timestamp_micros(F.lit(0).cast("bigint")), "size": F.octet_length("value")}
        )
        out = row if out is None else out.unionByName(row)
    return out


def test_records_are_classified_by_their_headers(spark):
    save = spark.createDataFrame([("a", 4, 77, b"x", "M")], "persistence_id string, seq_nr bigint, ticks bigint, payload binary, manifest string")
    one = spark.createDataFrame([("a", 4, 0)], "persistence_id string, seq_nr bigint, ticks bigint")
    many = spark.createDataFrame([("a", 1, None, None, 9)], "persistence_id string, min_seq bigint, max_seq bigint, min_ticks bigint, max_ticks bigint")
    saved, dropped, ranged = S.encode_saves(save), S.encode_seq_deletes(one), S.encode_range_deletes(many)
    empty = saved.withColumn("value", F.lit(b""))
    timeless = saved.withColumn("headers", F.map_filter("headers", lambda k, _: ~k.endswith("timestamp")))
    log = S.decode_snapshot_log(records(spark, saved, dropped, ranged, empty, timeless)).orderBy("offset").collect()
    assert [r.kind for r in log] == ["save", "del_seq", "del_range", "save"]
    assert (log[0].seq_nr, log[0].ticks) == (4, 77)
    assert (log[2].min_seq, log[2].max_seq, log[2].min_ticks, log[2].max_ticks) == (1, MAX_LONG, 0, 9)
    assert log[3].ticks == 621355968000000000


def test_a_later_save_survives_an_earlier_tombstone(spark):
    row = lambda o, kind, seq, ticks, body=b"": ("a", 0, o, kind, seq, ticks, None, None, None, None, "M", "json", body)
    log = spark.createDataFrame(
        [row(0, "save", 1, 5, b"old"), row(1, "del_seq", 1, 0), row(2, "save", 1, 6, b"new"), row(3, "del_seq", 1, 5)], LOG
    )
    (left,) = S.compact_snapshot_log(log).collect()
    assert (left.offset, bytes(left.payload)) == (2, b"new")
