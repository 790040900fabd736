"""Exact dedup by sorted neighbours, against grouping in plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from spoolway.llm import contentsort


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[norm(text)].append(i)
    want = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            want[i, keep, len(ids), sha] += 1
    return want, len(groups)


def check(df, rows):
    got = contentsort.with_groups(df, carry=["doc_id"]).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    want, groups = brute(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.fixture(autouse=True)
def many_tasks(spark):
    """Tables this small would end in one task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_awkward_rows(docs, rows):
    check(docs, [(r["doc_id"], r["text"]) for r in rows])


@pytest.mark.parametrize("batch,held,bytes_held", [(7, 5, 1 << 20), (1, 3, 1 << 20), (10_000, 65_536, 1 << 20), (50, 1000, 300)])
def test_large_groups_run_over_tasks_and_batches(spark, monkeypatch, batch, held, bytes_held):
    monkeypatch.setattr(contentsort, "HELD_ROWS", held)
    monkeypatch.setattr(contentsort, "HELD_BYTES", bytes_held)
    rng = random.Random(batch)
    texts = ["the same  text", "the\tsame text", "", None, " ", "  ", "shared head of sixteen and more a", "shared head of sixteen and more b"]
    texts += [f"text {i}" for i in range(30)]
    weights = [200, 100, 30, 20, 5, 5, 20, 20] + [2] * 30
    rows = [(i if rng.random() > 0.02 else None, rng.choices(texts, weights)[0]) for i in range(900)]
    rows += rows[:40]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
        check(df, rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_large_group_is_spread_over_tasks(spark):
    rows = [(i, "one text") for i in range(4000)] + [(i, f"other {i}") for i in range(4000, 6000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    parts = contentsort._marked(df, "doc_id", "text", ["doc_id"]).groupBy("part").count().collect()
    assert max(r["count"] for r in parts) < 0.5 * 6000


def test_rows_come_back_with_all_columns(spark, docs, empty):
    odd = docs.selectExpr("*", "map('a', 1) as keep_id", "'r' as run", "text as norm", "'x' as kept", "n as `a.b`")
    found = contentsort.deduplicated(odd)
    assert found.columns == odd.columns and found.count() == len({norm(r.text) for r in docs.collect()})
    assert contentsort.deduplicated(empty).count() == 0
    assert contentsort.with_groups(empty).columns == ["row", "keep_id", "group_size", "kept", "text_sha256"]
