"""Shards and length buckets."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

from spoolway.llm import common, packing, sharding


def test_shards_hold_all_rows_and_keep_texts_together(docs, rows):
    got = sharding.shard_documents(docs, 4).collect()
    size = lambda t: len((t or "").encode()) + 8
    want = Counter((r["doc_id"], size(r["text"]), zlib.crc32((r["text"] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # the null text is a group of its own, so size 8 may be in two shards
    homes = defaultdict(set)
    for r in got:
        homes[r["size"], r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for (n, _), s in homes.items() if n > 8)


def test_small_tables_get_the_plain_schedule(spark):
    rng = random.Random(3)
    texts = ["x" * rng.randrange(50, 900) + str(i) for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    loads = Counter()
    for r in sharding.shard_documents(df, 7).collect():
        loads[r["shard"]] += r["size"]
    plain = Counter()
    for (i, s) in sharding.schedule({i: len(t) + 8 for i, t in enumerate(texts)}, 7).items():
        plain[s] += len(texts[i]) + 8
    assert sorted(loads.values()) == sorted(plain.values())
    assert max(loads.values()) - min(loads.values()) < 900


def test_bundles_stay_level(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LARGE_PER_SHARD", 5)
    rng = random.Random(4)
    texts = ["y" * rng.randrange(1, 60) + str(i) for i in range(3000)] + ["big" * 4000] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    loads = Counter()
    for r in sharding.shard_documents(df, 5).collect():
        loads[r["shard"]] += r["size"]
    rest = sorted(loads.values())
    assert sum(rest) == sum(len(t) + 8 for t in texts) and rest[-2] - rest[0] < 0.05 * rest[0]


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


def test_boundaries_are_optimal():
    rng = random.Random(9)
    for _ in range(60):
        histogram = {rng.randrange(0, 60): rng.randrange(1, 9) for _ in range(rng.randrange(1, 11))}
        k = rng.randrange(1, 5)
        found = packing.boundaries(histogram, k)
        assert len(found) <= k and found[-1] == max(histogram)
        tried = itertools.combinations(sorted(histogram), min(k, len(histogram)))
        best = min(padding(histogram, c) for c in tried if c[-1] == max(histogram))
        assert padding(histogram, found) == best
    assert packing.boundaries({}) == []


def test_batches_keep_to_the_budget(docs, rows):
    got = packing.pack(docs, buckets=3, budget=400).collect()
    words = lambda t: len((t or "").encode().split())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter((r["doc_id"], words(r["text"])) for r in rows)
    bounds = packing.boundaries(Counter(r["n_tokens"] for r in got), 3)
    batches, numbers = defaultdict(list), defaultdict(set)
    for r in got:
        assert r["bucket_length"] == bounds[r["bucket"]] >= r["n_tokens"] == r["bucket_length"] - r["padding"]
        batches[r["bucket"], r["batch"]].append(r["place"])
        numbers[r["bucket"]].add(r["batch"])
    for (bucket, _), places in batches.items():
        assert sorted(places) == list(range(len(places)))
        assert len(places) * bounds[bucket] <= 400 or len(places) == 1
    assert all(x == set(range(len(x))) for x in numbers.values())


def test_numbers_are_gapless_whatever_the_parts(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_PER_PART", 7)
    df = spark.createDataFrame([(i % 3 if i % 7 else None, i // 2) for i in range(500)], "g int, x int")
    got = defaultdict(list)
    for r in common.numbered(df, "g", ["x"], 500).collect():
        got[r["g"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in got.values()) and sum(map(len, got.values())) == 500


def test_empty_tables(empty):
    assert sharding.shard_documents(empty, 24).count() == 0
    assert packing.pack(empty).count() == 0
