import random

from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from spoolway.llm import simhash
from spoolway.llm.components import components


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    out = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return out - (1 << 64) if out >> 63 else out


def brute_roots(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count() <= 2


def test_fingerprints_and_classes_equal_brute_force(docs, rows):
    got = simhash.near_copies(docs).collect()
    prints = [(r["doc_id"], brute_print(r["text"])) for r in rows]
    roots = brute_roots({p for _, p in prints}, near)
    least = {}
    for i, p in prints:
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    want = [(i, p, least.get(roots[p])) for i, p in prints]
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_links_lose_nothing(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(30)]
    all_prints = set(base)
    for b in base:
        for _ in range(12):
            x = b
            for _ in range(rng.randrange(1, 5)):
                x ^= 1 << rng.randrange(64)
            all_prints.add(x)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in all_prints)
    df = spark.createDataFrame([(x,) for x in signed], "fingerprint bigint")
    got = [tuple(r) for r in simhash.links(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in signed for b in signed if a < b and near(a, b)}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, 101 + i) for i in range(50)] + [(7, 7), (200, 200)]
    edges += [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(45)]
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    pairs = {frozenset(e) for e in edges}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == brute_roots(nodes, lambda a, b: frozenset((a, b)) in pairs)


def test_one_of_each_keeps_whole_rows(docs, rows):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    found = [r.asDict() for r in kept.collect()]
    classes = {r["component_id"] for r in simhash.near_copies(docs).collect()}
    assert {r["doc_id"] for r in found} == classes and len(found) == len(classes)
    assert all(r in rows for r in found)


def test_empty_table(empty):
    assert simhash.near_copies(empty).count() == 0
    assert simhash.one_of_each(empty).count() == 0


def test_hex_of_the_query(spark):
    df = spark.createDataFrame([(-1,), (0,), (255,)], "x bigint")
    got = [r[0] for r in df.select(F.lpad(F.lower(F.hex("x")), 16, "0")).collect()]
    assert got == ["f" * 16, "0" * 16, "0" * 14 + "ff"]
