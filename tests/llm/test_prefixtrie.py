"""The conversation trie against plain Python, and list ranking against a walk."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spoolway.llm import prefixtrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, place int, key map<string,int>"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """The turns of each conversation, by (turn, nulls first) as long as no two share a turn."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in convs.items()}


def rebuild(convs):
    found = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = convs.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])
        found[c] = tuple(base[:h] + own[h:])
    return found


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[x] for x in children[p])
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(cs), len(p), parent, len(cs), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(autouse=True)
def many_tasks(spark, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    monkeypatch.setattr(prefixtrie, "LEAST_SHARE", 20)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def table(spark, rows):
    rows = [(*r, "x", 1, {"a": 1}) for r in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def both(spark, rows, walked):
    turns, convs = prefixtrie.rebuilt(prefixtrie.digested(table(spark, rows)))
    got = prefixtrie.prefix_trie(turns, convs, walked).collect()
    assert sorted((tuple(r[n] for n in NAMES) for r in got), key=repr) == brute(rebuild(ordered(rows)))
    at = sorted(x for r in got for x in (r.enter_at, r.exit_at))
    assert at == list(range(2 * len(got)))
    return got


def conversations(rng, n, replies=4, hot=0.3):
    """A share of conversations is one and the same; some have nulls, gaps and no base."""
    rows = []
    for c in rng.sample(range(3 * n), n):
        turns = 3 if rng.random() < hot else rng.randrange(1, 12)
        for k in range(turns):
            text = "same" if turns == 3 else rng.choice(["a", "b", "é", "", None][:replies])
            rows.append((c, None if k == 0 and rng.random() < 0.2 else 2 * k, rng.choice([None, "user"]) if k == 1 else "user", text))
    return rows


@pytest.mark.parametrize("walked,n", [(30, 120), (10_000, 60)])
def test_trie_equals_brute_force(spark, walked, n):
    rng = random.Random(n)
    rows = conversations(rng, n) + [(-7, 0, "user", "a"), (-5, 0, "user", "a"), (-5, 1, None, None), (None, 0, "user", "lost"), (10**15, 0, None, None)]
    got = both(spark, rows, walked)
    # enclosed arcs are those of the subtree
    spans = {(r.conv_id, r.depth): (r.enter_at, r.exit_at) for r in got}
    for r in got:
        if r.depth:
            a, b = spans[r.parent_conv_id, r.depth - 1]
            assert a < r.enter_at < r.exit_at < b


def test_one_long_conversation_and_copies(spark):
    rows = [(1, k, "user", f"t{k % 7}") for k in range(300)] + [(c, k, "user", "copy") for c in range(10, 130) for k in range(2)]
    both(spark, rows, 50)


def test_equal_turns_keep_one_order(spark):
    rows = [(c, 0, "user", t) for c in (0, 25) for t in ("p", "q", "r")] + [(0, 0, "user", "p"), (25, 0, "user", "p")]
    got = prefixtrie.prefix_trie(*_plain(spark, rows)).collect()
    assert [r.n_convs for r in sorted(got, key=lambda r: r.depth)] == [2] * 5


def _plain(spark, rows):
    turns = prefixtrie.digested(table(spark, rows))
    return turns, turns.select("conv_id").distinct()


def test_empty(spark):
    assert prefixtrie.prefix_trie(*prefixtrie.rebuilt(prefixtrie.digested(table(spark, [])))).count() == 0


@pytest.mark.parametrize("n,walked", [(1, 10), (200, 7), (200, 1000)])
def test_list_rank_equals_a_walk(spark, n, walked):
    rng = random.Random(n)
    ids = rng.sample(range(10**6), n)
    weights = [rng.randrange(-5, 50) for _ in ids]
    df = spark.createDataFrame([(i, j, w) for i, j, w in zip(ids, [*ids[1:], None], weights)], "id bigint, next bigint, w bigint")
    got = {r.id: r.w for r in prefixtrie.list_rank(df.orderBy(F.xxhash64("id")), ["w"], walked).collect()}
    assert got == {i: sum(weights[k:]) for k, i in enumerate(ids)}
