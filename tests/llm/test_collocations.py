"""Collocations against plain counting, and the index of a shard against a scan of its words."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from spoolway.llm import collocations as C


def counted(rows):
    grams, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang or "und"] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    grams[lang or "und"][tuple(words[i : i + n])] += 1
    return grams, totals


def brute(rows, least, top):
    out, (grams, totals) = [], counted(rows)
    for lang, f in grams.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            inside = (q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * found[q] >= 80 * a for q in inside):
                continue
            score, k = min((floor(Fraction(2000000 * a, f[p[:k]] + f[p[k:]])), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def run(docs, least, top):
    got = C.collocations(docs, min_count=least, top=top).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got)


def prose(rng, n):
    """Words of uneven frequency with a few set phrases."""
    set_phrases = ["New York City Hall", "per se", "à la carte", "a b a b", "der die das"]
    words = []
    while len(words) < n:
        words.append(rng.choice(set_phrases) if rng.random() < 0.2 else "w" + str(int(rng.paretovariate(0.8))))
        if rng.random() < 0.15:
            words[-1] += rng.choice([". ", ",", "\n", "\r\n", "!?", "\x0b", " \t"])
    return rng.choice([" ", "  ", "\t "]).join(words)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(C, "SHARD_BYTES", 900)
    monkeypatch.setattr(C, "SHARD_WORDS", 60)
    monkeypatch.setattr(C, "GRAMS_PER_SUM", 300)


@pytest.mark.parametrize("seed,least,top", [(1, 4, 2000), (2, 2, 25)])
def test_equals_brute_force(spark, small, seed, least, top):
    rng = random.Random(seed)
    rows = [(rng.choice(["en", "en", "de", None, "und"]), prose(rng, rng.randrange(0, 220))) for _ in range(40)]
    rows += [("en", None), ("en", ""), ("xx", " ,. "), (None, None), ("en", "same words again " * 60), ("en", "x")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    want = brute(rows, least, top)
    assert len(want) > 20 and run(df, least, top) == want


def test_defaults_and_awkward_rows(spark, docs, rows):
    assert run(docs, 3, 2000) == brute([(r["lang"], r["text"]) for r in rows], 3, 2000)


def test_empty(spark, empty):
    assert run(empty, 1, 10) == []
    assert run(spark.createDataFrame([("en", "...")], "lang string, text string"), 1, 10) == []


def test_extra_columns_are_left_alone(spark):
    df = spark.createDataFrame([("en", "one two " * 40, 1, {"a": 1})], "lang string, text string, shard int, ids map<string,int>")
    assert run(df, 30, 10) == brute([("en", "one two " * 40)], 30, 10) != []


def test_index_counts_and_extends():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 5, 400).astype(np.int32)
    lists = [tuple(ids[i : i + 3].tolist()) for i in range(398)]
    phrases = np.array(sorted({x for x in lists if 0 not in x}))
    low, high = C.WordIndex(ids, 3).find(phrases)
    assert [lists.count(tuple(p)) for p in phrases.tolist()] == (high - low).tolist()
    for given, n in ((phrases[:, 1:], 2), (phrases, 3)):
        given = np.unique(given, axis=0)
        longer, counts = C.extended(ids, given)
        every = Counter(tuple(ids[i : i + n + 1].tolist()) for i in range(400 - n))
        parts = set(map(tuple, given.tolist()))
        want = {g: c for g, c in every.items() if 0 not in g and g[1:] in parts and g[:-1] in parts}
        assert dict(zip(map(tuple, longer.tolist()), counts.tolist())) == want


def test_cuts_count_nothing_twice():
    rng = random.Random(4)
    ids = np.array([rng.randrange(0, 4) for _ in range(100)], np.int32)
    for most in (4, 7, 50, 200):
        for n in range(1, 5):
            total = Counter()
            for sign, part in C.cut(ids, most):
                for i in range(len(part) - n + 1):
                    total[tuple(part[i : i + n].tolist())] += sign
            want = Counter(tuple(ids[i : i + n].tolist()) for i in range(101 - n))
            assert {g: c for g, c in total.items() if c and 0 not in g} == {g: c for g, c in want.items() if 0 not in g}


def test_packing_round_trip():
    for x in ([], [0], [-1, 2**62, -(2**63)], list(range(1000))):
        assert C.unpacked(C.packed(np.array(x, np.int64))).tolist() == x
