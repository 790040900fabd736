import re
from collections import Counter

import numpy as np
import pytest

from spoolway.llm import ruleensemble, textstats, weakrules


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_statistics_equal_brute_force(docs, spark):
    extra = ["a b c d e f a b c d e x", "a\nb\na\n \n\na", "a a a a a a a", "#$ %& |<>*", "p q r s t u p q r s t u p q r s t u\x0bv\x0cw"]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(extra)], "doc_id bigint, text string")
    both = docs.select("doc_id", "text").unionByName(more)
    for r in textstats.with_stats(both).collect():
        want = brute(r["text"])
        assert {k: r["stats"][k] for k in want} == want, r["text"]


def test_verdicts_follow_base_and_votes(docs):
    for r in weakrules.scored(docs).collect():
        b = brute(r["text"])
        failed = b["n_words"] < 10 or 100 * b["n_repeat_words"] > 20 * b["n_words"]
        assert r["kept"] == (not failed and r["quality"] >= 0.5)
        if b["n_words"] == 0:
            assert set(r["votes"]) == {"-"}


def test_posterior_column_equals_the_model(spark):
    patterns = {"-" * 6 + "111": 900, "0" + "-" * 5 + "111": 80, "-000--1-1": 30, "0000--000": 2}
    model = weakrules.fit(patterns)
    df = spark.createDataFrame([(p,) for p in patterns], "p string")
    for r in df.select("p", model.posterior(df["p"]).alias("q")).collect():
        assert r["q"] == pytest.approx(1 / (1 + np.exp(-model.log_odds(r["p"]))))
    assert model.log_odds("------111") > 0 > model.log_odds("-000--1-1")
    assert model.log_odds("0-----111") < 0


def test_the_fit_decides_verdicts():
    """The same vote against a text counts where texts look alike anyway, and is outvoted where they don't."""
    alike = weakrules.fit({"------111": 8544, "0-----111": 705, "-000--1-1": 272, "---0--10-": 87})
    assert alike.log_odds("------111") > 0 > alike.log_odds("0-----111")
    apart = weakrules.fit({"------111": 6000, "0-----111": 6000, "-000-0-0-": 2000, "-0-0--00-": 3000})
    assert apart.log_odds("0-----111") > 0 > apart.log_odds("-000-0-0-")
    assert apart.against[0] < alike.against[0]


def test_kept_rows_are_whole(docs, rows, empty):
    kept = weakrules.kept_documents(docs)
    assert kept.columns == docs.columns
    found = [r.asDict() for r in kept.collect()]
    assert found and all(r in rows for r in found)
    assert weakrules.kept_documents(empty).count() == 0


def test_rules_compile_to_the_same_score(spark):
    rng = np.random.default_rng(1)
    columns = {n: rng.random(600) for n in ("a", "b", "c")}
    y = ((columns["a"] > 0.4) & (columns["b"] <= 0.7)).astype(int)
    model = ruleensemble.train(columns, y)
    assert 0 < len(model.rules) < 120
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns.values())], "a double, b double, c double")
    got = np.array([r[0] for r in df.select(model.score({n: df[n] for n in columns})).collect()])
    x = ruleensemble._matrix([r for r, _ in model.rules], columns)
    want = 1 / (1 + np.exp(-(model.intercept + x @ np.array([w for _, w in model.rules]))))
    assert np.allclose(got, want)
    assert ((got >= 0.5) == y).mean() > 0.97


def test_few_or_equal_labels():
    assert ruleensemble.train({"a": np.zeros(0)}, []).intercept == 0
    one = ruleensemble.train({"a": np.arange(100.0)}, np.ones(100))
    assert one.intercept > 3 and not one.rules


def test_fit_without_labels(docs, spark):
    stats = textstats.with_stats(docs.select("doc_id", "text")).drop("text")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = ruleensemble.fit(stats, labels)
    assert {r[0] for r in stats.select(model.score(textstats.ratios())).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, 0), (1, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert not ruleensemble.fit(stats, labels).rules


def test_held_out_accuracy(spark):
    from spoolway.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op6_rule_ensemble"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
