"""Token counts, language-model scores and language identification."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from spoolway.llm import bytecnn, ppm, tokencount

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_equal_the_library_on_odd_texts(library):
    rng = random.Random(3)
    texts = ["", " ", "  ", "   a", " " * 37 + "x" + " " * 5, "a" * 500, "ab" * 300, "the " * 50, "=" * 200, "-=-=" * 90]
    texts += ["<s> hi </s>", "<unk><0x41>", "haha" * 40 + "he" * 30, "▁x", "x▁▁y", " " * 1000, "\x00\x01", "é", "日本語" * 50]
    for alphabet in ("aab", "aaabbeethin  ▁\n\té日本①😀.,-=#", "the  an", "0123456789 ,.", "=-_*#"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))) for _ in range(300)]
    got = tokencount.count_batch(tokencount.load_merges(MODEL), texts, {})
    assert got == [len(x) for x in library.encode(texts, num_threads=1)]


def test_counts_of_rows(docs, rows, empty, library):
    got = tokencount.with_token_counts(docs, MODEL).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["row"]["text"] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(library.encode(text)))
    assert tokencount.with_token_counts(empty, MODEL).count() == 0


def test_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokencount, "CACHE_ENTRIES", 5)
    monkeypatch.setattr(tokencount, "BATCH_SYMBOLS", 20)
    merges, cache = tokencount.load_merges(MODEL), {}
    for text in ["several words here", "several other words", "words and words " * 20]:
        assert tokencount.count_batch(merges, [text], cache) == [len(library.encode(text))]


def spell(text):
    return b"".join(w + b" " for w in (text or "").encode().lower().split()) + b"\n"


def brute_levels(texts):
    """Counts by context (the bytes before, across words) of every order; ``texts`` tells how often each text is there."""
    levels = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    for text, n in texts.items():
        spelled = b"\0" * ppm.ORDER + spell(text)
        for i in range(ppm.ORDER, len(spelled)):
            for order in range(ppm.ORDER + 1):
                levels[order][spelled[i - order : i]][spelled[i : i + 1][0]] += n
    return levels


def brute_score(levels, text):
    s = spell(text)
    return sum(math.log10(brute_byte(levels, s[max(0, i - ppm.ORDER) : i], b)) for i, b in enumerate(s))


def brute_byte(levels, past, b):
    """Probability of a byte, by the definition: one order after the other, seen bytes excluded."""
    p, excluded = 1.0, set()
    for order in range(ppm.ORDER, -1, -1):
        context = (b"\0" * ppm.ORDER + past)[-order:] if order else b""
        seen = {s: n for s, n in levels[order].get(context, {}).items() if s not in excluded}
        if not seen:
            continue
        total = sum(seen.values())
        if b in seen:
            return p * (seen[b] - ppm.DISCOUNT) / total
        p *= ppm.DISCOUNT * len(seen) / total
        excluded |= set(seen)
    return p / (256 - len(excluded))


def test_scores_equal_the_definition(docs, rows):
    train = F.col("doc_id") % 3 != 0
    got = ppm.with_scores(docs, train).collect()
    assert len(got) == len(rows)
    token = lambda t: [*(t or "").encode().lower().split(), b""]
    counts = Counter(x for r in rows if r["doc_id"] is not None and r["doc_id"] % 3 for x in token(r["text"]))
    total, distinct = sum(counts.values()), len(counts)
    levels = brute_levels(Counter(r["text"] for r in rows if r["doc_id"] is not None and r["doc_id"] % 3))
    for r in got:
        own = token(r["row"]["text"])
        assert (r["n_tokens"], r["train_tokens"]) == (len(own), total)
        assert r["n_known"] == sum(x in counts for x in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in own))
        if len(own) < 100:
            assert r["score"] == pytest.approx(brute_score(levels, r["row"]["text"]), rel=1e-6)


def test_the_order_of_words_counts(spark):
    rows = [(1, "the cat sat on the mat and the dog sat on the log")] * 3 + [(0, "the cat sat on the mat"), (0, "mat the on sat cat the")]
    docs = spark.createDataFrame(rows, "learn int, text string")
    got = {r["row"]["text"]: r["score"] for r in ppm.with_scores(docs, F.col("learn") == 1).collect()}
    assert got["the cat sat on the mat"] > got["mat the on sat cat the"] + 3


def test_blocks_change_nothing(docs, monkeypatch):
    """Texts cut into small blocks, sums held back for a few codes and rare codes met by a join give the same scores."""
    columns = ["row.doc_id", "n_known", "base_score", "score"]
    rounded = lambda df: sorted(map(repr, ((*r[:2], round(r[2], 6), round(r[3], 6)) for r in df.select(*columns).collect())))
    want = rounded(ppm.with_scores(docs, F.lit(True)))
    monkeypatch.setattr(ppm, "BLOCK", 64)
    monkeypatch.setattr(ppm, "HELD", 100)
    monkeypatch.setattr(ppm, "HOT", 50)
    assert rounded(ppm.with_scores(docs, F.lit(True))) == want


def test_pruned_trie_still_gives_probabilities(docs):
    counts = ppm.context_counts(docs, "text")
    levels = ppm.fit(counts, nodes=200)
    assert all(len(x.codes) <= 200 for x in levels[:-1])
    for context in (b"", b"ba", b"ken", b"wor", b"zzz"):
        past = int.from_bytes(context, "big") << 8
        p = 10 ** ppm.byte_scores(levels, np.array([past | b for b in range(256)], np.int64))
        assert p.sum() == pytest.approx(1, abs=1e-6)


def test_rare_contexts_count_in_a_large_corpus(spark):
    """In millions of training bytes, spellings that occurred once keep their nodes at every order."""
    many = 1_400_000
    rows = [(1, "aaaa " * many), (1, "qzxwvkj"), (0, "qzxwvkj aaaa qzxwvka bqzx")]
    docs = spark.createDataFrame(rows, "learn int, text string")
    held = ppm.with_scores(docs, F.col("learn") == 1).where("row.learn = 0").first()
    levels = brute_levels({"aaaa " * 20: 1, "qzxwvkj": 1})
    less, more = (brute_levels({"aaaa " * k: 1}) for k in (20, 21))
    for order, contexts in enumerate(more):  # each further word adds the same counts
        for context, seen in contexts.items():
            for byte, n in seen.items():
                levels[order][context][byte] += (many - 20) * (n - less[order][context][byte])
    assert held["score"] == pytest.approx(brute_score(levels, rows[2][1]), rel=1e-6)
    assert (held["n_known"], held["train_tokens"]) == (3, many + 3)


def test_few_frequent_tokens_change_nothing(docs, monkeypatch):
    columns = ["row.doc_id", "n_known", F.round("base_score", 6).alias("base")]
    order = lambda rows: sorted(map(tuple, rows), key=str)
    want = order(ppm.with_scores(docs, F.lit(True)).select(*columns).collect())
    monkeypatch.setattr(ppm, "FREQUENT", 50)
    assert order(ppm.with_scores(docs, F.lit(True)).select(*columns).collect()) == want


def test_no_training_rows_and_no_rows(docs, empty):
    got = ppm.with_scores(docs, F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["base_score"] == 0 and r["train_tokens"] == 0 for r in got)
    assert all(r["score"] == pytest.approx(-math.log10(256)) for r in got if r["n_tokens"] == 1)
    assert ppm.with_scores(empty, F.lit(True)).count() == 0


def test_pooling_equals_plain_convolution():
    rng = np.random.default_rng(3)
    filters = {w: rng.normal(size=(w, 256, bytecnn.FILTERS)).astype(np.float32) for w in bytecnn.WIDTHS}
    size = bytecnn.FILTERS * len(bytecnn.WIDTHS)
    net = bytecnn.Network(["a"], filters, rng.normal(size=size).astype(np.float32), None, None)
    windows = rng.integers(0, 256, (5, bytecnn.WINDOW)).astype(np.uint8)
    got = bytecnn._pooled(windows, net.tables(), net.bias)
    for i, w in enumerate(windows):
        want = [
            max(sum(filters[width][k, w[p + k], f] for k in range(width)) for p in range(len(w) - width + 1))
            for width in bytecnn.WIDTHS
            for f in range(bytecnn.FILTERS)
        ]
        assert np.allclose(got[i], np.maximum(np.array(want) + net.bias, 0), atol=1e-4)


def test_whole_texts_count():
    rng = np.random.default_rng(5)
    a = np.array([97 + rng.integers(0, 5, bytecnn.WINDOW) for _ in range(80)], np.uint8)
    b = np.array([107 + rng.integers(0, 5, bytecnn.WINDOW) for _ in range(80)], np.uint8)
    net = bytecnn.train(np.concatenate([a, b]), np.repeat([0, 1], 80), ["aa", "bb"])
    texts = [b"abcde" * 60 + b"klmno" * 600, b"abcde" * 600 + b"klmno" * 60, b"cab", b"onk"]
    found = bytecnn.predict(net, net.tables(), texts)
    assert found.argmax(axis=1).tolist() == [1, 0, 0, 1]
    assert np.allclose(found.sum(axis=1), 1)


def test_undetermined_texts(docs, rows, empty, spark):
    net = bytecnn.fit(docs, F.lit(True))
    assert net.langs == ["en"]
    for r in bytecnn.with_language(docs, net).collect():
        lettered = any(c.isalpha() for c in r["row"]["text"] or "")
        assert r["lang_pred"] == ("en" if lettered else "und") and 0 <= r["score"] <= 1
    assert bytecnn.fit(empty, F.lit(True)) is None and bytecnn.fit(docs, F.lit(False)) is None
    assert {r["lang_pred"] for r in bytecnn.with_language(docs, None).collect()} == {"und"}
    assert bytecnn.with_language(empty, net).count() == 0


def test_held_out_language(spark):
    from spoolway.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_byte_cnn"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97


def test_rare_languages_are_learned(spark):
    """Six labelled rows among very many are in the sample."""
    rows = [(i, "the cat sat on the mat and the dog ran " + str(i), "en") for i in range(3000)]
    rows += [(5000 + i, "žluťoučký kůň úpěl ďábelské ódy " + str(i), "cs") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert bytecnn.fit(df, F.lit(True), rows=200).langs == ["cs", "en"]
    odd = df.limit(20).selectExpr("*", "map('a', 1) as m")
    network = bytecnn.fit(odd, F.lit(True), rows=10)
    assert bytecnn.with_language(odd, network).count() == 20
