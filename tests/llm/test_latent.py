import random
import tracemalloc

import numpy as np

from spoolway.llm import latent


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs_equals_the_plain_recurrence():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 70))]
        b = [rng.randrange(6) for _ in range(rng.randrange(0, 90))]
        assert latent.lcs(a, b) == plain_lcs(a, b)


def test_singular_vectors_span_the_matrix(spark):
    rng = np.random.default_rng(2)
    topics = rng.integers(0, 2**32, (5, 40), dtype=np.uint32)
    rows = [(bytearray(rng.choice(topics[i % 5], 30).tobytes()), 1.0) for i in range(60)] + [(bytearray(), 1.0)]
    idf = np.ones(latent.FEATURES, np.float32)
    got = latent.randomised_svd(spark.createDataFrame(rows, "words binary, weight double"), idf, rank=5)
    a = np.zeros((61, latent.FEATURES), np.float32)
    for i, (raw, _) in enumerate(rows):
        a[i, np.unique(np.frombuffer(bytes(raw), np.uint32) & (latent.FEATURES - 1))] = 1
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-9)
    values = np.linalg.svd(a, compute_uv=False)[:5]
    assert np.allclose(got.T @ got, np.eye(5), atol=1e-3)
    assert (np.linalg.norm(a @ got) / np.linalg.norm(values)) > 0.98


def test_the_driver_holds_few_copies_of_the_matrix(spark):
    """By the memory of the driver's Python: one matrix in a product, two for the result; a space comes and goes."""
    rng = random.Random(3)
    idf = np.ones(latent.FEATURES, np.float32)
    rows = [(bytearray(np.array([rng.randrange(2**32) for _ in range(30)], np.uint32).tobytes()), 1.0) for _ in range(40)]
    passages = spark.createDataFrame(rows, "words binary, weight double")
    matrix = latent.FEATURES * (latent.RANK + latent.OVERSAMPLE) * 4
    docs, items, truth = cases(random.Random(6))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    tracemalloc.start()
    try:
        got = latent.randomised_svd(passages, idf)
        assert got.shape == (latent.FEATURES, latent.RANK)
        assert tracemalloc.get_traced_memory()[1] < 2.6 * matrix
        del got
        before = tracemalloc.get_traced_memory()[0]
        found = latent.with_leaks(d, b)
        # the tasks' space is not kept by the driver's Python as well
        assert tracemalloc.get_traced_memory()[0] - before < 0.5 * matrix
        assert {r["row"]["doc_id"] for r in found.collect() if r["leaks"]} == set(truth)
    finally:
        tracemalloc.stop()


def cases(rng):
    items = [(i, prose(rng, rng.randrange(20, 50)) + ". " + prose(rng, 6) + ".") for i in range(30)]
    docs = [(i, prose(rng, rng.randrange(5, 400))) for i in range(60)]
    truth = {}
    for k in range(20):  # whole
        docs.append((100 + k, f"{prose(rng, rng.randrange(0, 150))} {items[k][1]} {prose(rng, rng.randrange(0, 150))}".strip()))
        truth[100 + k] = {items[k][0]}
    for k in range(20, 30):  # a quarter of the words replaced, the answer left
        words = items[k][1].split()
        for j in rng.sample(range(len(words) - 6), len(words) // 4):
            words[j] = prose(rng, 1)
        docs.append((200 + k, f"{prose(rng, 70)} {' '.join(words)} {prose(rng, 90)}"))
        truth[200 + k] = {items[k][0]}
    return docs, items, truth


def test_leaks_are_found_and_clean_texts_left(spark):
    docs, items, truth = cases(random.Random(6))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame([*items, (99, None), (98, ""), (97, "of the")], "item_id bigint, text string")
    got = {r["row"]["doc_id"]: {x["item_id"] for x in r["leaks"]} for r in latent.with_leaks(d, b).collect()}
    assert len(got) == len(docs)
    assert {i: x for i, x in got.items() if x} == truth


def test_recall_against_brute_force(spark):
    """Candidates by cosine against all pairs whose words in order reach the bound."""
    docs, items, _ = cases(random.Random(8))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["row"]["doc_id"], x["item_id"]) for r in latent.with_leaks(d, b).collect() for x in r["leaks"]}
    ids = latent.word_ids()
    want = set()
    for i, t in docs:
        words = ids(t).tolist()
        for k, item in items:
            own = ids(item).tolist()
            spans = range(0, max(1, len(words) - len(own)), 8)
            if max(plain_lcs(own, words[s : s + len(own) + 16]) for s in spans) >= latent.MIN_LCS * len(own):
                want.add((i, k))
    assert len(want) >= 20 and len(want & got) >= 0.9 * len(want)


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    docs, items, truth = cases(random.Random(6))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(latent, "ITEMS_PER_BLOCK", 8)
    # one pass, and passes of two spaces each
    for most in (10, 2):
        monkeypatch.setattr(latent, "BLOCKS_PER_PASS", most)
        found = latent.with_leaks(d, b)
        kept = {r["doc_id"] for r in latent.decontaminated(d, b).collect()}
        assert kept == {i for i, _ in docs} - set(truth) and found.count() == len(docs)
        # never the spaces of two passes in one task
        assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1


def test_recall_does_not_fall_with_the_number_or_shortness_of_items(spark):
    """Verbatim passages of 5 to 20 and of 15 to 59 words, set into other texts; all pairs are known."""
    rng = random.Random(9)
    vocabulary = [prose(rng, 1) for _ in range(3000)]
    draw = lambda n: [vocabulary[int(3000 * rng.random() ** 2)] for _ in range(n)]
    items, docs = [], [(i, " ".join(draw(200))) for i in range(200)]
    for k in range(3000):
        own = draw(rng.randrange(5, 21) if k % 2 else rng.randrange(15, 60))
        items.append((k, " ".join(own)))
        if k % 10 < 2:
            docs.append((1000 + k, " ".join([*draw(rng.randrange(60)), *own, *draw(rng.randrange(60))])))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["row"]["doc_id"]: {x["item_id"] for x in r["leaks"]} for r in latent.with_leaks(d, b).collect()}
    planted = [i - 1000 for i, _ in docs if i >= 1000]
    for kind in (0, 1):
        own = [k for k in planted if k % 2 == kind]
        assert np.mean([k in got[1000 + k] for k in own]) >= 0.9


def test_awkward_rows(docs, rows, empty, spark):
    items = spark.createDataFrame([], "item_id bigint, text string")
    kept = latent.decontaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    one = spark.createDataFrame([(1, rows[0]["text"])], "item_id bigint, text string")
    left = latent.decontaminated(docs, one).collect()
    assert len(left) == sum(rows[0]["text"] not in (r["text"] or "") for r in rows)
    assert latent.decontaminated(empty, one).count() == 0
