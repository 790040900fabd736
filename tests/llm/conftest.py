"""Small tables that hold the awkward cases."""

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, place bigint, n bigint"


def _rows(n_random: int = 40):
    """Nulls in each column, empty, blank and long texts, ties, repeated rows, clashing names."""
    rng = random.Random(5)
    stems = [a + b for a in ("ba", "ke", "li", "mo", "nu", "ra", "si", "to") for b in ("n", "r", "s", "t", "lo", "mi")]
    texts = [" ".join(rng.choice(stems) + rng.choice(("", "a", "en")) for _ in range(rng.randrange(5, 160))) + "." for _ in range(n_random)]
    texts += [None, "", " \n\t ", "one", "two words", "!!!", "x" * 5000, "word " * 3000, texts[0], texts[0], texts[1] + " tail", "é ü 日本 " * 40]
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 == 0 else "s", None if t is None else len(t), "r", i, 1) for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[3], (None, texts[2], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d.parquet")
    spark.createDataFrame(_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
