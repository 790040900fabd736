from collections import Counter

import pytest

import corpus_pipeline
from spoolway.llm.queries import ORACLE, QUERIES


def test_one_query_for_each_operator():
    names = Counter(q.split("_")[0] for q in QUERIES)
    assert names == Counter([f"op{n}" for n in range(1, 14)] + ["pipeline"])
    assert set(ORACLE) <= set(QUERIES)


def test_stages_in_order():
    names = ["quality_rules", "near_dedup", "substring_dedup", "decontamination", "packing"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names


def test_stages_keep_the_columns_and_act(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.dtypes == docs.dtypes, name
        after = out.count()
        assert after == before if name == "substring_dedup" else 0 < after <= before, name
        docs, before = out, after


def test_run_packs_what_is_left(spark, sf):
    got = corpus_pipeline.run(spark, sf).collect()
    ids = [r["doc_id"] for r in got]
    assert 0 < len(ids) == len(set(ids)) < spark.read.parquet(f"{sf}/documents.parquet").count()


def test_awkward_rows_pass_all_stages(docs, empty, spark, sf):
    for start in (docs, empty):
        now = start
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, sf)
            now.collect()


def test_clashing_names_and_maps_pass_all_stages(docs, spark, sf):
    odd = docs.selectExpr("*", "map('a', doc_id) as dedup", "'s' as stats", "1 as votes", "true as kept", "2L as fingerprint", "'q' as quality")
    now = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf)
        assert now.columns == odd.columns, name
        found = now.collect()
    # the rows that stay have their own values
    assert found and all((r.stats, r.votes, r.kept, r.fingerprint) == ("s", 1, True, 2) and r.dedup == {"a": r.doc_id} for r in found)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf, name):
    import duckdb

    from checks.compare import normal

    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    df, found = QUERIES[name](spark, sf), con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.columns, df.collect()) == normal(columns, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_queries_run(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert "doc_id" in df.columns
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert df.count() == n or name == "pipeline"
