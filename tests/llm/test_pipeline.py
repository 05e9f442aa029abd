import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


def test_stages_keep_what_they_should(spark, small):
    import corpus_pipeline as pipeline
    from petrichor.llm import quality_rules, shingle_dedup

    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality", "lines", "copies", "mix", "pack"]
    now = docs
    for name, stage in pipeline.STAGES:
        before, now = now, stage(spark, now, small).cache()
        if name != "pack":
            assert now.columns == docs.columns
        if name == "quality":
            assert now.count() == quality_rules.judged(docs).where("__q_kept").count() > 0
        if name == "lines":
            assert now.count() == before.count()
        if name == "copies":
            parts = shingle_dedup.near_copies(before)
            assert now.count() == parts.select("component_id").distinct().count()
    assert now.agg({"length": "sum"}).first()[0] > 0


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op4_embedding_dedup", "op9_quality_rules", "op10_suffix_dedup"])
def test_queries_equal_their_sql(spark, small, name):
    import duckdb

    from petrichor.llm.oracle import ORACLE
    from petrichor.llm.queries import QUERIES

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    found = QUERIES[name](spark, small).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(want.fetchall())
