"""Plan-shape regression tests: the scale properties the design relies on."""

import re

import pytest

from quarry.operators import index as ix, tfidf
from quarry.sources import tables


@pytest.fixture
def static_plans(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", old)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_build_shuffles_aggregated_postings(spark, static_plans, tmp_path):
    spark.createDataFrame([(i, f"open access {i} river") for i in range(50)], "doc_id BIGINT, text STRING") \
        .repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    docs = tables.documents(spark, str(tmp_path))
    plan = plan_of(ix.build_index(docs).postings)
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
    assert len(exchanges) == 1, plan
    assert exchanges[0][0] == "hashpartitioning" and exchanges[0][1].startswith("term#") and "doc_id#" in exchanges[0][1]
    assert plan.index("Exchange") < plan.index("partial_collect_list")      # aggregated before it
    # the token pipeline (tokenize, filters, Porter steps) is one whole-stage-codegen stage
    assert len(set(re.findall(r"\*\((\d+)\) (?:Project|Generate|Filter)", plan))) == 1


def test_narrow_operators_do_not_shuffle(spark, static_plans, tmp_path):
    from quarry.operators.positions import tokenize_docs
    from quarry.sources import textformats
    spark.createDataFrame([(i, f"open access {i} river") for i in range(50)], "doc_id BIGINT, text STRING") \
        .repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    docs = tables.documents(spark, str(tmp_path))
    tokens = tokenize_docs(docs)
    for frame in (tokens, ix.normalized_terms(tokens), textformats.token_log_lines(tokens),
                  ix.nonempty_docs(docs, unique_ids=True)):
        assert "Exchange" not in plan_of(frame)


def test_no_single_partition_exchange_of_rows(spark, static_plans, docs_factory):
    idx = ix.build_index(docs_factory([(1, "open access"), (2, "open river")]))
    plan = plan_of(tfidf.tfidf(idx))
    assert "SinglePartition" not in plan and "Window" in plan
