"""The registered queries on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck
from tickflow.llm import queries as Q

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    names = sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES)
    assert names == list(range(1, 14)) and set(Q.QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_its_sql(spark, name):
    r = compare(spark, duck(SF), name, Q.QUERIES[name], Q.ORACLE[name], SF)
    assert r["status"] == "MATCH" and r["spark_rows"] > 0, r


@pytest.mark.parametrize("name", ["op1_toxicity", "op2_pseudonyms", "op7_shards", "op8_token_counts", "op10_pieces",
                                  "op12_line_dedup", "op13_periodic_runs"])
def test_one_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Q.QUERIES[name](spark, SF)
    assert got.count() == docs.count() == got.join(docs, "doc_id").count()


@pytest.mark.parametrize("name", ["op2_pseudonyms", "op3_quotations", "op6_line_rules"])
def test_native_queries_stay_in_the_jvm(spark, name):
    plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in ("Python", "Pandas", "Arrow"))
