import os

import pytest

import __spark_entry__ as registered
from checks import compare
from flowlens.llm.oracles import ORACLES
from flowlens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def connection():
    found = compare.duck(SF_DIR)
    for name in ("documents", "benchmark", "labels", "conversations"):
        found.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return found


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, connection, name, monkeypatch):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    assert compare.difference(spark, connection, SF_DIR, name) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_every_document(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    if name != "op5_token_counts":
        documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
        assert found.count() == found.select("doc_id").distinct().count() == documents
    else:
        assert found.agg({"n_docs": "sum"}).first()[0] == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_all_operators_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registered.queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14))
    assert "pipeline" in registered.queries() and set(ORACLES) <= set(registered.oracle_sql())
