import os

import oracle
import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return oracle.connect(sf)


def test_every_query_has_its_sql():
    """But for the training-text operators that SQL cannot express; tests/llm has those."""
    assert set(ORACLES) <= set(QUERIES)
    own = set(entry.llm.QUERIES) | {"pipeline"} if entry.llm else set()
    assert set(QUERIES) - set(ORACLES) <= own


def test_flagship(spark):
    found = entry.entry(spark)
    assert found.columns == ["gid", *entry.COLUMNS]
    assert found.count() > 0


def test_written_tables_go_where_the_cluster_says(spark, sf):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert entry.scratch_path(spark, "x").startswith(shared)
    QUERIES["sink_roundtrip"](spark, sf)
    assert [name for name in os.listdir(shared) if name.startswith("widevec-")]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    found = oracle.comparable(QUERIES[name](spark, sf).toArrow())
    expected = oracle.comparable(duck.sql(ORACLES[name]).to_arrow_table())
    assert found.column_names == expected.column_names
    assert [f.type for f in found.schema] == [f.type for f in expected.schema]
    assert found.num_rows > 0
    assert oracle.rows(found) == oracle.rows(expected)
