"""Every registered query against its DuckDB oracle (sf0.001), and the
rows-only ones for successful execution."""

import pytest

import __spark_entry__ as ent
from conftest import SF_SMALL
from tierload.compare import digest, duck

QUERIES = ent.queries()
ORACLE = ent.oracle_sql()


def test_every_query_has_a_callable():
    assert len(QUERIES) >= 50
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, got = df.columns, [tuple(r) for r in df.collect()]
    ocols, want = duck(SF_SMALL, ORACLE[name])
    assert sorted(cols) == sorted(ocols)
    assert len(got) == len(want)
    assert digest(cols, got) == digest(ocols, want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0 and len(df.columns) > 0


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert df.columns == ["entity_id", "event_type", "last_value", "modified_at", "last_event_id"]
