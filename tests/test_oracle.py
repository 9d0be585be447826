"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from staylens.checks.compare import compare
from tests.conftest import SF_SMALL

# the training-data operators have their own tests in tests/llm
QUERIES = {k: f for k, f in entry.queries().items() if k not in entry.LLM_QUERIES}
ORACLE = {k: sql for k, sql in entry.oracle_sql().items() if k not in entry.LLM_QUERIES}


def test_every_query_has_an_oracle():
    # including the incremental SCD2 merge (closed form over the drops; it is
    # also checked against a brute-force model in test_operators)
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    out = compare(name, df, duck, ORACLE[name], float_digits=None)
    assert out.ok, f"{name}: rows {out.rows_spark}/{out.rows_oracle} {out.detail}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["listing_neighbourhood_lga", "year", "month"]
