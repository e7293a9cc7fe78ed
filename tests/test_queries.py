"""Every registered query against its SQL, at the smallest scale."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_its_sql(spark, con, name):
    found, expected = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert found[0] == expected[0]
    assert found[1] == expected[1]


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_expected_counts(spark):
    """Counts worked out from the tables beforehand: resolved and wanted issues at this scale."""
    row = entry.queries()["run_summary"](spark, SF).first()
    assert (row["resolved_issues"], row["wanted_issues"]) == (13, 110)
