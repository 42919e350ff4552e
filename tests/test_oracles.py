"""Every registered query against its SQL twin, and the documented figures of the fixture."""

import pytest

import __spark_entry__ as entry
import compare
from eventwarden.operators import report as R
from eventwarden.plans import fixture as FX, oracle, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    ok, note = compare.compare(spark, con, sf_dir, name)
    assert ok, note


def test_every_oracle_belongs_to_a_query():
    assert set(oracle.ORACLES) <= set(queries.QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 2


@pytest.mark.parametrize("sf, figures", [
    ("0.001", (1_000, 50, 59, 28, 9)),
    ("0.01", (10_000, 875, 512, 280, 99)),
    ("0.1", (100_000, 8_750, 5_081, 2_783, 999)),
])
def test_fixture_figures(spark, sf, figures):
    flagged = FX.flagged_events(spark, f"/root/testdata/sf{sf}")
    row = R.run_report(flagged, by=[]).first()
    assert (row.total_records, row.late_records, row.dq_failures, row.dq_unknown,
            row.schema_drift_count) == figures
