"""The driver contract, on the smallest scale."""

import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")
SAMPLE = (
    "resolve_condition edge_person edge_visit_occurrence edge_procedure_occurrence edge_report_note "
    "edge_provider_roles visits_all visit_assignment csv_visit_occurrence csv_cost condition_era drug_era "
    "source_to_standard_map vocabulary_slice view_nested_forms null_profile row_bag_difference latest_wins"
).split()


def test_entry_and_keys(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_oracle(spark, name):
    import __spark_entry__ as entry
    from checks.compare import check

    ok, note = check(spark, DATA, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, note
