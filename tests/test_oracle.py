"""A cross-section of the registered queries against DuckDB on the smallest tables.

The whole register runs with ``python -m checks.harness <sf dir>``.
"""

import pytest

import __spark_entry__ as entry
from checks.harness import connect, difference

SF = "/root/testdata/sf0.001"
NAMES = [
    "stratify_spots", "drop_specks", "compartment_intensity", "thresholded_intensity", "nearest_partner", "mann_whitney",
    "spearman", "comparison_table", "coloc_metrics", "otsu", "depth_map", "disk_mean_clipped", "matched_random",
    "build_manifest", "plate_layout", "secondary_correct", "focus_scores", "fixed_window", "morph_close", "drop_border",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert difference(got, duck.execute(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
