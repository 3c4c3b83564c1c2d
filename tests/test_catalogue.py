"""Registered queries against their DuckDB statements.

A part runs by default; ``CATALOGUE=all`` runs every one.
"""

import os

import pytest
from compare import connect, difference
from conftest import SMALL

from sparkmart.plans.catalogue import all_oracles, all_queries

PART = [
    "s03_csv_scan_student_vle", "s09_quarantine_student_info", "p05_guarded_parse", "v00_error_code_counts",
    "v07_student_vle_errors", "v09_reconcile", "j12_overdue_without_result", "a05_median_event_value",
    "w05_inactive_streak", "m05_fact_module_presentation_activity_type_week",
    "m06_fact_module_presentation_assessments_week", "m07_fact_student_module_presentation_week", "m08_train_frame",
    "c03_c07_broken_frame", "e05_box_statistics", "e07_spearman_matrix", "f03_one_hot", "f06_standardised_numbers",
    "k07_calibration", "k09_metrics_by_module", "k10_threshold_sweep", "x03_top_factors",
]
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_statement_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES) if os.environ.get("CATALOGUE") == "all" else PART)
def test_query_equals_its_statement(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, ORACLES[name]) is None
