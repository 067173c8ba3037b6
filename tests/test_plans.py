"""What the plans of the registered queries must and must not contain."""

import subprocess
import sys

import pytest
from wayfare.plans.queries import QUERIES
from conftest import ROOT
from helpers import plan_of

WRITERS = {"partitioned_roundtrip", "monthly_windows_roundtrip", "view_last_24h", "stored_tables_sql",
           "trips_from_drifted_files", "trips_from_merged_files", "route_analysis_by_days", "table_inventory",
           "rolled_up_hours", "rolled_up_days", "append_violations",
           "latest_windows_ordered", "busiest_windows_ordered"}
BATCH = sorted(n for n in QUERIES if not n.startswith("stream") and n not in WRITERS)
# A merge has two inputs, an inventory several tables, and a replay looks up its start first.
SINGLE_SCAN = [n for n in BATCH if not n.startswith(("merge_", "table_", "replay_", "message_fates", "decimal_"))]


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {name: plan_of(QUERIES[name](spark, sf_dir)) for name in BATCH}


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_products(plans, name):
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in plans[name]


@pytest.mark.parametrize("name", SINGLE_SCAN)
def test_one_scan(plans, name):
    assert plans[name].count("Location: ") == 1


@pytest.mark.parametrize(
    "name", ["daily_summary_for_date", "hourly_zone_stats_for_date", "recent_windows_24h",
             "retained_windows_7d", "rebucket_5m_last_hour", "replay_schedule"]
)
def test_time_ranges_reach_the_scan(plans, name):
    assert "GreaterThanOrEqual(ts,2024-01" in plans[name]


def test_only_needed_columns_are_read(plans):
    assert "ReadSchema: struct<event_id:bigint>" in plans["grid_zones"]
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plans["dataset_profile"]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plans["top_zones_total"]


def test_entry_module_imports_without_a_session():
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    queries, with_sql = map(int, done.stdout.split())
    assert queries >= with_sql >= len(QUERIES)


def test_entry_module_without_a_library_of_the_llm_package():
    """The engine's queries do not depend on what only the training-data queries need."""
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert int(done.stdout) == len(QUERIES)
