"""Run queries over the slices of every workspace."""

import os

import pytest

import __spark_entry__ as driver
from oracle import connect
from workload.registry import ORACLE, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not mounted")

#: Queries whose results depend on the slices of the second workspace.
WHOLE = (
    "pipeline_updates",
    "streaming_job_runs",
    "batch_job_runs",
    "batch_health",
    "chart_running_runs",
    "chart_duration_by_day_and_job",
    "chart_batch_run_durations",
    "chart_update_durations",
    "chart_stream_run_durations",
)


@pytest.mark.parametrize("name", WHOLE)
def test_no_workspace_is_left_out(spark, name):
    assert "workspace_id = " not in driver.oracle_sql()[name]
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "= w1" not in plan and "signup" not in plan


def test_slices_of_the_second_workspace_count():
    """The whole text gives more seconds than the slices of one workspace alone."""
    duck = connect(SF_DIR)
    whole = ORACLE["pipeline_updates"]
    one = whole.replace("WHERE pipeline_id", "WHERE workspace_id = 'w1' AND pipeline_id")
    total = "SELECT sum(duration_seconds) FROM ({}) q"
    seconds = [duck.execute(total.format(text)).fetchone()[0] for text in (whole, one)]
    assert one != whole and seconds[0] > seconds[1]
