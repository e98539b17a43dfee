"""Plan-shape guards for the scale properties the README claims."""

import pytest

from corridor.plans import catalog
from tests.conftest import SF_SMALL

catalog.load_all()
QUERIES = catalog.QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    """No registered query plans a cartesian product or a nested-loop join."""
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, plan


def test_validation_not_inlined_into_scan(spark):
    """The quarantine filters stay above the validation projection."""
    plan = _plan(QUERIES["traffic_validate"](spark, SF_SMALL))
    assert "concat_ws" not in plan.split("FileScan", 1)[1]


def test_group_top1_is_an_aggregate(spark):
    for name in ("latest_reading", "traffic_dedupe"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert "Window" not in plan and "Aggregate" in plan, (name, plan)
    assert "HashAggregate" in _plan(QUERIES["traffic_dedupe"](spark, SF_SMALL))
    latest = _plan(QUERIES["latest_reading"](spark, SF_SMALL))
    assert "HashAggregate" in latest and "SortAggregate" not in latest and "Sort " not in latest


def test_point_filter_reaches_scan(spark):
    plan = _plan(QUERIES["traffic_trends_one_segment"](spark, SF_SMALL))
    assert "EqualTo(user_id,7)" in plan


@pytest.mark.parametrize("name", ["incidents_in_viewport", "active_incidents_filtered"])
def test_box_is_tested_before_validation(spark, name):
    """The view's coordinates are compared with the box below the projection that applies the rules."""
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("__reason"):]
    assert "-122.45" in below and "37.76" in below


def test_raw_box_filter_loses_no_valid_incident(spark):
    from corridor.operators import incidents, validate
    box = (-122.45, 37.72, -122.35, 37.76)
    rows = [("accident", x, y) for x in ("-122.4", " -122.35 ", "-122.36", "x", None, "NaN", "-122.46")
            for y in ("37.72", "37.74", "37.77", "", None)]
    raw = spark.createDataFrame(rows, "incident_type string, longitude string, latitude string")
    cols = ["longitude", "latitude"]
    after = validate.validate_incident(raw, ts="created_at").valid.filter(
        "longitude between -122.45 and -122.35 and latitude between 37.72 and 37.76").select(cols)
    before = validate.validate_incident(incidents.raw_in_box(raw, box), ts="created_at").valid.select(cols)
    assert sorted(before.collect()) == sorted(after.collect()) and before.count() == 6
