"""Physical-plan checks: column pruning and filter pushdown reach the parquet scan,
keep-first is a partial (map-side) aggregate, only fixed-size dimensions are broadcast."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_location_pivot_reads_one_column_of_customer(spark):
    plan = plan_of(E.queries()["a02_location_pivot"](spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas == ["struct<c_custkey:bigint>"], schemas


def test_date_window_is_pushed_to_the_scan(spark):
    plan = plan_of(E.queries()["f12_date_window"](spark, SF))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert re.findall(r"ReadSchema: (struct<[^>]*>)", plan) == ["struct<event_id:bigint,ts:timestamp_ntz>"]


def test_keep_first_is_partially_aggregated(spark):
    plan = plan_of(E.queries()["d01_dedupe_by_key"](spark, SF))
    assert "partial_min_by" in plan


def test_location_match_needs_no_join(spark):
    # the city dimension is a literal map inside the expression
    plan = plan_of(E.queries()["f01_location_match"](spark, SF))
    assert "Join" not in plan and "Exchange" not in plan


def test_top_n_per_group_limits_before_the_shuffle(spark):
    for name in ("w05_cap_per_entity", "w04_recent_per_user"):
        assert "WindowGroupLimit" in plan_of(E.queries()[name](spark, SF)), name
