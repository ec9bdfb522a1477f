"""What the physical plans must look like: pushdown, pruning, no Python, no hidden gathers."""

import pytest

from musterroll.workload import CHECKS

# Queries that write files or run jobs before they return a plan.
EAGER = {
    "csv_roundtrip", "mixed_delimiters", "mixed_encodings", "materialised_scan", "materialise_status", "filter_indexed",
    "keyed_load", "file_changes", "csv_as_seen",
    "daily_concat", "daily_stream", "parquet_roundtrip",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(CHECKS) - EAGER))
def test_plans_stay_on_the_jvm_without_cross_joins(spark, sf_dir, name):
    plan = plan_of(CHECKS[name].run(spark, sf_dir))
    for word in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("filter_and", "EqualTo(o_orderstatus,F), In(o_orderpriority, [1-URGENT,2-HIGH])"),
        ("filter_enum", "EqualTo(o_orderstatus,O)"),
        ("filter_list", "In(o_orderpriority, [3-MEDIUM,5-LOW])"),
        ("date_range", "LessThan(l_shipdate,1997-07-01T00:00)"),
        ("filter_then_count", "EqualTo(l_returnflag,R), EqualTo(l_linestatus,O)"),
        ("materialised_scan", "EqualTo(return_flag,R)"),
        ("top_n", "PushedFilters: []"),
    ],
)
def test_filters_reach_the_scan(spark, sf_dir, name, pushed):
    assert pushed in plan_of(CHECKS[name].run(spark, sf_dir))


@pytest.mark.parametrize(
    "name, schema",
    [
        ("distinct_values", "ReadSchema: struct<o_orderpriority:string>"),
        ("filter_then_count", "ReadSchema: struct<l_returnflag:string,l_linestatus:string>"),
        ("top_n", "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_extendedprice:double>"),
        ("period_extent", "ReadSchema: struct<l_shipdate:timestamp_ntz>"),
        ("date_range", "l_partkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>"),
        ("host_allowed", "ReadSchema: struct<page_id:bigint,url:string>"),
    ],
)
def test_only_needed_columns_are_read(spark, sf_dir, name, schema):
    assert schema in plan_of(CHECKS[name].run(spark, sf_dir))


def test_last_n_cuts_before_the_shuffle(spark, sf_dir):
    plan = plan_of(CHECKS["last_n_per_measure"].run(spark, sf_dir))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert "Partial" in plan


def test_hits_keep_few_rows_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(CHECKS["relevance_rank"].run(spark, sf_dir))


@pytest.mark.parametrize("name", ["top_n", "top_n_two_step", "latest_limit"])
def test_tops_are_heaps_merged_in_two_steps_of_one_scan(spark, sf_dir, name):
    plan = plan_of(CHECKS[name].run(spark, sf_dir))
    assert plan.count("FileScan") == 1 and "Sort" not in plan and "Window" not in plan
    assert plan.count("partial_collect_top_k") == 2 and plan.count("Exchange") == 2


@pytest.mark.parametrize(
    "name", ["fallback_pick", "upsert", "latest_resource", "enum_audit", "dimension_names", "fingerprint"]
)
def test_aggregates_combine_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(CHECKS[name].run(spark, sf_dir))
    below = plan[plan.rindex("Exchange"):]
    assert "partial_" in below or "Aggregate(keys" in below


@pytest.mark.parametrize("name", ["listed", "unlisted"])
def test_membership_reads_two_columns_once(spark, sf_dir, name):
    plan = plan_of(CHECKS[name].run(spark, sf_dir))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan and plan.count("FileScan") == 2


def test_series_is_one_lazy_plan(spark, sf_dir):
    from musterroll.operators import reshape
    from musterroll.specs.tables import LINEITEM

    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    long = rows.selectExpr("null period", "'m' measure", "l_quantity value", "'u' unit", "map('k', l_returnflag) dimensions")
    reshape.series(long.withColumn("period", long.period.cast("string")))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs and LINEITEM.large


def test_checks_are_paired_with_sql():
    assert [n for n, c in CHECKS.items() if c.sql is None] == []
