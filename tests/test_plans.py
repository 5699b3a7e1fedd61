"""Physical plans: no Python workers, filters at the scan, and the joins meant."""

import pytest

import __spark_entry__ as entry_point


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["extract_fields_a", "extract_fields_b", "parse_responses", "extract_with_fallback", "html_listing_rows", "clean_fields",
     "metric_cards", "facet_values", "cleanup_plan", "backfill_fields", "ledger_replay"],
)
def test_native_expressions_only(name, spark, sf_dir):
    plan = plan_of(entry_point.queries()[name](spark, sf_dir))
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_anti_joins_stay_anti_joins(spark, sf_dir):
    for name in ("pending_extraction", "incremental_update", "missing_documents"):
        assert "LeftAnti" in plan_of(entry_point.queries()[name](spark, sf_dir))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(entry_point.queries()["ledger_by_status"](spark, sf_dir))
    assert "In(status, [downloaded,error,pending])" in plan.replace(", error", ",error").replace(", pending", ",pending")
    plan = plan_of(entry_point.queries()["records_per_city"](spark, sf_dir))
    assert "ReadSchema: struct<city:string>" in plan


def test_top_list_is_a_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(entry_point.queries()["top_architects"](spark, sf_dir))


@pytest.mark.parametrize("name", ["extract_with_fallback", "extract_local"])
def test_no_text_is_shuffled(name, spark, sf_dir):
    """What an exchange sends on is in its child's output; no plan above a scan's own projection has the text."""
    plan = entry_point.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan()
    todo, sent = [plan], 0
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.nodeName().startswith("Exchange"):
            sent += 1
            output = node.output()
            assert "ocr_text" not in [output.apply(i).name() for i in range(output.size())]
    assert sent


def test_group_numbers_are_joined_by_piece(spark, sf_dir):
    """A join on the group alone would put a hot group in one task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(entry_point.queries()["group_subrows"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin") :]
    assert join.count("Exchange hashpartitioning(_part") >= 2


def test_tables_are_written_rebalanced_by_city(spark, sf_dir):
    from permitwright.fixtures import Fixtures

    plan = plan_of(Fixtures(spark, sf_dir)["fx_permits"].hint("rebalance", "city"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
