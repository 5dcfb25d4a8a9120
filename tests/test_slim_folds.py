"""What a fold of a change log carries, and how the marts are added up behind it."""

import datetime as dt

import pytest

from larder.operators import daily, orders
from larder.plans import reports


def shuffled(table):
    """The output columns of every shuffle of the plan."""
    text = table._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("name, nested", [("order_unified", "ORDERCATALOGITEMS"), ("document_unified", "LINEITEMS"),
                                          ("inventory_unified", "INVENTORYCOUNTITEMS")])
def test_nested_text_is_not_folded(spark, name, nested):
    m = reports.marts(spark, "/root/testdata/sf0.001")
    text = getattr(m, name)._jdf.queryExecution().optimizedPlan().toString()
    lines = text.splitlines()
    fold = next(n for n, line in enumerate(lines) if "Window [row_number()" in line)
    below = next(n for n, line in enumerate(lines) if n > fold and f"{nested}#" in line)
    assert nested not in "".join(lines[:fold + 1]) and nested in lines[below]


def test_order_totals_need_no_shuffle_behind_the_fold(spark):
    columns = ", ".join(f"'k' AS {c}" for c in orders.ROLLUP if c != "order_id")
    lines = spark.sql(f"SELECT id % 3 AS order_id, {columns}, 'a' AS catalog_item_id, 1 AS quantity_packing_ordered_item, "
                      "0 AS quantity_packing_recieved_item, 1.0D AS total_price_ordered_item, 1.0D AS total_price_recieved_item "
                      "FROM range(9)").repartition("order_id")
    header = orders.order_header(lines)
    assert len(shuffled(header)) == 1
    assert {(r.order_total_value, r.count_items_ordered, r.count_items_recieved) for r in header.collect()} == {(3.0, 1, 0)}


def test_daily_activity_needs_one_shuffle_behind_the_feeds(spark):
    day = "timestamp_ntz'2000-01-01 09:00:00'"
    unit = f"id % 2 AS buyer_id, CAST(NULL AS STRING) AS outlet_id, {day}"
    o = spark.sql(f"SELECT {unit} AS order_created_date, id AS order_id, if(id = 4, NULL, 'c') AS checkout_id, 1 AS "
                  "quantity_packing_ordered_item, 1.0D AS total_price_ordered_item, 1.0D AS total_price_recieved_item "
                  "FROM range(5)").repartition("order_id")
    d = spark.sql(f"SELECT {unit} AS create_datetime, id AS document_id, 1 AS total_price_item_document "
                  "FROM range(1)").repartition("document_id")
    i = spark.sql(f"SELECT {unit} AS create_datetime, id AS inventory_count_id, 1 AS inventory_item_total_value "
                  "FROM range(0)").repartition("inventory_count_id")
    activity = daily.daily_activity(o, d, i, dt.date(2000, 1, 2))
    assert len(shuffled(activity)) == 4
    assert sorted((r.buyer_id, r.ordered_quantity, r.checkout_quantity, r.document_quantity, r.inventory_daily_count)
                  for r in activity.collect()) == [(0, 3, 1, 1, None), (1, 2, 1, None, None)]


def test_digests_add_up_without_sorting(spark):
    m = reports.marts(spark, "/root/testdata/sf0.001")
    text = reports.calendar(m)._jdf.queryExecution().executedPlan().toString()
    first = text[text.index("_ordered_quantity_item"):]
    assert "HashAggregate(keys=[buyer_id" in first and "SortAggregate(keys=[buyer_id#" not in first.split("Generate")[0].split("Exchange")[-1]


def test_only_the_latest_version_has_to_convert(spark):
    rows = [("a", "B", 1, '[{"_id": "1", "Quantity": "many"}]'), ("a", "B", 2, '[{"_id": "1", "Quantity": "2"}, "odd"]')]
    raw = spark.createDataFrame(rows, "_ID string, BUYERID string, __TS_MS int, ORDERCATALOGITEMS string").selectExpr(
        "*", "false AS ISDEMO", "false AS ISDELETED", "__TS_MS AS UPDATEDATETIME", "CAST(NULL AS TIMESTAMP_NTZ) AS CREATEDATETIME",
        "CAST(NULL AS STRING) AS RECEIVEDORDER")
    got = orders.order_line_stage(raw, spark.createDataFrame([], "demo_id string")).collect()
    assert sorted(str(r.quantity_packing_ordered_item) for r in got) == ["2", "None"]


def test_days_of_the_score_are_not_shuffled(spark):
    m = reports.marts(spark, "/root/testdata/sf0.001")
    text = m.desertion_metrics._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    known = next(n for n, line in enumerate(lines) if "Generate posexplode" in line)
    assert not [line for line in lines[:known] if "Exchange hashpartitioning" in line and "median_order" in line]
    assert "buyer_id" in next(line for line in lines[known:] if "Exchange hashpartitioning" in line)


def test_the_buyer_log_comes_in_several_files(spark):
    from larder.sources.testshape import TestShape

    assert TestShape(spark, "/root/testdata/sf0.001").buyers().rdd.getNumPartitions() == 8


def test_baskets_are_not_merged_before_their_texts_are_made(spark):
    from larder.sources.testshape import TestShape

    shape = TestShape(spark, "/root/testdata/sf0.001")
    for log in (shape.orders(), shape.documents(), shape.inventory_counts()):
        placed = [line for line in shuffled(log) if "hashpartitioning(l_orderkey" in line]
        assert len(placed) == 1 and "REPARTITION_BY_NUM" in placed[0]


def feeds(spark, orders_text, documents_text):
    day = "timestamp_ntz'2000-01-01 09:00:00'"
    o = spark.sql(f"SELECT buyer_id, outlet_id, {day} + make_dt_interval(day) AS order_created_date, order_id, checkout_id, "
                  "1 AS quantity_packing_ordered_item, 1.0D AS total_price_ordered_item, 1.0D AS total_price_recieved_item "
                  f"FROM VALUES {orders_text} t(buyer_id, outlet_id, day, order_id, checkout_id)")
    d = spark.sql(f"SELECT buyer_id, outlet_id, {day} + make_dt_interval(day) AS create_datetime, document_id, "
                  f"2 AS total_price_item_document FROM VALUES {documents_text} t(buyer_id, outlet_id, day, document_id)")
    i = spark.sql(f"SELECT 'B' AS buyer_id, 'x' AS outlet_id, {day} AS create_datetime, 'c' AS inventory_count_id, "
                  "3 AS inventory_item_total_value FROM range(0)")
    return o, d, i


def test_checkouts_are_counted_per_unit_and_day(spark):
    o, d, i = feeds(
        spark, "('B', 'x', 0, 'o1', 'k'), ('B', 'x', 0, 'o2', 'k'), ('B', 'x', 0, 'o3', 'l'), ('B', 'x', 0, 'o4', NULL), "
        "('B', 'x', 1, 'o5', 'k'), ('B', 'y', 0, 'o6', 'k'), ('B', 'y', 3, 'o7', NULL), ('B', NULL, NULL, 'o8', 'k'), "
        "('B', NULL, NULL, 'o9', 'k')", "('B', 'x', 2, 'd1'), ('B', 'x', 4, 'd2'), ('B', NULL, NULL, 'd3')")
    rows = daily.daily_activity(o, d, i, dt.date(2000, 1, 4)).collect()
    got = sorted(((r.outlet_id or "", str(r.create_datetime)[-2:], r.ordered_quantity, r.checkout_quantity, r.document_quantity)
                  for r in rows), key=str)
    assert got == sorted([
        ("x", "01", 4, 2, None), ("x", "02", 1, 1, None), ("x", "03", None, None, 1), ("x", "05", None, None, 1),
        ("y", "01", 1, 1, None), ("y", "03", None, None, None), ("y", "04", 1, 0, None),
        ("", "ne", 2, 1, None), ("", "ne", None, None, 1), ("", "03", None, None, None)], key=str)


def test_days_are_added_up_by_one_sort_and_one_grouping(spark):
    o, d, i = feeds(spark, "('B', 'x', 0, 'o1', 'k')", "('B', 'x', 0, 'd1')")
    plan = daily.daily_activity(o, d, i, dt.date(2000, 1, 4))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    placed = next(n for n, line in enumerate(lines) if "Exchange hashpartitioning(buyer_id" in line and "order_id" not in line)
    behind = lines[:placed]
    assert "REPARTITION_BY_NUM" in lines[placed] and ", outlet_id" not in lines[placed]
    # Each grouping holds a partial and a final table of the task's days in memory.
    assert [sum(name in line for line in behind) for name in ("HashAggregate", "Sort [", "Window [")] == [2, 1, 1]
