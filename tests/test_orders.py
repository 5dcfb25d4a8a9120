"""Order lines against a brute-force outer join, and daily marts on hand-made rows."""

import datetime as dt
import json

from pyspark.sql import functions as F

from larder.operators import daily, orders

SCHEMA = """_ID string, BUYERID string, ISDEMO boolean, ISDELETED boolean, UPDATEDATETIME int, __TS_MS int,
            CREATEDATETIME timestamp_ntz, ORDERCATALOGITEMS string, RECEIVEDORDER string"""
DAY = dt.datetime(2000, 1, 1)


def line_rows(spark, docs):
    rows = [(i, "B", False, deleted, updated, 0, DAY, json.dumps(o), json.dumps({"CatalogItems": r}))
            for i, deleted, updated, o, r in docs]
    raw = spark.createDataFrame(rows, SCHEMA)
    return orders.order_line_stage(raw, spark.createDataFrame([], "demo_id string")).collect()


def ordered(key, name, quantity="2", price="1.50"):
    return {"_id": key, "CatalogItem": {"_id": f"C{name}", "Name": name}, "Quantity": quantity, "PricePerPacking": price}


def received(key, expense, quantity="2", total="5"):
    return {"OrderCatalogItemId": key, "ExpenseName": expense, "Quantity": quantity, "TotalPrice": total}


def test_lines_pair_up_as_a_full_outer_join(spark):
    o = [ordered("1", "a"), ordered("1", "b"), ordered("2", "c"), ordered(None, "d"), ordered(None, "e")]
    r = [received("1", "x"), received("1", "y"), received("3", "z"), received(None, "w")]
    got = sorted((row.item_name, row.quantity_packing_recieved_item is not None) for row in
                 line_rows(spark, [("O1", False, 1, o, r)]))
    pairs = [(a["CatalogItem"]["Name"], True) for a in o for b in r if a["_id"] and a["_id"] == b["OrderCatalogItemId"]]
    left = [(a["CatalogItem"]["Name"], False) for a in o
            if not a["_id"] or a["_id"] not in [b["OrderCatalogItemId"] for b in r]]
    right = [(b["ExpenseName"], True) for b in r
             if not b["OrderCatalogItemId"] or b["OrderCatalogItemId"] not in [a["_id"] for a in o]]
    assert got == sorted(pairs + left + right)


def test_received_only_line_and_zero_quantity(spark):
    row = line_rows(spark, [("O1", False, 1, [], [received("9", "misc", quantity="0", total="4")])])[0]
    assert (row.item_name, row.catalog_item_id) == ("misc", "9")
    assert float(row.price_per_packing_recieved_item) == 0.0


def test_amounts_are_rounded_then_multiplied(spark):
    row = line_rows(spark, [("O1", False, 1, {"_0": ordered("1", "a", "2.5", "1.005")}, [])])[0]
    assert (float(row.quantity_packing_ordered_item), float(row.price_per_packing_ordered_item)) == (3.0, 1.01)
    assert float(row.total_price_ordered_item) == 3.03


def test_a_deleted_last_version_brings_the_previous_one_back(spark):
    docs = [("O1", False, 1, [ordered("1", "before")], []), ("O1", True, 2, [ordered("1", "after")], [])]
    assert [r.item_name for r in line_rows(spark, docs)] == ["before"]


def test_lines_need_one_shuffle(spark):
    raw = spark.createDataFrame([], SCHEMA)
    plan = orders.order_line_stage(raw, spark.createDataFrame([], "demo_id string"))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "FullOuter" not in text
    assert text.count("Exchange hashpartitioning(_ID") == 1


def feed(spark, rows, date, key, **columns):
    schema = f"buyer_id string, outlet_id string, {date} timestamp_ntz, {key} string, " + ", ".join(
        f"{c} {t}" for c, t in columns.items())
    return spark.createDataFrame(rows, schema)


def test_daily_activity_merges_feeds_and_pads_yesterday(spark):
    as_of = dt.date(2000, 1, 3)
    day1, day2 = dt.datetime(2000, 1, 1, 9), dt.datetime(2000, 1, 2, 9)
    o = feed(spark, [("B", None, day1, "o1", "k1", 2, 3.0, 1.0), ("B", None, day1, "o1", "k1", 1, 1.0, None),
                     ("B", None, None, "o2", "k2", 1, 1.0, None), (None, "x", day1, "o3", "k", 1, 1.0, None)],
             "order_created_date", "order_id", checkout_id="string", quantity_packing_ordered_item="int",
             total_price_ordered_item="double", total_price_recieved_item="double")
    d = feed(spark, [("B", None, day1, "d1", 7), ("B", None, day2, "d2", 5), ("B", None, None, "d3", 5)],
             "create_datetime", "document_id", total_price_item_document="int")
    i = feed(spark, [("B", "x", day1, "c1", 7)], "create_datetime", "inventory_count_id", inventory_item_total_value="int")
    got = {(r.outlet_id, r.create_datetime, r.ordered_quantity, r.document_quantity, r.inventory_daily_count)
           for r in daily.daily_activity(o, d, i, as_of).collect()}
    yesterday = dt.date(2000, 1, 2)
    assert got == {
        (None, dt.date(2000, 1, 1), 1, 1, None), (None, yesterday, None, 1, None),
        (None, None, 1, None, None), (None, None, None, 1, None),
        ("x", dt.date(2000, 1, 1), None, None, 1), ("x", yesterday, None, None, None),
    }


def test_header_counts_only_positive_quantities(spark):
    columns = ["order_id", "buyer_id", "outlet_id", "supplier_id", "buyer_supplier_id", "order_created_date",
               "order_delivery_datetime", "cut_off_datetime", "order_sent_to_supplier_datetime", "order_closed_datetime",
               "status", "is_auto_closed", "user_id", "backoffice_assignee_user_id", "approvers_count",
               "closed_with_issues", "document_id"]
    rows = spark.sql("SELECT * FROM VALUES ('a', 1, 0, 2.0D, NULL), ('a', 2, 1, 3.0D, 1.0D), ('b', 0, 0, 1.0D, 1.0D) "
                     "t(catalog_item_id, quantity_packing_ordered_item, quantity_packing_recieved_item, "
                     "total_price_ordered_item, total_price_recieved_item)").select("*", *[F.lit("k").alias(c) for c in columns])
    row = orders.order_header(rows).first()
    assert (row.order_total_value, row.recieved_total_value) == (6.0, 2.0)
    assert (row.count_items_ordered, row.count_items_recieved) == (1, 1)


def test_chosen_columns_are_those_of_the_whole_table(spark):
    from larder.plans import reports

    m = reports.marts(spark, "/root/testdata/sf0.001")
    whole = m.order_unified
    for columns in (daily.SUPPLIER_ORDERS, daily.LINK_ORDERS, daily.BUYER_ORDERS, orders.LINES, ["order_id"],
                    ["item_name"], ["checkout_id", "sku_item"]):
        some = m.order_columns(columns)
        assert some.columns == columns
        assert sorted(map(repr, some.collect())) == sorted(map(repr, whole.select(*columns).collect()))


def test_folds_carry_only_what_is_asked(spark):
    from larder.plans import reports

    m = reports.marts(spark, "/root/testdata/sf0.001")

    def plan(table):
        return table._jdf.queryExecution().optimizedPlan().toString()

    for name, zones in (("daily_supplier", 0), ("daily_buyer_supplier", 0), ("order_line", 1)):
        assert plan(getattr(m, name)).count("convert_timezone") == zones
    assert "CHECKOUTDATA" not in plan(m.daily_supplier) and "CHECKOUTDATA" in plan(m.daily_buyer)
