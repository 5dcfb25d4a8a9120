"""Results that look odd but are meant: role lists, doubled rows, ids of the directory, chain versions, old demo marks."""

import datetime as dt

from pyspark.sql import functions as F

from larder.operators import accounts, daily

DAY = dt.date(2000, 3, 1)


def hierarchy(spark, role_lists):
    rows = [("C", f"B{i}", "name", None, "city", "land", "UTC", False, roles) for i, roles in enumerate(role_lists)]
    return spark.createDataFrame(rows, "chain_id string, buyer_id string, buyer_name string, buyer_created_at timestamp_ntz, "
                                       "buyer_city string, buyer_country string, timezone string, isdisabled boolean, "
                                       "allowedauthrolesids string")


def test_an_empty_role_object_keeps_a_buyer_and_null_drops_it(spark):
    roles = spark.createDataFrame([("R1", "Purchasing"), ("R2", "Inventory")], "Id string, Module string")
    lists = ["{}", None, "oops", '["R1", "R2"]', '{"_0": "R2"}', '["R9"]', "[]"]
    got = {r.buyer_id: (r.purchasing, r.inventory, r.recipes) for r in accounts.buyer(hierarchy(spark, lists), roles).collect()}
    assert got == {"B0": (False, False, False), "B3": (True, True, False), "B4": (False, True, False), "B5": (False, False, False)}


def directory(spark, rows):
    """(buyer, department, outlet, outlet name) per row."""
    return spark.createDataFrame(
        [("C", b, None, None, d, o, "chain", f"name {b}", "dep", n) for b, d, o, n in rows],
        "chain_id string, buyer_id string, buyer_created_at timestamp_ntz, buyer_deleted_at timestamp_ntz, "
        "department_id string, outlet_id string, chain_name string, buyer_name string, department_name string, outlet_name string")


def marts_of(spark, outlets, orders):
    """`daily_buyer` of one order per (buyer, outlet), all on one day."""
    unified = spark.createDataFrame(
        [(b, o, f"{b}{o}", "k", dt.datetime(2000, 2, 1), 1, 2, 3) for b, o in orders],
        "buyer_id string, outlet_id string, order_id string, checkout_id string, order_created_date timestamp_ntz, "
        "quantity_packing_ordered_item int, total_price_ordered_item int, total_price_recieved_item int")
    none = spark.createDataFrame([], "buyer_id string, outlet_id string, create_datetime timestamp_ntz, document_id string, "
                                     "total_price_item_document int, inventory_count_id string, inventory_item_total_value int")
    buyers = spark.createDataFrame([(b, True, True, True, False) for b in {b for b, _ in orders}],
                                   "buyer_id string, purchasing boolean, accounts_payable boolean, inventory boolean, isdisabled boolean")
    return daily.daily_buyer(directory(spark, outlets), buyers, unified, none, none, as_of=DAY).filter("ordered_quantity = 1")


def test_an_order_without_outlet_appears_twice_where_the_buyer_has_none(spark):
    got = marts_of(spark, [("B", None, None, None), ("E", "D1", "x", "Bar")], [("B", None), ("E", None)])
    assert sorted(r.buyer_id for r in got.collect()) == ["B", "B", "E"]


def test_an_outlet_in_two_departments_doubles_its_rows(spark):
    got = marts_of(spark, [("B", "D1", "x", "Bar"), ("B", "D2", "x", "Bar"), ("B", "D2", "y", "Spa")], [("B", "x"), ("B", "y")])
    assert sorted(r.outlet_id for r in got.collect()) == ["x", "x", "y"]


def test_ids_come_from_the_directory(spark):
    got = marts_of(spark, [("B", "D1", "x", "Bar")], [("B", "x"), ("B", "unknown"), ("Z", "x")]).collect()
    assert sorted((r.buyer_id, r.outlet_id, r.chain_id) for r in got if r.buyer_id) == [("B", "x", "C")]
    assert sum(r.buyer_id is None and r.outlet_id is None and r.chain_id is None for r in got) == 2


def test_every_live_version_of_a_chain_gives_a_row(spark):
    buyers = spark.createDataFrame([("C", "B", "name", dt.datetime(1999, 1, 1), False, True)],
                                   "chain_id string, buyer_id string, buyer_name string, buyer_created_at timestamp_ntz, "
                                   "isdisabled boolean, accounts_payable boolean")
    activity = spark.createDataFrame([("B", DAY - dt.timedelta(60), 2)], "buyer_id string, create_datetime date, document_quantity int")
    chains = spark.createDataFrame([("C", "old", False, False), ("C", "new", False, False), ("C", "gone", True, False),
                                    ("C", "also gone", False, True)], "_ID string, NAME string, __DELETED boolean, ISDELETED boolean")
    got = daily.non_active_buyers(buyers, activity, chains, as_of=DAY).collect()
    assert sorted(r.chain_name for r in got) == ["new", "old"]


def test_any_old_version_marks_a_demo_account(spark):
    versions = spark.createDataFrame([("B1", True, 1), ("B1", False, 2), ("B2", False, 1), ("B3", None, 1)],
                                     "_ID string, ISDEMOACCOUNT boolean, UPDATEDATETIME int")
    suppliers = spark.createDataFrame([("S1", True), ("B1", True), ("S2", False)], "_ID string, ISDEMOACCOUNT boolean")
    assert sorted(r.demo_id for r in accounts.demo_ids(versions, suppliers).collect()) == ["B1", "S1"]
    log = versions.withColumns({"ISDELETED": F.lit(False), "__TS_MS": F.lit(0), "NAME": F.col("_ID"),
                                "RECORD_METADATA": F.lit(None).cast("string")})
    live = accounts._live_buyers(log, accounts.demo_ids(versions, suppliers), ["NAME"])
    assert [r.NAME for r in live.collect()] == ["B2"]
