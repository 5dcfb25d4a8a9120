"""Daily activity marts per buyer, outlet and supplier."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ORDER_MEASURES = ["ordered_quantity_item", "checkout_quantity", "ordered_quantity",
                  "ordered_total_price", "recieved_total_price"]
DOCUMENT_MEASURES = ["document_quantity", "total_price_document"]
INVENTORY_MEASURES = ["inventory_daily_count", "inventory_item_total_value"]
MEASURES = ORDER_MEASURES + DOCUMENT_MEASURES + INVENTORY_MEASURES
UNIT = ["buyer_id", "outlet_id"]
# Columns of the unified orders, documents and counts that the marts read.
BUYER_ORDERS = [*UNIT, "order_id", "checkout_id", "order_created_date", "quantity_packing_ordered_item",
                "total_price_ordered_item", "total_price_recieved_item"]
BUYER_DOCUMENTS = [*UNIT, "create_datetime", "document_id", "total_price_item_document"]
BUYER_COUNTS = [*UNIT, "create_datetime", "inventory_count_id", "inventory_item_total_value"]
SUPPLIER_ORDERS = ["supplier_id", "order_id", "recieved_date_item", "total_price_recieved_item"]
LINK_ORDERS = ["buyer_supplier_id", "buyer_id", *SUPPLIER_ORDERS]


def orders_by_day(unified: DataFrame) -> DataFrame:
    """One row per order: its unit and local day, its number of orders, its checkout and the sums of its lines."""
    day = F.to_date("order_created_date").alias("create_datetime")
    per_order = unified.groupBy(*UNIT, day, "order_id", "checkout_id").agg(
        F.sum("quantity_packing_ordered_item").alias("ordered_quantity_item"),
        F.sum("total_price_ordered_item").alias("ordered_total_price"),
        F.sum("total_price_recieved_item").alias("recieved_total_price"),
    )
    return per_order.withColumn("ordered_quantity", F.col("order_id").isNotNull().cast("bigint")).drop("order_id")


def documents_by_day(unified: DataFrame) -> DataFrame:
    """One row per document: its unit and local day, its number of documents and the sum of its lines."""
    day = F.to_date("create_datetime").alias("create_datetime")
    per_document = unified.groupBy(*UNIT, day, "document_id").agg(
        F.sum("total_price_item_document").alias("total_price_document"))
    return per_document.withColumn("document_quantity", F.col("document_id").isNotNull().cast("bigint")).drop("document_id")


def counts_by_day(unified: DataFrame) -> DataFrame:
    """One row per inventory count: its unit and local day, its number of counts and the sum of its items."""
    day = F.to_date("create_datetime").alias("create_datetime")
    per_count = unified.groupBy(*UNIT, day, "inventory_count_id").agg(
        F.sum("inventory_item_total_value").alias("inventory_item_total_value"))
    return per_count.withColumn("inventory_daily_count", F.col("inventory_count_id").isNotNull().cast("bigint")).drop(
        "inventory_count_id")


def with_yesterday(daily: DataFrame, as_of: dt.date) -> DataFrame:
    """All rows, and one empty row per unit on the day before `as_of`, beside the row that `_first_of_unit` marks.

    A sum over the rows of one day passes over the empty row wherever that day has a real one, so
    each (buyer, outlet) gets a row for yesterday without an anti join.
    """
    yesterday = F.lit(as_of - dt.timedelta(days=1))
    measures = [c for c in daily.columns if c not in (*UNIT, "create_datetime", "_first_of_unit")]
    empty = [F.lit(None).cast(daily.schema[c].dataType).alias(c) for c in measures]
    row = F.struct("create_datetime", *measures)
    both = F.array(row, F.struct(yesterday.alias("create_datetime"), *empty))
    return daily.select(*UNIT, F.inline(F.when(F.col("_first_of_unit"), both).otherwise(F.array(row))))


def daily_activity(orders: DataFrame, documents: DataFrame, inventory: DataFrame, as_of: dt.date) -> DataFrame:
    """The three feeds side by side, one row per buyer, nullable outlet and day.

    Orders, documents and counts are added up one by one where their change logs were folded. Then all three are placed by
    buyer in one shuffle, behind which one sort marks the first row of every checkout and unit, and one grouping adds up days
    with the rows for yesterday; a join by buyer needs no other. A full outer join on keys that are unique on every side is
    one grouping. Rows without a date never join, so they are kept apart by feed.
    """
    feeds = {
        "orders": orders_by_day(orders.filter(F.col("buyer_id").isNotNull())),
        "documents": documents_by_day(documents.filter(F.col("buyer_id").isNotNull())),
        "inventory": counts_by_day(inventory.filter(F.col("buyer_id").isNotNull())),
    }
    union = None
    for name, feed in feeds.items():
        undated = F.when(F.col("create_datetime").isNull(), F.lit(name))
        tagged = feed.withColumn("_undated_feed", undated)
        union = tagged if union is None else union.unionByName(tagged, allowMissingColumns=True)
    key = [*UNIT, "create_datetime", "_undated_feed"]
    # Rows are many times larger in a task's sort and grouping than in the shuffle: a fixed number of partitions keeps the
    # planner from merging them by their size there.
    partitions = int(union.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_unit = Window.partitionBy(*UNIT).orderBy("create_datetime", "_undated_feed", "checkout_id")
    same = [F.lag(c).over(of_unit).eqNullSafe(F.col(c)) for c in ("create_datetime", "_undated_feed", "checkout_id")]
    new_checkout = F.col("checkout_id").isNotNull() & ~(same[0] & same[1] & same[2])
    marked = union.repartition(partitions, "buyer_id").select(
        *key, *[c for c in MEASURES if c != "checkout_quantity"],
        (F.row_number().over(of_unit) == 1).alias("_first_of_unit"),
        new_checkout.cast("bigint").alias("checkout_quantity"),
    )
    # A day without orders has no number of checkouts, one whose orders have no checkout has none of them.
    checkouts = F.when(F.count("ordered_quantity") > 0, F.sum("checkout_quantity"))
    totals = {c: checkouts if c == "checkout_quantity" else F.sum(c) for c in MEASURES}
    return (
        with_yesterday(marked, as_of).groupBy(*key)
        .agg(*[total.alias(c) for c, total in totals.items()])
        .drop("_undated_feed")
    )


def outlet_directory(outlets: DataFrame) -> DataFrame:
    """Outlets by department, and one row without outlet for every buyer."""
    columns = ["chain_id", "buyer_id", "buyer_created_at", "buyer_deleted_at", "outlet_id",
               "chain_name", "buyer_name", "outlet_name"]
    whole_buyer = outlets.groupBy("chain_id", "buyer_id", "chain_name", "buyer_name").agg(
        F.min("buyer_created_at").alias("buyer_created_at"),
        F.min("buyer_deleted_at").alias("buyer_deleted_at"),
        F.lit(None).cast("string").alias("outlet_id"),
        F.lit(None).cast("string").alias("outlet_name"),
    )
    return outlets.select(*columns).unionByName(whole_buyer.select(*columns))


def daily_buyer(
    outlets: DataFrame, buyers: DataFrame, orders: DataFrame, documents: DataFrame,
    inventory: DataFrame, *, as_of: dt.date,
) -> DataFrame:
    """Daily orders, documents and inventory counts of buyers that are not disabled.

    Names and ids come from the directory and are NULL for an outlet it does not list. An outlet
    listed in several departments appears once per department.
    """
    activity = daily_activity(orders, documents, inventory, as_of)
    roles = buyers.filter(~F.col("isdisabled")).select(
        F.col("buyer_id").alias("_role_buyer"),
        F.col("purchasing").alias("role_purchasing"),
        F.col("accounts_payable").alias("role_accounts_payable"),
        F.col("inventory").alias("role_inventory"),
        "isdisabled",
    )
    directory = outlet_directory(outlets).alias("d")
    held = activity.join(roles, F.col("buyer_id") == F.col("_role_buyer")).alias("a")
    same_unit = (F.col("a.buyer_id") == F.col("d.buyer_id")) & F.col("a.outlet_id").eqNullSafe(F.col("d.outlet_id"))
    return held.join(directory, same_unit, "left").select(
        "d.chain_name", "d.buyer_name", "d.outlet_name", "d.buyer_created_at", "d.buyer_deleted_at",
        "a.create_datetime", *[f"a.{c}" for c in MEASURES],
        "d.chain_id", "d.buyer_id", "d.outlet_id",
        "a.role_purchasing", "a.role_accounts_payable", "a.role_inventory", "a.isdisabled",
    )


def _received(orders: DataFrame, keys: list[str]) -> DataFrame:
    day = F.to_date("recieved_date_item").alias("order_delivery_datetime")
    per_order = orders.groupBy(*keys, day, "order_id").agg(F.sum("total_price_recieved_item").alias("total"))
    return per_order.groupBy(*keys, "order_delivery_datetime").agg(
        F.count("order_id").alias("orders_placed"), F.sum("total").alias("orders_placed_total_price"),
    )


def _groups_of(suppliers: DataFrame) -> DataFrame:
    return suppliers.select("supplier_id", "suppliers_group_id").distinct()


def daily_buyer_supplier(suppliers: DataFrame, outlets: DataFrame, orders: DataFrame) -> DataFrame:
    """Received orders per buyer-supplier link and day; lines not received have no day."""
    chains = outlets.select("chain_id", "buyer_id").distinct()
    return (
        _received(orders, ["buyer_supplier_id", "buyer_id", "supplier_id"])
        .join(_groups_of(suppliers), "supplier_id", "left")
        .join(chains, "buyer_id", "left")
        .select("buyer_supplier_id", "buyer_id", "chain_id", "supplier_id", "suppliers_group_id",
                "order_delivery_datetime", "orders_placed", "orders_placed_total_price")
        .distinct()
    )


def daily_supplier(suppliers: DataFrame, orders: DataFrame) -> DataFrame:
    """Received orders per supplier and day; lines not received have no day."""
    return (
        _received(orders, ["supplier_id"])
        .join(_groups_of(suppliers), "supplier_id", "left")
        .select("supplier_id", "suppliers_group_id", "order_delivery_datetime", "orders_placed",
                "orders_placed_total_price")
    )


def non_active_buyers(
    buyers: DataFrame, daily: DataFrame, chains: DataFrame, *, as_of: dt.date, quiet_days: int = 7,
) -> DataFrame:
    """Buyers with payables, older than the quiet period, without a document during it.

    `chains` is the raw change log: every live version of the chain gives a row of its own.
    """
    since = as_of - dt.timedelta(days=quiet_days)
    day, quantity = F.col("create_datetime"), F.col("document_quantity")
    recent = daily.groupBy(F.col("buyer_id").alias("_active_buyer")).agg(
        F.max(F.when(quantity > 0, day)).alias("last_invoice_update_date"),
        F.sum(F.when(day.between(F.lit(since), F.lit(as_of)), quantity)).alias("_recent_documents"),
    )
    live_chains = chains.filter(~F.col("__DELETED") & ~F.col("ISDELETED")).select(
        F.col("_ID").alias("_chain"), F.col("NAME").alias("chain_name")
    )
    candidates = buyers.filter(
        ~F.col("isdisabled") & F.col("accounts_payable") & (F.col("buyer_created_at") <= F.lit(since))
    )
    return (
        candidates.join(recent, F.col("buyer_id") == F.col("_active_buyer"), "left")
        .filter(F.coalesce("_recent_documents", F.lit(0)) == 0)
        .join(live_chains, F.col("chain_id") == F.col("_chain"), "left")
        .select("chain_name", "buyer_name", "last_invoice_update_date", "buyer_created_at")
    )
