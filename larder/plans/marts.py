"""All result tables as lazy DataFrames over one set of raw inputs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from larder.functions.versions import sent_if_small
from larder.operators import accounts, checks, clickstream, clusters, daily, desertion
from larder.operators import documents, inventory, orders, suppliers
from larder.operators.checks import Check
from larder.sources.tables import drop_staged, publish, staged, staged_so_far, write_version

# Tables that are stored; everything else stays a view.
BASE_TABLES = ["buyer", "buyer_group", "buyer_outlet", "buyer_user", "document_unified", "document_header",
               "document_line", "inventory_unified", "inventory_header", "inventory_line", "order_unified",
               "order_header", "order_line", "supplier_unified", "supplier", "supplier_group", "supplier_user"]
MART_TABLES = ["daily_buyer", "daily_buyer_supplier", "daily_supplier", "desertion_metrics", "events",
               "buyer_outlet_features", "cluster_buyer_outlets"]
VIEWS = ["demo_ids", "buyer_department_outlet", "buyer_timezone", "buyer_user_stage", "chain",
         "document_header_stage", "document_line_stage", "inventory_header_stage", "inventory_line_stage",
         "order_header_stage", "order_line_stage", "role_mapping", "supplier_stage", "supplier_buyer",
         "supplier_contact", "supplier_group_stage", "events_stage", "non_active_buyers"]


# Checks of tables, made while they are written.
CHECKS: dict[str, tuple[Check, ...]] = {"buyer_department_outlet": checks.HIERARCHY}


class Marts:
    """Every operator applied to the raw inputs that `raw(name)` delivers, computed on demand."""

    def __init__(self, raw: Callable[[str], DataFrame], as_of: dt.date):
        self._inputs: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}
        self._read = raw
        self._since = staged_so_far()
        # What the checks of the tables stored so far have found.
        self.check_results: list[checks.Result] = []
        self.as_of = as_of

    def raw(self, name: str) -> DataFrame:
        """A raw input; operators that share one share its plan."""
        if name not in self._inputs:
            self._inputs[name] = self._read(name)
        return self._inputs[name]

    def stored(self, name: str) -> DataFrame:
        """A table that several others read, written once instead of computed for each of them."""
        if name not in self._stored:
            self._keep(name, staged(getattr(self, name), name, CHECKS.get(name, ()), self.check_results))
        return self._stored[name]

    def _keep(self, name: str, table: DataFrame) -> None:
        """Have later tables read a written one; the ids that nearly all of them exclude go to every task while they are few."""
        self._stored[name] = sent_if_small(table) if name == "demo_ids" else table

    @cached_property
    def demo_ids(self) -> DataFrame:
        return accounts.demo_ids(self.raw("buyers"), self.raw("suppliers"))

    @cached_property
    def chain(self) -> DataFrame:
        return accounts.chain(self.raw("chains"))

    @cached_property
    def buyer_department_outlet(self) -> DataFrame:
        return accounts.buyer_department_outlet(self.raw("buyers"), self.stored("demo_ids"), self.chain)

    @cached_property
    def buyer_timezone(self) -> DataFrame:
        return accounts.buyer_timezone(self.stored("buyer_department_outlet"))

    @cached_property
    def buyer_user_stage(self) -> DataFrame:
        return accounts.buyer_user_stage(self.raw("buyers"), self.stored("demo_ids"))

    @cached_property
    def role_mapping(self) -> DataFrame:
        return accounts.role_mapping(self.raw("roles"))

    @cached_property
    def buyer(self) -> DataFrame:
        return accounts.buyer(self.stored("buyer_department_outlet"), self.role_mapping)

    @cached_property
    def buyer_group(self) -> DataFrame:
        return accounts.buyer_group(self.stored("buyer_department_outlet"))

    @cached_property
    def buyer_outlet(self) -> DataFrame:
        return accounts.buyer_outlet(self.stored("buyer_department_outlet"))

    @cached_property
    def buyer_user(self) -> DataFrame:
        return accounts.buyer_user(self.buyer_user_stage)

    @cached_property
    def order_header_stage(self) -> DataFrame:
        return orders.order_header_stage(self.raw("orders"), self.stored("demo_ids"), self.stored("buyer_timezone"))

    @cached_property
    def order_line_stage(self) -> DataFrame:
        return orders.order_line_stage(self.raw("orders"), self.stored("demo_ids"))

    @cached_property
    def order_unified(self) -> DataFrame:
        return orders.order_unified(self.raw("orders"), self.stored("demo_ids"), self.stored("buyer_timezone"))

    def order_columns(self, columns: list[str]) -> DataFrame:
        """Some columns of the unified orders: of their stored table, or of a fold that carries no others."""
        if "order_unified" in self._stored:
            return self._stored["order_unified"].select(*columns)
        return orders.order_unified(self.raw("orders"), self.stored("demo_ids"), self.stored("buyer_timezone"), columns)

    @cached_property
    def order_header(self) -> DataFrame:
        return orders.order_header(self.order_columns(orders.ROLLUP_COLUMNS))

    @cached_property
    def order_line(self) -> DataFrame:
        return orders.order_line(self.order_columns(orders.LINES))

    @cached_property
    def document_header_stage(self) -> DataFrame:
        return documents.document_header_stage(self.raw("documents"), self.stored("demo_ids"), self.stored("buyer_timezone"))

    @cached_property
    def document_line_stage(self) -> DataFrame:
        return documents.document_line_stage(self.raw("documents"), self.stored("demo_ids"))

    @cached_property
    def document_unified(self) -> DataFrame:
        return documents.document_unified(self.raw("documents"), self.stored("demo_ids"), self.stored("buyer_timezone"))

    def document_columns(self, columns: list[str]) -> DataFrame:
        """Some columns of the unified documents, as in `order_columns`."""
        if "document_unified" in self._stored:
            return self._stored["document_unified"].select(*columns)
        return documents.document_unified(self.raw("documents"), self.stored("demo_ids"), self.stored("buyer_timezone"), columns)

    @cached_property
    def document_header(self) -> DataFrame:
        return documents.document_header(self.document_columns([*documents.KEYS, *documents.ROLLED_UP]))

    @cached_property
    def document_line(self) -> DataFrame:
        return documents.document_line(self.document_columns(documents.LINES))

    @cached_property
    def inventory_header_stage(self) -> DataFrame:
        return inventory.inventory_header_stage(self.raw("inventory_counts"), self.stored("demo_ids"), self.stored("buyer_timezone"))

    @cached_property
    def inventory_line_stage(self) -> DataFrame:
        return inventory.inventory_line_stage(self.raw("inventory_counts"), self.stored("demo_ids"))

    @cached_property
    def inventory_unified(self) -> DataFrame:
        return inventory.inventory_unified(self.raw("inventory_counts"), self.stored("demo_ids"), self.stored("buyer_timezone"))

    def inventory_columns(self, columns: list[str]) -> DataFrame:
        """Some columns of the unified counts, as in `order_columns`."""
        if "inventory_unified" in self._stored:
            return self._stored["inventory_unified"].select(*columns)
        return inventory.inventory_unified(self.raw("inventory_counts"), self.stored("demo_ids"), self.stored("buyer_timezone"), columns)

    @cached_property
    def inventory_header(self) -> DataFrame:
        return inventory.inventory_header(self.inventory_columns(inventory.ROLLED_UP))

    @cached_property
    def inventory_line(self) -> DataFrame:
        return inventory.inventory_line(self.inventory_columns(inventory.LINES))

    @cached_property
    def supplier_stage(self) -> DataFrame:
        return suppliers.supplier_stage(self.raw("supplier_groups"), self.stored("demo_ids"))

    @cached_property
    def supplier_buyer(self) -> DataFrame:
        return suppliers.supplier_buyer(self.raw("links"), self.stored("demo_ids"))

    @cached_property
    def supplier_contact(self) -> DataFrame:
        return suppliers.supplier_contact(self.raw("contacts"))

    @cached_property
    def supplier_group_stage(self) -> DataFrame:
        return suppliers.supplier_group_stage(self.raw("supplier_groups"))

    @cached_property
    def supplier_unified(self) -> DataFrame:
        return suppliers.supplier_unified(
            self.supplier_stage, self.supplier_buyer, self.supplier_group_stage, self.supplier_contact
        )

    @cached_property
    def supplier(self) -> DataFrame:
        return suppliers.supplier(self.supplier_unified)

    @cached_property
    def supplier_group(self) -> DataFrame:
        return suppliers.supplier_group(self.supplier_unified)

    @cached_property
    def supplier_user(self) -> DataFrame:
        return suppliers.supplier_user(self.supplier_unified)

    @cached_property
    def events_stage(self) -> DataFrame:
        return clickstream.events_stage(self.raw("events"))

    @cached_property
    def events(self) -> DataFrame:
        return clickstream.events(self.events_stage, self.latest_buyer_metrics)

    @cached_property
    def daily_buyer(self) -> DataFrame:
        return daily.daily_buyer(
            self.buyer_outlet, self.buyer, self.order_columns(daily.BUYER_ORDERS),
            self.document_columns(daily.BUYER_DOCUMENTS), self.inventory_columns(daily.BUYER_COUNTS), as_of=self.as_of,
        )

    @cached_property
    def daily_buyer_supplier(self) -> DataFrame:
        return daily.daily_buyer_supplier(
            self.supplier_unified, self.buyer_outlet, self.order_columns(daily.LINK_ORDERS))

    @cached_property
    def daily_supplier(self) -> DataFrame:
        return daily.daily_supplier(self.supplier_unified, self.order_columns(daily.SUPPLIER_ORDERS))

    @cached_property
    def non_active_buyers(self) -> DataFrame:
        return daily.non_active_buyers(self.buyer, self.daily_buyer, self.raw("chains"), as_of=self.as_of)

    @cached_property
    def desertion_metrics(self) -> DataFrame:
        return desertion.desertion_metrics(self.stored("daily_buyer"))

    @cached_property
    def latest_metrics(self) -> DataFrame:
        return desertion.latest_metrics(self.stored("daily_buyer"))

    @cached_property
    def latest_buyer_metrics(self) -> DataFrame:
        return desertion.latest_buyer_metrics(self.stored("daily_buyer"))

    @cached_property
    def buyer_outlet_features(self) -> DataFrame:
        if "desertion_metrics" in self._stored:
            return clusters.buyer_outlet_features(
                self._stored["desertion_metrics"], self.raw("categories"), as_of=self.as_of)
        return clusters.recent_features(self.stored("daily_buyer"), self.raw("categories"), as_of=self.as_of)

    @cached_property
    def cluster_buyer_outlets(self) -> DataFrame:
        return clusters.cluster_buyer_outlets(self.stored("buyer_outlet_features"))

    @cached_property
    def cluster_invariants(self) -> DataFrame:
        features = self.stored("buyer_outlet_features")
        return clusters.cluster_invariants(features, self.stored("cluster_buyer_outlets"))

    @cached_property
    def hierarchy_checks(self) -> DataFrame:
        return checks.hierarchy_checks(self.stored("buyer_department_outlet"))

    def store(self, folder: str, database: str | None = None) -> None:
        """Full refresh: base tables and marts are written below `folder`, views registered for the session.

        Each table is written as a new version, which later tables read instead of computing the earlier ones again.
        Only when all are written do the new versions take the place of the old ones, each by one rename: a refresh that
        fails before, or whose check fails, leaves every table as it was. Read them with ``tables.read_table``.

        With `database` every table and view also gets a view in the catalog, which other sessions see. Spark stores
        SQL text there, and these operators have none: the rows of the views are written as well, and the catalog's views
        show the versions of this refresh.
        """
        versions = {}
        for name in CHECKS:
            self.stored(name)
        checks.refuse(self.check_results)
        written = VIEWS[:-1] if database else []
        for name in written + BASE_TABLES + MART_TABLES + (VIEWS[-1:] if database else []):
            table, versions[name] = write_version(getattr(self, name), f"{folder}/{name}")
            setattr(self, name, table)
            self._keep(name, table)
        spark = table.sparkSession
        for name in VIEWS:
            getattr(self, name).createOrReplaceTempView(name)
        for name, version in versions.items():
            publish(spark, f"{folder}/{name}", version)
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
            for name, version in versions.items():
                spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS "
                          f"SELECT * FROM parquet.`{folder}/{name}/{version}`")

    def close(self) -> None:
        """Delete the intermediate tables written since this object was made; tables that `store` has written stay.

        Results that were not stored or collected cannot be computed any more."""
        for source in list(self._inputs.values())[:1]:
            drop_staged(source.sparkSession, self._since)
        self._stored.clear()

    def __enter__(self) -> Marts:
        return self

    def __exit__(self, *failure: object) -> None:
        self.close()
