"""Suppliers, supplier groups, buyer links and contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.versions import exclude_all, latest_version, not_in

CONTACT = ["user_id", "firstname", "lastname", "email", "phonenumber", "autosendemail", "autosendsms"]


def supplier_stage(suppliers: DataFrame, demo: DataFrame) -> DataFrame:
    """Latest live suppliers with their group and operating company.

    The input is a parameter: by default the plans pass the supplier-groups change log.
    """
    live = not_in(suppliers.filter(~F.col("ISDEMOACCOUNT") & ~F.col("ISDELETED")), "_ID", demo)
    return latest_version(live, "_ID").select(
        F.col("_ID").alias("supplier_id"), F.col("SUPPLIERGROUPID").alias("suppliers_group_id"),
        F.col("OPCO").alias("opco"),
    )


def supplier_buyer(links: DataFrame, demo: DataFrame) -> DataFrame:
    """Latest live links between buyers and suppliers, neither side a demo account."""
    live = exclude_all(links.filter(~F.col("ISDELETED")), ["BUYERID", "SUPPLIERID"], demo)
    order = ("UPDATEDATETIME", F.col("BUYERID").asc_nulls_last(), F.col("SUPPLIERID").asc_nulls_last())
    return latest_version(live, "ID", order).select(
        F.col("ID").alias("buyer_supplier_id"), F.col("BUYERID").alias("buyer_id"),
        F.col("SUPPLIERID").alias("supplier_id"),
    )


def supplier_contact(contacts: DataFrame) -> DataFrame:
    """Latest live supplier contacts."""
    return latest_version(contacts.filter(~F.col("ISDELETED")), "ID").select(
        F.col("ID").alias("user_id"), F.col("BUYERSUPPLIERID").alias("buyer_supplier_id"),
        F.col("FIRSTNAME").alias("firstname"), F.col("LASTNAME").alias("lastname"),
        F.col("EMAILADDRESS").alias("email"), F.col("PHONENUMBER").alias("phonenumber"),
        F.col("AUTOSENDEMAIL").alias("autosendemail"), F.col("AUTOSENDSMS").alias("autosendsms"),
    )


def supplier_group_stage(groups: DataFrame) -> DataFrame:
    """Latest live supplier groups."""
    live = groups.filter(~F.col("ISDEMOACCOUNT") & ~F.col("ISDELETED"))
    return latest_version(live, "_ID").select(
        F.col("_ID").alias("suppliers_group_id"), F.col("NAME").alias("suppliers_group_name"),
    )


def supplier_unified(suppliers: DataFrame, links: DataFrame, groups: DataFrame, contacts: DataFrame) -> DataFrame:
    """Suppliers with their group, the buyers they serve and the contacts of every link."""
    return (
        suppliers.join(links, "supplier_id", "left")
        .join(groups, "suppliers_group_id", "left")
        .join(contacts, "buyer_supplier_id", "left")
        .select("supplier_id", "opco", "suppliers_group_id", "suppliers_group_name", "buyer_id", *CONTACT)
    )


def supplier(unified: DataFrame) -> DataFrame:
    """Buyers and contacts connected to each supplier."""
    return unified.groupBy("supplier_id", "suppliers_group_id").agg(
        F.max("opco").alias("opco"),
        F.count_distinct("buyer_id").alias("num_buyers_connected"),
        F.count_distinct("user_id").alias("num_users_connected"),
    )


def supplier_group(unified: DataFrame) -> DataFrame:
    """Suppliers connected to each group."""
    return unified.groupBy("suppliers_group_id", "suppliers_group_name").agg(
        F.count_distinct("supplier_id").alias("num_connected_suppliers")
    )


def supplier_user(unified: DataFrame) -> DataFrame:
    """Contacts that have a user id."""
    return unified.filter(F.col("user_id").isNotNull()).select(
        "suppliers_group_id", "supplier_id", "buyer_id", *CONTACT
    )
