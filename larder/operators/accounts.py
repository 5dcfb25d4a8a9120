"""Chains, buyers, departments, outlets, buyer users and roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.dialect import ntz_from_millis
from larder.functions.variants import elements, member_count, parsed, path_text
from larder.functions.versions import UPDATE_ORDER, latest_version, not_in

ROLE_MODULES = ("Purchasing", "Accounts Payable", "Inventory", "Recipes")


def demo_ids(buyers: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Ids that any version, however old, marks as a demo account."""
    marked = [s.filter("ISDEMOACCOUNT").selectExpr("_ID AS demo_id") for s in (buyers, suppliers)]
    return marked[0].unionByName(marked[1]).distinct()


def _live_buyers(buyers: DataFrame, demo: DataFrame, nested: list[str]) -> DataFrame:
    """Latest live version per buyer, with the creation time of the buyer's first version.

    That time is the running minimum of the versions' creation times in *text* order, up to the
    latest version. Among texts of equal length text order is numeric order, so the smallest text
    per length is enough. One pass over the log carries both: the newest version, and the smallest text of every
    length, each reduced before a shuffle.
    """
    live = not_in(buyers.filter("NOT ISDEMOACCOUNT AND NOT ISDELETED"), "_ID", demo).selectExpr(
        "_ID", "UPDATEDATETIME", "__TS_MS", *nested,
        f"{path_text(parsed('RECORD_METADATA'), '$.CreateTime')} AS _created",
    )
    # A NULL ranks before every value, as in ``latest_version``.
    order = F.struct(*[part for c in UPDATE_ORDER for part in (F.col(c).isNull(), F.col(c))])
    per_length = live.groupBy("_ID", F.length("_created").alias("_length")).agg(
        F.min("_created").alias("_first"), F.max(order).alias("_order"),
        F.max_by(F.struct("UPDATEDATETIME", "_created", *nested), order).alias("_newest"),
    )
    folded = per_length.groupBy("_ID").agg(
        F.collect_list("_first").alias("_firsts"), F.max_by("_newest", "_order").alias("_newest"))
    first_millis = (
        "array_min(transform(filter(_firsts, t -> _created IS NULL OR t <= _created), t -> CAST(t AS BIGINT)))"
    )
    return folded.select("_ID", "_firsts", "_newest.*").selectExpr(
        "_ID", "UPDATEDATETIME", *nested, f"{ntz_from_millis(first_millis)} AS buyer_created_at")


def chain(chains: DataFrame) -> DataFrame:
    """Latest version of every chain; ties on the update time are broken by name."""
    newest = latest_version(chains, "_ID", ("UPDATEDATETIME", F.col("NAME").asc_nulls_last()))
    return newest.selectExpr(
        "_ID AS chain_id", "NAME AS chain_name", "CREATEDATETIME AS create_datetime", "ISDISABLED AS is_disabled",
        "ISDEMO AS is_demo",
    )


def buyer_department_outlet(buyers: DataFrame, demo: DataFrame, chains: DataFrame) -> DataFrame:
    """Live buyers exploded to their outlets. `chains` is the output of :func:`chain`.

    A department without outlets vanishes; a buyer without any outlet keeps one row.
    """
    live = _live_buyers(
        buyers, demo,
        ["CHAINID", "NAME", "ADDRESS", "TIMEZONE", "CREATEDATETIME", "DELETEDATETIME",
         "BUYERDEPARTMENTS", "ALLOWEDAUTHROLESIDS", "ISDISABLED"],
    )
    outlets = f"""flatten(transform({elements('_departments')},
        d -> transform({elements('d', '$.Outlets')}, o -> struct(d AS department, o AS outlet))))"""
    rows = live.selectExpr("*", f"{parsed('BUYERDEPARTMENTS')} AS _departments").selectExpr(
        "CHAINID AS chain_id", "_ID AS buyer_id", "buyer_created_at", "DELETEDATETIME AS buyer_deleted_at",
        "NAME AS buyer_name",
        f"{path_text(parsed('ADDRESS'), '$.City')} AS buyer_city",
        f"{path_text(parsed('ADDRESS'), '$.Country')} AS buyer_country",
        f"{path_text(parsed('TIMEZONE'), '$._id')} AS timezone",
        "CREATEDATETIME AS time_created", "UPDATEDATETIME AS time_updated",
        "ALLOWEDAUTHROLESIDS AS allowedauthrolesids", "ISDISABLED AS isdisabled",
        f"explode_outer({outlets}) AS _unit",
    )
    named = chains.selectExpr(
        "chain_id AS _chain", "chain_name", "is_disabled AS is_disabled_chain", "is_demo AS is_demo_chain"
    )
    department, outlet = "_unit.department", "_unit.outlet"
    return rows.join(named, F.expr("chain_id = _chain"), "left").selectExpr(
        "chain_id", "buyer_id", "buyer_created_at", "buyer_deleted_at",
        f"{path_text(department, '$._id')} AS department_id",
        f"{path_text(outlet, '$._id')} AS outlet_id",
        "chain_name", "buyer_name",
        f"{path_text(department, '$.Name')} AS department_name",
        f"{path_text(outlet, '$.Name')} AS outlet_name",
        "buyer_city", "buyer_country", "timezone", "time_created", "time_updated",
        f"{path_text(outlet, '$.Code')} AS code_outlet",
        f"{path_text(outlet, '$.Description')} AS description_outlet",
        f"{path_text(outlet, '$.Budget.Value')} AS budget_value_outlet",
        "allowedauthrolesids", "isdisabled", "is_disabled_chain", "is_demo_chain",
    )


def buyer_timezone(hierarchy: DataFrame) -> DataFrame:
    """One zone name per buyer: the last in alphabetical order."""
    return hierarchy.groupBy("buyer_id").agg(F.max("timezone").alias("timezone"))


def buyer_user_stage(buyers: DataFrame, demo: DataFrame) -> DataFrame:
    """Users of live buyers, one row per outlet; a user without outlets vanishes."""
    live = _live_buyers(buyers, demo, ["CHAINID", "USERS"])
    users = live.selectExpr(
        "_ID AS buyer_id", "buyer_created_at", "CHAINID AS chain_id", f"{parsed('USERS')} AS _users"
    ).selectExpr("buyer_id", "buyer_created_at", "chain_id", f"explode({elements('_users')}) AS _user")
    return users.selectExpr("*", f"explode({elements('_user', '$.OutletsIds')}) AS _outlet").selectExpr(
        f"{path_text('_user', '$._id')} AS user_id",
        f"{path_text('_outlet', '$')} AS outlet_id",
        "buyer_id", "buyer_created_at", "chain_id",
        f"{path_text('_user', '$.FirstName')} AS firstname",
        f"{path_text('_user', '$.LastName')} AS lastname",
        f"{path_text('_user', '$.ContactInfo.Email')} AS email",
        f"{path_text('_user', '$.ContactInfo.Tel')} AS phone",
        f"{path_text('_user', '$.JobTitle')} AS jobtitle",
    )


def role_mapping(roles: DataFrame) -> DataFrame:
    """The role lookup as it is."""
    return roles


def buyer(hierarchy: DataFrame, roles: DataFrame) -> DataFrame:
    """One row per buyer with a flag for every module its roles open.

    Only a role list or an empty object keeps a buyer; NULL or malformed text drops it.
    """
    carried = ["chain_id", "buyer_id", "buyer_name", "buyer_created_at", "buyer_city",
               "buyer_country", "timezone", "isdisabled", "allowedauthrolesids"]
    role_ids = f"""CASE WHEN {member_count('allowedauthrolesids')} = 0 THEN array(CAST(NULL AS STRING))
        ELSE transform({elements(parsed('allowedauthrolesids'))}, r -> {path_text('r', '$')}) END"""
    held = (
        hierarchy.select(*carried).distinct()
        .selectExpr(*carried[:-1], f"explode({role_ids}) AS _role")
    )
    modules = roles.selectExpr("Id AS _role_id", "Module AS _module")
    flags = [
        F.expr(f"coalesce(bool_or(_module = '{m}'), false) AS {m.lower().replace(' ', '_')}") for m in ROLE_MODULES
    ]
    return (
        held.join(modules, F.expr("_role = _role_id"), "left")
        .groupBy("chain_id", "buyer_id", "buyer_name")
        .agg(
            F.min("buyer_created_at").alias("buyer_created_at"),
            *[F.max(c).alias(c) for c in ("buyer_city", "buyer_country", "timezone", "isdisabled")],
            *flags,
        )
    )


def buyer_group(hierarchy: DataFrame) -> DataFrame:
    """Number of buyers per chain."""
    return hierarchy.groupBy("chain_id", "chain_name", "is_disabled_chain", "is_demo_chain").agg(
        F.count_distinct("buyer_id").alias("count_distinct_buyers")
    )


def buyer_outlet(hierarchy: DataFrame) -> DataFrame:
    """The distinct buyer, department and outlet hierarchy."""
    return hierarchy.select(
        "chain_id", "buyer_id", "buyer_created_at", "buyer_deleted_at", "department_id", "outlet_id",
        "chain_name", "buyer_name", "department_name", "outlet_name", "code_outlet",
        "description_outlet", "budget_value_outlet",
    ).distinct()


def buyer_user(users: DataFrame) -> DataFrame:
    """Distinct users by outlet."""
    return users.select(
        "chain_id", "buyer_id", "outlet_id", "user_id", "firstname", "lastname", "email", "phone", "jobtitle",
    ).distinct()
