"""Folding change logs to their latest version, and null-aware exclusion lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPDATE_ORDER = ("UPDATEDATETIME", "__TS_MS")


def with_zone(rows: DataFrame, zones: DataFrame) -> DataFrame:
    """Rows with their buyer's time zone as `_zone`; joined before a fold, the rows are not shuffled once more after it."""
    known = zones.selectExpr("buyer_id AS _buyer", "timezone AS _zone")
    return rows.join(known, F.expr("BUYERID = _buyer"), "left").drop("_buyer")


def latest_version(versions: DataFrame, key: str, order: tuple[str | Column, ...] = UPDATE_ORDER) -> DataFrame:
    """Newest row per key; a NULL in an ordering column ranks before every value.

    The filter on ``row_number`` lets Spark keep one row per key in every input partition before
    the shuffle, so a key with very many versions does not gather in one task.
    """
    newest_first = Window.partitionBy(key).orderBy(
        *[F.col(c).desc_nulls_first() if isinstance(c, str) else c for c in order]
    )
    return versions.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def not_in(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``key NOT IN (ids)`` with SQL's null rules, without a forced broadcast of the list.

    An empty list keeps every row; otherwise a NULL key is dropped, and a NULL in the list drops
    everything. Both facts come from a one-row subquery. What remains is an ordinary anti join,
    for which the planner chooses broadcast or shuffle by size, unless ``sent_if_small`` has chosen.
    """
    id_column = ids.columns[0]
    listed = ids.select(F.col(id_column).alias("_listed_id"))
    facts = listed.agg(
        F.struct(
            F.count(F.lit(1)).alias("entries"),
            F.count_if(F.col("_listed_id").isNull()).alias("nulls"),
        ).alias("facts")
    ).scalar()
    eligible = (facts["entries"] == 0) | ((facts["nulls"] == 0) & F.col(key).isNotNull())
    return rows.filter(eligible).join(listed, F.col(key) == F.col("_listed_id"), "left_anti")


# Bytes up to which a list of ids is sent to every task, and what an entry takes besides its text.
SENT_LIST = 10 << 20
ENTRY = 48


def sent_if_small(ids: DataFrame, most: int = SENT_LIST) -> DataFrame:
    """A stored list of ids, to be sent to every task by the joins that read it while it holds at most `most` bytes.

    Beyond the planner's own limit, which may be far lower, an anti join places and sorts all rows by the id, and what needs
    them placed otherwise does so once more. A longer list is left to the planner."""
    held = ids.agg(F.sum(F.coalesce(F.octet_length(ids.columns[0]), F.lit(0)) + ENTRY)).first()[0] or 0
    return F.broadcast(ids) if held <= most else ids


def exclude_all(rows: DataFrame, keys: list[str], ids: DataFrame) -> DataFrame:
    """Apply the same exclusion list to several columns."""
    for key in keys:
        rows = not_in(rows, key, ids)
    return rows
