"""The registered queries: every operator over the test tables, in comparable types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators import clusters, desertion
from larder.operators.daily import MEASURES
from larder.plans.marts import BASE_TABLES, VIEWS, Marts
from larder.sources.testshape import AS_OF, TestShape

Query = Callable[[SparkSession, str], DataFrame]
# Added to sums before rounding: exact halves then do not depend on the order of addition.
OFF_TIES = 0.0001234
# Added to single values for the same reason: engines differ in rounding a half that has no exact double.
OFF_HALVES = 1.234e-9
# Sums of money times days have more digits than a double.
MONEY_MEASURES = {"ordered_quantity_item", "ordered_total_price", "recieved_total_price", "total_price_document",
                  "inventory_item_total_value"}


def marts(spark: SparkSession, folder: str) -> Marts:
    """All operators over the test tables in `folder`."""
    return Marts(TestShape(spark, folder).raw, AS_OF)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals and doubles rounded to six digits, sums of outlet weights to the nine they have,
    dates and times as text."""

    def plain(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            if field.name.startswith("pre_buyer_"):
                column = F.round(column, desertion.WEIGHT_DIGITS)
            else:
                column = F.round(column.cast("double") + OFF_HALVES, 6)
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            column = column.cast("string")
        return column.alias(field.name.lower())

    return df.select(*[plain(f) for f in df.schema.fields])


def digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count, and per buyer and outlet the number and sum of every column's values, and a sum weighted by the
    day, in which a value on the wrong day shows.

    The first step has only numbers in its sums and adds up by hashing, before any shuffle; names in a maximum would have
    every row sorted first."""
    parts, names, wholes = [], ["chain_name", "outlet_name"], []
    weight = F.datediff("create_datetime", F.lit("2000-01-01").cast("date")) % 97
    for name in columns:
        column = F.col(name)
        if isinstance(df.schema[name].dataType, T.DateType):
            number = F.datediff(column, F.lit("2000-01-01").cast("date"))
            part, part_by_day = F.sum(number), F.sum(number * weight)
            total, by_day = F.sum(f"_{name}"), F.sum(f"_{name}_by_day")
        else:
            part, part_by_day = F.sum(column), F.sum(column.cast("double") * weight)
            total = F.round(F.sum(f"_{name}").cast("double") + OFF_TIES, 3)
            by_day = F.round(F.sum(f"_{name}_by_day") + OFF_TIES, 1)
        if name not in MONEY_MEASURES:
            parts.append(part_by_day.alias(f"_{name}_by_day"))
            wholes.append(by_day.alias(f"{name}_by_day"))
        parts += [F.count(column).alias(f"_{name}_rows"), part.alias(f"_{name}")]
        wholes += [F.sum(f"_{name}_rows").alias(f"{name}_rows"), total.alias(name)]
    named = df.groupBy("buyer_id", "outlet_id", *names).agg(F.count(F.lit(1)).alias("_days"), *parts)
    return named.groupBy("buyer_id", "outlet_id").agg(
        *[F.max(c).alias(c) for c in names], F.sum("_days").alias("days"), *wholes)


def _each(*patterns: str) -> list[str]:
    return [p.format(kind) for p in patterns for kind in desertion.KINDS]


def calendar(m: Marts) -> DataFrame:
    return digest(desertion.calendar(m.stored("daily_buyer")), [*MEASURES, "create_datetime", *_each("previous_{}_date")])


def activity_deltas(m: Marts) -> DataFrame:
    days = desertion.deltas(desertion.calendar(m.stored("daily_buyer")))
    return digest(days, [*_each("{}_delta"), "period_days_from_minimum", "window_days", "create_datetime"])


def _sparse(m: Marts, per_day: bool = True) -> DataFrame:
    return desertion.medians(desertion.facts(m.stored("daily_buyer")), per_day=per_day)


def _graded(m: Marts) -> DataFrame:
    """Graded calendar of every unit; units without a buyer id have no grades."""
    unknown = desertion.deltas(desertion.unknown_calendar(m.stored("daily_buyer")).withColumns(
        {c: F.lit(None).cast("date") for c in _each("previous_{}_date")}))
    return desertion.graded_days(_sparse(m)).unionByName(unknown, allowMissingColumns=True)


def trailing_medians(m: Marts) -> DataFrame:
    return digest(_graded(m), [*_each("median_{}_interval_per_row", "avg_recent_{}_median"), "create_datetime"])


def outlet_grades(m: Marts) -> DataFrame:
    return digest(_graded(m), _each("{}_expected_real_delta", "grade_{}_outlet", "pre_outlet_{}_weighet",
                                    "predicted_next_{}_date"))


def buyer_weights(m: Marts) -> DataFrame:
    return comparable(desertion.buyer_weights(_sparse(m, per_day=False)))


def buyer_days(m: Marts) -> DataFrame:
    sparse = desertion.staged(_sparse(m), "medians")
    days = desertion.buyer_days(desertion.graded_days(desertion.by_buyer(sparse)), desertion.buyer_weights(sparse))
    grades = [*desertion.BUYER_GRADES.values(), "overall_weighted_buyer_grade"]
    return days.groupBy("buyer_id").agg(
        F.count(F.lit(1)).alias("days"),
        *[f(c) for c in grades for f in (
            lambda c: F.count(c).alias(f"{c}_rows"), lambda c: F.round(F.sum(c) + OFF_TIES, 3).alias(c))],
    )


def desertion_metrics(m: Marts) -> DataFrame:
    text = {"chain_name", "buyer_name", "outlet_name", "chain_id", "buyer_id", "outlet_id", *desertion.ROLES}
    left_out = text | {"period_days_from_minimum", "window_days", *_each("days_till_next_{}")}
    return digest(m.desertion_metrics, [c for c in desertion.METRIC_COLUMNS if c not in left_out])


def latest_scores(m: Marts) -> DataFrame:
    return comparable(m.latest_metrics)


def cluster_sizes(m: Marts) -> DataFrame:
    return clusters.cluster_sizes(m.cluster_buyer_outlets)


SPECIAL = [calendar, activity_deltas, trailing_medians, outlet_grades, buyer_weights, buyer_days,
           desertion_metrics, latest_scores, cluster_sizes]
PLAIN = [*VIEWS, *BASE_TABLES, "events", "daily_buyer", "daily_buyer_supplier", "daily_supplier",
         "buyer_outlet_features", "cluster_buyer_outlets", "cluster_invariants", "hierarchy_checks"]


def queries() -> dict[str, Query]:
    """One query per operator: name to a function of (session, test folder)."""

    def plain(name: str) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(getattr(marts(spark, folder), name))
        return run

    def special(report: Callable[[Marts], DataFrame]) -> Query:
        return lambda spark, folder: report(marts(spark, folder))

    registered = {name: plain(name) for name in PLAIN}
    registered.update({report.__name__: special(report) for report in SPECIAL})
    return registered
