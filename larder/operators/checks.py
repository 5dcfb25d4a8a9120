"""Data checks: counts of failing rows with a verdict, counted in a pass of their own or while a table is written."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class Check:
    """Rows for which `fails` holds, an SQL condition, are failures; more than `tolerated` give the severity, which is
    'error' or 'warn'."""

    name: str
    fails: str
    severity: str = "error"
    tolerated: int = 0

    def failing(self) -> Column:
        return F.count_if(F.coalesce(F.expr(self.fails), F.lit(False)))

    def status(self, failing: int) -> str:
        return self.severity if failing > self.tolerated else "pass"


class CheckFailed(Exception):
    """A check of severity error failed."""


def not_null(column: str, severity: str = "error", tolerated: int = 0) -> Check:
    """A check of rows that lack `column`."""
    return Check(f"not_null_{column}", f"{column} IS NULL", severity, tolerated)


# The buyer hierarchy needs a buyer name, and tolerates one row without a buyer id.
HIERARCHY = (not_null("buyer_name"), not_null("buyer_id", severity="warn", tolerated=1))


def results(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """One row per check: its name, the number of failing rows and 'pass' or the severity. Reads `df` once."""
    checks = list(checks)
    counted = df.agg(*[check.failing().alias(f"_{at}") for at, check in enumerate(checks)])
    rows = [
        F.struct(F.lit(check.name).alias("check_name"), F.col(f"_{at}").alias("failing_rows"),
                 F.when(F.col(f"_{at}") > check.tolerated, F.lit(check.severity)).otherwise(F.lit("pass")).alias("status"))
        for at, check in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Result:
    """What a check found while a table was written."""

    check_name: str
    failing_rows: int
    status: str


def with_checks(df: DataFrame, checks: Iterable[Check], write: Callable[[DataFrame], None]) -> list[Result]:
    """Write `df` by `write` and count the checks' failing rows in the same pass. Failures beyond what a check
    tolerates are logged; ``refuse`` makes errors of them."""
    checks = list(checks)
    if not checks:
        write(df)
        return []
    observed = Observation()
    write(df.observe(observed, *[check.failing().alias(check.name) for check in checks]))
    counts = observed.get
    found = [Result(check.name, counts[check.name], check.status(counts[check.name])) for check in checks]
    for result in found:
        if result.status != "pass":
            LOG.warning("%s: %s has %d failing rows", result.status, result.check_name, result.failing_rows)
    return found


def refuse(found: Iterable[Result]) -> None:
    """Raise CheckFailed if a check of severity error failed."""
    errors = [f"{result.check_name}: {result.failing_rows} rows" for result in found if result.status == "error"]
    if errors:
        raise CheckFailed("; ".join(errors))


def hierarchy_checks(hierarchy: DataFrame) -> DataFrame:
    """The checks of the buyer hierarchy, in a pass of their own."""
    return results(hierarchy, HIERARCHY)
