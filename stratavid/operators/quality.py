"""Declarative data checks.

Each gives rows ``(check, column, severity, failing_rows)``; a check fails where
``failing_rows > 0``. All row-level checks of a table share one pass over it, and with
``check_entries`` and ``verdicts`` all checks of all tables do, key checks included.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "error"
WARN = "warn"


@dataclass(frozen=True)
class RowCheck:
    """A check decided on one row alone; ``fails`` marks the bad rows."""

    check: str
    column: str
    fails: Column
    severity: str = ERROR


def not_null(column: str, severity: str = ERROR) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNull(), severity)


def accepted_range(
    column: str, minimum: float | None = None, maximum: float | None = None, severity: str = ERROR
) -> RowCheck:
    """Values below the minimum or above the maximum fail; null passes."""
    low = F.col(column) < minimum if minimum is not None else F.lit(False)
    high = F.col(column) > maximum if maximum is not None else F.lit(False)
    return RowCheck("accepted_range", column, low | high, severity)


def expression_is_true(
    expression: str, column: str = "", nulls_fail: bool = False, severity: str = ERROR
) -> RowCheck:
    """Rows where a SQL condition is false fail; an unknown outcome fails only on request."""
    outcome = F.expr(expression)
    fails = ~F.coalesce(outcome, F.lit(False)) if nulls_fail else ~outcome
    return RowCheck("expression_is_true", column or expression, fails, severity)


def row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """All ``checks`` in one aggregation without a shuffle of the data."""
    counts = df.agg(*[F.count_if(c.fails).alias(f"n{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.check).alias("check"),
            F.lit(c.column).alias("column"),
            F.lit(c.severity).alias("severity"),
            F.col(f"n{i}").alias("failing_rows"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def unique(df: DataFrame, column: str, severity: str = ERROR) -> DataFrame:
    """Number of values that occur more than once; null is not a value."""
    repeated = df.groupBy(column).count().filter(F.col(column).isNotNull() & (F.col("count") > 1))
    return _verdict(repeated.agg(F.count("*").alias("n")), "unique", column, severity)


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, severity: str = ERROR
) -> DataFrame:
    """Number of child rows whose key no parent has.

    Child keys are counted before the join, so a hot key meets the parent once.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).count()
    known = parent.select(F.col(parent_column).alias(column))
    orphans = keys.join(known, column, "left_anti")
    failing = orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"))
    return _verdict(failing, "relationships", column, severity)


def _verdict(failing: DataFrame, check: str, column: str, severity: str) -> DataFrame:
    return failing.select(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        F.lit(severity).alias("severity"),
        F.col("n").cast("bigint").alias("failing_rows"),
    )


@dataclass(frozen=True)
class KeyCheck:
    """A check on the values of a key column: that they are ``unique``, or that a parent has them.

    Without a relation it is a uniqueness check. ``relation`` names what child and parent share.
    """

    column: str
    severity: str = ERROR
    relation: str | None = None


STATE = "rule string, value string, own bigint, known bigint"


def check_entries(
    table: str, df: DataFrame, rows: Sequence[RowCheck], keys: Sequence[KeyCheck], parent_of: Mapping[str, str] = {}
) -> DataFrame:
    """What one pass over a table says about its checks, and about those that refer to it: STATE, not yet summed.

    A failing row is an entry of its check, a key value one of its rule with the rows that hold it.
    ``parent_of`` maps relations to the key columns of ``df`` that know their values.
    """

    def entry(rule: str, when: Column, value: Column, own: int, known: int) -> Column:
        return F.when(when, F.struct(F.lit(rule).alias("rule"), value.cast("string").alias("value"),
                                     F.lit(own).cast("bigint").alias("own"), F.lit(known).cast("bigint").alias("known")))

    nothing = F.lit(None)
    found = [entry(f"{table} row {i}", c.fails, nothing, 1, 0) for i, c in enumerate(rows)]
    found += [entry(f"{table} key {i}" if k.relation is None else k.relation, F.col(k.column).isNotNull(), F.col(k.column), 1, 0)
              for i, k in enumerate(keys)]
    found += [entry(relation, F.col(c).isNotNull(), F.col(c), 0, 1) for relation, c in parent_of.items()]
    return df.select(F.inline(F.array_compact(F.array(*found))))


def check_state(entries: DataFrame) -> DataFrame:
    """Entries summed by rule and value. States add up: that of a table is the state of its partitions' states."""
    return entries.groupBy("rule", "value").agg(F.sum("own").alias("own"), F.max("known").alias("known"))


def verdicts(state: DataFrame, declared: Sequence[tuple[str, Sequence[RowCheck], Sequence[KeyCheck]]]) -> DataFrame:
    """The report (with ``table``) of the declared checks, (table, row checks, key checks) each, from their state."""
    totals = state.groupBy("rule").agg(
        F.sum("own").alias("rows"),
        F.count_if(F.col("own") > 1).alias("repeated"),
        F.sum(F.when(F.col("known") == 0, F.col("own")).otherwise(0)).alias("orphans"),
    )
    lines = []
    for table, rows, keys in declared:
        lines += [(table, c.check, c.column, c.severity, f"{table} row {i}", "rows") for i, c in enumerate(rows)]
        for i, k in enumerate(keys):
            unique_ = k.relation is None
            rule = f"{table} key {i}" if unique_ else k.relation
            lines.append((table, "unique" if unique_ else "relationships", k.column, k.severity, rule, "repeated" if unique_ else "orphans"))
    names = "table string, check string, column string, severity string, rule string, counted string"
    listed = state.sparkSession.createDataFrame(lines, names)
    counted = F.when(F.col("counted") == "rows", F.col("rows")).when(F.col("counted") == "repeated", F.col("repeated"))
    failing = F.coalesce(counted.otherwise(F.col("orphans")), F.lit(0)).cast("bigint")
    # One line per declared check on either side.
    joined = listed.join(F.broadcast(totals), "rule", "left")
    return joined.select("table", "check", "column", "severity", failing.alias("failing_rows"))


def report(table: str, results: Sequence[DataFrame]) -> DataFrame:
    """One report for the check results of a table."""
    rows = reduce(DataFrame.unionByName, results)
    return rows.select(F.lit(table).alias("table"), *rows.columns)


class DataCheckError(Exception):
    """Some check of severity ``error`` failed."""


def enforce(checked: DataFrame) -> DataFrame:
    """The report, collected; raises if a check of severity ``error`` failed, warnings stay in it.

    The report has one row per declared check, which is what reaches the driver, so showing
    the result runs no check again.
    """
    rows = checked.collect()
    failed = [r for r in rows if r.severity == ERROR and r.failing_rows > 0]
    if failed:
        raise DataCheckError("; ".join(f"{r.check}({r.column}): {r.failing_rows} rows" for r in failed))
    return checked.sparkSession.createDataFrame(rows, checked.schema)
