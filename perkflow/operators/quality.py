"""Data-quality rules as tables.

A suite is a list of rules over one DataFrame. All rules of a suite are
evaluated in ONE aggregation pass (one partial aggregate per task, one row
merged), then unpivoted into one result row per rule:

    rule, column, kind, evaluated, failed, success

Between / in-set rules ignore NULLs (a separate not-null rule covers them).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["rule", "column", "kind", "evaluated", "failed", "success"]


@dataclass(frozen=True)
class Rule:
    name: str
    column: str | None
    kind: str
    evaluated: Column  # aggregate expression
    failed: Column  # aggregate expression


def expect_row_count(expected: int | Column, name: str = "row_count_equal") -> Rule:
    """Row count equals ``expected`` (a number or a scalar-subquery column).
    ``evaluated`` is the observed count, ``failed`` how far it is off."""
    n = F.count(F.lit(1))
    exp = F.lit(expected) if isinstance(expected, int) else expected
    return Rule(name, None, "table_row_count", n, F.abs(n - exp))


def expect_between(column: str, low, high, name: str | None = None) -> Rule:
    c = F.col(column)
    return Rule(
        name or f"{column}_between",
        column,
        "values_between",
        F.count(c),
        F.count_if((c < F.lit(low)) | (c > F.lit(high))),
    )


def expect_in_set(column: str, values: Sequence, name: str | None = None) -> Rule:
    c = F.col(column)
    return Rule(name or f"{column}_in_set", column, "values_in_set", F.count(c), F.count_if(~c.isin(list(values))))


def expect_not_null(column: str, name: str | None = None) -> Rule:
    c = F.col(column)
    return Rule(name or f"{column}_not_null", column, "values_not_null", F.count(F.lit(1)), F.count_if(c.isNull()))


def run_suite(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    rules = list(rules)
    aggs = []
    for i, r in enumerate(rules):
        aggs += [r.evaluated.cast("bigint").alias(f"e{i}"), r.failed.cast("bigint").alias(f"f{i}")]
    one = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.column).cast("string").alias("column"),
                F.lit(r.kind).alias("kind"),
                F.col(f"e{i}").alias("evaluated"),
                F.col(f"f{i}").alias("failed"),
            )
            for i, r in enumerate(rules)
        ]
    )
    out = one.select(F.inline(rows))
    return out.withColumn("success", F.col("failed") == 0).select(*RESULT_COLUMNS)


def summarize(report: DataFrame) -> DataFrame:
    """Suite summary: overall success, successful / evaluated rule counts and
    the comma-separated names of failed rules (sorted)."""
    return report.agg(
        F.bool_and("success").alias("success"),
        F.count_if("success").alias("successful_rules"),
        F.count(F.lit(1)).alias("evaluated_rules"),
        F.concat_ws(",", F.sort_array(F.collect_list(F.when(~F.col("success"), F.col("rule"))))).alias(
            "failed_rules"
        ),
    )


def constraint_violations(df: DataFrame, table: str, checks: Mapping[str, Column]) -> DataFrame:
    """SQL CHECK semantics: a row violates a check only when the predicate is
    FALSE (NULL passes). One aggregation pass; one row per check:
    ``table_name, constraint_name, checked_rows, violations``."""
    names = list(checks)
    aggs = [F.count(F.lit(1)).alias("n")] + [
        F.count_if(checks[k] == F.lit(False)).alias(f"v{i}") for i, k in enumerate(names)
    ]
    one = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(k).alias("constraint_name"),
                F.col("n").alias("checked_rows"),
                F.col(f"v{i}").alias("violations"),
            )
            for i, k in enumerate(names)
        ]
    )
    return one.select(F.inline(rows))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary-key check: keys occurring more than once, with their count.
    Partial counts before the shuffle keep hot keys cheap."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_counts(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """NOT NULL check of many columns in one pass:
    ``table_name, column_name, checked_rows, nulls``."""
    one = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"z{i}") for i, c in enumerate(columns)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.col("n").alias("checked_rows"),
                F.col(f"z{i}").alias("nulls"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return one.select(F.inline(rows))


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Foreign-key check: child rows whose key has no parent (left anti join).
    As in SQL, a key with a NULL part passes."""
    known = child.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    return known.join(parent.select(*keys), list(keys), "left_anti")


def key_violations(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Primary-key report: ``table_name, key_columns, key_value, n`` of every key that occurs more than once."""
    value = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    return duplicate_keys(df, keys).select(
        F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), value.alias("key_value"), "n"
    )
