"""Data-quality checks, answered together in one aggregation over the table."""

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """`failed` is an aggregate over the whole table that counts offending rows."""

    name: str
    column: str
    failed: Callable[[], Column]


def not_empty():
    return Check("not_empty", "*", lambda: F.when(F.count("*") == 0, 1).otherwise(0))


def at_most(k):
    return Check("at_most", "*", lambda: F.greatest(F.count("*") - k, F.lit(0)))


def is_positive(column):
    return Check("positive", column, lambda: F.count_if(~_holds(F.col(column) > 0)))


def is_between(column, low, high):
    return Check("between", column, lambda: F.count_if(~_holds(F.col(column).between(low, high))))


def is_unique(*columns):
    # Inside a struct a NULL key counts as one value, as it does in deduplication.
    return Check(
        "unique", ",".join(columns), lambda: F.count("*") - F.count_distinct(F.struct(*columns))
    )


def missing_columns(df, required):
    """Required columns the table lacks; looks at the schema only."""
    return [name for name in required if name not in df.columns]


def quality_report(df, checks, required=()):
    """One row per check: (check, column, failed_rows, total_rows).

    A required column that is missing counts as failed for every row, and at least once.
    """
    absent = set(missing_columns(df, required))
    lines = [
        _line(
            "column_present",
            name,
            F.greatest(F.count("*"), F.lit(1)) if name in absent else F.lit(0),
        )
        for name in required
    ]
    lines += [_line(check.name, check.column, check.failed()) for check in checks]
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def violations(report):
    return report.filter(F.col("failed_rows") > 0)


def _line(name, column, failed):
    return F.struct(
        F.lit(name).alias("check"),
        F.lit(column).alias("column"),
        failed.cast("long").alias("failed_rows"),
        F.count("*").alias("total_rows"),
    )


def _holds(condition):
    return F.coalesce(condition, F.lit(False))
