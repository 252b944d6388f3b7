"""Distinct counts from sketches that are kept, so that new rows are counted without reading the old.

A HyperLogLog sketch of `log_size` has 2 ** log_size registers and a relative standard error of about
1.04 / sqrt(2 ** log_size), 1.6 % at the default of 12; it takes a few kilobytes, whatever it counts.
"""

import math

from pyspark.sql import functions as F

LOG_SIZE = 12


def relative_error(log_size=LOG_SIZE):
    """The standard error of an estimate, as a share of the count."""
    return 1.04 / math.sqrt(1 << log_size)


def sketch_by(df, keys, rows, distinct, log_size=LOG_SIZE):
    """Rows, and a sketch of the distinct values of each column, per key.

    `distinct` maps output names to columns; nulls are not counted. One shuffle of partial sketches: a
    task sends one row a key, however many rows the key has.
    """
    sketches = [_sketch(column, log_size).alias(name) for name, column in distinct.items()]
    return df.groupBy(*keys).agg(F.count("*").alias(rows), *sketches)


def union_sketches(sketches, keys, rows, distinct):
    """One row per key from tables of sketches over parts of the rows, put together."""
    merged = [F.hll_union_agg(name).alias(name) for name in distinct]
    return sketches.groupBy(*keys).agg(F.sum(rows).alias(rows), *merged)


def estimates(sketches, distinct):
    """The sketch columns as counts; a sketch of nothing counts 0."""
    return sketches.withColumns(
        {name: F.coalesce(F.hll_sketch_estimate(name), F.lit(0)).cast("bigint") for name in distinct}
    )


def _sketch(column, log_size):
    # The type of a sketch must not hang on that of the column.
    return F.hll_sketch_agg(F.col(column).cast("string"), F.lit(log_size))

