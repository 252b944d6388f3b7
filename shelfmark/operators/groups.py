"""Rankings and per-group summaries."""

from pyspark.sql import functions as F

from .sketches import estimates, sketch_by


def top_k(df, order, k):
    """The first k rows in a total order. Spark keeps k rows per task, then merges them."""
    return df.orderBy(*order).limit(k)


def count_by(df, key, rows, distinct, exact=True):
    """Rows and distinct values per key, in key order.

    `distinct` maps output names to columns; nulls are not counted. Exact distinct values are first
    reduced in the map tasks and then spread by (key, value), so a hot key is not one task. With
    `exact=False` they are estimated by sketches, of which a task sends one a key.
    """
    if not exact:
        counted = estimates(sketch_by(df, [key], rows, distinct), distinct)
        return counted.orderBy(F.col(key).asc())
    counts = [F.count_distinct(F.col(column)).alias(name) for name, column in distinct.items()]
    return df.groupBy(key).agg(F.count("*").alias(rows), *counts).orderBy(F.col(key).asc())


def number_stats(df, key, column, rows, low, high, mean, digits=2):
    """Rows, minimum, maximum and mean of a number per key, keys descending."""
    value = F.col(column)
    return (
        df.groupBy(key)
        .agg(
            F.count("*").alias(rows),
            F.round(F.min(value), digits).alias(low),
            F.round(F.max(value), digits).alias(high),
            F.round(F.avg(value), digits).alias(mean),
        )
        .orderBy(F.col(key).desc())
    )


def size_ranking(df, key, rows, mean_of, mean, span_of, first, last, digits=2):
    """Groups by size: rows, mean of one column, smallest and largest of another."""
    return (
        df.groupBy(key)
        .agg(
            F.count("*").alias(rows),
            F.round(F.avg(mean_of), digits).alias(mean),
            F.min(span_of).alias(first),
            F.max(span_of).alias(last),
        )
        .orderBy(F.col(rows).desc(), F.col(key).asc())
    )
