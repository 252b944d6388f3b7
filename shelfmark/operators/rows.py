"""Row filters, deduplication and lineage columns."""

from functools import reduce

from pyspark.sql import functions as F


def require(df, columns):
    """Rows where every listed column is non-null; empty strings stay."""
    # Plain null tests reach the scan; dropna's own test does not, and takes NaN for a null.
    return df.filter(_all(F.col(f"`{name}`").isNotNull() for name in columns))


def positive(df, column):
    """Rows whose column is above zero; NULL is not."""
    return df.filter(F.col(column) > 0)


def in_range(df, column, low=None, high=None):
    """Rows whose column lies within the given inclusive bounds; NULL does not."""
    bounds = []
    if low is not None:
        bounds.append(F.col(column) >= low)
    if high is not None:
        bounds.append(F.col(column) <= high)
    return df.filter(_all(bounds)) if bounds else require(df, [column])


def dedup_latest(df, keys, latest=()):
    """One row per key: the one with the largest `latest` columns, then the largest others.

    Columns compare in the order given, then in the order of the table, a NULL below any value,
    so the winner does not depend on the order of the input. Rows with a NULL key form one group.
    A maximum is taken in every map task before the shuffle, so a hot key sends one row per task
    however many rows it has.
    """
    keys, latest = list(keys), list(latest)
    others = [name for name in df.columns if name not in {*keys, *latest}]
    if not latest and not others:
        return df.distinct()
    fields = [F.col(f"`{name}`") for name in [*latest, *others]]
    best = df.groupBy(*[F.col(f"`{name}`") for name in keys]).agg(
        F.max(F.struct(*fields)).alias("_best")
    )
    return best.select(
        *[
            F.col(f"`{name}`") if name in keys else F.col("_best")[name].alias(name)
            for name in df.columns
        ]
    )


def add_lineage(df, source, extracted_at):
    """Where a raw record came from and when."""
    return df.withColumns({"source": F.lit(source), "extracted_at": extracted_at})


def mark_layer(df, layer, batch_ts=None):
    """The layer a row belongs to and when it got there."""
    return df.withColumns({"layer": F.lit(layer), "transformed_at": moment(batch_ts)})


def moment(batch_ts=None):
    """A batch time as a column: a datetime, a timestamp string, or now when None."""
    if batch_ts is None:
        return F.current_timestamp()
    return F.lit(batch_ts).cast("timestamp")


def _all(conditions):
    return reduce(lambda a, b: a & b, conditions)
