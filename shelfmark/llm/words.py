"""Words of a text as Spark columns: runs without the six ASCII blanks."""

from pyspark.sql import functions as F

# The characters that separate words, U+0020 and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text):
    """A-Z in lower case; other letters as they are."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words_of(text):
    """The words of a text column; none for a null text."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, _GAP)
    )


def with_results(docs, needed, new, use):
    """`docs` with the columns `new` of `use(held)`, whatever other columns `docs` has.

    `held` has each row as one struct, `row`, and the columns `needed` (name to column) that `use` works
    with, so that no name of its own can clash with one of the table. Columns of `docs` named as one of
    `new`, in any case, are replaced.
    """
    held = docs.select(
        F.struct("*").alias("row"), *[column.alias(name) for name, column in needed.items()]
    )
    replaced = {name.lower() for name in new}
    kept = [name for name in docs.columns if name.lower() not in replaced]
    return use(held).select(*[F.col("row")[name].alias(name) for name in kept], *new)


def bound(value, use):
    """`use(value)` with `value` computed once, for columns that are read at many places."""
    return F.transform(F.array(value), use)[0]
