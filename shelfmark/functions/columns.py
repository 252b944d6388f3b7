"""Casts, trimming and lookups. None of them raises under ANSI mode."""

from pyspark.sql import functions as F

# Star-rating words and their numbers.
RATING_WORDS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}

# The tokens pandas.read_csv reads as missing by default.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Every character Python's str.strip() removes.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# An integer of up to 18 digits besides leading zeros, with any fraction after it.
_INTEGER = r"^[\x00-\x20]*([+-]?0*[0-9]{1,18})(?:\.[0-9]*)?[\x00-\x20]*$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def safe_int(col):
    """Integer value of a string, NULL where it has none.

    "2002.0" gives 2002; exponents such as "1e3" are not integers and give NULL.
    """
    # The pattern comes first, as a cast that fails costs far more than one that is not tried.
    digits = F.regexp_extract_all(_col(col), F.lit(_INTEGER), F.lit(1))
    return F.try_element_at(digits, F.lit(1)).cast("bigint").try_cast("int")


def safe_double(col):
    """Double value of a plain decimal string, NULL where it has none."""
    col = F.btrim(_col(col), F.lit(WHITESPACE))
    return F.when(col.rlike(_NUMBER), col.try_cast("double"))


def strip_ws(col):
    """Strip all leading and trailing Unicode whitespace (F.trim strips spaces only)."""
    return F.btrim(_col(col), F.lit(WHITESPACE))


def clean_price(col):
    """Price text such as "£51.77" or the mis-decoded "Â£51.77" as a double."""
    return safe_double(F.translate(_col(col), "£Â", ""))


def lookup(col, table, default):
    """Value of `table` (a small dict) for the column, or `default`."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(col)), F.lit(default))


def rating_from_word(col):
    """Star-rating word as 1..5, 0 when unknown."""
    return lookup(col, RATING_WORDS, 0)


def token(col, position):
    """The token at a 1-based position of a whitespace-separated string, NULL if absent."""
    return F.try_element_at(F.split(strip_ws(col), r"\s+"), F.lit(position))


def null_if_in(col, tokens):
    """NULL where the column equals one of the tokens."""
    col = _col(col)
    return F.when(col.isin(list(tokens)), F.lit(None)).otherwise(col)


def array_text(col):
    """Array as display text: [A, B], [] when empty, NULL when null."""
    return _col(col).cast("string")


def batch_stamp(col):
    """Timestamp in the format that names a batch, e.g. 20250131_235959."""
    return F.date_format(_col(col), "yyyyMMdd_HHmmss")


def sql_text(value):
    """A string as a literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pinned(col):
    """The column, as a value that Spark computes where it stands.

    Else a filter on it is moved to below, with all that the column is made of written out in it.
    """
    return F.when(F.monotonically_increasing_id() >= 0, col)


def _col(col):
    return F.col(col) if isinstance(col, str) else col
