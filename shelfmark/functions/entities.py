"""Character references of HTML decoded by Spark itself, as Python's html.unescape does."""

from html.entities import html5

from pyspark.sql import functions as F

from .columns import sql_text

# What is taken for a reference, and what lies between them.
_PIECES = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
# Names that pages use most are found first.
_FREQUENT = ["amp;", "quot;", "lt;", "gt;", "nbsp;", "apos;", "pound;", "copy;", "amp"]
_SHORTEST = 2
_LONGEST = max(len(name) for name in html5 if not name.endswith(";"))
_MAX_CODE = 0x10FFFF
_SEPARATOR = "\x01"


def _table():
    """The characters of all names, as a map that Spark makes once."""
    names = [*_FREQUENT, *sorted(set(html5) - set(_FREQUENT))]
    columns = (names, [html5[name] for name in names])
    split = [f"split({sql_text(_SEPARATOR.join(own))}, '{_SEPARATOR}')" for own in columns]
    return f"map_from_arrays({', '.join(split)})"


# The characters of a name, or of the longest name it begins with, and the rest of it.
_NAMED = f"""
    coalesce(
        try_element_at({_table()}, name),
        CASE WHEN length(name) > {_SHORTEST} THEN get(filter(
            transform(sequence(least(length(name) - 1, {_LONGEST}), {_SHORTEST}, -1), size -> concat(
                try_element_at({_table()}, substr(name, 1, size)), substr(name, size + 1))),
            text -> text IS NOT NULL), 0) END,
        concat('&', name))
"""

# The code of a number. One of more digits than the largest has is no character.
_CODE = f"""
    transform(array(regexp_replace(piece, '^&#[xX]?0*|;$', '')), digits ->
        CASE WHEN length(digits) > 7 THEN {_MAX_CODE + 1} WHEN digits = '' THEN 0
        WHEN substr(piece, 3, 1) IN ('x', 'X') THEN cast(conv(digits, 16, 10) AS int)
        ELSE cast(digits AS int) END)[0]
"""

# C1 control codes stand for the characters that Windows-1252 has in their place.
_WINDOWS = "".join(
    bytes([own]).decode("cp1252", "ignore") or chr(own) for own in range(0x80, 0xA0)
)

# The character of a code. Some codes stand for others, or for nothing.
_CHARACTER = f"""
    CASE WHEN code = 0 OR code BETWEEN {0xD800} AND {0xDFFF} OR code > {_MAX_CODE} THEN '\\uFFFD'
    WHEN code BETWEEN {0x80} AND {0x9F} THEN substr({sql_text(_WINDOWS)}, code - {0x7F}, 1)
    WHEN code BETWEEN 1 AND 8 OR code = 11 OR code BETWEEN 14 AND 31 OR code = 127
        OR code BETWEEN {0xFDD0} AND {0xFDEF} OR code % {0x10000} IN ({0xFFFE}, {0xFFFF}) THEN ''
    ELSE decode(unhex(lpad(hex(code), 8, '0')), 'UTF-32') END
"""

_DECODED = f"""
    CASE WHEN NOT startswith(piece, '&') OR piece = '&' THEN piece
    WHEN piece = '&amp;' THEN '&'
    WHEN startswith(piece, '&#') THEN transform(array({_CODE}), code -> {_CHARACTER})[0]
    ELSE transform(array(substr(piece, 2)), name -> {_NAMED})[0] END
"""


def unescape(column):
    """The named column with its references as characters; a value without `&` is not looked at."""
    return F.expr(f"""
        CASE WHEN contains({column}, '&') THEN array_join(transform(
            regexp_extract_all({column}, {sql_text(_PIECES)}, 0), piece -> {_DECODED}), '')
        ELSE {column} END
    """)
