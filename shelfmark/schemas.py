"""Declared schemas of every layer. Readers use these and never infer."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


STRING = T.StringType()
INT = T.IntegerType()

# What was fetched, before any parsing.
RAW_PAGES = _struct(("url", STRING), ("html", STRING))
RAW_RESPONSES = _struct(("subject", STRING), ("body", STRING))

LANDING_CSV_COLUMNS = [
    "ISBN",
    "Book-Title",
    "Book-Author",
    "Year-Of-Publication",
    "Publisher",
    "Image-URL-S",
    "Image-URL-M",
    "Image-URL-L",
]
LANDING_CSV = _struct(*[(name, STRING) for name in LANDING_CSV_COLUMNS])

BRONZE_WEB = _struct(
    ("title", STRING),
    ("price_gbp", T.DoubleType()),
    ("rating", INT),
    ("availability", STRING),
    ("source", STRING),
    ("extracted_at", T.TimestampType()),
)
# Every file column stays a string: an ISBN keeps its leading zeros.
BRONZE_CSV = _struct(
    *[(name, STRING) for name in LANDING_CSV_COLUMNS],
    ("source", STRING),
    ("extracted_at", T.TimestampType()),
)
BRONZE_API = _struct(
    ("title", STRING),
    ("authors", T.ArrayType(STRING)),
    ("first_publish_year", INT),
    ("subject", STRING),
    ("edition_count", INT),
    ("key", STRING),
    ("source", STRING),
    ("extracted_at", T.TimestampType()),
)
BRONZE = {"web": BRONZE_WEB, "csv": BRONZE_CSV, "api": BRONZE_API}

_LINEAGE = [
    ("source", STRING),
    ("extracted_at", T.TimestampType()),
    ("layer", STRING),
    ("transformed_at", T.TimestampType()),
]
SILVER_WEB = _struct(
    ("title", STRING),
    ("price_gbp", T.FloatType()),
    ("rating", INT),
    ("availability", STRING),
    *_LINEAGE,
)
SILVER_CSV = _struct(
    ("isbn", STRING),
    ("title", STRING),
    ("author", STRING),
    ("year", INT),
    ("publisher", STRING),
    *_LINEAGE,
)
SILVER_API = _struct(
    ("key", STRING),
    ("title", STRING),
    ("authors", STRING),
    ("first_publish_year", INT),
    ("edition_count", INT),
    ("subject", STRING),
    *_LINEAGE,
)
SILVER = {"web": SILVER_WEB, "csv": SILVER_CSV, "api": SILVER_API}

STEP_STATUS = _struct(
    ("step", STRING),
    ("status", STRING),
    ("rows_in", T.LongType()),
    ("rows_out", T.LongType()),
    ("seconds", T.DoubleType()),
    ("path", STRING),
    ("error", STRING),
)
