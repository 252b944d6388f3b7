"""Bronze -> Silver: valid, deduplicated, typed records.

Rows are filtered before they are deduplicated, so an invalid copy never displaces a valid one
and the filters reach the scan. Of several copies the one extracted last wins. The key is
compared as it is unless normalize_key trims it first.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import functions as F

from ..functions.columns import array_text, safe_int
from ..operators.quality import is_between, is_positive
from ..operators.rows import dedup_latest, in_range, mark_layer, positive, require

MIN_YEAR = 1800
MAX_YEAR = 2024

_CSV_NAMES = {
    "ISBN": "isbn",
    "Book-Title": "title",
    "Book-Author": "author",
    "Year-Of-Publication": "year",
    "Publisher": "publisher",
}
_API_COLUMNS = (
    "key title authors first_publish_year edition_count subject source extracted_at"
).split()
_CSV_IMAGES = ["Image-URL-S", "Image-URL-M", "Image-URL-L"]


@dataclass(frozen=True)
class SilverJob:
    """`prepare` keeps valid rows in the columns of the table, of which one of each `key` is kept;
    `finish` cleans what was kept. Rows compare as `prepare` leaves them."""

    key: str
    prepare: Callable
    finish: Callable

    def __call__(self, bronze, batch_ts=None, normalize_key=False, **bounds):
        return self.finish(self.deduplicated(bronze, normalize_key, **bounds), batch_ts)

    def deduplicated(self, bronze, normalize_key=False, **bounds):
        rows = self.prepare(bronze, **bounds)
        if normalize_key:
            rows = rows.withColumn(self.key, F.trim(self.key))
        return dedup_latest(rows, [self.key], ["extracted_at"])


def _valid_web(bronze):
    return positive(require(bronze, ["price_gbp"]), "price_gbp")


def _finished_web(df, batch_ts=None):
    df = df.withColumns(
        {
            "title": F.trim("title"),
            "price_gbp": F.col("price_gbp").cast("float"),
            "rating": F.col("rating").cast("int"),
            "availability": F.trim("availability"),
        }
    )
    return mark_layer(df, "silver", batch_ts)


def _valid_csv(bronze, min_year=MIN_YEAR, max_year=MAX_YEAR):
    df = bronze.drop(*_CSV_IMAGES).withColumnsRenamed(_CSV_NAMES)
    df = require(df, ["isbn", "title", "author"]).withColumn("year", safe_int("year"))
    return in_range(df, "year", min_year, max_year)


def _finished_csv(df, batch_ts=None):
    df = df.withColumns({"title": F.trim("title"), "author": F.trim("author")})
    return mark_layer(df, "silver", batch_ts)


def _valid_api(bronze, min_year=MIN_YEAR):
    df = require(bronze, ["title"]).withColumns(
        {
            "first_publish_year": F.col("first_publish_year").cast("int"),
            "edition_count": F.col("edition_count").cast("int"),
            "authors": array_text("authors"),
        }
    )
    return in_range(df, "first_publish_year", low=min_year)


def _finished_api(df, batch_ts=None):
    rest = [name for name in df.columns if name not in _API_COLUMNS]
    df = df.withColumn("title", F.trim("title")).select(*_API_COLUMNS, *rest)
    return mark_layer(df, "silver", batch_ts)


silver_web = SilverJob("title", _valid_web, _finished_web)
silver_csv = SilverJob("isbn", _valid_csv, _finished_csv)
# A work listed under several subjects is kept under one of them.
silver_api = SilverJob("key", _valid_api, _finished_api)

SILVER_JOBS = {"web": silver_web, "csv": silver_csv, "api": silver_api}

# What a written Silver table must satisfy before it replaces the one before.
SILVER_CHECKS = {
    "web": [is_positive("price_gbp")],
    "csv": [is_between("year", MIN_YEAR, MAX_YEAR)],
    "api": [is_between("first_publish_year", MIN_YEAR, 2**31 - 1)],
}
