"""Works listed in fetched subject responses."""

from pyspark.sql import functions as F

from ..functions.fields import field, has_field
from ..schemas import RAW_RESPONSES

# Fixed value: the `source` of these records.
API_SOURCE = "openlibrary_api"

_BODY = "struct<works: array<variant>>"


def read_raw_responses(spark, path, fmt="parquet", partitions=None):
    """Fetched responses: (subject, body), Parquet or JSON Lines.

    `partitions` deals the raw rows out anew, a shuffle that helps only where the files hold fewer
    splits than the cluster has cores. Without it they stay where they are read.
    """
    raw = spark.read.schema(RAW_RESPONSES).format(fmt).load(path)
    return raw.repartition(partitions) if partitions else raw


def all_works(responses, subject="subject", body="body", subjects=None, limit=None):
    """Every listed work with a `valid` flag, one row per work.

    A body that is not a JSON object, or lists no works, gives no rows. A work is valid when it
    is an object whose authors, if given, are a list. As in a lookup with a default, the default
    stands in for an absent field only; an explicit null stays NULL.
    """
    if subjects is not None:
        responses = responses.filter(F.col(subject).isin(list(subjects)))
    works = F.from_json(F.col(body), _BODY)["works"]
    if limit is not None:
        works = F.slice(works, 1, limit)
    rows = responses.select(
        F.col(subject).alias("subject"), F.inline(F.transform(works, _raw_fields))
    )
    return rows.select(
        "title",
        "authors",
        "first_publish_year",
        "subject",
        "edition_count",
        "key",
        F.col("valid"),
    )


def works_from_responses(responses, subject="subject", body="body", subjects=None, limit=None):
    """The valid works, in the columns of a Bronze record without its lineage."""
    return all_works(responses, subject, body, subjects, limit).filter("valid").drop("valid")


def _raw_fields(work):
    authors = F.try_variant_get(work, "$.authors", "array<variant>")
    is_object = has_field(work, "$.title") | F.try_variant_get(
        work, "$", "map<string, variant>"
    ).isNotNull()
    return F.struct(
        field(work, "$.title", "string", "").alias("title"),
        F.when(
            has_field(work, "$.authors"),
            F.transform(authors, lambda author: field(author, "$.name", "string", "")),
        )
        .otherwise(F.array().cast("array<string>"))
        .alias("authors"),
        F.try_variant_get(work, "$.first_publish_year", "int").alias("first_publish_year"),
        field(work, "$.edition_count", "int", 0).alias("edition_count"),
        field(work, "$.key", "string", "").alias("key"),
        (is_object & (authors.isNotNull() | ~has_field(work, "$.authors"))).alias("valid"),
    )
