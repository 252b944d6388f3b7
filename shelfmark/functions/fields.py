"""Fields of a JSON value (variant), telling an absent field from an explicit null."""

from pyspark.sql import functions as F


def has_field(value, path):
    """Whether the path is there at all, be it null."""
    return F.try_variant_get(value, path, "variant").isNotNull()


def field(value, path, dtype, default):
    """The field as `dtype`. `default` if absent; NULL if null or of another type."""
    given = F.try_variant_get(value, path, dtype)
    return F.when(has_field(value, path), given).otherwise(F.lit(default))
