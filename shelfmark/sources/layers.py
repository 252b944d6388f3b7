"""Scans of Bronze and Silver tables by their declared schemas."""

from pyspark.sql import functions as F

from ..schemas import BRONZE, SILVER
from ..sinks.switch import require_table
from .arrays import read_objects
from .records import read_declared_csv


def read_bronze(
    spark, layers, source, fmt=None, multi_line=False, file_column=None, splits=False
):
    """Every batch of a Bronze source, whatever folder or file below it holds it.

    `multi_line` reads JSON files that hold one array each instead of one record per line; such
    a file is one task. CSV is always read with quoted line breaks allowed, as the writer bounds
    the size of its files, and a file whose header is not the declared one is an error.
    With `splits` several tasks share a large file of either kind, with the same rows.
    `file_column` adds the file each row came from.
    """
    fmt = fmt or batch_format(source)
    path = layers.bronze_path(source)
    if splits and file_column is None and (fmt == "csv" or (fmt == "json" and multi_line)):
        read = read_declared_csv if fmt == "csv" else read_objects
        return read(spark, path, BRONZE[source])
    reader = spark.read.schema(BRONZE[source]).option("recursiveFileLookup", True)
    for name, value in _read_options(fmt, multi_line).items():
        reader = reader.option(name, value)
    df = reader.format(fmt).load(path)
    if file_column is not None:
        df = df.withColumn(file_column, F.col("_metadata.file_path"))
    return df


def read_batch(spark, path, source, fmt=None):
    """One batch, as it was written."""
    fmt = fmt or batch_format(source)
    options = _read_options(fmt, False)
    return spark.read.schema(BRONZE[source]).options(**options).format(fmt).load(path)


def read_silver(spark, layers, source):
    """A Silver table. One that is missing, or that a failed write left unfinished, is an error."""
    # A table in buckets has the bucket as a column too.
    schema = SILVER[source]
    return open_table(spark, layers.silver_path(source), schema).select(*schema.names)


def open_table(spark, path, schema=None):
    """A replaced table: always a whole one. Without one at `path` MissingTable is raised."""
    require_table(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def batch_format(source):
    """Default file format of a Bronze source."""
    return "csv" if source == "csv" else "json"


def _read_options(fmt, multi_line):
    if fmt == "csv":
        return {"header": True, "enforceSchema": False, "escape": '"', "multiLine": True}
    if fmt == "json":
        return {"multiLine": multi_line}
    return {}
