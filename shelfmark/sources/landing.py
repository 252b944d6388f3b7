"""Landing CSV files: mixed encodings, layouts and quoting, read without a declared encoding."""

import csv
import re
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NA_TOKENS, null_if_in
from ..schemas import LANDING_CSV_COLUMNS
from .records import assemble_records, lines_of, number_lines

_MALFORMED = "_malformed"
_QUOTED_FIELD = r'"[^"]*+(?:""[^"]*+)*+"'
# A quote opens a field only where the field begins.
_WHOLE_QUOTED_FIELD = rf"(?<![^,]){_QUOTED_FIELD}"
_FIELD = rf'(?>{_QUOTED_FIELD}|(?!")[^,]*+)'
# A line made of whole fields only. When every line of a file is one, no record spans lines.
_WHOLE_RECORD = rf"^{_FIELD}(?:,{_FIELD})*+$"


# One task parses a file up to this size in about a minute; larger ones are read in splits, with the
# same rows.
LARGE_FILE_BYTES = 4 * 1024**3

# A longer first line is no header; it would pass through the driver.
HEADER_CHARS = 1 << 20
# Fields that Spark's parser makes room for, unless lines are wider.
_FIELDS = 20480

# How the records of a file are found.
BY_LINE = "each line is a record"
BY_FILE = "one task parses the file"
BY_QUOTES = "lines are joined by their quotes"


@dataclass(frozen=True)
class Layout:
    """What a file must be read with."""

    header: str
    utf8: bool
    records: str
    line_end: str | None
    fields: int

    @property
    def columns(self):
        """Names of the header; repeated ones are numbered, as `a`, `a.1`, `a.2`."""
        names, seen = [], set()
        for name in next(csv.reader([self.header])):
            own, count = name, 0
            while own in seen:
                count += 1
                own = f"{name}.{count}"
            seen.add(own)
            names.append(own)
        return names

    @property
    def encoding(self):
        return "UTF-8" if self.utf8 else "ISO-8859-1"


def _as_paths(names):
    """File names as Spark reports them, as paths that its readers take literally."""
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(name)) for name in names]


def profile_landing(spark, path):
    """One row per file: its header, encoding, kind of lines, and the start of its last split.

    The header is the first line that is not blank.
    """
    has_return = F.col("value").contains("\r")
    line = F.when(has_return, F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    first = F.when((F.col("block_start") == 0) & line.rlike(r"\S"), F.col("line"))
    returns = F.col("value").endswith("\r")
    return (
        lines_of(spark, path)
        .groupBy("file_path")
        .agg(
            F.min_by(F.left("value", F.lit(HEADER_CHARS + 1)), first).alias("header"),
            F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
            F.bool_and(line.rlike(_WHOLE_RECORD) & ~line.contains("\r")).alias("one_line_records"),
            F.bool_and(returns).alias("all_returns"),
            F.bool_or(returns).alias("any_returns"),
            F.max(F.length("value") - F.length(F.replace("value", F.lit(",")))).alias("commas"),
            F.max("block_start").alias("last_split"),
        )
    )


def _layouts(spark, path, large):
    """Names of the files of each layout.

    How a file is read depends on its content and on its size, but its rows do not: where one task
    parses a file, all its lines end alike and records end as its lines do.
    """
    # One short row per file, as Spark's own file listing holds on the driver.
    rows = [row for row in profile_landing(spark, path).collect() if row["header"] is not None]
    for row in rows:
        if len(row["header"]) > HEADER_CHARS:
            raise ValueError(f"the first line of {row['file_path']} is too long for a header")
    mixed = {row["file_path"] for row in rows if row["any_returns"] and not row["all_returns"]}
    files = {}
    for row in rows:
        name = row["file_path"]
        records = BY_LINE if row["one_line_records"] else BY_FILE
        if records == BY_FILE and (row["last_split"] >= large or name in mixed):
            records = BY_QUOTES
        line_end = None if name in mixed else "\r\n" if row["all_returns"] else "\n"
        fields = _FIELDS
        while fields < 4 * row["commas"] + 4:
            fields *= 2
        header = row["header"].removesuffix("\r")
        layout = Layout(header, row["utf8"], records, line_end, fields)
        files.setdefault(layout, []).append(name)
    return files


def read_landing_csv(
    spark,
    path,
    columns=LANDING_CSV_COLUMNS,
    na_tokens=NA_TOKENS,
    large_file_bytes=LARGE_FILE_BYTES,
):
    """All records of the CSV files under a folder, as strings in the given columns.

    A file that is not UTF-8 throughout is read as Latin-1. Records with too many fields are
    skipped, short ones are padded with NULL, and missing-value tokens become NULL. Files may
    order their columns differently; a column a file lacks is NULL.

    Files are split among tasks, but one that quotes line breaks is a single task, up to
    large_file_bytes. Beyond that it is split as well, however it is quoted. Line breaks in
    quotes stay as they are. In a split file a last field that goes on after its closing quote, and ends
    in quotes, may have one more of them. Blank lines are skipped; the first other line of a file is its header,
    and a file without one has no records.
    """
    return drop_overlong(all_records(spark, path, columns, na_tokens, large_file_bytes))


def drop_overlong(records):
    return records.filter(~F.col("overlong")).drop("overlong")


def all_records(
    spark,
    path,
    columns=LANDING_CSV_COLUMNS,
    na_tokens=NA_TOKENS,
    large_file_bytes=LARGE_FILE_BYTES,
):
    """As read_landing_csv, with over-long records kept and marked in `overlong`."""
    files = _layouts(spark, path, large_file_bytes)
    if not files:
        fields = [T.StructField(name, T.StringType()) for name in columns]
        return spark.createDataFrame(
            [], T.StructType([*fields, T.StructField("overlong", T.BooleanType())])
        )
    parts = []
    for layout, names in files.items():
        read = _join_by_quotes if layout.records == BY_QUOTES else _parse_files
        parts.append(_shape(read(spark, layout, _as_paths(names)), layout, columns, na_tokens))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _parse_files(spark, layout, paths):
    fields = [T.StructField(name, T.StringType()) for name in [*layout.columns, _MALFORMED]]
    reader = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", layout.records == BY_FILE)
        .option("encoding", layout.encoding)
        .option("maxColumns", layout.fields)
        .option("columnNameOfCorruptRecord", _MALFORMED)
        # Else a narrow query parses a narrow record and sees no excess fields.
        .option("columnPruning", False)
        .option("recursiveFileLookup", True)
    )
    if layout.records == BY_FILE and layout.line_end:
        # Else the parser guesses, and changes line ends in quotes to the one it found.
        reader = reader.option("lineSep", layout.line_end)
    return reader.csv(paths)


def _join_by_quotes(spark, layout, paths):
    lines = lines_of(spark, paths)
    if not layout.utf8:
        lines = lines.withColumn("value", F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    records = assemble_records(number_lines(lines)).filter(F.col("text").rlike(r"\S"))
    # The header is the first record that is not blank.
    header = records.groupBy("file_path").agg(F.min("record").alias("header"))
    records = records.join(header, "file_path").filter("record > header")
    quoted = [name.replace("`", "``") for name in [*layout.columns, _MALFORMED]]
    schema = ", ".join(f"`{name}` string" for name in quoted)
    options = {
        "escape": '"',
        "columnNameOfCorruptRecord": _MALFORMED,
        "maxColumns": str(layout.fields),
    }
    return records.select(F.from_csv("text", schema, options).alias("row")).select("row.*")


def _shape(parsed, layout, columns, na_tokens):
    names = layout.columns
    # Spark keeps the text of a record whose field count is off; count its separators. A scan may
    # not ask for that text alone, hence the harmless look at the first column.
    outside_quotes = F.regexp_replace(F.col(_MALFORMED), _WHOLE_QUOTED_FIELD, "")
    separators = F.length(outside_quotes) - F.length(F.replace(outside_quotes, F.lit(",")))
    overlong = F.coalesce(separators, F.length(F.col(f"`{names[0]}`")) * 0, F.lit(0)) >= len(names)
    values = [
        null_if_in(F.col(f"`{name}`"), na_tokens).alias(name)
        if name in names
        else F.lit(None).cast("string").alias(name)
        for name in columns
    ]
    blank = F.coalesce(~F.col(_MALFORMED).rlike(r"\S"), F.lit(False))
    return parsed.filter(~blank).select(*values, overlong.alias("overlong"))
