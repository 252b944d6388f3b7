"""Whole CSV records of large files whose quoted fields may hold line breaks.

Spark reads such a file in one task, as a split may begin inside a field. Here its lines are read
in splits. Whether the next line begins a record depends on a line and on where the line itself
begins, outside or inside of a quoted field. Each line is thus a map of these two states, found by two
patterns that follow the parser through stray quotes as well. The maps of the lines of a split are
composed, then those of the splits of a file, so that every line learns its state from a few numbers per
split. Only the lines of records that do span lines are then brought together.

How the parser reads a field: one that begins with a quote goes on to the next quote that is not
doubled, over line breaks, and from there to the next comma whatever comes; in any other, a
quote is a character like all others.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

_BODY = r'(?>[^"]++|"")*+'
_FIELDS = rf'(?>(?>"{_BODY}"|(?!"))[^,]*+,)*+'
# The line ends inside of a quoted field, if it began outside or inside of one.
_OPENS = rf'^{_FIELDS}"{_BODY}\z'
_STAYS = rf'^{_BODY}(?:\z|"[^,]*+,{_FIELDS}"{_BODY}\z)'
_SPLIT = ["file_path", "block_start"]


def lines_of(spark, path):
    """Lines of files below `path`, cut at line feeds only: a quoted CR LF stays whole."""
    text = spark.read.options(recursiveFileLookup=True, lineSep="\n").text(path)
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        # Lines of a split are read in order by one task.
        F.monotonically_increasing_id().alias("line"),
        (F.octet_length("value") + 1).alias("bytes"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def read_declared_csv(spark, path, schema):
    """CSV files with a header each, which must name the columns of `schema`, read in splits."""
    records = assemble_records(number_lines(lines_of(spark, path))).filter(F.col("text").rlike(r"\S"))
    header = F.assert_true(
        F.col("text") == ",".join(schema.names),
        F.concat(F.lit("CSV header does not conform to the schema: "), F.left("text", F.lit(1000))),
    )
    kept = F.when(F.col("record") == 1, header.isNotNull()).otherwise(True)
    columns = ", ".join(f"`{own.name}` {own.dataType.simpleString()}" for own in schema)
    row = F.from_csv("text", columns, {"escape": '"'})
    return records.filter(kept).select(row.alias("row")).select("row.*")


def number_lines(lines):
    """Lines, as `lines_of` gives them, with the record each belongs to.

    `line` orders the lines of a split. `record` counts from 1 in each file; `starts` tells that the
    line begins one, and `goes_on` that the next line belongs to it too. `ended` tells that the file ends
    in a line break. No task or group holds more than one split.
    """
    in_split = Window.partitionBy(*_SPLIT).orderBy("line")
    lines = lines.withColumns({"opens": F.col("value").rlike(_OPENS), "stays": F.col("value").rlike(_STAYS)})
    lines = _states_before(lines, in_split, "opens", "stays")
    for state in ("from_outside", "from_inside"):
        lines = lines.withColumn(f"after_{state}", F.when(F.col(state), F.col("stays")).otherwise(F.col("opens")))

    # A few numbers per split: whether it begins inside a field, and the records before it.
    splits = lines.groupBy(*_SPLIT).agg(
        F.max_by("after_from_outside", "line").alias("opens"),
        F.max_by("after_from_inside", "line").alias("stays"),
        F.count_if(~F.col("from_outside")).alias("starts_if_outside"),
        F.count_if(~F.col("from_inside")).alias("starts_if_inside"),
        F.sum("bytes").alias("read"),
        F.first("file_size").alias("file_size"),
    )
    in_file = Window.partitionBy("file_path").orderBy("block_start")
    splits = _states_before(splits, in_file, "opens", "stays")
    starts = F.when(F.col("from_outside"), F.col("starts_if_inside")).otherwise(F.col("starts_if_outside"))
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("starts", starts).select(
        *_SPLIT,
        F.col("from_outside").alias("inside"),  # a file begins outside
        F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("records_before"),
        (F.sum("read").over(Window.partitionBy("file_path")) <= F.col("file_size")).alias("ended"),
    )

    lines = lines.drop("bytes", "file_size").join(splits, _SPLIT)
    inside = F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    lines = lines.withColumn("starts", ~inside)
    goes_on = F.when(F.col("starts"), F.col("opens")).otherwise(F.col("stays"))
    running = F.count_if("starts").over(in_split.rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumns({"goes_on": goes_on, "record": F.col("records_before") + running})


def _states_before(rows, window, opens, stays):
    """`rows` with the state before each, if the first began outside (`from_outside`) or inside.

    `opens` and `stays` say whether a row ends inside, coming from outside and from inside. A row where
    both are equal forgets what was before; after the last of these only the rows count that turn
    the state around.
    """
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    until = window.rowsBetween(Window.unboundedPreceding, 0)
    turns = F.col(opens) & ~F.col(stays)
    rows = rows.withColumn("turns", F.count_if(turns).over(until))
    fixed = F.when(F.col(opens) == F.col(stays), F.struct(F.col(opens).alias("state"), "turns"))
    rows = rows.withColumn("last", F.last(fixed, ignorenulls=True).over(before))
    turned = F.coalesce(F.lag("turns").over(window), F.lit(0)) - F.coalesce(F.col("last.turns"), F.lit(0))
    odd = turned % 2 == 1
    return rows.withColumns(
        {
            "from_outside": F.coalesce(F.col("last.state"), F.lit(False)) != odd,
            "from_inside": F.coalesce(F.col("last.state"), F.lit(True)) != odd,
        }
    ).drop("turns", "last")


def assemble_records(lines):
    """Numbered lines as records (file_path, record, text)."""
    # Most records are one line and need no grouping.
    alone = F.col("starts") & ~F.col("goes_on")
    singles = lines.filter(alone).select(
        "file_path", "record", _without_return(F.col("value")).alias("text")
    )
    spanning = (
        lines.filter(~alone)
        .groupBy("file_path", "record")
        .agg(
            F.sort_array(F.collect_list(F.struct("block_start", "line", "value"))).alias("parts"),
            F.max_by("goes_on", F.struct("block_start", "line")).alias("open"),
            F.first("ended").alias("ended"),
        )
    )
    text = _without_return(F.array_join(F.col("parts")["value"], "\n"))
    # The last line break of a file belongs to a field that is never closed.
    end = F.when(F.col("open") & F.col("ended"), "\n").otherwise("")
    return singles.unionByName(spanning.select("file_path", "record", F.concat(text, end).alias("text")))


def _without_return(text):
    """A line was cut at its line feed; what is left of CR LF goes too."""
    return F.regexp_replace(text, r"\r\z", "")
