"""Objects of JSON documents that hold one array, read in splits of their files.

Spark reads such a file in one task. Here it is cut at every closing brace, in splits. Whether a brace
ends an object of the array depends on two things before it: whether it lies in a string, which the number
of quotes tells, and how deep it lies, which the number of brackets outside of strings tells. Both are
sums, so that running sums within a split and over the splits of a file give them for every piece from a
few numbers per split. Only the pieces of objects that hold other objects are then brought together.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

_SPLIT = ["file_path", "block_start"]
_ESCAPE = r"(?s)\\."
_STRING = r'"[^"]*+(?:"|\z)'
_REST_OF_STRING = r'^[^"]*+(?:"|\z)'
# What lies before the next object of an array: commas, blanks, values that are no objects.
_BEFORE_OBJECT = r'^(?>[^{"]++|"(?>[^"\\]++|\\.)*+")*+'


def _pieces(spark, path):
    text = spark.read.options(recursiveFileLookup=True, lineSep="}").text(path)
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("piece"),
    )


def _count(text, character):
    return F.length(text) - F.length(F.replace(text, F.lit(character)))


def _depth(text):
    """Brackets that open less those that close, outside of strings."""
    plain = F.regexp_replace(text, _STRING, "")
    opened = _count(plain, "{") + _count(plain, "[")
    return opened - _count(plain, "}") - _count(plain, "]")


def number_objects(pieces):
    """Pieces (file_path, block_start, piece, value) with the object each belongs to.

    `object` counts from 0 in each file; `ends` tells that the closing brace after the piece ends the
    object, `starts` that the piece is the object's first. No task or group holds more than a split.
    """
    in_split = Window.partitionBy(*_SPLIT).orderBy("piece")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    until = in_split.rowsBetween(Window.unboundedPreceding, 0)
    plain = F.regexp_replace("value", _ESCAPE, "")
    pieces = pieces.withColumns(
        {
            "quotes": _count(plain, '"'),
            "outside": _depth(plain),
            "inside": _depth(F.regexp_replace(plain, _REST_OF_STRING, "")),
        }
    )
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    pieces = pieces.withColumn("odd", odd)

    def change(in_string):
        """The change of depth over a piece and the brace after it."""
        ends_inside = in_string != (F.col("quotes") % 2 == 1)
        own = F.when(in_string, F.col("inside")).otherwise(F.col("outside"))
        return own - F.when(ends_inside, 0).otherwise(1)

    splits = pieces.groupBy(*_SPLIT).agg(
        F.sum("quotes").alias("quotes"),
        F.sum(change(F.col("odd"))).alias("change_if_outside"),
        F.sum(change(~F.col("odd"))).alias("change_if_inside"),
        F.min_by("value", "piece").alias("first"),
    )
    earlier = Window.partitionBy("file_path").orderBy("block_start")
    splits = splits.withColumn("array", F.first(F.col("first").rlike(r"^\s*\[")).over(earlier))
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("in_string", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1)
    moved = F.when(F.col("in_string"), F.col("change_if_inside")).otherwise(F.col("change_if_outside"))
    splits = splits.withColumn("moved", moved).select(
        *_SPLIT,
        "in_string",
        F.col("array").cast("int").alias("level"),
        F.coalesce(F.sum("moved").over(earlier), F.lit(0)).alias("depth_before"),
    )

    pieces = pieces.join(splits, _SPLIT)
    in_string = F.col("odd") != F.col("in_string")
    ends_inside = in_string != (F.col("quotes") % 2 == 1)
    depth = F.col("depth_before") + F.sum(change(in_string)).over(until)
    pieces = pieces.withColumn("ends", ~ends_inside & (depth == F.col("level")))
    pieces = pieces.withColumn("ended", F.coalesce(F.count_if("ends").over(before), F.lit(0)))
    # How many objects end in the splits before, and whether the last piece before ends one.
    ends = pieces.groupBy(*_SPLIT).agg(
        F.count_if("ends").alias("n"), F.max_by("ends", "piece").alias("last")
    )
    by_file = Window.partitionBy("file_path").orderBy("block_start")
    ends = ends.select(
        *_SPLIT,
        F.coalesce(F.sum("n").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("n"),
        F.coalesce(F.lag("last").over(by_file), F.lit(True)).alias("fresh"),
    )
    pieces = pieces.join(ends, _SPLIT)
    starts = F.coalesce(F.lag("ends").over(in_split), F.col("fresh"))
    return pieces.withColumns({"object": F.col("n") + F.col("ended"), "starts": starts})


def read_objects(spark, path, schema):
    """The objects of the JSON files below `path`, one row each, in the columns of `schema`.

    A file holds one array of objects, or objects one after the other. Elements that are no objects
    are left out; an object that does not fit the schema has nulls, as in Spark's own reader. The order
    of rows is not kept. An array that is cut off loses its last object only.
    """
    pieces = number_objects(_pieces(spark, path))
    alone = F.col("starts") & F.col("ends")
    singles = pieces.filter(alone).select("value")
    grouped = pieces.filter(~alone).groupBy("file_path", "object")
    grouped = grouped.agg(
        F.sort_array(F.collect_list(F.struct("block_start", "piece", "value"))).alias("parts"),
        F.bool_or("ends").alias("whole"),
    )
    joined = grouped.filter("whole").select(F.array_join(F.col("parts")["value"], "}").alias("value"))
    text = F.concat(F.regexp_replace(F.col("value"), _BEFORE_OBJECT, ""), F.lit("}"))
    objects = singles.unionByName(joined).select(F.from_json(text, schema).alias("own"))
    return objects.select("own.*")
