"""Shards of a bounded size by extendible hashing.

A directory is indexed by the first bits of a hash of the key. A bucket whose rows are too large
together is split on one more bit; all others stay as they are. A key that is too large by itself
has a directory of its own, over a hash of its rows. Copies of one row that are too large together
are dealt out by running number.
"""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import stored

_STEP = 8  # bits that one pass over the sizes looks ahead


def _prefix(address, depth):
    """The first `depth` bits; 0 for no bits, since shifts are modulo 64."""
    return F.when(depth == 0, F.lit(0).cast("bigint")).otherwise(
        F.call_function("shiftrightunsigned", address, 64 - depth)
    )


def _first_bits(address, depth):
    return F.lit(0).cast("bigint") if depth == 0 else F.shiftrightunsigned(address, 64 - depth)


def build_directory(sizes, limit):
    """Buckets (group, depth, prefix, bytes, rows, addresses) of `sizes` (group, address, bytes, rows).

    Each bucket holds at most `limit` bytes, or a single address. Every pass sums the open buckets
    for the next bits at once, keeps those that fit though their parent does not, and goes on with
    the rest. A pass reads one small row for each address, and ends the latest at 64 bits.
    """
    buckets, depth, todo = None, 0, sizes
    while True:
        deep = min(64, depth + _STEP)
        cells = todo.groupBy("group", _first_bits(F.col("address"), deep).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.count("*").alias("addresses")
        )
        levels = F.explode(F.array(*[F.lit(d) for d in range(depth, deep + 1)]))
        down = F.expr(f"shiftrightunsigned(cell, {deep} - depth)")
        prefix = F.when((F.col("depth") == 0) & F.lit(deep == 64), 0).otherwise(down)
        sums = (
            cells.withColumn("depth", levels)
            .groupBy("group", "depth", prefix.cast("bigint").alias("prefix"))
            .agg(*[F.sum(name).alias(name) for name in ("bytes", "rows", "addresses")])
            .withColumn("fits", (F.col("bytes") <= limit) | (F.col("addresses") == 1))
        )
        sums = stored(sums, "shards")
        # A bucket at the first level is open, but for the root: its parent did not fit.
        parents = sums.filter(~F.col("fits")).select(
            "group", (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        fitting = sums.filter("fits").withColumn("parent", F.expr("shiftrightunsigned(prefix, 1)"))
        leaves = fitting.join(parents, ["group", "depth", "parent"], "left_semi").drop("parent")
        if depth == 0:
            leaves = leaves.unionByName(fitting.filter("depth = 0").drop("parent"))
        buckets = leaves if buckets is None else buckets.unionByName(leaves)
        opened = sums.filter(~F.col("fits") & (F.col("depth") == deep)).select(
            "group", F.col("prefix").alias("cell")
        )
        if deep == 64 or opened.isEmpty():
            return stored(buckets.drop("fits"), "shards")
        todo = todo.withColumn("cell", _first_bits(F.col("address"), deep))
        todo = todo.join(opened, ["group", "cell"], "left_semi").drop("cell")
        depth = deep


def assign_shards(docs, keys, limit, text="text", size=None):
    """`docs` with `bytes`, `shard` and `oversized`.

    Rows are placed by their `keys`; shards hold at most `limit` bytes. `size` is the bytes of a
    row, by default those of `text` in UTF-8; a null counts as 0. `shard` is a name from the group,
    the hash bits and the part. `oversized` marks a single row above the limit, which has a shard of
    its own. Null keys hash like any other value. Copies of a row may lie in several shards only if
    they do not fit one. Every row is kept; columns with the three names are replaced. An empty
    table has no shards.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    own = F.octet_length(text) if size is None else size
    plain = [c for c in docs.columns if c.lower() not in ("bytes", "shard", "oversized")]
    rows = docs.select(
        F.struct(*plain).alias("row"),
        F.coalesce(own, F.lit(0)).cast("bigint").alias("bytes"),
        F.xxhash64(*keys).alias("_key"),
        F.xxhash64(F.lit("row"), *plain).alias("_row"),
    )
    narrow = stored(
        rows.groupBy("_key", "_row").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows")),
        "shards",
    )
    # A group is a key that is too large by itself, or null for all other keys together.
    large = (
        narrow.groupBy("_key")
        .agg(F.sum("bytes").alias("total"))
        .filter(F.col("total") > limit)
        .select("_key", F.col("_key").alias("group"))
    )
    placed = narrow.join(large, "_key", "left").withColumn(
        "address", F.when(F.col("group").isNull(), F.col("_key")).otherwise(F.col("_row"))
    )
    placed = placed.withColumn("group", F.coalesce(F.hex("group"), F.lit("all")))
    sizes = placed.groupBy("group", "address").agg(
        F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
    )
    directory = build_directory(stored(sizes, "shards"), limit)
    depths = [row[0] for row in directory.select("depth").distinct().collect()]  # 65 at most
    found = placed.select("_key", "_row", "group", "address")
    if depths:
        found = found.withColumn("depth", F.explode(F.array(*map(F.lit, depths))))
    else:
        found = found.withColumn("depth", F.lit(0))
    found = found.withColumn("prefix", _prefix(F.col("address"), F.col("depth")))
    found = found.join(directory, ["group", "depth", "prefix"])
    name = F.concat_ws("-", "group", F.format_string("%02d", "depth"), F.lower(F.hex("prefix")))
    found = found.select(
        "_key",
        "_row",
        name.alias("shard"),
        F.col("bytes").alias("_total"),
        F.col("rows").alias("_rows"),
    )
    return _deal_copies(rows, found, limit).select("row.*", "bytes", "shard", "oversized")


def _deal_copies(rows, found, limit):
    """Split shards that hold copies of one row and are too large.

    A copy's number counts first the copies in earlier scan partitions, then those before it in its
    own; so no group is larger than a scan partition. The copies are stored with the number of their
    partition, since it is read twice and would not come out the same if it were computed twice.
    """
    many = (F.col("_total") > limit) & (F.col("_rows") > 1)
    single = (F.col("_total") > limit) & (F.col("_rows") == 1)
    rest = rows.join(found.filter(~many), ["_key", "_row"]).withColumn("oversized", single)
    found = stored(found.filter(many), "shards")
    if found.isEmpty():
        return rest
    copies = rows.withColumn("_at", F.spark_partition_id()).join(found, ["_key", "_row"])
    copies = stored(copies, "shards")
    before = Window.partitionBy("_row").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    counts = copies.groupBy("_row", "_at").agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    number = F.row_number().over(Window.partitionBy("_row", "_at").orderBy("bytes"))
    copies = copies.withColumn("_number", number).join(counts, ["_row", "_at"])
    fit = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("bytes"))).cast("bigint")
    part = F.floor((F.col("_before") + F.col("_number") - 1) / fit)
    copies = copies.withColumns(
        {
            "shard": F.concat_ws("-", "shard", part.cast("string")),
            "oversized": F.col("bytes") > limit,
        }
    ).drop("_at", "_number", "_before")
    return rest.unionByName(copies)


def write_shards(docs, path, keys, limit, text="text"):
    """Write `docs` as Parquet, one folder for each shard; one task writes a shard.

    Nulls, long texts, ties and copies as in `assign_shards`; an empty table writes no folder.
    """
    assigned = assign_shards(docs, keys, limit, text)
    assigned.repartition("shard").write.partitionBy("shard").parquet(path)
