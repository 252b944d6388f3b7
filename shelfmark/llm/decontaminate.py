"""Benchmark passages in documents, by SimHash over windows as long as the items.

Every window is taken that has as many of the benchmark's shingles as the similarity asks for; any
other window is less like each item. A window and an item whose fingerprints differ in at most `radius` bits agree
in one of `radius + 1` blocks, so that an equi-join on blocks finds all of them. Candidates are
verified by the exact similarity of their shingles, weighted by how often each occurs.

All of it is built-in expressions and joins.
"""

from pyspark.sql import functions as F

from .scratch import stored
from .words import bound, with_results

RADIUS = 18
_BITS = 64


def _words(text):
    """Runs of letters and digits in lower case."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _key(text):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _shingles(words, size):
    """Hashes of the runs of `size` words in order; none in shorter lists."""
    last = F.size(words) - size
    run = [lambda i, k=k: words[i + k] for k in range(size)]
    return F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[word(i) for word in run])),
    ).otherwise(F.array().cast("array<bigint>"))


def _shingles_of_item(words, size):
    """The same, where a list shorter than `size` is one run."""
    count = F.size(words)
    out = _shingles(words, size)
    for k in range(1, size):
        out = F.when(count == k, _shingles(words, k)).otherwise(out)
    return out


def fingerprint(words):
    """SimHash of a list of words: each bit is the majority of that bit over all words' hashes."""

    def bits(hashes):
        def majority(b):
            votes = F.aggregate(
                hashes,
                F.lit(0),
                lambda sum_, h: sum_
                + F.call_function("shiftright", h, b).bitwiseAND(F.lit(1)).cast("int") * 2
                - 1,
            )
            return F.when(votes > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(
                F.lit(0).cast("bigint")
            )

        each = F.transform(F.sequence(F.lit(0), F.lit(_BITS - 1)), majority)
        return F.aggregate(each, F.lit(0).cast("bigint"), lambda whole, bit: whole.bitwiseOR(bit))

    return bound(F.transform(words, lambda w: F.xxhash64(w)), bits)


def _blocks(print_, radius):
    """(number, bits) of the blocks of a fingerprint, as one number each."""
    count = radius + 1
    edges = [_BITS * k // count for k in range(count + 1)]
    return F.array(
        *[
            F.call_function("shiftrightunsigned", F.col(print_), F.lit(low))
            .bitwiseAND(F.lit((1 << (high - low)) - 1))
            * count
            + k
            for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False))
        ]
    )


def _counted(shingles):
    """Shingles told apart by how many equal ones come before, so that sets hold multiplicities."""

    def numbered(ordered):
        return F.transform(
            ordered,
            lambda x, i: F.xxhash64(x, i + 1 - F.array_position(ordered, x).cast("int")),
        )

    return F.when(
        F.size(F.array_distinct(shingles)) == F.size(shingles),
        F.transform(shingles, lambda x: F.xxhash64(x, F.lit(0))),
    ).otherwise(bound(F.sort_array(shingles), numbered))


def _starts(percent):
    """Starts of the windows of `length` words that can hold an item, from the places of `hits`.

    `both` common shingles reach `percent` of the union of `a` and `b` from
    both = percent * (a + b) / (100 + percent) on, and a window has no more in common with an item
    than it has hits. A window with k hits begins at the first of them or before, and ends with the
    last of them or after.
    """
    reach = F.col("length") - F.col("size")
    last = F.greatest(F.lit(0), F.col("n") - F.col("length"))
    a = F.least(F.col("n"), F.col("length")) - F.col("size") + 1
    least = F.ceil(F.lit(percent) * (a + F.col("shingles")) / F.lit(100 + percent) - 1e-9).cast("int")
    least = F.greatest(F.lit(1), least)

    def of(bounds):
        def around(i):
            low = F.greatest(F.lit(0), F.col("hits")[i + bounds["least"] - 1] - bounds["reach"])
            high = F.least(F.col("hits")[i], bounds["last"])
            return F.when(low <= high, F.sequence(low, high)).otherwise(none)

        firsts = F.sequence(F.lit(0), F.size("hits") - bounds["least"])
        every = F.array_distinct(F.flatten(F.transform(firsts, around)))
        return F.when(F.size("hits") >= bounds["least"], every).otherwise(none)

    none = F.array().cast("array<int>")
    return bound(F.struct(least.alias("least"), reach.alias("reach"), last.alias("last")), of)


def find_items(
    docs, items, text="text", item="item_id", item_text="text", size=5, percent=80, radius=RADIUS
):
    """(`text_key`, `item_id`) of the texts of `docs` that hold an item, each pair once.

    `text_key` is the SHA-256 of the text. A window of an item's length, at any place, holds the item
    if their shingles of `size` words reach `percent` of their union, both counted with multiplicity. An item
    of fewer words is one shingle. Words are runs of letters and digits in any case. Items with a
    null id or without words, and null or empty texts, take part in nothing. Copies of a text are
    searched each, but lead to one pair.

    The benchmark's shingles are joined with every shingle of the documents. Spark broadcasts them
    if they are small; that is checked, not forced.
    """
    items = (
        items.select(F.col(item).alias("item_id"), _words(item_text).alias("item_words"))
        .filter(F.col("item_id").isNotNull() & (F.size("item_words") > 0))
        .withColumn("length", F.size("item_words"))
    )
    items = stored(
        items.withColumns(
            {
                "item_shingles": _shingles_of_item(F.col("item_words"), size),
                "item_print": fingerprint(F.col("item_words")),
                "size": F.least(F.col("length"), F.lit(size)),
            }
        ),
        "bench-items",
    )
    sizes = [row[0] for row in items.select("size").distinct().collect()]  # `size` values at most
    places = items.select(
        "length", F.size("item_shingles").alias("shingles"), "size", F.explode("item_shingles").alias("shingle")
    ).distinct()

    own = docs.select(_key(text).alias("text_key"), _words(text).alias("words"))
    runs = F.concat(*[_shingles_by_place(F.col("words"), k) for k in sizes]) if sizes else None
    if runs is None:
        runs = F.array().cast("array<struct<at:int,shingle:bigint>>")
    hits = (
        own.select("text_key", F.size("words").alias("n"), F.explode(runs).alias("run"))
        .select("text_key", "n", "run.at", "run.shingle")
        .join(places, "shingle")
    )
    hits = hits.groupBy("text_key", "n", "length", "shingles", "size").agg(
        F.sort_array(F.collect_set("at")).alias("hits")
    )
    windows = hits.withColumn("starts", _starts(percent)).filter(F.size("starts") > 0)
    windows = windows.groupBy("text_key").agg(F.collect_set(F.struct("length", "starts")).alias("at"))
    windows = own.join(windows, "text_key").dropDuplicates(["text_key"])
    windows = windows.select("text_key", "words", F.explode("at").alias("at"))
    windows = windows.select(
        "text_key", "words", F.col("at.length").alias("length"), F.explode("at.starts").alias("start")
    )
    windows = windows.select(
        "text_key", "length", F.slice("words", F.col("start") + 1, F.col("length")).alias("window")
    )
    windows = stored(
        windows.withColumn("window_key", F.sha2(F.concat_ws(" ", "window"), 256)), "bench-windows"
    )
    prints = windows.groupBy("window_key", "length").agg(F.first("window").alias("window"))
    prints = prints.withColumn("print", fingerprint(F.col("window")))
    prints = stored(prints, "bench-prints")

    left = prints.select("window_key", "length", "print", F.explode(_blocks("print", radius)).alias("block"))
    right = items.select(
        "item_id", "length", "item_print", F.explode(_blocks("item_print", radius)).alias("block")
    )
    near = (
        left.join(right, ["length", "block"])
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .select("window_key", "length", "item_id")
        .distinct()
    )
    full = near.join(prints, ["window_key", "length"]).join(
        items.select("item_id", "length", "item_shingles"), ["item_id", "length"]
    )
    full = full.select(
        "window_key",
        "length",
        "item_id",
        _counted(_shingles_of_item(F.col("window"), size)).alias("a"),
        _counted(F.col("item_shingles")).alias("b"),
    )
    both = F.size(F.array_intersect("a", "b"))
    alike = full.filter(100 * both >= percent * (F.size("a") + F.size("b") - both))
    return windows.join(alike, ["window_key", "length"]).select("text_key", "item_id").distinct()


def _shingles_by_place(words, size):
    return F.transform(
        _shingles(words, size), lambda x, i: F.struct(i.alias("at"), x.alias("shingle"))
    )


def mark(docs, items, text="text", **options):
    """`docs` with `item_ids` (sorted, empty if none), `n_items` and `contaminated`.

    Every row is kept, equal ones too; columns with the three names are replaced. A null or empty text
    holds nothing, and so do all if there are no items. Texts are searched whole, however long. Of items
    with equal texts each is named. Options as for `find_items`.
    """
    found = (
        find_items(docs, items, text=text, **options)
        .groupBy(F.col("text_key").alias("_key"))
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )
    kind = found.schema["item_ids"].dataType

    def marked(held):
        held = held.join(found, "_key", "left")
        held = held.withColumn("item_ids", F.coalesce("item_ids", F.array().cast(kind)))
        held = held.withColumn("n_items", F.size("item_ids").cast("bigint"))
        return held.withColumn("contaminated", F.col("n_items") > 0)

    return with_results(docs, {"_key": _key(text)}, ["item_ids", "n_items", "contaminated"], marked)


def keep_clean(docs, items, text="text", **options):
    """The rows of `docs` that hold no item, with their own columns."""
    held = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return mark(held, items, "text", **options).filter(~F.col("contaminated")).select("row.*")
