"""Near duplicates by fast similarity sketching, banding and exact verification.

The sketch of a set has t coordinates. In each round every element is thrown into one bin, and a bin
keeps the least value of the first round that reaches it; rounds end once no bin is empty. In the
last t rounds round i throws all elements into bin i, so that small sets fill every bin too. Equal
coordinates estimate the Jaccard similarity as in MinHash, for about one hash an element.

Bands of coordinates make buckets. Members of a bucket are not paired with each other. First each is
compared with one leader, then, where a bucket still holds several components, with its best linked
member, and last the members outside of a bucket's largest component with all others. After that,
each two documents that share a bucket are either connected or known to be too different.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import slices
from .graph import components
from .scratch import stored
from .words import with_results

BANDS = 32
ROWS = 4  # coordinates of a band
_COORDINATES = BANDS * ROWS
_BLOCK = 32  # members of a group that are compared with as many others at once
_SLICE_CHARS = 500_000

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**64 - 1, 256, np.uint64)
_SEEDS = _RANDOM.integers(1, 2**64 - 1, 2 * _COORDINATES, np.uint64)
_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
_BYTE[_BLANK] = 0
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x):
    """A fixed random-looking permutation of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal_words(text):
    """Words in lower case (A-Z only) as bytes; the blanks of bytes.split are the six of a word."""
    return (text or "").encode().lower().split()


def digest(words):
    return hashlib.sha256(b" ".join(words)).digest()[:16]


def shingle_hashes(word_lists, size):
    """For each list of words the distinct hashes of its runs of `size`, or of the whole."""
    joined = np.frombuffer(b" ".join(b" ".join(words) for words in word_lists) + b" ", np.uint8)
    solid = ~_BLANK[joined]
    starts = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
    counts = np.fromiter(map(len, word_lists), np.int64, len(word_lists))
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in word_lists]
    lengths = np.diff(np.concatenate([starts, [len(joined)]]))
    places = np.arange(starts[0], len(joined)) - np.repeat(starts, lengths)
    powers = np.full(int(lengths.max()), _ODD)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    word = np.add.reduceat(_BYTE[joined[starts[0] :]] * powers[places], starts - starts[0])
    word = _mix(word)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    factors = np.multiply.accumulate(np.full(size, _ODD))
    runs = np.zeros(max(0, len(word) - size + 1), np.uint64)
    for k in range(size):
        runs += _mix(word[k : k + len(runs)] ^ factors[k])
    runs = _mix(runs)
    out = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        n = high - low
        if n >= size:
            out.append(np.unique(runs[low : high - size + 1]))
        elif n:
            whole = np.add.reduce(_mix(word[low:high] ^ factors[:n])) + np.uint64(n)
            out.append(_mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fast_sketch(elements):
    """The sketch of a non-empty set of hashes: round and value of each coordinate."""
    t = _COORDINATES
    sketch = np.full(t, 2**64 - 1, np.uint64)
    block = max(1, t // len(elements))  # later rounds do not change a bin that is full
    for first in range(0, 2 * t, block):
        rounds = np.arange(first, min(2 * t, first + block), dtype=np.uint64)[:, None]
        value = _mix(elements[None, :] ^ _SEEDS[rounds.astype(np.intp)])
        bins = np.where(rounds < t, value & np.uint64(t - 1), rounds - np.uint64(t))
        value = (rounds << np.uint64(56)) | (value >> np.uint64(8))
        np.minimum.at(sketch, bins.ravel().astype(np.intp), value.ravel())
        if sketch.max() < 2**64 - 1:
            break
    return sketch


def band_keys(sketch):
    parts = sketch.reshape(BANDS, ROWS) * np.multiply.accumulate(np.full(ROWS, _ODD))
    return _mix(parts.sum(1, dtype=np.uint64) + _SEEDS[:BANDS]).view(np.int64)


def _sketch_udf(size):
    kind = "struct<digest: binary, n_shingles: bigint, bands: array<bigint>>"

    @F.arrow_udf(kind)
    def sketched(texts: pa.Array) -> pa.Array:
        digests, counts, bands = [], [], []
        for run in slices(texts, _SLICE_CHARS):
            words = [normal_words(text) for text in run]
            digests.extend(map(digest, words))
            for own in shingle_hashes(words, size):
                counts.append(len(own))
                bands.append(band_keys(fast_sketch(own)) if len(own) else [])
        arrays = [
            pa.array(digests, pa.binary()),
            pa.array(counts, pa.int64()),
            pa.array(bands, pa.list_(pa.int64())),
        ]
        return pa.StructArray.from_arrays(arrays, ["digest", "n_shingles", "bands"])

    return sketched


@F.arrow_udf(T.BinaryType())
def _digest_udf(texts: pa.Array) -> pa.Array:
    runs = slices(texts, _SLICE_CHARS)
    return pa.array([digest(normal_words(text)) for run in runs for text in run], pa.binary())


def _shingles(text, size):
    words = normal_words(text)
    return set(zip(*[words[k:] for k in range(min(size, len(words)))], strict=False))


def _similar_udf(size, percent):
    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        recent = {}

        def shingles(text):
            if text not in recent:
                if len(recent) > 8:
                    recent.clear()
                recent[text] = _shingles(text, size)
            return recent[text]

        out = []
        for a, b in zip(left, right, strict=True):
            a, b = shingles(a.as_py()), shingles(b.as_py())
            both = len(a & b)
            out.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
        return pa.array(out, pa.bool_())

    return similar


def _links(pairs, texts, size, percent):
    """Of `pairs` (node, other) those whose full sets reach the threshold."""
    other = texts.select(F.col("node").alias("other"), F.col("text").alias("other_text"))
    full = pairs.join(texts, "node").join(other, "other")
    alike = _similar_udf(size, percent)(F.col("other_text"), F.col("text"))
    return stored(full.filter(alike).select("node", "other"), "near-links")


def _differences(pairs, texts, size):
    """`pairs` (node, hub, ...) with the size of the node's set and its difference from the hub's."""

    @F.arrow_udf("struct<size: bigint, diff: array<bigint>>")
    def compared(texts: pa.Array, hubs: pa.Array) -> pa.Array:
        sizes, diffs, recent = [], [], {}
        for text, hub in zip(texts, hubs, strict=True):
            hub = hub.as_py()
            if hub not in recent:
                recent = {hub: _shingles(hub, size)}
            own = _shingles(text.as_py(), size)
            sizes.append(len(own))
            hashes = (xxhash.xxh3_64_intdigest(b" ".join(s)) - (1 << 63) for s in own ^ recent[hub])
            diffs.append(sorted(hashes))
        arrays = [pa.array(sizes, pa.int64()), pa.array(diffs, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(arrays, ["size", "diff"])

    hub = texts.select(F.col("node").alias("hub"), F.col("text").alias("hub_text"))
    full = pairs.join(texts, "node").join(hub, "hub")
    full = full.withColumn("d", compared(F.col("text"), F.col("hub_text")))
    return full.select("hub", "node", "root", "d.size", "d.diff")


def _linked_udf(percent):
    """Links between the members of two blocks, of different components, by their differences.

    Two sets differ in what one of their differences from the same hub has and the other has not;
    with the sizes that gives their intersection exactly.
    """

    @F.arrow_udf("array<struct<node: bigint, other: bigint>>")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(left, right, strict=True):
            a, b = a.as_py(), b.as_py()
            node, root, n = (np.array([x[name] for x in b]) for name in ("node", "root", "size"))
            counts = np.array([len(x["diff"]) for x in b])
            owner = np.repeat(np.arange(len(b)), counts)
            diffs = np.array([d for x in b for d in x["diff"]], np.int64)
            found = []
            for x in a:
                held = np.isin(diffs, np.array(x["diff"], np.int64))
                shared = np.bincount(owner[held], minlength=len(b))
                apart = len(x["diff"]) + counts - 2 * shared
                both, either = (x["size"] + n - apart) // 2, (x["size"] + n + apart) // 2
                near = (both > 0) & (100 * both >= percent * either) & (root != x["root"])
                found += [{"node": x["node"], "other": k} for k in node[near].tolist()]
            out.append(found)
        kind = pa.list_(pa.struct([("node", pa.int64()), ("other", pa.int64())]))
        return pa.array(out, kind)

    return linked


def _last_links(still, degrees, texts, size, percent):
    """Links that are left in open buckets: of members outside of the largest component with all.

    Members meet by their bucket's best linked member, the hub, and in blocks: one row holds the
    differences of some dozens of members on either side, and only links leave it.
    """
    best = still.join(degrees, "node", "left").groupBy("key")
    best = best.agg(F.max(F.struct(F.coalesce("degree", F.lit(0)), "node"))["node"].alias("hub"))
    members = still.join(best, "key").select("hub", "node", "root").distinct()
    members = stored(_differences(members, texts, size), "near-differences")
    shares = members.groupBy("hub", "root").agg(F.count("*").alias("n"))
    groups = shares.groupBy("hub").agg(
        F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("top")
    )
    groups = groups.select(
        "hub", F.col("top.root").alias("largest"), "all", (F.col("all") - F.col("top.n")).alias("few")
    )
    members = members.join(groups, "hub")

    def blocks(rows, count, name):
        block = F.pmod(F.xxhash64("node"), F.ceil(F.col(count) / _BLOCK))
        rows = rows.withColumn("block", block).groupBy("hub", "block")
        return rows.agg(F.collect_list(F.struct("node", "root", "size", "diff")).alias(name))

    left = blocks(members, "all", "left").drop("block")
    right = blocks(members.filter("root <> largest"), "few", "right").drop("block")
    links = left.join(right, "hub").select(
        F.explode(_linked_udf(percent)(F.col("left"), F.col("right"))).alias("link")
    )
    return stored(links.select("link.*"), "near-links")


def _open(buckets, roots):
    """Rows of buckets that hold several components, with the component of each node."""
    own = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    spread = own.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    return own.join(spread.filter("lo <> hi").select("key"), "key", "left_semi")


def _ordered(pairs):
    """Distinct pairs with the larger node first."""
    pairs = pairs.select(
        F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")
    )
    return pairs.filter("node <> other").distinct()


def _classes(docs, id, text, size):
    """One row for each text with words: its smallest id, sketch, and a number as its node."""
    rows = docs.select(F.col(id).alias("id"), _sketch_udf(size)(F.col(text)).alias("s"))
    classes = (
        rows.select("id", "s.*")
        .filter("n_shingles > 0")
        .groupBy("digest")
        .agg(
            F.min("id").alias("id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        )
    )
    return stored(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")


def _buckets(classes):
    """(key, node, leader) of the bands that two nodes or more agree in."""
    members = classes.select("node", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(
        F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node"), "node")).alias("first")
    )
    shared = shared.filter("n > 1").select("key", F.col("first.node").alias("leader"))
    return stored(members.join(shared, "key"), "near-buckets")


def _texts(docs, text, classes, buckets):
    """The text of every node that shares a bucket, once."""
    wanted = buckets.select("node").distinct()
    wanted = classes.select("digest", "node").join(wanted, "node", "left_semi")
    own = docs.select(_digest_udf(F.col(text)).alias("digest"), F.col(text).alias("text"))
    own = own.join(wanted, "digest").dropDuplicates(["digest"])
    return stored(own.select("node", "text"), "near-texts")


def _roots(docs, text, classes, size, percent):
    """(node, root) of every linked node."""
    buckets = _buckets(classes)
    texts = _texts(docs, text, classes, buckets)

    tried = _ordered(buckets.select("node", F.col("leader").alias("other")))
    tried = stored(tried, "near-pairs")
    links = _links(tried, texts, size, percent)
    roots = components(links)

    # The member with the most links so far is likely the one that the others were made from.
    ends = links.select("node").unionByName(links.select(F.col("other").alias("node")))
    degrees = ends.groupBy("node").agg(F.count("*").alias("degree"))
    still = _open(buckets, roots).join(degrees, "node", "left")
    best = still.groupBy("key").agg(
        F.max(F.struct(F.coalesce("degree", F.lit(0)), "node")).alias("best")
    )
    pairs = still.join(best, "key").filter(F.col("root").isNotNull())
    pairs = _ordered(pairs.select("node", F.col("best.node").alias("other")))
    pairs = stored(pairs.join(tried, ["node", "other"], "left_anti"), "near-pairs")
    links = links.unionByName(_links(pairs, texts, size, percent))
    roots = components(links)

    still = stored(_open(buckets, roots).select("key", "node", "root"), "near-open")
    return components(links.unionByName(_last_links(still, degrees, texts, size, percent)))


def near_duplicates(docs, id="doc_id", text="text", size=4, percent=80):
    """`docs` with `n_shingles`, `component_id` and `kept`.

    Sets hold the distinct runs of `size` words, in lower case; a shorter text is one run. Two
    documents are linked if their intersection has at least `percent` of their union.
    `component_id` is the smallest id that links reach, the own one included; `kept` is whether it is
    the own one. A null or empty text has no shingle, no link, and its own id.

    Rows with equal words are one node. Rows without an id take the component of their node, or
    null if none of it has an id; those are kept. Rows with equal ids and different texts are
    linked only by their texts. Every row is returned; columns with the three names are replaced.
    An empty table has no rows. Texts are compared whole, however long.
    A link is missed if no band agrees: for 80 percent with a chance of 5 in 10^8.
    """
    classes = _classes(docs, id, text, size)
    roots = _roots(docs, text, classes, size, percent)
    placed = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    found = placed.join(least, "root").select(
        F.col("digest").alias("_digest"), "n_shingles", "component_id"
    )

    def placed_rows(held):
        held = held.withColumn("_digest", _digest_udf(F.col("text"))).drop("text")
        alone = F.col("n_shingles").isNull()
        held = held.join(found, "_digest", "left").withColumns(
            {
                "component_id": F.when(alone, F.col("id")).otherwise(F.col("component_id")),
                "n_shingles": F.coalesce("n_shingles", F.lit(0)),
            }
        )
        own = F.col("id").eqNullSafe(F.col("component_id"))
        return held.withColumn("kept", F.col("component_id").isNull() | own)

    needed = {"id": F.col(id), "text": F.col(text)}
    return with_results(docs, needed, ["n_shingles", "component_id", "kept"], placed_rows)


def keep_one(docs, id="doc_id", text="text", size=5, percent=80):
    """The rows of `docs` that stand for their group, with their own columns; equal rows once."""
    held = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))
    judged = near_duplicates(held, "id", "text", size, percent).filter("kept")
    return judged.dropDuplicates(["id", "text"]).select("row.*")
