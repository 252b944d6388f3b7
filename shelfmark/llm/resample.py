"""Importance resampling towards a target: documents whose words are likelier there are drawn more often.

Features are runs of words, hashed into buckets by CRC-32. A CRC is a state that can be carried on, so
that the head of the vocabulary, its most frequent words and pairs, is broadcast as finished states
and buckets, and only the tail is computed byte by byte. Head and tail give the same numbers; totals of
all buckets are exact, over all texts. The log ratio of a bucket's share in the target and in the corpus
is its gain, the mean gain of a document its weight, and the highest of weight plus Gumbel noise
are a sample without replacement.
"""

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .bpe import slices
from .scratch import stored

BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = "2024"
#: So many words, and as many pairs, make the head at most. It changes the speed, not the result.
HEAD_SIZE = 50_000

_HEAD_BYTES = 64  # a longer word or pair is never in the head
_SLICE_BYTES = 500_000
# Bytes of words: 0-9, a-z and all of characters beyond ASCII. A-Z in lower case, the others as blanks.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def words_of(raw):
    """Words of a UTF-8 text as bytes."""
    return (raw or b"").translate(_WORD_BYTES).split()


class _States(dict):
    """CRC states of the head; those of other words are computed, and not kept."""

    def __missing__(self, word):
        return zlib.crc32(word)


@dataclass(frozen=True)
class Head:
    """CRC-32 states of frequent words, and buckets of frequent pairs."""

    states: dict
    pairs: dict
    buckets: int


class Features:
    """Buckets of the features of a text: all runs of one to `longest` words."""

    def __init__(self, head, longest):
        self.states = _States(head.states)
        self.pairs = head.pairs
        self.buckets = head.buckets
        self.longest = longest

    def of(self, words):
        """The bucket of every feature, in no order that matters."""
        states = list(map(self.states.__getitem__, words))
        parts = [np.array(states, np.int64) % self.buckets]
        if self.longest > 1 and len(words) > 1:
            parts.append(np.array(self._pairs(words, states), np.int64))
        if self.longest > 2:
            for length in range(3, min(self.longest, len(words)) + 1):
                parts.append(np.array(self._runs(words, states, length), np.int64))
        return np.concatenate(parts)

    def _pairs(self, words, states):
        known, buckets = self.pairs, self.buckets
        out = []
        for word, after, state in zip(words, words[1:], states, strict=False):
            pair = word + b" " + after
            bucket = known.get(pair)
            if bucket is None:
                bucket = zlib.crc32(b" " + after, state) % buckets
            out.append(bucket)
        return out

    def _runs(self, words, states, length):
        out = []
        for at in range(len(words) - length + 1):
            rest = b" ".join(words[at + 1 : at + length])
            out.append(zlib.crc32(b" " + rest, states[at]) % self.buckets)
        return out


def _lighten(counts, size):
    """The `size` largest counts less the next one: any count is too low by that much at most."""
    if len(counts) <= size:
        return counts
    floor = sorted(counts.values(), reverse=True)[size]
    return Counter({gram: n - floor for gram, n in counts.items() if n > floor})


def head_vocabulary(docs, text="text", longest=1, buckets=BUCKETS, size=HEAD_SIZE):
    """States of the most frequent words of all texts, and buckets of the most frequent pairs.

    Each task keeps `size` counts of either kind, less what the others have (a sketch whose error is a
    `size`-th of its words), so that neither a shuffle nor the driver gets more than `size` rows a task
    and kind. At most `size` words and pairs, none longer than 64 bytes, reach the driver.
    """
    kinds = min(longest, 2)

    def counted(batches):
        counts = [Counter() for _ in range(kinds)]
        for batch in batches:
            for run in slices(batch.column(0).cast(pa.binary()), _SLICE_BYTES):
                for raw in run:
                    words = words_of(raw)
                    counts[0].update(words)
                    if kinds > 1:
                        counts[1].update(a + b" " + b for a, b in zip(words, words[1:], strict=False))
                counts = [_lighten(own, 2 * size) if len(own) > 4 * size else own for own in counts]
        for kind, own in enumerate(counts, 1):
            own = {g: n for g, n in _lighten(own, size).items() if len(g) <= _HEAD_BYTES}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([kind] * len(own), pa.int32()),
                    pa.array(list(own), pa.binary()),
                    pa.array(list(own.values()), pa.int64()),
                ],
                ["kind", "gram", "n"],
            )

    grams = docs.select(F.col(text).alias("text")).mapInArrow(counted, "kind int, gram binary, n bigint")
    grams = stored(grams.groupBy("kind", "gram").agg(F.sum("n").alias("n")), "resample-head")

    def most_frequent(kind):
        own = grams.filter(F.col("kind") == kind).orderBy(F.desc("n"), "gram").limit(size)
        return [bytes(row.gram) for row in own.select("gram").collect()]

    words, pairs = most_frequent(1), most_frequent(2) if kinds > 1 else []
    states = {word: zlib.crc32(word) for word in words}
    return Head(states, {pair: zlib.crc32(pair) % buckets for pair in pairs}, buckets)


def bucket_totals(docs, head, text="text", longest=1):
    """How many features of all texts fall into each bucket, as an array on the driver.

    Tasks sum over all their texts, so that no more than one row a task and bucket is shuffled.
    """
    head = docs.sparkSession.sparkContext.broadcast(head)

    def counted(batches):
        features = Features(head.value, longest)
        totals = np.zeros(features.buckets, np.int64)
        for batch in batches:
            for run in slices(batch.column(0).cast(pa.binary()), _SLICE_BYTES):
                found = np.concatenate([features.of(words_of(raw)) for raw in run])
                totals += np.bincount(found, minlength=len(totals))
        found = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()), pa.array(totals[found], pa.int64())], ["bucket", "n"]
        )

    rows = docs.select(F.col(text).alias("text")).mapInArrow(counted, "bucket bigint, n bigint")
    totals = np.zeros(head.value.buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[row.bucket] = row.n
    return totals


def gains(source, target):
    """Thousandths of the log ratio of a bucket's smoothed shares in target and source, floored."""
    above = (target + 1).astype(float) * float(source.sum() + len(source))
    below = (source + 1).astype(float) * float(target.sum() + len(target))
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def _weights_udf(shared, longest):
    kind = "struct<n_words: bigint, n_features: bigint, weight: bigint>"

    @F.arrow_udf(kind)
    def weighed(texts: pa.Array) -> pa.Array:
        head, gain = shared.value
        features = _features(head, longest)
        rows = [
            (len(words), len(own), int(gain[own].sum()) // len(own) if len(own) else 0)
            for run in slices(texts.cast(pa.binary()), _SLICE_BYTES)
            for words in map(words_of, run)
            for own in [features.of(words)]
        ]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.StructArray.from_arrays(
            [pa.array(column, pa.int64()) for column in columns], ["n_words", "n_features", "weight"]
        )

    return weighed


_KEPT = {}


def _features(head, longest):
    if _KEPT.get("head") is not head:
        _KEPT.update(head=head, features=Features(head, longest))
    return _KEPT["features"]


def noise(id, seed=SEED):
    """Gumbel noise of an id in thousandths, floored: the same for one id and seed everywhere."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(text, 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(
    docs,
    target,
    id="doc_id",
    text="text",
    target_text="text",
    longest=1,
    buckets=BUCKETS,
    seed=SEED,
    head_size=HEAD_SIZE,
):
    """`docs` with `n_words`, `n_features`, `weight` and `score` of each text, all long.

    `weight` is the floored mean gain of the features, 0 without any; `score` adds the noise of the
    id. Totals are taken over all rows of `docs` and of `target`, equal rows and all; a null or empty
    text has no words. A null id has the noise of an empty one. Texts of any length are read whole, one
    at a time. Every row is kept; columns with the four names are replaced. `docs` may be empty, and
    so may `target`.
    """
    head = head_vocabulary(docs, text, longest, buckets, head_size)
    source = bucket_totals(docs, head, text, longest)
    gain = gains(source, bucket_totals(target, head, target_text, longest))
    shared = docs.sparkSession.sparkContext.broadcast((head, gain))
    held = docs.select(
        F.struct("*").alias("row"), F.col(text).alias("text"), noise(id, seed).alias("noise")
    )
    found = held.select("row", "noise", _weights_udf(shared, longest)(F.col("text")).alias("found"))
    names = ("n_words", "n_features", "weight", "score")
    kept = [F.col("row")[name].alias(name) for name in docs.columns if name not in names]
    score = (F.col("found.weight") + F.col("noise")).alias("score")
    return found.select(*kept, "found.n_words", "found.n_features", "found.weight", score)


def ranked(weighed, percent=PERCENT, least_words=LEAST_WORDS, id="doc_id"):
    """`weighed` with `rank`: 1, 2, 3, ... from the highest score down for the rows that are drawn.

    Of the N rows with `least_words` words or more floor(N * percent / 100) are drawn, at equal scores
    those with the smaller id; the rank of all others is null. Equal rows are ranked one after the
    other; of unequal rows with one id and score the order follows their hash. A null id comes first.
    All rows are sorted in ranges and numbered within each, so that no task holds more than a range
    and only the sizes of ranges reach the driver; give it narrow rows, since they move. Every row
    is kept; a column named `rank` is replaced.
    """
    spark = weighed.sparkSession
    names = [name for name in weighed.columns if name != "rank"]
    rows = stored(
        weighed.select(
            F.struct(*names).alias("row"),
            (F.col("n_words") >= least_words).alias("fits"),
            F.col("score").alias("score"),
            F.col(id).alias("id"),
            F.xxhash64(*names).alias("hash"),
            # Parts a range of equal rows.
            F.monotonically_increasing_id().alias("place"),
        ),
        "resample-weights",
    )
    order = [F.desc("fits"), F.desc("score"), "id", "hash", "place"]
    numbered = rows.orderBy(*order).select(
        "row",
        "fits",
        F.spark_partition_id().alias("range"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"),
    )
    numbered = stored(numbered, "resample-order")
    sizes = numbered.groupBy("range").agg(F.count("*").alias("n"), F.count_if("fits").alias("fit"))
    before, all_fit, offsets = 0, 0, []
    for size in sizes.orderBy("range").collect():  # one row a range
        offsets.append((size["range"], before))
        before += size.n
        all_fit += size.fit
    offsets = spark.createDataFrame(offsets, "range int, before bigint")
    rank = F.col("before") + F.col("at") + 1
    drawn = rank <= all_fit * percent // 100
    return numbered.join(F.broadcast(offsets), "range").select(
        "row.*", F.when(drawn, rank).alias("rank")
    )


def resample(
    docs, target, percent=PERCENT, least_words=LEAST_WORDS, id="doc_id", text="text", **settings
):
    """The rows of `docs` that are drawn, with their own columns.

    The last one drawn is found from narrow rows; the texts are then filtered where they are read,
    and do not move. Rows with the id and the score of the last one drawn come with it. `settings` go to
    `weigh`. Nulls, empty texts and tables as in `weigh` and `ranked`.
    """
    held = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))
    weighed = weigh(held, target, "id", "text", **settings)
    last = ranked(weighed.select("id", "n_words", "score"), percent, least_words, "id")
    last = last.filter("rank IS NOT NULL").agg(F.max_by(F.struct("score", "id"), "rank").alias("last"))
    last = last.first().last
    if last is None:
        return docs.limit(0)
    first = F.col("id").isNull() | (F.lit(False) if last.id is None else F.col("id") <= last.id)
    drawn = (F.col("score") > last.score) | ((F.col("score") == last.score) & first)
    return weighed.filter((F.col("n_words") >= least_words) & drawn).select("row.*")
