"""BPE encoding and decoding by speculation: propose tokens, verify pairs, merge what failed.

Each distinct word is cut greedily into the longest tokens. That is the right encoding exactly when
every two neighbours are compatible, which one vectorised check tells for all words at once. Only
words with an incompatible pair are merged rank by rank.
"""

import hashlib
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .vocabulary import NEVER, read_model, shared_vocabulary
from .words import with_results

_SHORT = 48
_CACHED_WORDS = 200_000
_CACHED_LENGTH = 64
_SLICE_CHARS = 500_000


def greedy(vocabulary, word):
    """Ids of the longest tokens from left to right."""
    ids, at, longest, id_of = [], 0, vocabulary.longest, vocabulary.id_of
    while at < len(word):
        reach = longest.get(word[at : at + 3]) or longest.get(word[at : at + 2], 1)
        end = min(len(word), at + reach)
        while (found := id_of.get(word[at:end])) is None:
            end -= 1
        ids.append(found)
        at = end
    return ids


def merge_exactly(vocabulary, word):
    """Ids after all merges in order of rank, the leftmost first among equals."""
    return (_merge_short if len(word) <= _SHORT else _merge_long)(vocabulary, word)


def _merge_short(vocabulary, word):
    merge = vocabulary.merge.get
    none = (NEVER, -1)
    ids = [vocabulary.byte_id[byte] for byte in word]
    found = [merge(pair, none) for pair in zip(ids, ids[1:], strict=False)]
    while found:
        best = min(found)
        if best is none:
            break
        at = found.index(best)
        ids[at : at + 2] = [best[1]]
        del found[at]
        if at < len(found):
            found[at] = merge((ids[at], ids[at + 1]), none)
        if at:
            found[at - 1] = merge((ids[at - 1], ids[at]), none)
    return ids


def _merge_long(vocabulary, word):
    """The same with a queue, for words in which searching for the least rank would take long."""
    ids = [vocabulary.byte_id[byte] for byte in word]
    after = [*range(1, len(ids)), -1]
    before = list(range(-1, len(ids) - 1))
    merge = vocabulary.merge
    queue = [
        (*found, at) for at in range(len(ids) - 1) if (found := merge.get((ids[at], ids[at + 1])))
    ]
    heapify(queue)
    while queue:
        _, whole, at = heappop(queue)
        nxt = after[at]
        if ids[at] < 0 or nxt < 0 or merge.get((ids[at], ids[nxt]), (0, -1))[1] != whole:
            continue
        ids[at], ids[nxt], after[at] = whole, -1, after[nxt]
        if after[at] >= 0:
            before[after[at]] = at
            if found := merge.get((whole, ids[after[at]])):
                heappush(queue, (*found, at))
        if before[at] >= 0 and (found := merge.get((ids[before[at]], whole))):
            heappush(queue, (*found, before[at]))
    return [k for k in ids if k >= 0]


def encode_words(vocabulary, words):
    """For each word its ids as little-endian unsigned 32-bit integers."""
    raw = [word.encode() for word in words]
    proposed = [greedy(vocabulary, word) for word in raw]
    sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
    flat = np.fromiter((k for ids in proposed for k in ids), np.int64, sizes.sum())
    owner = np.repeat(np.arange(len(raw)), sizes)
    inner = owner[:-1] == owner[1:]
    pairs = flat[:-1][inner] * vocabulary.size + flat[1:][inner]
    distinct, back = np.unique(pairs, return_inverse=True)
    fits = vocabulary.compatible(distinct // vocabulary.size, distinct % vocabulary.size)
    for at in np.unique(owner[:-1][inner][~fits[back]]):
        proposed[at] = merge_exactly(vocabulary, raw[at])
    return [np.array(ids, "<u4").tobytes() for ids in proposed]


class Encoder:
    """Encodes texts; keeps the ids of common words of a bounded number."""

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary
        self.known = {}

    def encode(self, texts):
        vocabulary = self.vocabulary
        pieces = []
        missing = set()
        for text in texts:
            own = []
            for k, part in enumerate(vocabulary.parts(text or "")):
                own.append([part] if k % 2 else vocabulary.words(part))
                if not k % 2:
                    missing.update(own[-1])
            pieces.append(own)
        missing.difference_update(self.known)
        if len(self.known) + len(missing) > _CACHED_WORDS:
            self.known.clear()
            missing = {word for own in pieces for part in own[::2] for word in part}
        missing = list(missing)
        found = dict(zip(missing, encode_words(vocabulary, missing), strict=True))
        self.known.update(found)
        known = self.known
        special = {c: np.array([k], "<u4").tobytes() for c, k in vocabulary.special.items()}
        encoded = [
            b"".join(
                b"".join(map((special if k % 2 else known).__getitem__, part))
                for k, part in enumerate(own)
            )
            for own in pieces
        ]
        for word in found:
            if len(word) > _CACHED_LENGTH:
                del known[word]
        return encoded

    def decode(self, ids):
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        names = self.vocabulary.token_bytes
        return b"".join(map(names.__getitem__, ids.tolist())).decode("utf-8", "replace")


_ENCODERS = {}


def _encoder(model):
    """One encoder for each Python worker, so that common words stay known between batches."""
    vocabulary = shared_vocabulary(model)
    if id(vocabulary) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[id(vocabulary)] = Encoder(vocabulary)
    return _ENCODERS[id(vocabulary)]


def slices(texts, chars=_SLICE_CHARS, rows=500):
    """An Arrow array as lists of texts of a bounded size, so that no batch is held as words at once."""
    run, size = [], 0
    for at in range(0, len(texts), rows):
        for text in texts.slice(at, rows).to_pylist():
            run.append(text)
            size += len(text or "")
            if size >= chars:
                yield run
                run, size = [], 0
    if run:
        yield run


def _encode_udf(model, summary):
    kind = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    kind = kind if summary else "ids array<int>"

    @F.arrow_udf(f"struct<{kind.replace(' ', ': ').replace(',:', ',')}>")
    def encoded(texts: pa.Array) -> pa.Array:
        encoder = _encoder(model)
        counts, ids_sha, text_sha, raws = [], [], [], []
        for run in slices(texts):
            for raw in encoder.encode(run):
                if not summary:
                    raws.append(raw)
                    continue
                ids = np.frombuffer(raw, "<u4")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                text_sha.append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
        if not summary:
            ends = np.cumsum([0, *(len(raw) // 4 for raw in raws)], dtype=np.int32)
            values = np.frombuffer(b"".join(raws), "<i4")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            return pa.StructArray.from_arrays([lists], ["ids"])
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return encoded


def encode(docs, path, text="text", ids="ids"):
    """`docs` with the token ids of each text.

    A null text counts as empty and has no ids. Other columns and the order and number of rows are
    as given; a column named `ids` is replaced. Ids follow the file at `path`, special strings
    inside a text included.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(path))
    return docs.withColumn(ids, _encode_udf(model, False)(F.col(text))["ids"])


def decode(docs, path, ids="ids", text="text"):
    """`docs` with the text of each list of token ids; a null list has a null text.

    Ids outside of the vocabulary fail. Bytes that are no UTF-8 become replacement characters.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(path))

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        encoder = _encoder(model)
        return pa.array(
            [None if own is None else encoder.decode(np.array(own, np.int64)) for own in lists.to_pylist()],
            pa.string(),
        )

    return docs.withColumn(text, decoded(F.col(ids)))


def encode_summary(docs, path, text="text"):
    """`docs` with `n_tokens`, and the SHA-256 of the ids and of the text decoded from them.

    Does both ways in one pass, so that ids are not kept. A null text counts as empty. Every row is kept;
    columns with the three names are replaced. A text of any length is encoded whole, word by word.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(path))
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    def encoded(held):
        found = held.select("row", _encode_udf(model, True)(F.col("text")).alias("found"))
        return found.select("row", "found.*")

    return with_results(docs, {"text": F.col(text)}, names, encoded)
