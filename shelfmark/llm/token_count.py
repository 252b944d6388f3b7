"""Token counts by finite-state transducers.

Two deterministic machines. The first cuts text into words: ten states over character classes, each
transition annotated with where words start. Texts are cut into chunks; a chunk maps every state it
may be entered in to the state it is left in, and a parallel prefix scan composes these maps, so
that all chunks run at once. The second machine reads the bytes of a word, each transition annotated
with the tokens it adds. Its states are compiled when first met: what tokens may still reach back
to, and the last token at each such place.
"""

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .bpe import slices
from .vocabulary import read_model, shared_vocabulary

_SLICE_CHARS = 2_000_000
_CHUNK = 256
_KNOWN_WORDS = 600_000
_STATES = 200_000

# Character classes.
SPACE, BLANK, LETTER, NUMBER, OTHER, QUOTE, ENDS, NEEDS_E, E, L = range(10)
# States: what the last character belongs to.
START, LETTERS, NUMBERS, OTHERS, QUOTED, QUOTED_E, QUOTED_L, DONE, SPACED, BLANKED = range(10)
# Output of a transition: a word starts here; a word starts at the character before.
HERE, BEFORE = 1, 2


def _classes():
    table = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))
        if kind[0] == "L":
            table[point] = LETTER
        elif kind[0] == "N":
            table[point] = NUMBER
    # The code points of Unicode's White_Space besides U+0020.
    blanks = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
    table[[*blanks, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = BLANK
    table[ord(" ")] = SPACE
    table[ord("'")] = QUOTE
    table[[ord(c) for c in "stmd"]] = ENDS
    table[[ord(c) for c in "rv"]] = NEEDS_E
    table[ord("e")] = E
    table[ord("l")] = L
    return table


def _step(state, kind):
    """Next state and output. A quote that opens a word may begin a contraction."""
    run = {SPACE: SPACED, BLANK: BLANKED, NUMBER: NUMBERS, OTHER: OTHERS, QUOTE: OTHERS}
    own = run.get(kind, LETTERS)
    fresh = QUOTED if kind == QUOTE else own
    if state == QUOTED:
        if kind == ENDS:
            return DONE, 0
        if kind == NEEDS_E:
            return QUOTED_E, 0
        if kind == L:
            return QUOTED_L, 0
        return (OTHERS, 0) if own == OTHERS else (own, HERE)
    if state == QUOTED_E or state == QUOTED_L:
        if kind == (E if state == QUOTED_E else L):
            return DONE, 0
        return (LETTERS, BEFORE) if own == LETTERS else (fresh, BEFORE | HERE)
    if state in (SPACED, BLANKED):
        if own in (SPACED, BLANKED):
            return own, 0
        return (own, BEFORE) if state == SPACED else (fresh, BEFORE | HERE)
    if state == own and state in (LETTERS, NUMBERS, OTHERS):
        return own, 0
    return fresh, HERE


# A quoted "r" or "v" at the end of a text is a word of its own: END flushes it.
_NEXT = np.array([[_step(s, k)[0] for k in range(10)] for s in range(10)], np.uint8)
_OUT = np.array([[_step(s, k)[1] for k in range(10)] for s in range(10)], np.uint8)
_CLASSES = []


def compose(maps, first):
    """State before each chunk: an inclusive scan over maps by doubling.

    `maps[c, s]` is the state after chunk c when entered in s; a chunk in `first` opens a text and
    is entered in START, whatever came before.
    """
    whole = maps.copy()
    whole[first] = maps[first, START][:, None]
    reach = 1
    while reach < len(whole):
        whole[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), 1)
        reach *= 2
    entry = np.full(len(maps), START, np.uint8)
    entry[1:] = whole[:-1, START]
    entry[first] = START
    return entry


def word_starts(texts):
    """Start flags of words over the joined characters of non-empty texts, and their text bounds."""
    if not _CLASSES:
        _CLASSES.append(_classes())
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _CLASSES[0][points]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    chunks = -(-sizes // _CHUNK)
    first = np.concatenate([[0], np.cumsum(chunks)[:-1]])
    text_of = np.repeat(np.arange(len(texts)), chunks)
    begin = bounds[text_of] + (np.arange(len(text_of)) - first[text_of]) * _CHUNK
    length = np.minimum(_CHUNK, bounds[text_of + 1] - begin)
    by_length = np.argsort(-length, kind="stable")
    maps = np.tile(np.arange(10, dtype=np.uint8), (len(begin), 1))
    active = np.searchsorted(-length[by_length], -np.arange(_CHUNK), "left")
    k = 0
    while k < _CHUNK and (maps != maps[:, :1]).any():
        live = by_length[: active[k]]
        maps[live] = _NEXT[maps[live], kinds[begin[live] + k][:, None]]
        k += 1
        if k < _CHUNK and not len(by_length[: active[k]]):
            break
    lane = maps[:, 0].copy()
    merged = (maps == maps[:, :1]).all(1)
    for k in range(k, _CHUNK):  # all states have become one
        live = by_length[: active[k]]
        lane[live] = _NEXT[lane[live], kinds[begin[live] + k]]
    maps[merged] = lane[merged][:, None]
    state = compose(maps, first)
    starts = np.zeros(len(kinds), bool)
    for k in range(_CHUNK):
        live = by_length[: active[k]]
        at = begin[live] + k
        now = kinds[at]
        out = _OUT[state[live], now]
        starts[at[out & HERE > 0]] = True
        starts[at[out & BEFORE > 0] - 1] = True
        state[live] = _NEXT[state[live], now]
    last = first + chunks - 1
    pending = np.isin(state[last], [QUOTED_E, QUOTED_L])
    starts[bounds[1:][pending] - 1] = True
    return starts, bounds


class CountMachine:
    """Reads the bytes of a word and adds up the tokens of its encoding.

    The last token of a prefix is the one whose left neighbour, the last token of the rest, is
    compatible with it. A state holds, for every place where a token may still begin, the last
    token before it and the count there, relative to the count now.
    """

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary
        self.openings = {
            token[:k] for token in vocabulary.id_of for k in range(1, len(token))
        }
        self.fits = {}
        self.clear()

    def clear(self):
        self.numbers = {}
        self.states = []
        self.moves = {}
        self.start = self._number((b"", ((0, -1, 0),)))

    def _number(self, state):
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state]

    def _compatible(self, a, b):
        if a < 0:
            return True
        key = a * self.vocabulary.size + b
        if key not in self.fits:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            self.fits[key] = self._fits(a, b)
        return self.fits[key]

    def _fits(self, a, b):
        v = self.vocabulary
        limit = len(v.merge)
        while True:
            found = v.merge.get((a, b))
            if found and found[0] < limit:
                return False
            a_rank, b_rank = self.rank(a), self.rank(b)
            if a_rank < 0 and b_rank < 0:
                return True
            if a_rank > b_rank:
                limit, a = a_rank, int(v.right[a])
            else:
                limit, b = b_rank + 1, int(v.left[b])

    def rank(self, token):
        return int(self.vocabulary.rank[token])

    def _compile(self, number, byte):
        held, places = self.states[number]
        read = held + bytes([byte])
        for back, before, count in places:
            token = self.vocabulary.id_of.get(read[len(held) - back :])
            if token is not None and self._compatible(before, token):
                break
        added = count + 1
        places = [
            (back + 1, before, count - added)
            for back, before, count in places
            if read[len(held) - back :] in self.openings
        ]
        places.append((0, token, 0))
        held = read[len(read) - places[0][0] :]
        move = self._number((held, tuple(places))), added
        self.moves[number << 8 | byte] = move
        return move

    def count(self, word):
        state, total, moves = self.start, 0, self.moves
        for byte in word:
            move = moves.get(state << 8 | byte) or self._compile(state, byte)
            state = move[0]
            total += move[1]
        return total


class Counter:
    """Counts tokens of texts; keeps the counts of common words of a bounded number."""

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary
        self.machine = CountMachine(vocabulary)
        self.known = {}

    def learn(self, words):
        if len(self.known) + len(words) > _KNOWN_WORDS:
            self.known.clear()
        for word in set(words).difference(self.known):
            if len(self.machine.states) > _STATES:
                self.machine.clear()
            self.known[word] = self.machine.count(word.encode())

    def count(self, texts):
        totals = np.zeros(len(texts), np.int64)
        parts, owners = [], []
        for at, text in enumerate(texts):
            for k, part in enumerate(self.vocabulary.parts(text or "")):
                if k % 2:
                    totals[at] += 1
                elif part:
                    parts.append(part)
                    owners.append(at)
        if parts:
            starts, bounds = word_starts(parts)
            at = np.flatnonzero(starts)
            firsts = np.searchsorted(at, bounds[:-1])
            lasts = [*firsts[1:].tolist(), len(at)]
            for part, owner, low, first, last in zip(
                parts, owners, bounds[:-1].tolist(), firsts.tolist(), lasts, strict=True
            ):
                begin = (at[first:last] - low).tolist()
                words = list(map(part.__getitem__, map(slice, begin, [*begin[1:], len(part)])))
                self.learn(words)
                totals[owner] += sum(map(self.known.__getitem__, words))
        return totals


_COUNTERS = {}


def _counter(model):
    vocabulary = shared_vocabulary(model)
    if id(vocabulary) not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[id(vocabulary)] = Counter(vocabulary)
    return _COUNTERS[id(vocabulary)]


def count_tokens(docs, path, text="text", limit=512):
    """`docs` with `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more tokens than `limit`).

    A null or empty text has 0 bytes and 0 tokens. Other columns and rows are as given; columns
    with the three names are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(path))

    @F.arrow_udf("bigint")
    def counted(texts: pa.Array) -> pa.Array:
        counter = _counter(model)
        runs = [counter.count(run) for run in slices(texts, _SLICE_CHARS)]
        return pa.array(np.concatenate([*runs, np.zeros(0, np.int64)]), pa.int64())

    return docs.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"),
            "n_tokens": counted(F.col(text)),
        }
    ).withColumn("over_limit", F.col("n_tokens") > limit)
