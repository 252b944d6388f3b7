"""Periodic runs in the words of a text: stretches that repeat themselves after a fixed number of words.

Two places of a text agree for a number of words, their common extension. Only suffixes at the places
of a difference cover are sorted. For any two places a shift below `CYCLE` leads to two sorted
suffixes: the words before them are compared, and a sparse table over the sorted suffixes answers
the rest. A run of period q holds a place of every grid of q (exponent - 1) words, so that the
extensions of a place and the one q later, forward and backward, find every run with
n/q + n/2q + ... pairs of places instead of all.

Texts are worked on in concatenated slices of a bounded size, with codes of words that differ from text
to text; a longer text is a slice of its own.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .bpe import slices
from .words import bound, words_of

# A perfect difference cover. Every difference modulo 31 is one of two of its members.
CYCLE = 31
COVER = (1, 5, 11, 24, 25, 27)

LEAST_LENGTH = 6
LEAST_EXPONENT = 4

_SLICE_BYTES = 1_500_000
_PAIRS = 1 << 19


def shifts():
    """For residues a and b the smallest shift that takes both into the cover."""
    inside = np.zeros(CYCLE, bool)
    inside[list(COVER)] = True
    table = np.full((CYCLE, CYCLE), -1, np.int64)
    residues = np.arange(CYCLE)
    for shift in range(CYCLE - 1, -1, -1):
        hit = inside[(residues + shift) % CYCLE]
        table[np.ix_(hit, hit)] = shift
    return table


_SHIFTS = shifts()


class Extensions:
    """Longest common extensions of places of `codes`.

    Both places must lie in the same text, and each text must end in a code that is found once.
    """

    def __init__(self, codes):
        self.codes = codes
        residues = np.zeros(CYCLE, bool)
        residues[list(COVER)] = True
        self.places = np.flatnonzero(residues[np.arange(len(codes)) % CYCLE])
        self.number = np.full(len(codes), -1, np.int64)
        self.number[self.places] = np.arange(len(self.places))
        self._sort()
        self._tabulate()

    def _sort(self):
        """Sorted suffixes of the cover, the words that neighbours share, and classes on the way.

        Word by word up to a cycle, then by the classes of the suffixes that begin where the sorted
        part ends: these are in the cover too. Only suffixes that still tie are sorted again.
        """
        codes, places = self.codes, self.places
        self.rank = np.zeros(len(places), np.int64)
        self.order = np.arange(len(places))
        self.shared = np.zeros(len(places), np.int64)
        self.classes = []
        tied, depth, late = self._refine(np.arange(len(places)), codes[places], None), 1, []
        while len(tied):
            if depth >= CYCLE:
                self.classes.append((depth, self.rank.copy()))
                keys = self.rank[self.number[places[self.order[tied]] + depth]]
            else:
                keys = codes[places[self.order[tied]] + depth]
            tied, new = self._refine(tied, keys, depth), self._new
            if depth >= CYCLE:
                late.append(new)
            depth = depth * 2 if depth >= CYCLE else depth + 1
        if late:
            late = np.concatenate(late)
            self.shared[late] = self._by_classes(self.order[late - 1], self.order[late])

    def _refine(self, slots, keys, depth):
        """Sort the members at `slots`, tied ones, by `keys`; returns the slots that still tie."""
        members = self.order[slots]
        if depth is None:
            group = np.zeros(len(slots), np.int64)
            sort = np.argsort(keys, kind="stable")
        else:
            group = self.rank[members]
            sort = np.lexsort((keys, group))
        members, keys, group = members[sort], keys[sort], group[sort]
        self.order[slots] = members
        first = np.ones(len(slots), bool)
        other_group = group[1:] != group[:-1]
        first[1:] = other_group | (keys[1:] != keys[:-1])
        within = np.zeros(len(slots), bool)
        within[1:] = ~other_group & first[1:]
        self._new = slots[within]
        self.shared[self._new] = depth or 0
        starts = np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))
        self.rank[members] = slots[starts]
        alone = first.copy()
        alone[:-1] &= first[1:]
        return slots[~alone]

    def _by_classes(self, a, b):
        """Shared words of the sorted suffixes numbered a and b, by the classes of growing lengths."""
        a, b = self.places[a], self.places[b]
        total = np.zeros(len(a), np.int64)
        for depth, classes in reversed(self.classes):
            same = classes[self.number[a + total]] == classes[self.number[b + total]]
            total += np.where(same, depth, 0)
        return total + self._compare(a + total, b + total, np.full(len(a), CYCLE))

    def _compare(self, a, b, most):
        """Words from a and b on that agree, `most` at most."""
        total = np.zeros(len(a), np.int64)
        live, step = np.flatnonzero(most > 0), 0
        while len(live):
            live = live[self.codes[a[live] + step] == self.codes[b[live] + step]]
            step += 1
            total[live] = step
            live = live[most[live] > step]
        return total

    def _tabulate(self):
        """Minima of `shared` over stretches of 1, 2, 4, ... neighbours."""
        self.minima = [self.shared.astype(np.int32)]
        width = 1
        while 2 * width <= len(self.shared):
            below = self.minima[-1]
            self.minima.append(np.minimum(below[:-width], below[width:]))
            width *= 2

    def _least(self, low, high):
        """Minimum of `shared` from low to high, both included."""
        level = np.frexp((high - low + 1).astype(float))[1] - 1
        least = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.minima[k]
            least[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k)) + 1])
        return least

    def common(self, a, b):
        """How many words agree from the places a on and from b on, a and b different."""
        shift = _SHIFTS[a % CYCLE, b % CYCLE]
        total = self._compare(a, b, shift)
        on = np.flatnonzero(total == shift)
        left = self.rank[self.number[a[on] + shift[on]]]
        right = self.rank[self.number[b[on] + shift[on]]]
        total[on] += self._least(np.minimum(left, right) + 1, np.maximum(left, right))
        return total


def _grid_pairs(codes, lengths, least_length, exponent):
    """Blocks of (place, period) where a run may be: the same word at a grid place and a period later.

    `lengths` fall; the texts follow each other in `codes`, each after one code of its own.
    """
    ends = np.cumsum(lengths + 1)
    falling = -lengths
    some, held = [], 0
    for period in range(1, int(lengths[0]) // exponent + 1):
        fits = np.searchsorted(falling, -max(least_length, exponent * period), side="right")
        if not fits:
            break
        places = np.arange(0, ends[fits - 1] - period + 1, (exponent - 1) * period)
        places = places[codes[places] == codes[places + period]]
        some.append((places, np.full(len(places), period)))
        held += len(places)
        if held >= _PAIRS:
            yield [np.concatenate(column) for column in zip(*some, strict=True)]
            some, held = [], 0
    if held:
        yield [np.concatenate(column) for column in zip(*some, strict=True)]


def runs_of(texts, least_length=LEAST_LENGTH, exponent=LEAST_EXPONENT):
    """For each list of words its runs, as an array of (start, length, period) by start, then period.

    A run is a stretch with a smallest period q, of `exponent` q words at least and `least_length`,
    that keeps q with neither neighbour added.
    """
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    found = [np.zeros((0, 3), np.int64)] * len(texts)
    chosen = np.argsort(-counts, kind="stable")
    chosen = chosen[counts[chosen] >= max(least_length, exponent)]
    if not len(chosen):
        return found
    lengths = counts[chosen]
    known = {}
    codes = np.empty(int(lengths.sum()) + len(chosen) + 1, np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    for at, number in zip(starts.tolist(), chosen.tolist(), strict=False):
        words = texts[number]
        own = [known.setdefault(word, len(known)) for word in words]
        codes[at + 1 : at + 1 + len(own)] = own
    text_of = np.repeat(np.arange(len(chosen)), lengths + 1)
    codes[:-1] += text_of * len(known)
    codes[starts] = -1 - np.arange(len(starts))

    rows = [np.zeros((0, 3), np.int64)]
    forward = backward = None
    last = len(codes) - 1
    for places, period in _grid_pairs(codes, lengths, least_length, exponent):
        if forward is None:
            forward, backward = Extensions(codes), Extensions(codes[::-1].copy())
        after = forward.common(places, places + period)
        before = backward.common(last - places + 1, last - places - period + 1)
        length = before + after + period
        long = length >= np.maximum(least_length, exponent * period)
        own = np.stack([places - before, length, period], 1)[long]
        rows.append(_smallest_periods(own))
    rows = _smallest_periods(np.concatenate(rows))
    owner = text_of[rows[:, 0]]
    rows[:, 0] -= starts[owner] + 1
    order = np.lexsort((rows[:, 2], rows[:, 0], owner))
    rows, owner = rows[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(len(chosen) + 1))
    for k in np.unique(owner):
        found[chosen[k]] = rows[bounds[k] : bounds[k + 1]]
    return found


def _smallest_periods(rows):
    """One row for each stretch: several periods of one are multiples of the smallest."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[first]


def collapse(words, runs):
    """The words without those after the first period of a run."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    inside = np.cumsum(edges[:-1])
    return [words[k] for k in np.flatnonzero(inside == 0).tolist()]


def _runs_udf(least_length, exponent):
    kind = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"

    @F.arrow_udf(kind)
    def periodic(texts: pa.Array) -> pa.Array:
        n_words, found, collapsed = [], [np.zeros((0, 3), np.int64)], []
        ends = [0]
        for run in slices(texts.cast(pa.binary()), _SLICE_BYTES):
            words = [(raw or b"").split() for raw in run]  # at the six blanks of a word
            for own, runs in zip(words, runs_of(words, least_length, exponent), strict=True):
                n_words.append(len(own))
                ends.append(ends[-1] + len(runs))
                collapsed.append(b" ".join(collapse(own, runs)))
                if len(runs):
                    found.append(runs)
        columns = [pa.array(column, pa.int64()) for column in np.concatenate(found).T.copy()]
        rows = pa.StructArray.from_arrays(columns, ["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
        texts = pa.array(collapsed, pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), lists, texts], ["n_words", "runs", "collapsed"]
        )

    return periodic


def find_runs(docs, text="text", least_length=LEAST_LENGTH, exponent=LEAST_EXPONENT):
    """`docs` with `n_words`, `runs` and `collapsed` of each text.

    `runs` lists (`start`, `length`, `period`) in words counted from 0, by start, then period.
    `collapsed` joins by one blank the words that are in no run after its first period. Words are
    what stands between the six ASCII blanks, in the case they have. A null or empty text has no
    words, no runs and an empty `collapsed`. Every row is kept, equal ones too, and worked on by
    itself: no row moves. A text of any length is read whole; it takes a few hundred bytes a word.
    Columns with the three names are replaced. `least_length` and `exponent` (2 or more) bound runs from
    below.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period: exponent must be 2 or more")
    held = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    found = held.select("row", _runs_udf(least_length, exponent)(F.col("text")).alias("found"))
    kept = [
        F.col("row")[name].alias(name)
        for name in docs.columns
        if name not in ("n_words", "runs", "collapsed")
    ]
    return found.select(*kept, "found.n_words", "found.runs", "found.collapsed")


def greatest_run(runs):
    """Of an array of runs the one with the greatest length to period, the first of equal ones.

    Compared in whole numbers; null if there is no run.
    """
    return F.aggregate(
        runs,
        F.get(F.col(runs), F.lit(0)),
        lambda best, run: F.when(
            run["length"] * best["period"] > best["length"] * run["period"], run
        ).otherwise(best),
    )


def plant_runs(docs, id="doc_id", text="text"):
    """`docs` where about a tenth of the texts, by their id, end in a stretch repeated to the end.

    With h = crc32 of the id as text and g = h div 10, a text of n > 0 words with h mod 10 = 0 gets
    from word a = g mod n on its own words a to a + p - 1 again and again, p = 1 + (n - a) div
    (3 + g mod 8). Other texts, and those with a null id, stay as they are.
    """
    h = F.crc32(F.col(id).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words):
        n = F.size(words)
        period = lambda a: F.lit(1) + F.floor((n - a) / (3 + g % 8))
        return bound(g % n, lambda a: bound(period(a), lambda p: _repeated(words, a, p)))

    changed = bound(
        words_of(text), lambda words: F.when(F.size(words) > 0, planted(words))
    )
    changed = F.when(h % 10 == 0, changed)
    return docs.withColumn(text, F.coalesce(changed, F.col(text)))


def _repeated(words, a, p):
    """The words, from the a-th on those of the first p after it, joined by one blank."""
    source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
    return F.array_join(F.transform(words, lambda _, i: F.get(words, source(i).cast("int"))), " ")
