"""Quality of texts by their lines: a linear-chain conditional random field labels each good or bad.

A line is described by signs of its characters and words, and by those of the lines before and after
it. The chain adds what it costs to change from good to bad lines and back. Forward and backward
sums give the chance of each line to be good, and a text's score is their mean by length. The field is
fitted by gradient steps; each is a Spark job over the stored signs of the labelled rows, so that
only sums reach the driver.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .bpe import slices
from .quality import STOP_WORDS
from .scratch import stored

#: At most so many labelled rows are learned from, those with the smallest hash of their id.
MAX_LABELS = 20_000
THRESHOLD = 0.3
_ROUNDS = 40
_RIDGE = 1.0
_SLICE_CHARS = 500_000
_BLOCK = 1 << 16  # lines whose signs are held as numbers at once

# Kinds of characters.
_BLANK, _LOWER, _UPPER, _DIGIT, _STOP, _SHOUT, _MARK, _BAR, _SIGN, _END = range(10)
_KINDS = 10
_TABLE_SIZE = 0x3000

_SHARES = (0.0, 0.05, 0.15, 0.3, 0.6)
_WORD_COUNTS = (1, 3, 6, 12, 25, 60)
_WORD_LENGTHS = (2.5, 4.0, 6.0, 8.0, 12.0)

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _tables():
    """Kind and lower case of each character; those beyond the table are letters."""
    kind = np.full(_TABLE_SIZE + 1, _SIGN, np.uint8)
    lower = np.arange(_TABLE_SIZE + 1, dtype=np.uint64)
    for code in range(_TABLE_SIZE):
        c = chr(code)
        if c.isalpha():
            kind[code] = _UPPER if c.isupper() else _LOWER
        elif c.isdigit():
            kind[code] = _DIGIT
        elif c.isspace():
            kind[code] = _BLANK
        if len(c.lower()) == 1:
            lower[code] = ord(c.lower())
    kind[_TABLE_SIZE] = _LOWER
    for signs, own in ((".…", _STOP), ("!?", _SHOUT), (",;:'\"-()«»“”„’–—¿¡", _MARK), ("|", _BAR), ("\n", _END)):
        kind[[ord(c) for c in signs]] = own
    return kind, lower


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


class Describer:
    """Signs of the lines of texts, all texts of a slice at once."""

    def __init__(self):
        self.kind, self.lower = _tables()
        joined = " ".join(STOP_WORDS)
        self.stop_words = np.unique(self._words(self._codes(joined))[2])

    def _codes(self, text):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        return np.minimum(codes, _TABLE_SIZE).astype(np.intp), codes

    def _words(self, codes):
        """Starts, lengths and hashes of words; only letters count, in lower case."""
        small, codes = codes
        kind = self.kind[small]
        solid = (kind != _BLANK) & (kind != _END)
        before = np.concatenate([[False], solid[:-1]])
        starts = np.flatnonzero(solid & ~before)
        ends = np.flatnonzero(before & ~solid)
        if len(ends) < len(starts):
            ends = np.append(ends, len(solid))
        if not len(starts):
            return starts, ends, np.zeros(0, np.uint64)
        value = np.where(codes < _TABLE_SIZE, self.lower[small], codes)
        value = np.where((kind == _LOWER) | (kind == _UPPER), _mix(value * _ODD), np.uint64(0))
        begin = np.zeros(len(codes), np.int64)
        begin[starts] = np.diff(starts, prepend=0)
        place = (np.arange(len(codes)) - np.cumsum(begin)).astype(np.uint64)
        value = value * (np.uint64(2) * place + np.uint64(1))
        return starts, ends, _mix(np.add.reduceat(value, starts))

    def lines(self, texts):
        """Of all lines with a word: (text, number in the text, characters in words, signs)."""
        texts = [text or "" for text in texts]
        counts = np.array([text.count("\n") + 1 for text in texts], np.int64)
        codes = self._codes("\n".join(texts) + "\n")
        kind = self.kind[codes[0]]
        line_of = np.cumsum(kind == _END) - (kind == _END)
        n_lines = int(counts.sum())
        chars = np.bincount(line_of * _KINDS + kind, minlength=n_lines * _KINDS).reshape(-1, _KINDS)
        starts, ends, hashes = self._words(codes)
        word_line = line_of[starts]
        words = np.bincount(word_line, minlength=n_lines)
        kept = np.flatnonzero(words)
        text_of = np.repeat(np.arange(len(texts)), counts)
        number = np.arange(n_lines) - np.repeat(np.cumsum(counts) - counts, counts)
        if not len(kept):
            return text_of[kept], number[kept], words[kept], np.zeros((0, self.size), np.uint8)

        def per_line(flags):
            return np.bincount(word_line[flags], minlength=n_lines)

        signed = np.add.reduceat((kind == _SIGN).astype(np.int64), starts) > 0
        same = np.zeros(len(starts), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (word_line[1:] == word_line[:-1])
        own = _mix(hashes ^ (word_line.astype(np.uint64) * _ODD))
        again = np.ones(len(starts), bool)
        again[np.unique(own, return_index=True)[1]] = False
        stop = self.stop_words[np.minimum(np.searchsorted(self.stop_words, hashes), len(self.stop_words) - 1)] == hashes

        first = np.searchsorted(word_line, kept)
        place = np.arange(len(starts)) - np.repeat(first, words[kept])
        whole = np.add.reduceat(_mix(hashes + place.astype(np.uint64) * _ODD), first)
        whole = _mix(whole ^ (text_of[kept].astype(np.uint64) * _ODD))
        _, which, copies = np.unique(whole, return_inverse=True, return_counts=True)

        chars, words = chars[kept].astype(float), words[kept].astype(float)
        letters = chars[:, _LOWER] + chars[:, _UPPER]
        solid = chars.sum(1) - chars[:, _BLANK] - chars[:, _END]
        last = np.append(first[1:], len(starts)) - 1
        ratios = [
            chars[:, _UPPER] / np.maximum(1, letters),
            chars[:, _DIGIT] / solid,
            chars[:, _SIGN] / solid,
            chars[:, _MARK] / solid,
            chars[:, _BAR] / words,
            chars[:, _SHOUT] / words,
            chars[:, _STOP] / words,
            per_line(signed)[kept] / words,
            per_line(again)[kept] / words,
            per_line(same)[kept] / words,
            per_line(stop)[kept] / words,
        ]
        signs = [ratio > bound for ratio in ratios for bound in _SHARES]
        signs += [words > bound for bound in _WORD_COUNTS]
        signs += [solid / words > bound for bound in _WORD_LENGTHS]
        signs += [
            copies[which] > 1,
            np.isin(kind[ends[last] - 1], (_STOP, _SHOUT)),
            kind[starts[first]] == _UPPER,
        ]
        return text_of[kept], number[kept], solid.astype(np.int64), np.stack(signs, 1).astype(np.uint8)

    size = 11 * len(_SHARES) + len(_WORD_COUNTS) + len(_WORD_LENGTHS) + 3


@dataclass(frozen=True)
class Field:
    """Weights of a line's own signs and of its neighbours', a constant, and costs of changes."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    edges: np.ndarray  # a constant, no line before, no line after
    change: np.ndarray  # 2 x 2: from bad or good to bad or good

    SIZE = 3 * Describer.size + 3 + 4

    @classmethod
    def of(cls, weights):
        k = Describer.size
        return cls(weights[:k], weights[k : 2 * k], weights[2 * k : 3 * k], weights[3 * k : -4], weights[-4:].reshape(2, 2))


class Chains:
    """Sequences of lines, longest first, for steps that treat all sequences at once."""

    def __init__(self, signs, lengths):
        """`signs` of all lines, sequence after sequence, of which each has a line or more."""
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.signs = signs
        self.first = (np.cumsum(lengths) - lengths)[self.order]
        self.last = self.first + self.lengths - 1
        # Lines by step: the first of all sequences, then the second of those that have one, ...
        numbers = -np.arange(1, self.lengths.max() + 1)
        self.active = np.searchsorted(-self.lengths, numbers, side="right")
        self.steps = [self.first[:n] + t for t, n in enumerate(self.active.tolist())]

    def _blocks(self):
        for at in range(0, len(self.signs), _BLOCK):
            yield slice(at, at + _BLOCK), self.signs[at : at + _BLOCK].astype(float)

    def potentials(self, field):
        """What speaks for good rather than bad, line by line."""
        weights = np.stack([field.own, field.before, field.after], 1)
        parts = np.empty((len(self.signs), 3))
        for at, signs in self._blocks():
            parts[at] = signs @ weights
        parts[1:, 1], parts[:-1, 2] = parts[:-1, 1].copy(), parts[1:, 2].copy()
        parts[self.first, 1] = field.edges[1]
        parts[self.last, 2] = field.edges[2]
        return parts.sum(1) + field.edges[0]

    def sums(self, field):
        """Logarithms of the forward and backward sums of each line, and the total of each sequence."""
        u, change = self.potentials(field), field.change
        forward, backward = np.zeros((len(u), 2)), np.zeros((len(u), 2))
        forward[self.first, 1] = u[self.first]
        for t in range(1, len(self.steps)):
            at = self.steps[t]
            came = forward[at - 1]
            for y in (0, 1):
                forward[at, y] = np.logaddexp(came[:, 0] + change[0, y], came[:, 1] + change[1, y])
            forward[at, 1] += u[at]
        for t in range(len(self.steps) - 1, 0, -1):
            at = self.steps[t]
            bad, good = backward[at, 0], backward[at, 1] + u[at]
            for y in (0, 1):
                backward[at - 1, y] = np.logaddexp(change[y, 0] + bad, change[y, 1] + good)
        total = np.logaddexp(forward[self.last, 0], forward[self.last, 1])
        return u, forward, backward, total

    def good(self, field):
        """The chance of each line to be good."""
        _, forward, backward, _ = self.sums(field)
        both = forward + backward
        return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))

    def gradient(self, field, labels):
        """Log likelihood of sequences whose lines all have the sequence's label, and its gradient."""
        u, forward, backward, total = self.sums(field)
        labels = labels[self.order].astype(float)
        per_line, totals = np.empty(len(u)), np.empty(len(u))
        for at, n in zip(self.steps, self.active.tolist(), strict=True):
            per_line[at], totals[at] = labels[:n], total[:n]
        good = np.exp(np.minimum(0, forward[:, 1] + backward[:, 1] - totals))
        rest = per_line - good
        inner = np.ones(len(u), bool)
        inner[self.first] = False
        at = np.flatnonzero(inner)
        change = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                sure = (per_line[at] == a) & (per_line[at] == b)
                chance = forward[at - 1, a] + field.change[a, b] + b * u[at] + backward[at, b] - totals[at]
                change[a, b] = sure.sum() - np.exp(np.minimum(0, chance)).sum()
        # What each line's signs weigh as its own, and as those of the line before and after another.
        shares = np.zeros((len(u), 3))
        shares[:, 0], shares[at - 1, 1], shares[at, 2] = rest, rest[at], rest[at - 1]
        own = sum(signs.T @ shares[part] for part, signs in self._blocks())
        edges = [rest.sum(), rest[self.first].sum(), rest[self.last].sum()]
        inside = sum(field.change[a, a] * ((per_line[at] == a).sum()) for a in (0, 1))
        value = (u * per_line).sum() + inside - total.sum()
        return value, np.concatenate([own.T.ravel(), edges, change.ravel()])


def _sign_rows(docs, labels, id, text, label, rest_of, max_labels):
    """Signs of the lines of labelled rows: (good, n_lines, signs), rows without words left out."""
    chosen = (
        labels.select(F.col(id).cast("bigint").alias("id"), F.col(label).alias("good"))
        .filter(F.col("id").isNotNull() & F.col("good").isin(0, 1) & (_rest("id", rest_of) != 0))
        .groupBy("id")
        .agg(F.max("good").cast("int").alias("good"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_labels)
    )
    # At most `max_labels` rows of two numbers: a bound that is known.
    held = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    rows = held.join(F.broadcast(chosen), "id").select("good", "text")

    def described(batches):
        describer = Describer()
        for batch in batches:
            good = batch.column(0).to_pylist()
            at = 0
            for run in slices(batch.column(1), _SLICE_CHARS):
                text_of, _, _, signs = describer.lines(run)
                bounds = np.searchsorted(text_of, np.arange(len(run) + 1)).tolist()
                full = [k for k in range(len(run)) if bounds[k + 1] > bounds[k]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([good[at + k] for k in full], pa.int32()),
                        pa.array([bounds[k + 1] - bounds[k] for k in full], pa.int32()),
                        pa.array([signs[bounds[k] : bounds[k + 1]].tobytes() for k in full], pa.binary()),
                    ],
                    ["good", "n_lines", "signs"],
                )
                at += len(run)

    return rows.mapInArrow(described, "good int, n_lines int, signs binary")


def _summed_loss(rows, weights):
    """Loss and gradient over all rows; one short list of sums a task reaches the driver."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def summed(batches):
        total = np.zeros(1 + Field.SIZE)
        field = Field.of(shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            signs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8)
            signs = signs.reshape(-1, Describer.size)
            chains = Chains(signs, batch.column(1).to_numpy().astype(np.int64))
            value, gradient = chains.gradient(field, batch.column(0).to_numpy())
            total -= np.concatenate([[value], gradient])
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    found = rows.mapInArrow(summed, "sums array<double>").collect()
    shared.destroy()
    total = np.sum([row.sums for row in found], axis=0) if found else np.zeros(1 + Field.SIZE)
    return total[0] + _RIDGE * (weights @ weights) / 2, total[1:] + _RIDGE * weights


def descend(function, weights, rounds=_ROUNDS, memory=8, close=1e-5):
    """Minimum of a convex function by limited-memory quasi-Newton steps."""
    value, gradient = function(weights)
    past = []
    for _ in range(rounds):
        direction, used = -gradient, []
        for s, y in reversed(past):
            share = (s @ direction) / (s @ y)
            direction = direction - share * y
            used.append(share)
        if past:
            s, y = past[-1]
            direction = direction * ((s @ y) / (y @ y))
        else:
            direction = direction / max(1.0, np.linalg.norm(gradient))
        for (s, y), share in zip(past, reversed(used), strict=True):
            direction = direction + s * (share - (y @ direction) / (s @ y))
        rate, slope = 1.0, direction @ gradient
        while True:
            new_value, new_gradient = function(weights + rate * direction)
            if new_value <= value + 1e-4 * rate * slope or rate < 1e-6:
                break
            rate /= 2
        if new_value > value:
            break
        s, y, gain = rate * direction, new_gradient - gradient, value - new_value
        weights, value, gradient = weights + s, new_value, new_gradient
        if s @ y > 1e-12:
            past = [*past, (s, y)][-memory:]
        if gain < close * max(1.0, abs(value)):
            break
    return weights


def train(docs, labels, id="doc_id", text="text", label="quality", rest_of=5, max_labels=MAX_LABELS):
    """The field, from labelled rows of `docs` that are not held out (see `held_out`).

    At most `max_labels` labels are learned from; null ids and labels other than 0 and 1 are left
    out, and of several labels of an id the larger holds. Every line is taken to have its text's label.
    All rows of `docs` with such an id are read, whole; texts without words teach nothing. Their
    signs, some 70 bytes a line, are stored, and the driver gets sums only. Without rows to learn
    from every line has a chance of a half.
    """
    rows = stored(_sign_rows(docs, labels, id, text, label, rest_of, max_labels), "line-signs")
    return Field.of(descend(lambda weights: _summed_loss(rows, weights), np.zeros(Field.SIZE)))


_KEPT = []


def _describer():
    if not _KEPT:
        _KEPT.append(Describer())
    return _KEPT[0]


def _judge_udf(shared, with_lines):
    kind = "struct<score: double, lines: array<struct<line: bigint, length: bigint, good: double>>>"

    @F.arrow_udf(kind if with_lines else "struct<score: double>")
    def judged(texts: pa.Array) -> pa.Array:
        scores, ends, columns = [], [0], []
        for run in slices(texts, _SLICE_CHARS):
            text_of, number, length, signs = _describer().lines(run)
            score = np.zeros(len(run))
            counts = np.bincount(text_of, minlength=len(run))
            if len(text_of):
                good = Chains(signs, counts[counts > 0]).good(shared.value)
                size = np.bincount(text_of, length, len(run))
                score = np.bincount(text_of, length * good, len(run)) / np.maximum(1, size)
                columns.append((number, length, good))
            scores.append(np.clip(score, 0, 1))
            ends.extend((ends[-1] + np.cumsum(counts)).tolist())
        scores = pa.array(np.concatenate(scores) if scores else [], pa.float64())
        if not with_lines:
            return pa.StructArray.from_arrays([scores], ["score"])
        columns = zip(*columns, strict=True) if columns else ([[]], [[]], [[]])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        arrays = [pa.array(np.concatenate(own), k) for own, k in zip(columns, kinds, strict=True)]
        lines = pa.StructArray.from_arrays(arrays, ["line", "length", "good"])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines)
        return pa.StructArray.from_arrays([scores, lists], ["score", "lines"])

    return judged


def _judged(docs, field, text, threshold, with_lines):
    shared = docs.sparkSession.sparkContext.broadcast(field)
    held = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    found = held.select("row", _judge_udf(shared, with_lines)(F.col("text")).alias("found"))
    new = [F.col("found.score"), (F.col("found.score") >= threshold).cast("int").alias("predicted")]
    new += [F.col("found.lines")] if with_lines else []
    names = {"score", "predicted", *(["lines"] if with_lines else [])}
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in names], *new)


def score(docs, field, text="text", threshold=THRESHOLD):
    """`docs` with `score` (0 to 1, higher: likelier good) and `predicted` (1 from `threshold`).

    The score is the mean chance of the lines to be good, weighted by their characters in words.
    Only the text is read, whole and one slice at a time. A text without words, null or empty, scores
    0. Every row is kept, equal ones score alike, and no row moves; columns with the two names are replaced.
    """
    return _judged(docs, field, text, threshold, False)


def label_lines(docs, field, text="text", threshold=THRESHOLD):
    """As `score`, with `lines` too: number from 0, characters in words, and chance to be good.

    Lines end at a line feed; those without a word are left out.
    """
    return _judged(docs, field, text, threshold, True)


def _rest(id, rest_of):
    return F.crc32(F.col(id).cast("string").cast("binary")) % rest_of


def held_out(id="doc_id", rest_of=5):
    """Whether a row is never learned from: crc32 of its id as text is divisible by `rest_of`."""
    return F.coalesce(_rest(id, rest_of) == 0, F.lit(False))
