"""Toxicity of texts that hide it: a noisy channel undoes disguise, then restored words are scored.

A disguised word is a lattice: a digit or sign may stand for letters, a repeated letter for one or
two, a separator for nothing, and letters set apart by spaces for one word. Viterbi search finds the
path that the character model of the corpus and the costs of the channel make likeliest. Evidence is
learned for the beginnings of restored words, from labelled rows, and a logistic curve turns the
evidence in a text into a score.
"""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .scratch import stored

#: At most so many labelled rows are learned from, those with the smallest hash of their id.
MAX_LABELS = 20_000
THRESHOLD = 0.7
_PREFIXES = (4, 5, 6, 7)
_LEAST_CONTEXTS = 4  # different neighbours that a beginning must occur with in toxic texts
_KNOWN_WORDS = 400_000

# Letters that signs and digits are used for.
SIGNS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
_SEPARATORS = "-._*~"
_EDGES = " \t\n\r\x0b\x0c.,;:!?\"'#$%&*|<>()[]{}-_~…«»“”„"
_SIGN_COST, _DOUBLE_COST, _SKIP_COST = -1.5, -1.0, -0.5
_SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+(€])(?: (?:[^\W_]|[@$!|+(€])){3,}(?!\S)")
_REPEAT = re.compile(r"([^\W\d_])\1\1")

# The characters of the model: a word border, a-z, the Latin letters with marks, and all others.
_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_PLACE = {c: k + 1 for k, c in enumerate(_LETTERS)}
_OTHER = len(_LETTERS) + 1
_SIZE = _OTHER + 1


def _alphabet():
    table = np.full(0x110000, _OTHER, np.int64)
    for letter, place in _PLACE.items():
        table[ord(letter)] = place
    table[[ord(c) for c in " \t\n\r\x0b\x0c.,;:!?\"'"]] = 0
    return table


_TABLE = []


def count_trigrams(docs, text="text"):
    """(`gram`, `n`) over all texts: how often each three characters of the model follow each other.

    Each batch is counted by itself and only counts are shuffled; there are at most `_SIZE` ** 3.
    """

    def counted(batches):
        if not _TABLE:
            _TABLE.append(_alphabet())
        for batch in batches:
            totals = np.zeros(_SIZE**3, np.int64)
            for own in batch.column(0).to_pylist():
                if own:
                    raw = f"  {own.lower()} ".encode("utf-32-le", "surrogatepass")
                    k = _TABLE[0][np.frombuffer(raw, "<u4")]
                    grams = (k[:-2] * _SIZE + k[1:-1]) * _SIZE + k[2:]
                    found, n = np.unique(grams, return_counts=True)
                    totals[found] += n
            gram = np.flatnonzero(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram, pa.int64()), pa.array(totals[gram], pa.int64())], ["gram", "n"]
            )

    grams = docs.select(F.col(text).alias("text")).mapInArrow(counted, "gram bigint, n bigint")
    return grams.groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(counts):
    """Log probabilities of a character after two others. The counts are a table of fixed size."""
    rows = counts.toPandas()
    table = np.zeros(_SIZE**3)
    table[rows["gram"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    table = table.reshape(_SIZE, _SIZE, _SIZE)
    pairs = table.sum(2, keepdims=True)
    single = table.sum((0, 1)) + 1.0
    return np.log((table + 5 * single / single.sum()) / (pairs + 5)).astype(np.float32)


class Restorer:
    """Restores words; those without disguise are returned as they are."""

    def __init__(self, model):
        self.model = model

    @staticmethod
    def disguised(word):
        if word.isalpha():
            return bool(_REPEAT.search(word))
        letters = sum(map(str.isalpha, word))
        if not letters:
            return False
        return any(c in SIGNS or c in _SEPARATORS for c in word) or bool(_REPEAT.search(word))

    def _options(self, c, run):
        """(letters, cost) that a run of one character may stand for."""
        letters = [(c, 0.0)] if c.isalpha() or c not in SIGNS else []
        letters += [(a, _SIGN_COST) for a in SIGNS.get(c, "")]
        own = [(a, cost * min(run, 2)) for a, cost in letters]
        if run > 1:
            own += [(a + a, cost * 2 + (_DOUBLE_COST if run > 2 else 0)) for a, cost in letters]
            if run == 2:
                own = [(a, cost + _DOUBLE_COST) if len(a) == 1 else (a, cost) for a, cost in own]
        if c in _SEPARATORS:
            own.append(("", _SKIP_COST))
        return own

    def restore(self, word):
        """The likeliest word behind `word`, in time linear in its length."""
        paths = {(0, 0): (0.0, None)}
        model, at = self.model, 0
        while at < len(word):
            c, run = word[at], 1
            while at + run < len(word) and word[at + run] == c:
                run += 1
            at += run
            new = {}
            options = self._options(c, run)
            for (a, b), path in paths.items():
                for letters, cost in options:
                    score, p, q = path[0] + cost, a, b
                    for letter in letters:
                        k = _PLACE.get(letter, _OTHER)
                        score += float(model[p, q, k])
                        p, q = q, k
                    if (p, q) not in new or new[p, q][0] < score:
                        new[p, q] = (score, (letters, path))
            paths = new
        score, path = max(
            ((s + float(model[p, q, 0]), (s, back)) for (p, q), (s, back) in paths.items()),
            key=lambda x: x[0],
        )
        out = []
        while path[1] is not None:
            out.append(path[1][0])
            path = path[1][1]
        return "".join(reversed(out))


def beginnings(word):
    """What evidence is kept for: the whole word, and its beginnings."""
    return [word + "$", *(word[:k] for k in _PREFIXES if len(word) >= k)]


def plain_words(text):
    """Words in lower case, and the joined letters of words set apart by spaces."""
    text = (text or "").lower()
    words = text.split()
    spaced = [m.group().replace(" ", "") for m in _SPACED.finditer(text)]
    return words, spaced


class Reader:
    """Restores words and looks up their evidence; keeps common ones of a bounded number."""

    def __init__(self, model, evidence=None):
        self.restorer = Restorer(model)
        self.evidence = evidence or {}
        self.known = {}

    def restored(self, word):
        bare = word.strip(_EDGES)
        if not bare:
            return ""
        return self.restorer.restore(bare) if self.restorer.disguised(bare) else bare

    def weight(self, word):
        get = self.evidence.get
        forms = [self.restored(word)]
        if self.restorer.disguised(word):  # signs at the edges may be letters too
            forms.append(self.restorer.restore(word))
        return max((get(f, 0.0) for form in forms for f in beginnings(form)), default=0.0)

    def measures(self, text):
        """Strongest evidence, evidence of the second word, and how many words have any."""
        words, spaced = plain_words(text)
        own = set(words)
        own.update(spaced)
        known = self.known
        missing = own.difference(known)
        if missing:
            if len(known) + len(missing) > _KNOWN_WORDS:
                known.clear()
                missing = own
            for word in missing:
                known[word] = self.weight(word)
        found = [w for w in map(known.__getitem__, own) if w > 0]
        found.sort(reverse=True)
        return (*([*found[:2], 0.0, 0.0][:2]), len(found), len(own))


def _learning_rows(docs, labels, id, text, label, max_labels):
    """Labelled rows to learn from: (id, text, toxic, fold)."""
    rest = F.crc32(F.col("id").cast("string").cast("binary")) % 3
    chosen = (
        labels.select(F.col(id).cast("bigint").alias("id"), F.col(label).alias("toxic"))
        .filter(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & (rest != 1))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_labels)
    )
    # At most `max_labels` rows of two numbers: a bound that is known.
    held = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return held.join(F.broadcast(chosen), "id").withColumn("fold", (rest / 2).cast("int"))


def _occurrences(text, reader):
    """Distinct (word, before, after) of a text, and the beginnings of its restored words."""
    words, spaced = plain_words(text)
    around = ["", *words, ""]
    places = {*zip(words, around, around[2:], strict=False), *((w, "", "") for w in spaced)}
    return places, {w: beginnings(reader.restored(w)) for w in {place[0] for place in places}}


def _toxic_counts(rows, model):
    """(`fold`, `feature`, `toxic`): different contexts of each beginning in toxic texts.

    The context is the words before and after, so that copies of a text count once.
    """

    def used(batches):
        reader = Reader(model.value)
        for batch in batches:
            for text, fold in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
                places, features = _occurrences(text, reader)
                found = {(f, hash_pair(a, b)) for word, a, b in places for f in features[word]}
                columns = [
                    pa.array([fold] * len(found), pa.int32()),
                    pa.array([f for f, _ in found], pa.string()),
                    pa.array([c for _, c in found], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["fold", "feature", "context"])

    rows = rows.filter("toxic = 1").select("text", "fold")
    places = rows.mapInArrow(used, "fold int, feature string, context bigint").distinct()
    return places.groupBy("fold", "feature").agg(F.count("*").alias("toxic"))


def _clean_counts(rows, model, wanted):
    """(`fold`, `feature`, `clean`): occurrences of the wanted beginnings in clean texts.

    Batches are summed before anything is shuffled.
    """
    wanted = rows.sparkSession.sparkContext.broadcast(frozenset(wanted))

    def used(batches):
        reader = Reader(model.value)
        for batch in batches:
            counts = Counter()
            for text, fold in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
                places, features = _occurrences(text, reader)
                features = {w: [f for f in own if f in wanted.value] for w, own in features.items()}
                counts.update((fold, f) for word, _, _ in places for f in features[word])
            columns = [
                pa.array([fold for fold, _ in counts], pa.int32()),
                pa.array([f for _, f in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["fold", "feature", "n"])

    rows = rows.filter("toxic = 0").select("text", "fold")
    counts = rows.mapInArrow(used, "fold int, feature string, n bigint")
    return counts.groupBy("fold", "feature").agg(F.sum("n").alias("clean"))


def hash_pair(a, b):
    """A hash that is equal in every worker."""
    return xxhash.xxh3_64_intdigest(f"{a}\0{b}") - (1 << 63)


def _weights(counts):
    """Log odds of the beginnings that occur in enough contexts of toxic texts."""
    kept = counts[(counts["toxic"] >= _LEAST_CONTEXTS)]
    odds = (kept["toxic"] + 0.5) / (kept["clean"] + 0.5) * kept["ratio"]
    weight = np.log(odds)
    return {f: float(w) for f, w in zip(kept["feature"], weight, strict=True) if w > 1.5}


def _design(measures):
    first, second, some, _ = (np.asarray(x, float) for x in zip(*measures, strict=True))
    return np.stack([np.ones_like(first), first, second, np.log1p(some)], 1)


def _fit_curve(x, y, rounds=50, ridge=1e-2):
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs, labels, id="doc_id", text="text", label="toxic", max_labels=MAX_LABELS):
    """The character model of all of `docs`, the evidence, and the curve, from labelled rows.

    Rows whose crc32 of the id as text leaves 1 when divided by 3 are held out; of the others at
    most `max_labels` are learned from. Evidence of one half is measured on the other half to fit
    the curve. What the driver holds is the character model, of fixed size, and evidence and three
    numbers for each of the rows learned from, which the bound limits.
    """
    spark = docs.sparkSession
    model = language_model(count_trigrams(docs, text))
    shared = spark.sparkContext.broadcast(model)
    rows = stored(_learning_rows(docs, labels, id, text, label, max_labels), "toxic-rows")
    toxic = _toxic_counts(rows, shared)
    often = toxic.groupBy("feature").agg(F.sum("toxic").alias("all"))
    often = often.filter(F.col("all") >= _LEAST_CONTEXTS).select("feature")
    toxic = toxic.join(often, "feature", "left_semi").toPandas()
    clean = _clean_counts(rows, shared, set(toxic["feature"])).toPandas()
    counts = toxic.merge(clean, how="left", on=["fold", "feature"]).fillna({"clean": 0})
    learned = dict(rows.groupBy("toxic").count().toPandas().itertuples(index=False))

    def evidence(folds):
        own = counts[counts["fold"].isin(folds)].groupby("feature", as_index=False)
        table = own[["toxic", "clean"]].sum()
        table["ratio"] = max(1, learned.get(0, 0)) / max(1, learned.get(1, 0))
        return _weights(table)

    halves = {0: evidence([1]), 1: evidence([0])}
    whole = evidence([0, 1])
    measured = _measure(rows.select("text", "fold", "toxic"), shared, halves).toPandas()
    if measured.empty or measured["toxic"].nunique() < 2:
        return model, whole, np.array([-4.0, 1.0, 0.5, 0.5])
    x = _design(list(measured[["a", "b", "c", "d"]].itertuples(index=False, name=None)))
    return model, whole, _fit_curve(x, measured["toxic"].to_numpy(float))


def _measure(rows, model, halves):
    """Measures of learned rows, each by the evidence of the other half."""
    halves = rows.sparkSession.sparkContext.broadcast(halves)

    def measured(batches):
        readers = {fold: Reader(model.value, own) for fold, own in halves.value.items()}
        for batch in batches:
            texts, folds, toxic = (batch.column(k).to_pylist() for k in range(3))
            found = [readers[fold].measures(text) for text, fold in zip(texts, folds, strict=True)]
            columns = [pa.array(np.array(x, float)) for x in zip(*found, strict=True)] or [
                pa.array([], pa.float64()) for _ in "abcd"
            ]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(toxic, pa.int32())], [*"abcd", "toxic"])

    kind = "a double, b double, c double, d double, toxic int"
    return rows.select("text", "fold", F.col("toxic").cast("int")).mapInArrow(measured, kind)


_READERS = {}


def score(docs, trained, text="text", threshold=THRESHOLD):
    """`docs` with `score` (0 to 1, higher: likelier toxic) and `predicted` (1 from `threshold`).

    Only the text is read. A null or empty text has no evidence and the lowest score. Every row is
    kept; columns with the two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        model, evidence, curve = shared.value
        if id(model) not in _READERS:
            _READERS.clear()
            _READERS[id(model)] = Reader(model, evidence)
        reader = _READERS[id(model)]
        if not len(texts):
            return pa.array([], pa.float64())
        x = _design([reader.measures(value.as_py()) for value in texts])
        return pa.array(1 / (1 + np.exp(-np.clip(x @ curve, -30, 30))))

    docs = docs.withColumn("score", scored(F.col(text)))
    return docs.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(id="doc_id"):
    """Whether a row is never learned from."""
    rest = F.crc32(F.col(id).cast("string").cast("binary")) % 3
    return F.coalesce(rest == 1, F.lit(False))
