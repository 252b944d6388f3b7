"""Periodic runs, importance resampling and quality by lines."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from brute import WORD, lower, sha
from oracle import connect, differences
from pyspark.sql import functions as F

from shelfmark.llm import line_quality, periodic, resample
from shelfmark.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"


def rows_of(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet").collect()


# --- Periodic runs ----------------------------------------------------------------------------


def plain_runs(words, least_length=6, exponent=4):
    """Runs by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end > start and end + q - start >= max(least_length, exponent * q):
                found.setdefault((start, end + q - start), q)
            start = max(end, start + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def plain_collapse(words, runs):
    drop = {k for start, length, q in runs for k in range(start + q, start + length)}
    return [w for k, w in enumerate(words) if k not in drop]


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_every_difference_is_covered():
    for a, b in itertools.product(range(periodic.CYCLE), repeat=2):
        shift = periodic.shifts()[a, b]
        assert {(a + shift) % periodic.CYCLE, (b + shift) % periodic.CYCLE} <= set(periodic.COVER)
        assert 0 <= shift < periodic.CYCLE


def test_common_extensions():
    rng = random.Random(3)
    for letters, n in ((1, 300), (2, 400), (3, 100)):
        words = [rng.randrange(letters) for _ in range(n)]
        words[n // 2 :] = words[: n - n // 2]
        codes = np.array([-1, *words, -2])
        a, b = (np.array([rng.randrange(1, n + 1) for _ in range(2000)]) for _ in range(2))
        a, b = a[a != b], b[a != b]
        got = periodic.Extensions(codes).common(a, b)
        for left, right, length in zip(a, b, got, strict=True):
            want = 0
            while codes[left + want] == codes[right + want]:
                want += 1
            assert length == want


def test_runs_equal_those_of_all_places():
    rng = random.Random(1)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 8)):
            n, letters = rng.choice([0, 1, 5, 6, 7, 40, 300]), rng.choice([1, 2, 3, 60])
            words = [rng.randrange(letters) for _ in range(n)]
            texts.append(planted(words, rng.randrange(100)))
        for exponent in (2, 4):
            got = periodic.runs_of(texts, 6, exponent)
            for words, runs in zip(texts, got, strict=True):
                want = plain_runs(words, 6, exponent)
                assert [tuple(run) for run in runs.tolist()] == want
                assert periodic.collapse(words, runs) == plain_collapse(words, want)


def test_runs_of_odd_rows(spark):
    texts = [None, "", " \n ", "a", "x " * 6, "A a " * 4 + "b", "é ü " * 5, "a b c " * 40_000]
    rows = [(k, t, "n", "r", "f", 1) for k, t in enumerate(texts)] + [(4, texts[4], "n", "r", "f", 1)]
    docs = spark.createDataFrame(
        [*rows, (None, "y y y y y y", "n", "r", "f", 1)],
        "doc_id long, text string, row string, found string, `runs` string, n_words int",
    )
    got = periodic.find_runs(docs).collect()
    assert got[0].__fields__ == ["doc_id", "text", "row", "found", "n_words", "runs", "collapsed"]
    assert len(got) == 10 and {r.row for r in got} == {"n"} and {r.found for r in got} == {"r"}
    found = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got}
    assert found[0] == found[1] == found[2] == (0, [], "") and found[3] == (1, [], "a")
    assert found[4] == (6, [(0, 6, 1)], "x") and found[None] == (6, [(0, 6, 1)], "y")
    assert found[5] == (9, [(0, 8, 2)], "A a b") and found[6] == (5, [], "é ü é ü é ü é ü é ü")
    assert found[7] == (120_000, [(0, 120_000, 3)], "a b c")
    assert periodic.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(docs, exponent=1)


def test_query_of_runs(spark):
    texts = {r.doc_id: r.text for r in rows_of(spark, "documents")}
    got = QUERIES["op13_periodic_runs"](spark, DATA).collect()
    assert len(got) == len(texts)
    for row in got:
        words = planted(WORD.findall(texts[row.doc_id] or ""), row.doc_id)
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == milli
        assert row.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert row.collapsed_sha256 == sha(" ".join(plain_collapse(words, runs)))
    assert sum(row.n_runs > 0 for row in got) > 5


# --- Resampling -------------------------------------------------------------------------------


def plain_features(text, longest):
    words = "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in lower(text))
    words = [w for w in words.split(" ") if w]
    return words, [
        " ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)
    ]


def plain_resample(docs, target, longest=1, percent=10, least=20, buckets=10_000):
    """{place of the row: (n_features, weight, score, rank)}"""

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    own = [plain_features(text, longest) for _, text in docs]
    s = Counter(bucket(f) for _, features in own for f in features)
    t = Counter(bucket(f) for text in target for f in plain_features(text, longest)[1])
    all_s, all_t = s.total() + buckets, t.total() + buckets
    out = {}
    for k, ((doc_id, _), (words, features)) in enumerate(zip(docs, own, strict=True)):
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
            for b in map(bucket, features)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[k] = [len(words), len(features), weight, score, None]
    fit = [k for k in out if out[k][0] >= least]
    fit.sort(key=lambda k: (-out[k][3], docs[k][0] is not None, docs[k][0] or 0))
    for rank, k in enumerate(fit[: len(fit) * percent // 100], 1):
        out[k][4] = rank
    return out


def test_query_of_resampling(spark):
    docs = [(r.doc_id, r.text) for r in rows_of(spark, "documents")]
    target = [r.text for r in rows_of(spark, "benchmark")]
    want = sorted((docs[k][0], *own[1:]) for k, own in plain_resample(docs, target).items())
    got = QUERIES["op11_resampling"](spark, DATA)
    assert sorted(map(tuple, got.collect())) == want and len(want) == len(docs)
    rank = F.coalesce("rank", F.lit(-1))
    sql = f"SELECT * REPLACE (coalesce(rank, -1) AS rank) FROM ({ORACLE['op11_resampling']})"
    assert differences(got.withColumn("rank", rank), connect(DATA), sql) == []


@pytest.mark.parametrize("head_size", [0, 7, 10_000])
def test_longer_features_with_any_head(spark, head_size):
    docs = [(r.doc_id, r.text[:2000]) for r in rows_of(spark, "documents")[:60]]
    target = [r.text for r in rows_of(spark, "benchmark")]
    want = {docs[k][0]: tuple(own[1:4]) for k, own in plain_resample(docs, target, 3).items()}
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "passage string")
    got = resample.weigh(frame, aim, target_text="passage", longest=3, head_size=head_size).collect()
    assert {r.doc_id: (r.n_features, r.weight, r.score) for r in got} == want


def test_resampling_of_odd_rows(spark):
    long = "word " * 25
    rows = [(None, long), (1, None), (2, ""), (3, "few words"), (4, long), (4, long), (5, "Ünd 1a " * 12)]
    rows += [(k, f"{long} {k}") for k in range(10, 60)]
    kind = "doc_id long, text string, `row` string, noise int, found int, place int, range int"
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], kind)
    target = spark.createDataFrame([("other words",), (None,)], "text string")
    weighed = resample.weigh(docs, target)
    assert weighed.columns == [*docs.columns, "n_words", "n_features", "weight", "score"]
    got = resample.ranked(weighed, percent=50).collect()
    want = plain_resample(rows, ["other words", None], percent=50)
    key = lambda r: tuple((x is not None, x) for x in r)
    plain = sorted(((rows[k][0], *own[:4]) for k, own in want.items()), key=key)
    assert sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got), key=key) == plain
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, sum(own[0] >= 20 for own in want.values()) // 2 + 1))
    assert {r["rank"]: r.doc_id for r in got if r["rank"]} == {
        own[4]: rows[k][0] for k, own in want.items() if own[4]
    }
    drawn = resample.resample(docs, target, percent=50)
    assert drawn.columns == docs.columns
    names = sorted((rows[k] for k, own in want.items() if own[4]), key=key)
    assert sorted(((r.doc_id, r.text) for r in drawn.collect()), key=key) == names
    assert resample.resample(docs, target, percent=0).count() == 0
    assert resample.ranked(resample.weigh(docs.limit(0), target.limit(0))).count() == 0


def test_ranks_of_one_score(spark):
    weighed = spark.range(20_000).selectExpr("id % 3 AS doc_id", "20L AS n_words", "5L AS score", "id AS own")
    got = resample.ranked(weighed, percent=25).filter("rank IS NOT NULL").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 5001)) and {r.doc_id for r in got} == {0}


# --- Lines ------------------------------------------------------------------------------------


def small_field(seed=4):
    rng = np.random.default_rng(seed)
    return rng.normal(0, 0.7, line_quality.Field.SIZE)


def small_chains():
    rng = np.random.default_rng(8)
    lengths = np.array([3, 1, 5, 2, 5])
    signs = rng.integers(0, 2, (int(lengths.sum()), line_quality.Describer.size)).astype(np.uint8)
    return line_quality.Chains(signs, lengths), signs, lengths


def test_chances_are_sums_over_all_labellings():
    chains, signs, lengths = small_chains()
    field = line_quality.Field.of(small_field())
    got = chains.good(field)
    start = 0
    for n in lengths.tolist():
        own = signs[start : start + n].astype(float)
        total, good = 0.0, np.zeros(n)
        for labels in itertools.product((0, 1), repeat=n):
            value = 0.0
            for k, y in enumerate(labels):
                if y:
                    value += own[k] @ field.own + field.edges[0]
                    value += own[k - 1] @ field.before if k else field.edges[1]
                    value += own[k + 1] @ field.after if k + 1 < n else field.edges[2]
                if k:
                    value += field.change[labels[k - 1], y]
            total += math.exp(value)
            good += math.exp(value) * np.array(labels)
        assert np.allclose(got[start : start + n], good / total)
        start += n


def test_gradient_equals_differences():
    chains, _, lengths = small_chains()
    labels = np.array([1, 0, 1, 1, 0])
    weights = small_field()

    def value(w):
        return chains.gradient(line_quality.Field.of(w), labels)[0]

    got = chains.gradient(line_quality.Field.of(weights), labels)[1]
    for k in [*range(0, len(weights), 7), *range(len(weights) - 7, len(weights))]:
        step = np.zeros(len(weights))
        step[k] = 1e-5
        assert abs((value(weights + step) - value(weights - step)) / 2e-5 - got[k]) < 1e-4


def test_signs_do_not_depend_on_the_slice():
    texts = ["One two.\n\nTHREE !! four", None, "", "a|b | c\nsame line\nsame line", "x" * 5000, "\n\n", "é ü 12 $$"]
    describer = line_quality.Describer()
    text_of, number, length, signs = describer.lines(texts)
    at = 0
    for k, text in enumerate(texts):
        _, own_number, own_length, own_signs = describer.lines([text])
        n = len(own_number)
        assert (text_of[at : at + n] == k).all()
        assert (number[at : at + n] == own_number).all() and (length[at : at + n] == own_length).all()
        assert (signs[at : at + n] == own_signs).all()
        at += n
    assert at == len(text_of)
    assert list(zip(text_of.tolist(), number.tolist(), length.tolist(), strict=True))[:3] == [
        (0, 0, 7),
        (0, 2, 11),
        (3, 0, 5),
    ]


def test_quality_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op12_line_quality"](spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    seen = rows.merge(labels, on="doc_id").query("held_out")
    assert len(rows) == 10_000 and rows.score.between(0, 1).all()
    assert ((rows.score >= 0.3) == (rows.predicted == 1)).all()
    assert (seen.predicted == seen.quality)[seen.quality == 1].mean() >= 0.97
    assert (seen.predicted == seen.quality)[seen.quality == 0].mean() >= 0.97


def test_labels_of_lines(spark):
    good = [f"The river of town {k} ran to the sea, and the people were with it for long." for k in range(40)]
    bad = [f"BUY!! NOW$$$ cheap### {k} | {k} | deal%%% WIN!!" for k in range(40)]
    rows = [(k, "\n".join(good[k : k + 4]), 1) for k in range(36)]
    rows += [(100 + k, "\n".join(bad[k : k + 4]), 0) for k in range(36)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    field = line_quality.train(docs, docs.select("doc_id", "quality"))
    mixed = "\n".join([*good[:6], "", *bad[:6]])
    asked = spark.createDataFrame(
        [(1, mixed, "x"), (1, mixed, "x"), (2, None, "x"), (3, "", "x"), (None, good[0], "x")],
        "doc_id long, text string, found string",
    )
    got = line_quality.label_lines(asked, field).collect()
    assert got[0].__fields__ == ["doc_id", "text", "found", "score", "predicted", "lines"] and len(got) == 5
    row = next(r for r in got if r.doc_id == 1)
    assert [line.line for line in row.lines] == [*range(6), *range(7, 13)]
    assert all(line.good > 0.5 for line in row.lines[:5]) and all(line.good < 0.5 for line in row.lines[-5:])
    whole = sum(line.length for line in row.lines)
    assert abs(row.score - sum(line.length * line.good for line in row.lines) / whole) < 1e-9
    assert {(r.score, r.predicted, len(r.lines)) for r in got if r.doc_id in (2, 3)} == {(0.0, 0, 0)}
    assert next(r for r in got if r.doc_id is None).predicted == 1
    assert line_quality.score(asked.limit(0), field).count() == 0


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None), (3, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, None), (9, 1), (3, 5)], "doc_id long, quality int")
    for own in (labels, labels.limit(0)):
        got = {r.doc_id: r.score for r in line_quality.score(docs, line_quality.train(docs, own)).collect()}
        assert got == {1: 0.5, 2: 0.0, 3: 0.5}
    assert line_quality.train(docs.limit(0), labels).own.shape == (line_quality.Describer.size,)
