"""Near duplicates and benchmark passages against comparisons of all pairs."""

import random

import numpy as np
from brute import groups, items_in

from shelfmark.llm import near_dup
from shelfmark.llm.decontaminate import keep_clean, mark
from shelfmark.llm.graph import components
from shelfmark.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def edited(rng, words, share):
    return [rng.choice("abcdefgh") + w if rng.random() < share else w for w in words]


def test_groups_of_near_copies(spark):
    rng = random.Random(1)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(120)]
        texts += [" ".join(edited(rng, base, 0.04)) for _ in range(25)]
    texts += texts[:9] + [t.upper() for t in texts[:3]] + ["one two", "one two", "one two three"]
    texts += ["", None, " \n", "a a a a a a a", "a a a a a"]
    rows = [(k, t, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    want = groups([(k, t) for k, t, _ in rows], 4)
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs).collect()}
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want
    assert all(r.kept == (k == r.component_id) for k, r in got.items())


def test_rows_without_an_id_or_repeated(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (None, None), (7, "")]
    rows += [(None, "only here and now it is")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.near_duplicates(docs).collect()
    assert sorted(str((r.doc_id, r.component_id, r.kept)) for r in got) == sorted(
        map(str, [(None, 5, False), (5, 5, True), (5, 5, True), (None, None, True), (7, 7, True), (None, None, True)])
    )
    assert near_dup.keep_one(docs).count() == 4
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_query_equals_comparing_all_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    want = groups([(r.doc_id, r.text) for r in docs], 4)
    got = QUERIES["op3_near_duplicates"](spark, DATA).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 60, 5000):
        own = rng.integers(0, 2**63, size, np.uint64)
        assert near_dup.fast_sketch(own).max() < 2**64 - 1
    own = rng.integers(0, 2**63, 900, np.uint64)
    same = [
        (near_dup.fast_sketch(own[: 900 - d]) == near_dup.fast_sketch(own[d:])).mean()
        for d in range(95, 105)
    ]
    assert abs(np.mean(same) - 0.8) < 0.05


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog, and then it sleeps for a while in the sun."),
    (2, "Quatre élèves ÉTAIENT là, puis cinq autres sont venus avec eux à midi pile hier."),
    (3, "too short"),
    (4, "a a a a a a b a a a a a"),
    (None, "no id but many words are here to be found by nobody"),
    (5, None),
    (6, "..."),
]


def test_passages_in_texts(spark):
    filler = " ".join(f"f{k}" for k in range(60))
    one = ITEMS[0][1]
    texts = [
        f"{filler} {one} {filler}",
        f"{filler}\n{one.upper()}!! {filler}",
        f"{filler} {' '.join(one.split()[2:])} {filler}",
        f"{filler} {' '.join(one.split()[:9])} {filler}",
        f"{ITEMS[1][1]} {one} {ITEMS[1][1]}",
        "this is too short",
        "a a a a a a b a a a a a",
        one,
        " ".join(one.split()[:-1]),
        None,
        "",
        filler,
        ITEMS[4][1],
    ]
    rows = [(k, t, 1) for k, t in enumerate(texts)] + [(0, texts[0], 1), (None, one, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = mark(docs, items).collect()
    assert len(got) == len(rows)
    named = [x for x in ITEMS if x[0] is not None]
    for row in got:
        assert row.item_ids == items_in(row.text, named), row.text
    clean = keep_clean(docs, items).collect()
    assert {r.doc_id for r in clean} == {r.doc_id for r in got if not r.item_ids}
    assert mark(docs.limit(0), items).count() == 0
    assert mark(docs, items.limit(0)).filter("contaminated").count() == 0


def test_decontamination_query_equals_trying_every_place(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = {r.doc_id: r.item_ids for r in QUERIES["op9_decontamination"](spark, DATA).collect()}
    assert got == {r.doc_id: items_in(r.text, items) for r in docs}
    assert any(got.values())


def test_passages_in_another_order(spark):
    item = [f"w{k}" for k in range(50)]
    filler = [f"f{k}" for k in range(70)]
    cuts = [item[k:] + item[:k] for k in (25, 10, 40)] + [item[34:] + item[17:34] + item[:17]]
    texts = [" ".join(filler + cut + filler) for cut in cuts]
    texts += [" ".join(cut) for cut in cuts] + [" ".join(filler[:9] + cut[:-3]) for cut in cuts]
    texts += [" ".join(item[:46]), " ".join(cuts[0][2:]), " ".join([*item[:25], "x", *item[25:]] * 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = [(1, " ".join(item)), (2, " ".join(item[:30])), (3, " ".join(item[20:] + item[:20]))]
    got = mark(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    for row in got:
        assert row.item_ids == items_in(row.text, items), row.text
    assert 1 in got[0].item_ids
