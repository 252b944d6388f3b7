"""BPE and token counts against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import bpe, token_count
from shelfmark.llm.queries import QUERIES
from shelfmark.llm.vocabulary import Vocabulary, read_model

DATA = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None,
    "",
    " ",
    "<|endoftext|>",
    "a<|endoftext|><|endoftext|> b",
    "'re 're's 'l 'll 'r",
    "x'r",
    "  \n's\n 't  a'vx 'v",
    "\x85\x1c a\x1fb \u00a0\u3000c",
    "a" * 5000,
    " " * 3000 + "x",
    "日本語 テスト 😀😀 ñandú ß",
    "x" * 100 + "'" * 100,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(read_model(PATH))


def random_texts(n):
    rng = random.Random(5)
    signs = "'srvelltmd  \n\t.!aé1² 中😀'x"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return texts + [
        "".join(chr(rng.choice([rng.randrange(32, 600), rng.randrange(0xE000, 0x1F000)])) for _ in range(20))
        for _ in range(n)
    ]


def test_ids_and_counts_equal_the_library(library, vocabulary):
    texts = [text or "" for text in ODD] + random_texts(1500)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(raw, "<u4").tolist() for raw in bpe.Encoder(vocabulary).encode(texts)]
    assert got == want
    assert token_count.Counter(vocabulary).count(texts).tolist() == [len(ids) for ids in want]


def test_both_ways_of_merging_agree(vocabulary):
    rng = random.Random(6)
    for _ in range(300):
        word = bytes(rng.choice(b"abcdethinrs \xc3\xa9") for _ in range(rng.randint(1, 60)))
        assert bpe._merge_short(vocabulary, word) == bpe._merge_long(vocabulary, word)


def test_compatibility_is_that_of_merging(vocabulary):
    rng = np.random.default_rng(7)
    a, b = rng.integers(0, 50_000, (2, 4000))
    fits = vocabulary.compatible(a, b)
    for left, right, fit in zip(a.tolist(), b.tolist(), fits.tolist(), strict=True):
        whole = vocabulary.token_bytes[left] + vocabulary.token_bytes[right]
        assert fit == (bpe.merge_exactly(vocabulary, whole) == [left, right])


def test_chunk_maps_compose_to_a_plain_run():
    texts = ["ab'll c" * 200, " ", "'" * 700, "x  \n" * 300]
    starts, bounds = token_count.word_starts(texts)
    for k, text in enumerate(texts):
        alone, _ = token_count.word_starts([text])
        assert (starts[bounds[k] : bounds[k + 1]] == alone).all()


def test_round_trip_keeps_rows_and_columns(spark):
    rows = [(k, text, "x") for k, text in enumerate(ODD)] + [(None, "twice", "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(docs, PATH), PATH, text="back").collect()
    assert len(out) == len(rows)
    assert all(row.back == (row.text or "") for row in out)
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    assert token_count.count_tokens(docs.limit(0), PATH).count() == 0


def test_decode_of_null_and_of_broken_bytes(spark):
    rows = spark.createDataFrame([(None,), ([],), ([222],)], "ids array<int>")
    assert [row.text for row in bpe.decode(rows, PATH).collect()] == [None, "", "\ufffd"]


@pytest.mark.parametrize("name", ["op1_bpe", "op7_token_count"])
def test_queries_over_all_documents(spark, library, name):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = QUERIES[name](spark, DATA).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id]
        ids = library.encode(text, add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        if name == "op1_bpe":
            assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            back = library.decode(ids, skip_special_tokens=False)
            assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
        else:
            assert row.n_bytes == len(text.encode())
            assert row.over_limit == (len(ids) > 512)
