"""Extra columns with whatever names stay as they are, in every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmark.llm import (
    bpe,
    decontaminate,
    html_text,
    line_quality,
    near_dup,
    periodic,
    quality,
    resample,
    secrets,
    sharding,
    token_count,
    toxicity,
    url_rules,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
# Names that the operators give to columns of their own.
NAMES = (
    "row found held id own page html digest key node root hub block size length start window print at "
    "_key _row _at _n _number _before _total _rows _digest _words _solid _lines _grams _encoded _own _host "
    "_path _best _short _page _low _candidates _found _apart _score group address depth prefix cell fits "
    "hits words text_key window_key n_words noise weight place range hash before rank lines good kept_ one "
    "host path verdict rule score predicted shard bytes oversized findings redacted item_ids n_items"
).split()


@pytest.fixture(scope="module")
def clashing(spark):
    long = "the river of the town ran to the sea and all the people were with it for a long time " * 4
    texts = [None, "", "a b", long, long, long + " token = 'abcdefabcdef0123456789ab'", "x" * 200_000]
    rows = [(k, text, "en", 0) for k, text in enumerate(texts)] + [(None, long, "en", 0), (3, long, "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    docs = docs.withColumn("url", F.lit("http://a.example.com/de/x")).withColumn("toxic", F.col("quality"))
    return docs.withColumns({name: F.lit(f"own {name}") for name in NAMES})


def operators(spark, docs):
    items = spark.createDataFrame([(1, "the sea and all the people were with it")], "item_id long, text string")
    labels = spark.createDataFrame([(3, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    rules = spark.createDataFrame([("example.com/de/", "block")], "rule string, verdict string")
    rule = secrets.train(secrets.example_findings(spark, 600))
    held = docs.select("doc_id", "text")
    return {
        "encode_summary": lambda d: bpe.encode_summary(d, PATH),
        "encode": lambda d: bpe.encode(d, PATH),
        "judge_urls": lambda d: url_rules.judge_urls(d, rules),
        "near_duplicates": lambda d: near_dup.near_duplicates(d),
        "toxicity": lambda d: toxicity.score(d, toxicity.train(held, labels)),
        "assign_shards": lambda d: sharding.assign_shards(d, ["doc_id"], 1000),
        "judge": lambda d: quality.judge(d),
        "count_tokens": lambda d: token_count.count_tokens(d, PATH),
        "extract_text": lambda d: html_text.extract_text(d, page="text"),
        "mark": lambda d: decontaminate.mark(d, items),
        "scan": lambda d: secrets.scan(d, rule),
        "weigh": lambda d: resample.weigh(d, items),
        "line_quality": lambda d: line_quality.label_lines(d, line_quality.train(held, labels)),
        "find_runs": lambda d: periodic.find_runs(d),
    }


@pytest.fixture(scope="module")
def made(spark, clashing):
    return operators(spark, clashing)


NEW = {
    "encode_summary": "n_tokens ids_sha256 decoded_sha256",
    "encode": "ids",
    "judge_urls": "host path rule verdict",
    "near_duplicates": "n_shingles component_id kept",
    "toxicity": "score predicted",
    "assign_shards": "bytes shard oversized",
    "judge": "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_stop_words one base_failed broken kept",
    "count_tokens": "n_bytes n_tokens over_limit",
    "extract_text": "text n_chars",
    "mark": "item_ids n_items contaminated",
    "scan": "findings secrets redacted",
    "weigh": "n_words n_features weight score",
    "line_quality": "score predicted lines",
    "find_runs": "n_words runs collapsed",
}


@pytest.mark.parametrize("name", NEW)
def test_other_columns_stay(spark, clashing, made, name):
    new = set(NEW[name].split())
    full = made[name](clashing)
    assert set(full.columns) == {*clashing.columns, *new} and len(full.columns) == len(set(full.columns))
    rows = full.collect()
    assert len(rows) == clashing.count()
    assert all(row[own] == f"own {own}" for row in rows for own in NAMES if own not in new)


@pytest.fixture(scope="module")
def folder_of_odd_rows(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    good = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, None, "en", "s", 0), (1, "", "en", "s", 0), (1, "x", None, "s", 1)],
        good.schema,
    )
    docs = good.unionByName(odd).unionByName(good.limit(5)).unionByName(
        good.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    )
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("benchmark",):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_stages_with_nulls_repeats_and_extra_columns(spark, folder_of_odd_rows):
    """Nulls fail the quality rules, repeated rows go with the near duplicates, other columns stay."""
    docs = spark.read.parquet(f"{folder_of_odd_rows}/documents.parquet")
    docs = docs.withColumns({name: F.lit("own") for name in ("row", "_key", "found", "kept", "n_words", "text_key")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, folder_of_odd_rows)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert 0 < docs.count() <= before
        assert docs.filter("row = 'own' AND _key = 'own' AND kept = 'own' AND text_key = 'own'").count() == docs.count()
    assert docs.filter("text IS NULL OR length(text) < 20").count() == 0
    assert docs.select("text").distinct().count() == docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder_of_odd_rows)
    assert "text" not in last.columns and last.filter("n_tokens < 1").count() == 0


def test_stages_of_an_empty_table(spark, folder_of_odd_rows):
    docs = spark.read.parquet(f"{folder_of_odd_rows}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame([], stage(spark, docs, folder_of_odd_rows).schema)
    assert docs.count() == 0
