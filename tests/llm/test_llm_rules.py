"""Quality rules, URL rules and shards."""

import pytest
from brute import is_good
from oracle import connect, differences

from shelfmark.llm.queries import ORACLE, QUERIES, SHARD_BYTES
from shelfmark.llm.quality import STOP_WORDS, judge, keep_good, measure
from shelfmark.llm.sharding import assign_shards, write_shards
from shelfmark.llm.url_rules import judge_urls

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, DATA), connect(DATA), ORACLE[name]) == []


def test_counts_of_small_texts(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "a b a b a b"),
        (5, "x\n\nx\ny\n x"),
        (6, "#1 a|b <é> %"),
        (7, "a a a a"),
    ]
    got = measure(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {
        r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        for r in got.collect()
    }
    assert got == {
        1: (0, 0, 0, 0, 0),
        2: (0, 0, 0, 0, 0),
        3: (0, 0, 0, 0, 0),
        4: (6, 6, 0, 0, 6),
        5: (4, 4, 0, 1, 0),
        6: (4, 9, 5, 0, 0),
        7: (4, 4, 0, 0, 4),
    }


def test_good_documents_stay_whole(spark):
    text = " ".join(f"word{k} the of" for k in range(40))
    rows = [(1, text, 7), (1, text, 7), (2, "short", 8), (None, text, None), (3, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    assert sorted(keep_good(docs).collect(), key=str) == sorted(
        [r for r in docs.collect() if r.text == text], key=str
    )
    assert keep_good(docs.limit(0)).count() == 0
    broken = {r.doc_id: r.broken for r in judge(docs).collect()}
    assert broken[1] == [] and "few_words" in broken[2] and "few_words" in broken[3]
    assert is_good(text, STOP_WORDS)


def test_url_rules_of_odd_urls(spark):
    urls = [
        None,
        "",
        "example.net/en/x",
        "HTTP://WWW.Example.NET/en/x?y",
        "http://notexample.net",
        "http://notexample.net/",
        "http://net/a#b",
        "x://a.org/fr/://b.net/",
        "http://[::1]:80/de/",
    ]
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("org/fr/", "allow"), (None, "block")]
    rules += [("net/", "allow"), ("a.org/", "block"), ("b.a.org/", "odd")]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id int, url string, host string")
    got = judge_urls(pages, spark.createDataFrame(rules, "rule string, verdict string"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    assert got == {
        0: ("", "", None, "allow"),
        1: ("", "", None, "allow"),
        2: ("", "", None, "allow"),
        3: ("www.example.net", "/en/x", "example.net/en/", "allow"),
        4: ("notexample.net", "", None, "allow"),
        5: ("notexample.net", "/", "net/", "block"),
        6: ("net", "/a", "net/", "block"),
        7: ("a.org", "/fr/://b.net/", "org/fr/", "allow"),
        8: ("[::1]:80", "/de/", None, "allow"),
    }
    none = spark.createDataFrame([], "rule string, verdict string")
    assert {r.verdict for r in judge_urls(pages, none).collect()} == {"allow"}
    assert judge_urls(pages.limit(0), none).count() == 0


@pytest.mark.parametrize("limit", [100, 1000, 10**7])
def test_shards_keep_all_rows_within_the_limit(spark, folder, limit):
    rows = [(i, "x" * (i % 50), 1) for i in range(300)] + [(7, "y" * 30, 1)] * 60
    rows += [(8, f"z{i}", 2) for i in range(200)] + [(None, None, None)] * 3 + [(9, "q" * 5000, 1)]
    schema = "doc_id long, text string, bytes int"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/docs")
    docs = spark.read.parquet(f"{folder}/docs")
    out = assign_shards(docs, ["doc_id"], limit).toPandas()
    assert len(out) == len(rows)
    held = out.groupby("shard").agg({"bytes": "sum", "oversized": "max", "doc_id": "size"})
    assert (held["bytes"] <= limit).to_numpy()[~held["oversized"].to_numpy()].all()
    assert (held["doc_id"][held["oversized"]] == 1).all()
    assert out["oversized"].sum() == (1 if limit < 5000 else 0)


def test_shards_of_the_query_and_of_nothing(spark, folder):
    out = QUERIES["op5_sharding"](spark, DATA).toPandas()
    sizes = out[~out["oversized"]].groupby("shard")["bytes"].sum()
    assert sizes.max() <= SHARD_BYTES
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert len(out) == docs.count()
    assert assign_shards(docs.limit(0), ["doc_id"], 10).count() == 0
    write_shards(docs, f"{folder}/shards", ["doc_id"], 10_000)
    assert spark.read.parquet(f"{folder}/shards").count() == docs.count()


def test_copies_are_kept_by_shuffle_joins_of_other_partitions(spark, folder):
    held = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in held}
    wide = spark.range(60, numPartitions=4).selectExpr(
        "id AS doc_id", "array_join(transform(sequence(1, 30), k -> sha2(concat(id, '-', k), 256)), '') AS text"
    )
    wide.crossJoin(spark.range(100)).select("doc_id", "text").repartition(6).write.parquet(f"{folder}/in")
    docs = spark.read.parquet(f"{folder}/in")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        out = assign_shards(docs, ["doc_id"], 20_000).toPandas()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert len(out) == 6000 and set(out.groupby("doc_id").size()) == {100}
    assert out.groupby("shard")["bytes"].sum().max() <= 20_000
    assert not out["oversized"].any()
