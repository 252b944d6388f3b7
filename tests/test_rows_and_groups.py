import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.operators import quality as Q
from shelfmark.operators.groups import count_by, number_stats, size_ranking, top_k
from shelfmark.operators.rows import dedup_latest, in_range, positive, require

WEB = "title string, price_gbp float, rating int, availability string"


def read(df):
    return [tuple(row) for row in df.collect()]


def test_null_prices_are_dropped(spark):
    df = spark.createDataFrame([("A", 10.0, 3, "x"), ("B", None, 4, "x")], WEB)
    assert require(df, ["price_gbp"]).count() == 1


def test_prices_must_be_positive(spark):
    rows = [("A", 10.0, 3, "x"), ("B", -5.0, 4, "x"), ("C", 0.0, 2, "x"), ("D", None, 1, "x")]
    assert read(positive(spark.createDataFrame(rows, WEB), "price_gbp").select("title")) == [("A",)]


def test_range_is_inclusive_and_drops_nulls(spark):
    rows = [(2020,), (1750,), (9999,), (1800,), (2024,), (None,)]
    df = spark.createDataFrame(rows, "year int")
    assert sorted(read(in_range(df, "year", 1800, 2024))) == [(1800,), (2020,), (2024,)]
    assert in_range(df, "year", low=1800).count() == 4
    assert in_range(df, "year").count() == 5


def test_require_drops_nulls_and_keeps_empty_strings(spark):
    rows = [("1", "A", "X"), (None, "B", "X"), ("3", None, "X"), ("", "", "X")]
    df = spark.createDataFrame(rows, "isbn string, title string, author string")
    assert sorted(read(require(df, ["isbn", "title"]))) == [("", "", "X"), ("1", "A", "X")]


RECORD = "k string, at int, a string, b double"


def test_dedup_keeps_the_latest_then_settles_ties(spark):
    rows = [("k", 1, "z", 1.0), ("k", 2, "b", 2.0), ("k", 2, "a", 3.0), ("k", None, "a", 0.0)]
    df = spark.createDataFrame(rows, RECORD)
    assert read(dedup_latest(df, ["k"], ["at"])) == [("k", 2, "b", 2.0)]


def test_null_keys_are_one_group_and_spaces_count(spark):
    rows = [(None, 1, "a", 0.0), (None, 2, "b", 0.0), ("A", 1, "c", 0.0), (" A", 1, "d", 0.0)]
    df = spark.createDataFrame(rows, RECORD)
    assert sorted(row[2] for row in read(dedup_latest(df, ["k"], ["at"]))) == ["b", "c", "d"]


def test_dedup_reduces_in_the_map_tasks(spark):
    df = spark.range(10_000).selectExpr("IF(id < 0, 'cold', 'hot') AS k", "CAST(id AS INT) AS at")
    latest = dedup_latest(df, ["k"], ["at"])
    plan = latest._jdf.queryExecution().toString()
    assert "partial_max" in plan
    assert read(latest) == [("hot", 9999)]


keys = st.one_of(st.none(), st.sampled_from(["a", "b", " a", ""]))
records = st.tuples(keys, st.integers(0, 3), st.sampled_from("xyz"), st.sampled_from([0.5, 1.5]))


@settings(max_examples=15, deadline=None)
@given(st.lists(records, min_size=1, max_size=25), st.randoms(use_true_random=False))
def test_dedup_is_repeatable(spark, rows, rng: random.Random):
    def winners(input_rows):
        df = spark.createDataFrame(input_rows, RECORD).repartition(3)
        return sorted(read(dedup_latest(df, ["k"], ["at"])), key=str)

    first = winners(rows)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    assert winners(shuffled) == first
    assert winners(first) == first
    assert len(first) == len({row[0] for row in rows})
    assert set(first) <= set(rows)


def test_top_k(spark):
    rows = [(f"Book {i:02d}", float(i), i % 5 + 1, "In stock") for i in range(50)]
    df = spark.createDataFrame(rows, WEB)
    top = top_k(df, [F.col("rating").desc(), "price_gbp", "title"], 20)
    assert [row[0] for row in read(top)][:3] == ["Book 04", "Book 09", "Book 14"]
    assert top.count() == 20
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().toString()


def test_count_by_ignores_nulls_in_distinct_counts(spark):
    rows = [(2020, "A", "P"), (2020, "A", None), (2021, None, "P"), (2019, "B", "Q")]
    df = spark.createDataFrame(rows, "year int, author string, publisher string")
    counted = count_by(df, "year", "n", {"authors": "author", "publishers": "publisher"})
    assert read(counted) == [(2019, 1, 1, 1), (2020, 2, 1, 1), (2021, 1, 0, 1)]
    assert read(count_by(df, "year", "n", {}).filter("year = 2020")) == [(2020, 2)]


def test_number_stats(spark):
    rows = [("A", 10.0, 5), ("B", 20.0, 5), ("C", 15.456, 4), ("D", None, None)]
    df = spark.createDataFrame(rows, "title string, price_gbp float, rating int")
    stats = number_stats(df, "rating", "price_gbp", "n", "low", "high", "mean")
    assert [field.dataType.simpleString() for field in stats.schema] == [
        "int",
        "bigint",
        "float",
        "float",
        "double",
    ]
    first, second, third = read(stats)
    assert first == (5, 2, 10.0, 20.0, 15.0)
    assert second[:2] == (4, 1) and round(second[4], 4) == 15.46
    assert third == (None, 1, None, None, None)


def test_size_ranking_breaks_ties_by_key(spark):
    rows = [("b", 1, 1990), ("a", 2, 2000), ("c", 3, 1980), ("c", 4, None)]
    df = spark.createDataFrame(rows, "subject string, editions int, year int")
    ranked = size_ranking(df, "subject", "n", "editions", "mean", "year", "first", "last")
    assert read(ranked) == [
        ("c", 2, 3.5, 1980, 1980),
        ("a", 1, 2.0, 2000, 2000),
        ("b", 1, 1.0, 1990, 1990),
    ]


def test_quality_report(spark):
    rows = [("A", 10.0, 5, "x"), ("A", -1.0, 0, "x"), (None, None, None, "x"), (None, 1.0, 6, "x")]
    df = spark.createDataFrame(rows, WEB)
    checks = [
        Q.not_empty(),
        Q.is_positive("price_gbp"),
        Q.is_between("rating", 1, 5),
        Q.is_unique("title"),
        Q.is_unique("title", "rating"),
        Q.at_most(3),
    ]
    report = Q.quality_report(df, checks, required=["title", "isbn"])
    assert report.columns == ["check", "column", "failed_rows", "total_rows"]
    assert [row[:3] for row in read(report)] == [
        ("column_present", "title", 0),
        ("column_present", "isbn", 4),
        ("not_empty", "*", 0),
        ("positive", "price_gbp", 2),
        ("between", "rating", 3),
        ("unique", "title", 2),
        ("unique", "title,rating", 0),
        ("at_most", "*", 1),
    ]
    assert Q.violations(report).count() == 5


def test_quality_of_an_empty_table(spark):
    df = spark.createDataFrame([], WEB)
    report = Q.quality_report(df, [Q.not_empty(), Q.is_unique("title")], required=["isbn"])
    assert [row[1:] for row in read(report)] == [("isbn", 1, 0), ("*", 1, 0), ("title", 0, 0)]
