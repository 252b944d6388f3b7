"""The plans the jobs rely on at scale: what a scan reads, and what is shuffled."""

import re

import pytest

from shelfmark import schemas as S
from shelfmark.plans.gold import gold_by_year, gold_price_stats, gold_top_rated
from shelfmark.plans.silver import silver_api, silver_csv, silver_web
from shelfmark.sinks.tables import RowCount, overwrite_table
from shelfmark.sources.pages import cards_from_pages
from shelfmark.sources.responses import works_from_responses


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def columns_read(df):
    schema = re.search(r"ReadSchema: struct<(.*)>", plan(df)).group(1)
    return {part.split(":")[0] for part in re.sub(r"<[^>]*>", "", schema).split(",")}


def shuffles(df):
    return len(re.findall(r"^\(\d+\) Exchange", plan(df), re.M))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")

    def scan(name, schema):
        path = f"{root}/{name}"
        overwrite_table(spark.createDataFrame([], schema), path)
        return spark.read.schema(schema).parquet(path)

    return scan


def test_silver_filters_reach_the_scan_and_dedup_shuffles_once(stored):
    web = silver_web(stored("bronze_web", S.BRONZE_WEB))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(price_gbp,0.0\)", plan(web))
    api = silver_api(stored("bronze_api", S.BRONZE_API))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan(api)).group(1)
    assert "IsNotNull(title)" in pushed
    assert "GreaterThanOrEqual(first_publish_year,1800)" in pushed
    dump = silver_csv(stored("bronze_csv", S.BRONZE_CSV))
    assert "IsNotNull(ISBN)" in plan(dump)
    assert not any(name.startswith("Image") for name in columns_read(dump))
    for job in (web, api, dump):
        assert shuffles(job) == 1
        assert "partial_max" in plan(job)


def test_gold_reads_the_columns_it_needs(stored):
    csv, web = stored("silver_csv", S.SILVER_CSV), stored("silver_web", S.SILVER_WEB)
    by_year = gold_by_year(csv)
    assert columns_read(by_year) == {"year", "author", "publisher"}
    assert "PushedFilters: [IsNotNull(year)]" in plan(by_year)
    assert columns_read(gold_price_stats(web)) == {"rating", "price_gbp"}
    top = gold_top_rated(web)
    assert columns_read(top) == {"title", "price_gbp", "rating", "availability"}
    assert "TakeOrderedAndProject" in plan(top) and shuffles(top) == 0


def test_counting_rows_keeps_a_scan_narrow(stored):
    watched = RowCount().watch(stored("counted", S.SILVER_CSV))
    assert columns_read(gold_by_year(watched)) == {"year", "author", "publisher"}


def test_extraction_moves_no_rows(stored):
    cards = cards_from_pages(stored("pages", S.RAW_PAGES))
    assert columns_read(cards) == {"html"}
    works = works_from_responses(stored("responses", S.RAW_RESPONSES))
    assert shuffles(cards) == shuffles(works) == 0
    assert plan(cards).count("ArrowEvalPython (") <= 1 and "BatchEvalPython" not in plan(cards)
