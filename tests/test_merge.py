"""Silver from new batches only equals Silver from all of them."""

import glob
import json
import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.plans.gold import gold_by_year
from shelfmark.plans.jobs import run_gold, run_silver
from shelfmark.plans.merge import Merge, merge_silver, merge_years
from shelfmark.plans.silver import SILVER_JOBS
from shelfmark.session import Layers
from shelfmark.sinks.tables import write_batch
from shelfmark.sources.layers import open_table, read_bronze, read_silver

DAY = datetime(2025, 1, 1, tzinfo=timezone.utc)
BUCKETS = 8


def books(rng, count):
    for _ in range(count):
        n = rng.randrange(40)
        yield (
            rng.choice([f"{n}", f" {n}", None]),
            rng.choice([f"T{n}", f" T{n} ", "t"]),
            rng.choice(["A", " A", "B", None]),
            rng.choice(["2000", "2001.0", "1700", None, "x"]),
            rng.choice(["P", "Q", None]),
            *[None] * 3,
            "csv",
            DAY + timedelta(days=rng.randrange(4)),
        )


def cards(rng, count):
    for _ in range(count):
        n = rng.randrange(30)
        price = rng.choice([1.0, 1.00000001, 2.5, -1.0, None])
        yield (rng.choice([f"T{n}", f" T{n}", None]), price, rng.randrange(6), " x ", "web", DAY)


def works(rng, count):
    for _ in range(count):
        n = rng.randrange(30)
        yield (f"T{n}", rng.choice([["A"], ["A", None], [], None]), rng.choice([1700, 1900, 2000, None]),
               rng.choice("st"), n, rng.choice([f"k{n}", "", None]), "api", DAY)


MADE = {"csv": books, "web": cards, "api": works}


def batch(spark, layers, source, number, count=60):
    rows = list(MADE[source](random.Random(f"{source}{number}"), count))
    df = spark.createDataFrame(rows, S.BRONZE[source])
    return write_batch(df, layers, source, DAY + timedelta(days=number), "parquet")


def merge(spark, layers, source, buckets=BUCKETS, **more):
    return merge_silver(spark, layers, source, buckets, DAY, "parquet", **more)


def table(df):
    return sorted(map(str, df.drop("transformed_at").collect()))


def full(spark, layers, source):
    return table(SILVER_JOBS[source](read_bronze(spark, layers, source, "parquet"), DAY))


@pytest.mark.parametrize("source", ["web", "csv", "api"])
def test_merged_batches_equal_one_full_run(spark, folder, source):
    layers = Layers.under(folder)
    for number in range(3):
        batch(spark, layers, source, number)
        merge(spark, layers, source)
        assert table(read_silver(spark, layers, source)) == full(spark, layers, source)
    assert read_silver(spark, layers, source).schema == S.SILVER[source]
    assert not glob.glob(f"{folder}/silver/_staged/*")


def one_book(spark, layers, number, isbn):
    row = (isbn, f"T{number}", "A", "2000", "P", None, None, None, "csv", DAY + timedelta(days=number))
    return write_batch(
        spark.createDataFrame([row], S.BRONZE_CSV), layers, "csv", DAY + timedelta(days=number), "parquet"
    )


def test_only_the_buckets_of_a_batch_are_read_and_written(spark, folder):
    layers = Layers.under(folder)
    batch(spark, layers, "csv", 0, 200)
    merge(spark, layers, "csv")
    own = Merge(spark, layers, "csv", BUCKETS)
    one_book(spark, layers, 9, "7")
    touched = own.bucketed(spark.createDataFrame([("7",)], "isbn string")).first().bucket
    others = {}
    for root in (own.table, own.state):
        assert len(glob.glob(f"{root}/bucket=*")) > 4
        for name in glob.glob(f"{root}/bucket=*/part-*"):
            if f"bucket={touched}/" not in name:
                others[name] = os.stat(name).st_mtime_ns
    for name in others:  # a file that is read now would be an error
        with open(name, "r+b") as file:
            file.write(b"none")
        crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
        others[name] = os.stat(name).st_mtime_ns
    merge(spark, layers, "csv")
    assert all(os.stat(name).st_mtime_ns == time for name, time in others.items())
    rows = read_silver(spark, layers, "csv")
    found = spark.read.schema(S.SILVER_CSV).parquet(f"{own.table}/bucket={touched}")
    assert found.filter("isbn = '7'").first().title == "T9"
    plan = own.kept_rows(own.bucketed(own.job.prepare(read_bronze(spark, layers, "csv", "parquet"))).schema, [touched])
    text = plan._jdf.queryExecution().toString()
    assert f"PartitionFilters: [isnotnull(bucket#" in text or "PartitionFilters: [bucket#" in text
    assert rows.columns == S.SILVER_CSV.names


def test_without_new_batches_nothing_is_written(spark, folder):
    layers = Layers.under(folder)
    batch(spark, layers, "csv", 0)
    merge(spark, layers, "csv")
    names = sorted(glob.glob(f"{folder}/silver/**/part-*", recursive=True))
    merge(spark, layers, "csv", watch=lambda rows, names: pytest.fail("read again"))
    assert sorted(glob.glob(f"{folder}/silver/**/part-*", recursive=True)) == names


def test_a_batch_without_valid_rows(spark, folder):
    layers = Layers.under(folder)
    one_book(spark, layers, 0, None)
    merge(spark, layers, "csv")
    assert read_silver(spark, layers, "csv").count() == 0
    one_book(spark, layers, 1, "1")
    merge(spark, layers, "csv")
    one_book(spark, layers, 2, None)
    merge(spark, layers, "csv")
    assert [row.title for row in read_silver(spark, layers, "csv").collect()] == ["T1"]
    empty = spark.createDataFrame([], S.BRONZE_CSV)
    write_batch(empty, layers, "csv", DAY + timedelta(days=3), "parquet")
    merge(spark, layers, "csv")
    assert read_silver(spark, layers, "csv").count() == 1


@pytest.mark.parametrize("change", ["written again", "gone", "full run", "other buckets"])
def test_what_cannot_be_merged_is_made_anew(spark, folder, change):
    layers = Layers.under(folder)
    paths = [batch(spark, layers, "csv", number) for number in range(2)]
    merge(spark, layers, "csv")
    buckets = BUCKETS
    if change == "written again":
        os.utime(f"{paths[0]}/_SUCCESS", (1, 1))  # as if written at another time
        ledger = Merge(spark, layers, "csv", BUCKETS).ledger
        assert json.load(open(ledger))["batches"]
    elif change == "gone":
        for name in glob.glob(f"{paths[1]}/*") + glob.glob(f"{paths[1]}/.*"):
            os.remove(name)
        os.rmdir(paths[1])
    elif change == "full run":
        run_silver(spark, layers, ["csv"], DAY, formats={"csv": "parquet"})
    else:
        buckets = 3
    batch(spark, layers, "csv", 2)
    merge(spark, layers, "csv", buckets)
    assert table(read_silver(spark, layers, "csv")) == full(spark, layers, "csv")


@pytest.mark.parametrize("step", ["publish_table", "switch"])
def test_a_merge_that_breaks_off_is_done_again(spark, folder, monkeypatch, step):
    from shelfmark.plans import merge as module

    layers = Layers.under(folder)
    batch(spark, layers, "csv", 0)
    merge(spark, layers, "csv")
    before = table(read_silver(spark, layers, "csv"))
    batch(spark, layers, "csv", 1)
    with monkeypatch.context() as patch:
        patch.setattr(module, step, lambda *args, **more: (_ for _ in ()).throw(OSError("broken off")))
        with pytest.raises(OSError):
            merge(spark, layers, "csv")
    if step == "publish_table":
        assert table(read_silver(spark, layers, "csv")) == before
    merge(spark, layers, "csv")
    assert table(read_silver(spark, layers, "csv")) == full(spark, layers, "csv")


def test_runs_with_buckets(spark, folder):
    layers = Layers.under(folder)
    batch(spark, layers, "csv", 0)
    run = dict(formats={"csv": "parquet"}, buckets=BUCKETS)
    first = run_silver(spark, layers, ["csv"], DAY, **run).first()
    assert (first.status, first.rows_in) == ("OK", 60)
    batch(spark, layers, "csv", 1, 35)
    second = run_silver(spark, layers, ["csv"], DAY, **run).first()
    rows = read_silver(spark, layers, "csv").count()
    assert (second.status, second.rows_in, second.rows_out) == ("OK", 35, rows)
    third = run_silver(spark, layers, ["csv"], DAY, **run).first()
    assert (third.status, third.rows_in, third.rows_out) == ("OK", 0, rows)
    gold = run_gold(spark, layers, ["books_by_year"]).first()
    assert (gold.status, gold.rows_in) == ("OK", rows)
    assert read_silver(spark, layers, "csv").filter(F.col("year") > 1999).count() == rows


def test_years_from_kept_sketches(spark, folder):
    layers = Layers.under(folder)
    for number in range(3):
        batch(spark, layers, "csv", number, 100)
        merge(spark, layers, "csv")
        step = run_gold(spark, layers, ["books_by_year"], sketch_buckets=BUCKETS).first()
        silver = read_silver(spark, layers, "csv")
        got = open_table(spark, layers.gold_path("books_by_year")).collect()
        # So few values are counted exactly.
        assert got == gold_by_year(silver).collect() == gold_by_year(silver, exact=False).collect()
        assert (step.rows_in, step.rows_out) == (silver.count(), len(got))


def test_years_read_changed_buckets_only(spark, folder):
    layers = Layers.under(folder)
    batch(spark, layers, "csv", 0, 200)
    merge(spark, layers, "csv")
    merge_years(spark, layers, BUCKETS)
    own = Merge(spark, layers, "csv", BUCKETS)
    one_book(spark, layers, 9, "7")
    merge(spark, layers, "csv")
    want = gold_by_year(read_silver(spark, layers, "csv")).collect()
    touched = own.bucketed(spark.createDataFrame([("7",)], "isbn string")).first().bucket
    for name in glob.glob(f"{own.table}/bucket=*/part-*"):
        if f"bucket={touched}/" not in name:
            os.remove(name)  # no bucket is read but the one that changed
    path = merge_years(spark, layers, BUCKETS)
    assert spark.read.parquet(path).collect() == want


def test_years_over_a_table_that_was_not_merged(spark, folder):
    layers = Layers.under(folder)
    batch(spark, layers, "csv", 0)
    run_silver(spark, layers, ["csv"], DAY, formats={"csv": "parquet"})
    step = run_gold(spark, layers, ["books_by_year"], sketch_buckets=4, raise_on_error=False).first()
    assert step.status == "ERROR" and "has not been merged" in step.error
