"""Tables are replaced as a whole or not at all."""

import glob
import json
import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfmark.operators.quality import is_positive, is_unique, not_empty
from shelfmark.plans import jobs
from shelfmark.plans.jobs import run_gold, run_silver
from shelfmark.session import Layers
from shelfmark.sinks import switch as S
from shelfmark.sinks.tables import TableRejected, overwrite_table, publish_table, write_batch
from shelfmark.sources.layers import open_table, read_silver
from shelfmark.schemas import BRONZE_WEB


def ids(spark, path):
    return sorted(row[0] for row in open_table(spark, path).collect())


def broken(df, at):
    bad = F.when(F.col("id") == at, F.raise_error(F.lit("broken row")).cast("long"))
    return df.withColumn("id", F.coalesce(bad, F.col("id")))


def test_a_failed_write_leaves_the_old_rows(spark, folder):
    path = f"{folder}/t"
    overwrite_table(spark.range(5), path)
    before = sorted(os.listdir(path))
    with pytest.raises(PySparkException, match="broken row"):
        overwrite_table(broken(spark.range(0, 1000, 1, 8), 700), path)
    assert ids(spark, path) == [0, 1, 2, 3, 4] and sorted(os.listdir(path)) == before
    assert not glob.glob(f"{folder}/_staged/*") and not glob.glob(f"{folder}/_switching/*")


def test_a_first_write_that_fails_is_no_table(spark, folder):
    path = f"{folder}/t"
    with pytest.raises(PySparkException):
        overwrite_table(broken(spark.range(9), 3), path)
    with pytest.raises(S.MissingTable, match="no complete table"):
        open_table(spark, path)
    overwrite_table(spark.range(2), path)
    assert ids(spark, path) == [0, 1]


def test_a_table_may_be_replaced_from_itself(spark, folder):
    path = f"{folder}/t"
    overwrite_table(spark.range(5), path)
    overwrite_table(spark.read.parquet(path).filter("id > 2"), path)
    assert ids(spark, path) == [3, 4]


def test_rejected_tables_are_not_published(spark, folder):
    path = f"{folder}/t"
    publish_table(spark.range(1, 4), path, [is_positive("id"), is_unique("id")])
    with pytest.raises(TableRejected, match=r"positive\(id\): 1") as failure:
        publish_table(spark.range(0, 9), path, [is_positive("id"), is_unique("id")])
    assert [(r["check"], r["total_rows"]) for r in failure.value.report] == [("positive", 9)]
    with pytest.raises(TableRejected, match="not_empty"):
        publish_table(spark.range(0), path, [not_empty()])
    assert ids(spark, path) == [1, 2, 3] and not glob.glob(f"{folder}/_staged/*")
    publish_table(spark.range(0), path)
    assert ids(spark, path) == []


class Broken(Exception):
    pass


@pytest.mark.parametrize("stop_at", range(1, 12))
def test_a_switch_that_breaks_off_is_ended_by_the_next_reader(spark, folder, monkeypatch, stop_at):
    """Whatever call on the file system is the last one, the next reader gets one whole table."""
    path = f"{folder}/t"
    overwrite_table(spark.range(5), path)
    staged = S.staging_folder(path)
    spark.range(10, 13).write.parquet(staged)
    calls = []

    def counted(name):
        plain = getattr(S.Store, name)

        def call(self, *args):
            calls.append(name)
            if len(calls) == stop_at:
                raise Broken
            return plain(self, *args)

        return call

    with monkeypatch.context() as patch:
        for name in ("delete", "rename", "make_folder", "write"):
            patch.setattr(S.Store, name, counted(name))
        try:
            S.switch(spark, staged, path)
            begun = True
        except Broken:
            begun = os.path.exists(f"{folder}/_switching/t")
    assert ids(spark, path) == ([10, 11, 12] if begun else [0, 1, 2, 3, 4])
    assert not glob.glob(f"{folder}/_switching/t")


@pytest.mark.parametrize("moved", [1, 2, 3])
def test_a_store_that_moves_file_by_file(spark, folder, moved):
    path = f"{folder}/t"
    overwrite_table(spark.range(0, 40, 1, 4), path)
    staged = S.staging_folder(path)
    spark.range(100, 130, 1, 3).write.parquet(staged)
    names = sorted(name for name in os.listdir(staged) if not name.startswith("."))
    os.makedirs(f"{folder}/_switching")
    with open(f"{folder}/_switching/t", "w") as file:
        json.dump({"staged": staged, "moves": [{"from": staged, "to": path, "names": names}]}, file)
    data = [name for name in names if name.startswith("part")]
    for name in data[:moved]:
        os.rename(f"{staged}/{name}", f"{path}/{name}")
    assert ids(spark, path) == list(range(100, 130))
    assert ids(spark, path) == list(range(100, 130))
    assert sorted(n for n in os.listdir(path) if not n.startswith(".")) == names


def test_only_the_named_parts_are_replaced(spark, folder):
    path = f"{folder}/t"
    spark.range(30).withColumn("part", F.col("id") % 3).write.partitionBy("part").parquet(path)
    kept = glob.glob(f"{path}/part=0/*.parquet") + glob.glob(f"{path}/part=2/*.parquet")
    staged = S.staging_folder(path)
    new = spark.range(100, 102).withColumn("part", F.lit(1)).unionByName(
        spark.range(103, 104).withColumn("part", F.lit(7))
    )
    new.write.partitionBy("part").parquet(staged)
    S.switch(spark, staged, path, ["part=1", "part=7"])
    assert all(os.path.exists(name) for name in kept)
    want = sorted([*(k for k in range(30) if k % 3 != 1), 100, 101, 103])
    assert ids(spark, path) == want
    with pytest.raises(S.MissingTable):
        S.switch(spark, f"{folder}/absent", path)


def web(spark, *rows):
    rows = [(*row, "web", None) for row in rows]
    return spark.createDataFrame(rows, BRONZE_WEB)


def statuses(df):
    return {row["step"]: (row["status"], row["rows_in"], row["rows_out"], row["error"]) for row in df.collect()}


def test_gold_alone_over_a_lost_silver_table_is_an_error(spark, folder):
    layers = Layers.under(folder)
    write_batch(web(spark, ("A", 1.0, 1, "x")), layers, "web")
    run_silver(spark, layers, ["web"])
    run_gold(spark, layers, ["top_rated_books"])
    gold = layers.gold_path("top_rated_books")
    for name in os.listdir(layers.silver_path("web")):  # as a write in place leaves it when it fails
        os.remove(f"{layers.silver_path('web')}/{name}")
    found = statuses(run_gold(spark, layers, ["top_rated_books", "books_by_year"], raise_on_error=False))
    assert found["gold/top_rated_books"][0] == found["gold/books_by_year"][0] == "ERROR"
    assert "no complete table" in found["gold/top_rated_books"][3]
    assert [row.title for row in open_table(spark, gold).collect()] == ["A"]


def test_a_silver_table_that_breaks_its_checks_is_not_replaced(spark, folder, monkeypatch):
    layers = Layers.under(folder)
    write_batch(web(spark, ("A", 1.0, 1, "x")), layers, "web", datetime(2025, 1, 1))
    run_silver(spark, layers, ["web"])
    monkeypatch.setitem(jobs.SILVER_CHECKS, "web", [is_unique("rating")])
    write_batch(web(spark, ("B", 2.0, 1, "x")), layers, "web", datetime(2025, 1, 2))
    found = statuses(run_silver(spark, layers, ["web"], raise_on_error=False))
    assert found["silver/web"][0] == "ERROR" and "unique(rating): 1" in found["silver/web"][3]
    assert [row.title for row in read_silver(spark, layers, "web").collect()] == ["A"]
