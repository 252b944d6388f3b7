"""Runs that break off, tasks that fail once, and what a run leaves unread."""

import glob
import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from test_book_jobs import DAY1, DAY2, inputs, statuses, web  # noqa: F401

from shelfmark import schemas as S
from shelfmark.__main__ import main
from shelfmark.plans import jobs
from shelfmark.plans.jobs import Inputs, StepsFailed, run_all, run_bronze, run_silver
from shelfmark.session import Layers
from shelfmark.sinks.tables import batch_rows, write_batch
from shelfmark.sources.layers import read_bronze
from shelfmark.sources.pages import cards_from_pages, page_range, read_raw_pages, store_raw_pages

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# --- Runs that go on where they were ---


@pytest.mark.parametrize("parallel", [False, True])
def test_a_broken_run_goes_on(spark, folder, inputs, monkeypatch, parallel):  # noqa: F811
    layers = Layers.under(folder)

    def fails(*args, **more):
        raise OSError("no more disk")

    with monkeypatch.context() as patch:
        patch.setitem(jobs.SILVER_JOBS, "csv", fails)
        patch.setitem(jobs.GOLD_JOBS, "top_subjects", ("api", fails))
        with pytest.raises(StepsFailed, match="no more disk"):
            run_all(spark, inputs, layers, DAY1, parallel=parallel)
    bronze = {name: os.stat(name).st_mtime_ns for name in glob.glob(f"{folder}/bronze/*/*/part-*")}
    found = statuses(run_all(spark, inputs, layers, DAY1, parallel=parallel, resume=True))
    ran = {step for step, own in found.items() if own[0] == "OK"}
    assert ran == {"silver/csv", "gold/books_by_year", "gold/top_subjects"}
    assert {own[0] for own in found.values()} == {"OK", "KEPT"}
    assert found["bronze/web"] == ("KEPT", 4, 3) and found["silver/web"] == ("KEPT", 3, 2)
    assert found["silver/csv"] == ("OK", 1, 1) and found["gold/top_rated_books"] == ("KEPT", 2, 2)
    assert {name: os.stat(name).st_mtime_ns for name in bronze} == bronze
    again = statuses(run_all(spark, inputs, layers, DAY1, resume=True))
    assert {own[0] for own in again.values()} == {"KEPT"}
    assert {step: own[1:] for step, own in again.items()} == {step: own[1:] for step, own in found.items()}


def test_steps_after_one_that_runs_again_run_too(spark, folder, inputs):  # noqa: F811
    layers = Layers.under(folder)
    run_all(spark, inputs, layers, DAY1)
    for name in glob.glob(f"{folder}/bronze/web/*/*"):
        os.remove(name)
    found = statuses(run_all(spark, inputs, layers, DAY1, resume=True))
    ran = {step for step, own in found.items() if own[0] == "OK"}
    assert ran == {"bronze/web", "silver/web", "gold/top_rated_books", "gold/price_stats_by_rating"}
    assert found["silver/web"] == ("OK", 3, 2)


def test_only_the_same_batch_is_resumed(spark, folder, inputs):  # noqa: F811
    layers = Layers.under(folder)
    run_bronze(spark, inputs, layers, DAY1)
    other = statuses(run_all(spark, inputs, layers, DAY2, resume=True))
    assert {own[0] for own in other.values()} == {"OK"}
    fresh = statuses(run_all(spark, inputs, layers, DAY1))
    assert {own[0] for own in fresh.values()} == {"OK"}


def test_command_line_resumes(spark, folder, inputs, capsys):  # noqa: F811
    roots = [f"--{layer}={folder}/{layer}" for layer in ("bronze", "silver", "gold")]
    raw = [f"--pages={inputs.pages}", "--batch=2025-01-01T00:00:00"]
    assert main([*roots, "bronze", *raw]) == 0
    assert main([*roots, "--silver-buckets", "4", "all", *raw, "--resume"]) == 0
    out = capsys.readouterr().out.split("silver/web")[0]
    assert "KEPT" in out
    with pytest.raises(SystemExit):
        main([*roots, "all", raw[0], "--resume"])


# --- Counts ---


def test_batches_know_their_rows(spark, folder):
    layers = Layers.under(folder)
    rows = [("A", 1.0, 1, "x"), ("B", -2.0, 1, "x")]
    write_batch(web(spark, *rows), layers, "web", DAY1)
    write_batch(web(spark, rows[0]).limit(0), layers, "web", DAY2)
    assert batch_rows(spark, layers, "web") == 2
    found = statuses(run_silver(spark, layers, ["web"]))
    assert found["silver/web"] == ("OK", 2, 1)
    # A batch from elsewhere is counted as it is read.
    with open(f"{folder}/bronze/web/other.json", "w") as file:
        file.write('{"title": "C", "price_gbp": 3}\n')
    assert batch_rows(spark, layers, "web") is None
    assert statuses(run_silver(spark, layers, ["web"]))["silver/web"] == ("OK", 3, 2)


RETRIES = """
import sys
from pyspark import TaskContext
from shelfmark import schemas as S
from shelfmark.plans import jobs
from shelfmark.plans.jobs import run_silver
from shelfmark.session import Layers, SessionSpec, build_session
from shelfmark.sinks.tables import write_batch

extra = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"}
spark = build_session(SessionSpec(master="local[2,4]", extra=extra))
spark.sparkContext.setLogLevel("OFF")
layers = Layers.under(sys.argv[1])


def flaky(batches):
    attempt = TaskContext.get().attemptNumber()
    for batch in batches:
        yield batch
    if attempt < 2:
        raise OSError("lost")


def once(df):
    return df.mapInArrow(flaky, df.schema)


rows = spark.range(1000).selectExpr(
    "cast(id % 300 as string) title", "1.0d price_gbp", "1 rating", "'x' availability", "'web' source",
    "timestamp'2025-01-01' extracted_at")
write_batch(once(rows.repartition(5)), layers, "web", fmt="json")
job = jobs.SILVER_JOBS["web"]
jobs.SILVER_JOBS["web"] = lambda df, batch_ts: job(once(df), batch_ts)
step = run_silver(spark, layers, ["web"]).first()
print("counted", step.status, step.rows_in, step.rows_out)
"""


def test_counts_are_exact_when_tasks_fail(folder):
    """Each task of the write of a batch and of the step that reads it fails twice, after its last row."""
    environment = {**os.environ, "PYTHONPATH": ROOT}
    done = subprocess.run(
        [sys.executable, "-c", RETRIES, folder], capture_output=True, text=True, env=environment, timeout=300
    )
    assert "counted OK 1000 300" in done.stdout, done.stderr[-2000:]


# --- Pages by number ---


def test_page_caps_leave_folders_unread(spark, folder):
    urls = [f"http://s/page-{n}.html" for n in (1, 2, 3, 9, 10, 11, 16, 500)] + ["http://s/", None, "x/page-0.html"]
    urls.append("http://s/page-99999999999.html")
    pages = spark.createDataFrame([(url, "<p>") for url in urls], S.RAW_PAGES)
    path = store_raw_pages(pages, f"{folder}/pages")
    for cap in (0, 1, 2, 10, 15, 16, 1000, -3):
        stored = read_raw_pages(spark, path, by_number=True, max_pages=cap).select("url")
        assert sorted(stored.collect()) == sorted(page_range(pages, cap).select("url").collect())
    everything = read_raw_pages(spark, path, by_number=True)
    assert sorted(map(str, everything.select("url", "html").collect())) == sorted(map(str, pages.collect()))
    capped = cards_from_pages(read_raw_pages(spark, path, by_number=True, max_pages=10))
    plan = capped._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(page_group" in plan and "(page_group" in plan and "<= 4)" in plan
    assert "LessThanOrEqual(page,10)" in plan
    for name in glob.glob(f"{path}/page_group=9/part-*"):
        os.remove(name)  # read by no cap below 256
    assert read_raw_pages(spark, path, by_number=True, max_pages=255).count() == 8


def test_runs_over_pages_by_number(spark, folder, inputs):  # noqa: F811
    path = store_raw_pages(spark.read.parquet(inputs.pages), f"{folder}/numbered")
    for cap, rows in ((1, 4), (0, 0)):
        own = Inputs(pages=path, pages_by_number=True, max_pages=cap)
        assert statuses(run_bronze(spark, own, Layers.under(f"{folder}/{cap}"), DAY1))["bronze/web"][1] == rows


# --- Large files of one array, and Bronze CSV, in splits ---


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def random_works(rng, count):
    signs = ['"', "\\", "{", "}", "[", "]", ",", "é", "\n", "x" * 40, " ", '\\"', "}}", '{"a": 1}', " "]
    for n in range(count):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(12)))
        yield {
            "title": f"{n}{text}",
            "authors": rng.choice([None, [], [text, None, "A"]]),
            "first_publish_year": rng.choice([None, 1999]),
            "subject": text,
            "nested": {"deep": [{"x": text}, {}], "y": {}},
            "key": "k",
        }


@pytest.mark.parametrize("indent", [None, 2])
def test_array_documents_in_splits(spark, folder, small_splits, indent):
    layers = Layers.under(folder)
    path = layers.bronze_path("api")
    os.makedirs(path)
    rng = random.Random(6)
    for name, count in (("a", 300), ("b", 1), ("c", 0), ("d", 200)):
        with open(f"{path}/{name}.json", "w") as file:
            json.dump(list(random_works(rng, count)), file, indent=indent, ensure_ascii=name == "a")
    whole = read_bronze(spark, layers, "api", multi_line=True)
    split = read_bronze(spark, layers, "api", multi_line=True, splits=True)
    assert split.schema == whole.schema
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    assert split.count() == 501


def test_odd_array_documents(spark, folder, small_splits):
    layers = Layers.under(folder)
    path = layers.bronze_path("web")
    os.makedirs(path)
    texts = {
        "scalars": '[1, "}{", null, {"title": "A"}, [2], "x\\"}", {"title": "B"}]',
        "object": ' {"title": "C", "price_gbp": 1}',
        "lines": '{"title": "D"}\n{"title": "E"}\n',
        "empty": "",
        "cut": '[{"title": "F"}, {"title": "G", "availability": "' + "x" * 3000,
    }
    for name, text in texts.items():
        with open(f"{path}/{name}.json", "w") as file:
            file.write(text)
    rows = read_bronze(spark, layers, "web", multi_line=True, splits=True).collect()
    assert sorted(row.title for row in rows) == list("ABCDEF")


def test_bronze_csv_in_splits(spark, folder, small_splits):
    layers = Layers.under(folder)
    rng = random.Random(2)
    signs = ['"', ",", "\n", "\r\n", "é", " ", "x" * 30, "\\", ""]

    def text():
        return rng.choice([None, "".join(rng.choice(signs) for _ in range(rng.randrange(8)))])

    rows = [(str(n), *[text() for _ in range(7)], "csv", DAY1) for n in range(400)]
    df = spark.createDataFrame(rows, S.BRONZE_CSV).coalesce(2)
    write_batch(df, layers, "csv", DAY1)
    whole, split = (read_bronze(spark, layers, "csv", splits=splits) for splits in (False, True))
    assert split.schema == whole.schema and split.count() == 400
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    assert split.select("ISBN").distinct().count() == 400
    other = df.select(*reversed(df.columns)).withColumn("extracted_at", F.lit("x"))
    other.write.csv(f"{layers.bronze_path('csv')}/other", header=True)
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_bronze(spark, layers, "csv", splits=True).collect()
