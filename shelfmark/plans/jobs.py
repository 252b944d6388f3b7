"""The Bronze, Silver and Gold runs, step by step, with a status row for every step.

A Silver or Gold table is written beside the one it replaces, checked, and then put in its place, so
that a step that fails leaves the old table. Gold over a Silver table that is missing is an error.
One step failing does not stop the others, but a run with failures ends in StepsFailed, which
carries the status table.

Rows are counted by the write itself: its last stage counts a task once, however often it ran. What a
Silver or Gold step reads is known from the batch, or from the footers of its files. Only batches that
others have written are counted as they are read, in tasks that may run again after an executor is
lost; their `rows_in` can then come out too high.
"""

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rows import add_lineage, moment
from ..schemas import STEP_STATUS
from ..session import sized_for
from ..sinks.tables import RowCount, batch_rows, overwrite_table, publish_table, write_batch
from ..sources.landing import all_records
from ..sources.layers import read_batch, read_bronze, read_silver
from ..sources.pages import WEB_SOURCE, all_cards, read_raw_pages
from ..sources.responses import API_SOURCE, all_works, read_raw_responses
from .gold import GOLD_CHECKS, GOLD_JOBS
from .ledger import Ledger
from .merge import merge_silver, merge_years
from .silver import SILVER_CHECKS, SILVER_JOBS

SOURCES = ("web", "csv", "api")


@dataclass(frozen=True)
class Inputs:
    """Where the raw data of each source lies; a source without a path is left out."""

    pages: str | None = None
    landing_csv: str | None = None
    responses: str | None = None
    raw_format: str = "parquet"
    max_pages: int | None = None
    subjects: tuple[str, ...] | None = None
    works_per_subject: int | None = None
    raw_partitions: int | None = None
    pages_by_number: bool = False

    def sources(self):
        paths = {"web": self.pages, "csv": self.landing_csv, "api": self.responses}
        return [source for source in SOURCES if paths[source] is not None]


@dataclass(frozen=True)
class Step:
    """A step's result: OK, KEPT from the run before, ERROR, or SKIPPED when its input step failed."""

    step: str
    status: str
    rows_in: int | None = None
    rows_out: int | None = None
    seconds: float = 0.0
    path: str | None = None
    error: str | None = None

    def row(self):
        return tuple(getattr(self, name) for name in STEP_STATUS.names)


class StepsFailed(RuntimeError):
    def __init__(self, failed, status):
        super().__init__("; ".join(f"{step.step}: {step.error}" for step in failed))
        self.status = status


@dataclass(frozen=True)
class _Work:
    """What a step reads, which of those rows it may keep, and where it puts them."""

    read: Callable[[], DataFrame]
    shape: Callable[[DataFrame], DataFrame]
    write: Callable[[DataFrame], str]
    reread: Callable[[str], DataFrame]
    # Parquet tells its rows without reading them. To watch them go by would keep filters from the
    # scan.
    by_footer: bool = False
    # Rows that are known before they are read; None if they are not.
    rows_in: int | None = None


def run_bronze(
    spark,
    inputs,
    layers,
    batch_ts=None,
    raise_on_error=True,
    formats=None,
    packed=True,
    parallel=False,
):
    """Raw data of every given source -> one Bronze batch each.

    `formats` names the file format of a source, where it is not the usual one; `packed=False` leaves JSON
    plain. `parallel` extracts the sources at the same time. A run_all of the same `batch_ts` can resume
    from here.
    """
    batch_ts = batch_ts or datetime.now(timezone.utc)
    ledger = Ledger(spark, layers, batch_ts)

    def extracted(source):
        fmt = (formats or {}).get(source)
        return _noted(ledger, _bronze_step(spark, source, inputs, layers, batch_ts, fmt, packed))

    steps = _each(spark, extracted, inputs.sources(), parallel)
    return _finish(spark, steps, raise_on_error)


def run_silver(
    spark,
    layers,
    sources=SOURCES,
    batch_ts=None,
    raise_on_error=True,
    input_bytes=None,
    formats=None,
    buckets=None,
    **read,
):
    """All Bronze batches of each source -> its Silver table. `read` goes to read_bronze.

    `input_bytes` sizes the shuffles, `formats` names the file format of a source. With `buckets` only
    batches that are not in the table yet are read, and merged into a table of so many buckets.
    """
    with sized_for(spark, "silver", input_bytes):
        steps = [
            _silver_step(
                spark, source, layers, batch_ts, {"fmt": (formats or {}).get(source), **read}, buckets
            )
            for source in sources
        ]
    return _finish(spark, steps, raise_on_error)


def run_gold(
    spark, layers, tables=tuple(GOLD_JOBS), raise_on_error=True, input_bytes=None, sketch_buckets=None
):
    """Silver tables -> the named Gold tables.

    `sketch_buckets`, the buckets that Silver was merged into, makes the table of years from kept
    sketches: authors and publishers are then estimated, and only buckets that changed are read.
    """
    with sized_for(spark, "gold", input_bytes):
        steps = [_gold_step(spark, table, layers, sketch_buckets) for table in tables]
    return _finish(spark, steps, raise_on_error)


def run_all(
    spark,
    inputs,
    layers,
    batch_ts=None,
    parallel=False,
    raise_on_error=True,
    input_bytes=None,
    formats=None,
    buckets=None,
    resume=False,
    packed=True,
):
    """Bronze then Silver for each source, then Gold.

    `resume` goes on with the run of the same `batch_ts`: steps that it finished are KEPT, unless their
    files have gone or a step before them runs again.

    `input_bytes`, of the raw data, sizes the shuffles of each layer. `formats` names the Bronze
    format of a source, such as {"csv": "parquet"} for a run too large for files that one task reads;
    `packed=False` leaves Bronze JSON plain.
    `buckets` makes Silver take in new batches only, as in run_silver.

    A Gold table is built when its own source succeeded. `parallel` runs the chains of the
    sources, and then the Gold tables, as concurrent jobs of the one application.
    """
    batch_ts = batch_ts or datetime.now(timezone.utc)

    ledger = Ledger(spark, layers, batch_ts, resume)

    def chain(source):
        fmt = (formats or {}).get(source)
        bronze = _kept_or(
            ledger,
            f"bronze/{source}",
            lambda: _bronze_step(spark, source, inputs, layers, batch_ts, fmt, packed),
        )
        if bronze.status not in _DONE:
            return [bronze, Step(f"silver/{source}", "SKIPPED", error="no new Bronze batch")]
        silver = _kept_or(
            ledger,
            f"silver/{source}",
            lambda: _silver_step(spark, source, layers, batch_ts, {"fmt": fmt}, buckets),
            bronze,
        )
        return [bronze, silver]

    with sized_for(spark, "silver", input_bytes):
        chains = _each(spark, chain, inputs.sources(), parallel)
    steps = [step for chained in chains for step in chained]
    before = {step.step: step for step in steps}

    def table(name):
        source, _ = GOLD_JOBS[name]
        silver = before[f"silver/{source}"]
        if silver.status not in _DONE:
            return Step(f"gold/{name}", "SKIPPED", error=f"no Silver table of {source}")
        return _kept_or(
            ledger, f"gold/{name}", lambda: _gold_step(spark, name, layers), silver
        )

    wanted = [name for name, (source, _) in GOLD_JOBS.items() if source in inputs.sources()]
    with sized_for(spark, "gold", input_bytes):
        steps += _each(spark, table, wanted, parallel)
    return _finish(spark, steps, raise_on_error)


_DONE = ("OK", "KEPT")


def _kept_or(ledger, name, run, before=None):
    """The step as the ledger has it, or else as it runs now; it runs if the step before it ran."""
    noted = ledger.kept(name) if before is None or before.status == "KEPT" else None
    if noted is not None:
        return Step(name, "KEPT", noted["rows_in"], noted["rows_out"], 0.0, noted["path"])
    ledger.forget(name)
    return _noted(ledger, run())


def _noted(ledger, step):
    if step.status == "OK":
        ledger.note(step.step, step.rows_in, step.rows_out, step.path)
    return step


def _bronze_step(spark, source, inputs, layers, batch_ts, fmt=None, packed=True):
    readers = {
        "web": lambda: all_cards(
            read_raw_pages(
                spark,
                inputs.pages,
                inputs.raw_format,
                inputs.raw_partitions,
                inputs.pages_by_number,
                inputs.max_pages,
            ),
            max_pages=inputs.max_pages,
        ),
        "csv": lambda: all_records(spark, inputs.landing_csv),
        "api": lambda: all_works(
            read_raw_responses(spark, inputs.responses, inputs.raw_format, inputs.raw_partitions),
            subjects=inputs.subjects,
            limit=inputs.works_per_subject,
        ),
    }
    keep = {"web": F.col("valid"), "csv": ~F.col("overlong"), "api": F.col("valid")}[source]
    label = {"web": WEB_SOURCE, "csv": "csv", "api": API_SOURCE}[source]

    def shape(records):
        kept = records.filter(keep).drop("valid", "overlong")
        return add_lineage(kept, label, moment(batch_ts))

    return _run(
        f"bronze/{source}",
        _Work(
            readers[source],
            shape,
            lambda df: write_batch(df, layers, source, batch_ts, fmt, packed),
            lambda path: read_batch(spark, path, source, fmt),
        ),
    )


def _silver_step(spark, source, layers, batch_ts, read, buckets=None):
    if buckets:
        return _merge_step(spark, source, layers, batch_ts, read.get("fmt"), buckets)
    return _run(
        f"silver/{source}",
        _Work(
            lambda: read_bronze(spark, layers, source, **read),
            lambda df: SILVER_JOBS[source](df, batch_ts),
            lambda df: _publish(df, layers.silver_path(source), SILVER_CHECKS[source]),
            spark.read.parquet,
            by_footer=read.get("fmt") == "parquet",
            rows_in=batch_rows(spark, layers, source),
        ),
    )


def _merge_step(spark, source, layers, batch_ts, fmt, buckets):
    """As any step; `rows_in` are those of new batches, `rows_out` those of the whole table."""
    name, start, rows_in = f"silver/{source}", time.monotonic(), RowCount()
    seen = []

    def watch(rows, names):
        known = batch_rows(spark, layers, source, names)
        seen.append((rows, known))
        return rows if known is not None else rows_in.watch(rows)

    try:
        path = merge_silver(spark, layers, source, buckets, batch_ts, fmt, watch)
        rows, counted = seen[0] if seen else (None, 0)
        counted = rows_in.rows() if counted is None else counted
        counted = rows.count() if counted is None else counted
        rows_out = read_silver(spark, layers, source).count()  # from footers
        return Step(name, "OK", counted, rows_out, time.monotonic() - start, path)
    except Exception as error:  # a step reports its failure and lets the others run
        return Step(name, "ERROR", seconds=time.monotonic() - start, error=_reason(error))


def _gold_step(spark, table, layers, sketch_buckets=None):
    source, job = GOLD_JOBS[table]
    if sketch_buckets and table == "books_by_year":
        return _years_step(spark, layers, sketch_buckets)
    return _run(
        f"gold/{table}",
        _Work(
            lambda: read_silver(spark, layers, source),
            job,
            lambda df: _publish(df, layers.gold_path(table), GOLD_CHECKS[table]),
            spark.read.parquet,
            by_footer=True,
        ),
    )


def _years_step(spark, layers, buckets):
    name, start = "gold/books_by_year", time.monotonic()
    try:
        path = merge_years(spark, layers, buckets)
        rows = [read_silver(spark, layers, "csv").count(), spark.read.parquet(path).count()]  # from footers
        return Step(name, "OK", *rows, time.monotonic() - start, path)
    except Exception as error:  # a step reports its failure and lets the others run
        return Step(name, "ERROR", seconds=time.monotonic() - start, error=_reason(error))


def _publish(df, path, checks):
    return publish_table(df, path, checks, lambda own, folder: overwrite_table(own, folder))


def _run(name, work):
    start = time.monotonic()
    try:
        rows_in, rows_out = RowCount(), RowCount()
        source = work.read()
        unwatched = work.by_footer or work.rows_in is not None
        watched = source if unwatched else rows_in.watch(source)
        path = work.write(rows_out.watch(work.shape(watched)))
        # Spark drops the observations of a plan it finds to be empty at run time.
        counted_in = work.rows_in if unwatched else rows_in.rows()
        counted_out = rows_out.rows()
        return Step(
            name,
            "OK",
            source.count() if counted_in is None else counted_in,
            work.reread(path).count() if counted_out is None else counted_out,
            time.monotonic() - start,
            path,
        )
    except Exception as error:  # a step reports its failure and lets the others run
        return Step(name, "ERROR", seconds=time.monotonic() - start, error=_reason(error))


def _reason(error):
    """The innermost message, whole."""
    cause = getattr(error, "java_exception", None)
    while cause is not None and cause.getCause() is not None:
        cause = cause.getCause()
    text = str(error) if cause is None else cause.toString()
    return text.strip() or repr(error)


def _each(spark, job, items, parallel):
    if not parallel or len(items) < 2:
        return [job(item) for item in items]
    with ThreadPoolExecutor(len(items)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(job), items))


def _finish(spark, steps, raise_on_error):
    status = spark.createDataFrame([step.row() for step in steps], STEP_STATUS)
    failed = [step for step in steps if step.status == "ERROR"]
    if failed and raise_on_error:
        raise StepsFailed(failed, status)
    return status
