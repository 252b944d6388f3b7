"""Silver from new Bronze batches only: a table in hash buckets, of which a batch rewrites its own.

What decides between copies of a key is lost in the finished table, as it is trimmed and cast there. So
the rows that were kept are stored as they compare, in the same buckets, beside the table. A batch is
deduplicated by itself, meets the stored rows of the buckets it has keys in, and these buckets are
written anew; no other is read. The largest row of a key is the same in whatever order batches come, so
that the table is what a run over all batches would make of them.

The table of years can follow in the same way: sketches of each bucket are kept, those of buckets that
were written anew are made again, and all are put together without reading the other books.

A ledger names the batches that are in, with the time they were written. It comes last: a merge that
breaks off is done again, with the same result. If a batch has gone or was written again, or
the table was replaced by a full run, all is made anew.
"""

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rows import dedup_latest
from ..schemas import SILVER
from ..sinks.switch import MissingTable, Store, require_table, settle, staging_folder, switch
from ..sinks.tables import publish_table
from ..sources.layers import read_batch, read_bronze
from .gold import GOLD_CHECKS, gold_by_year_of, year_sketches
from .silver import SILVER_CHECKS, SILVER_JOBS

BUCKET = "bucket"


@dataclass(frozen=True)
class Merge:
    """The places and the state of one source's table."""

    spark: object
    layers: object
    source: str
    buckets: int
    fmt: str | None = None

    @property
    def table(self):
        return self.layers.silver_path(self.source)

    @property
    def state(self):
        return f"{self.layers.silver.rstrip('/')}/_kept/{self.source}-{self.buckets}"

    @property
    def ledger(self):
        return f"{self.state}.json"

    @property
    def job(self):
        return SILVER_JOBS[self.source]

    def batches(self):
        """Bronze batches and the time each was written."""
        folder = self.layers.bronze_path(self.source)
        return Store(self.spark, folder).written(folder)

    def merged(self):
        """The batches that are in the table, or None if it must be made anew."""
        settle(self.spark, self.state)
        settle(self.spark, self.table)
        store = Store(self.spark, self.state)
        if not store.exists(self.ledger):
            return None
        ledger = self.read_ledger()
        now = self.batches()
        if any(now.get(name) != time for name, time in ledger["batches"].items()):
            return None
        # A full run leaves files of no bucket.
        names = store.names(self.table)
        whole = "_SUCCESS" in names and not any(name.startswith("part-") for name in names)
        return ledger["batches"] if whole else None

    def read_ledger(self):
        return json.loads(Store(self.spark, self.state).read(self.ledger))

    def write_ledger(self, batches, touched):
        """Note the batches that are in, and the buckets that were written now; None: all."""
        written = {} if touched is None else self.read_ledger()["written"]
        touched = range(self.buckets) if touched is None else touched
        written |= {str(bucket): uuid.uuid4().hex for bucket in touched}
        text = json.dumps({"batches": batches, "written": written})
        Store(self.spark, self.state).write(self.ledger, text)

    def schema(self):
        return T.StructType([*SILVER[self.source], T.StructField(BUCKET, T.IntegerType())])

    def new_rows(self, done):
        """Bronze rows of the batches that are not in yet."""
        if done is None:
            return read_bronze(self.spark, self.layers, self.source, self.fmt)
        folder = self.layers.bronze_path(self.source)
        names = [name for name in sorted(self.batches()) if name not in done]
        parts = [read_batch(self.spark, f"{folder}/{name}", self.source, self.fmt) for name in names]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows

    def bucketed(self, rows):
        bucket = F.pmod(F.xxhash64(self.job.key), F.lit(self.buckets)).cast("int")
        return rows.withColumn(BUCKET, F.coalesce(bucket, F.lit(0)))

    def kept_rows(self, schema, touched):
        """The stored rows of some buckets; the scan reads no others."""
        require_table(self.spark, self.state)
        rows = self.spark.read.schema(schema).parquet(self.state)
        return rows.filter(F.col(BUCKET).isin(touched))


def _write_buckets(rows, folder, count):
    """One file a bucket."""
    rows.repartition(max(1, count), BUCKET).write.partitionBy(BUCKET).parquet(folder)


def _buckets_in(store, folder):
    prefix = f"{BUCKET}="
    return sorted(int(name.removeprefix(prefix)) for name in store.names(folder) if name.startswith(prefix))


def merge_silver(spark, layers, source, buckets, batch_ts=None, fmt=None, watch=None):
    """Bring a Silver table in `buckets` buckets up to date with Bronze; returns its path.

    Without new batches nothing is written. `watch(rows, batches)` sees the Bronze rows that are read, and
    the names of their batches. Every bucket is
    one task and one file: choose `buckets` for the size the table will have. Rows carry the
    `transformed_at` of the run that last rewrote their bucket. Another number of buckets makes the
    table anew.
    """
    own = Merge(spark, layers, source, buckets, fmt)
    done = own.merged()
    now = own.batches()
    if done is not None and set(done) == set(now):
        return own.table
    store = Store(spark, own.state)

    # The batch, deduplicated and in buckets: small against the table.
    rows = own.new_rows(done)
    if watch is not None:
        rows = watch(rows, sorted(set(now) - set(done or ())))
    batch = own.bucketed(own.job.deduplicated(rows))
    staged = [staging_folder(f"{own.state}-batch"), staging_folder(own.state)]
    try:
        _write_buckets(batch, staged[0], buckets)
        touched = _buckets_in(store, staged[0])
        rows = spark.read.schema(batch.schema).parquet(staged[0])
        parts = None
        if done is not None:
            parts = [f"{BUCKET}={bucket}" for bucket in touched]
            rows = rows.unionByName(own.kept_rows(batch.schema, touched))
            rows = rows.repartition(max(1, len(touched)), BUCKET)  # by which keys lie together too
            rows = dedup_latest(rows, [BUCKET, own.job.key], ["extracted_at"])
            _write_buckets(rows, staged[1], len(touched))
            rows = spark.read.schema(batch.schema).parquet(staged[1])
        publish_table(
            own.job.finish(rows, batch_ts).select(*SILVER[source].names, BUCKET),
            own.table,
            SILVER_CHECKS[source],
            lambda df, folder: _write_buckets(df, folder, len(touched)),
            parts,
        )
        switch(spark, staged[0] if done is None else staged[1], own.state, parts)
    finally:
        for folder in staged:
            store.delete(folder.rpartition("/")[0])
    own.write_ledger(now, None if done is None else touched)
    return own.table


def merge_years(spark, layers, buckets):
    """Bring the Gold table of years up to date with a Silver table in buckets; returns its path.

    Authors and publishers are estimated. Only Silver buckets that were written since the last time
    are read; the rest comes from kept sketches, one row a bucket and year.
    """
    books = Merge(spark, layers, "csv", buckets)
    if books.merged() is None:
        raise MissingTable(f"{books.table} has not been merged into {buckets} buckets")
    written = books.read_ledger()["written"]
    state = f"{layers.gold.rstrip('/')}/_kept/books_by_year-{buckets}"
    settle(spark, state)
    store, ledger = Store(spark, state), f"{state}.json"
    seen = json.loads(store.read(ledger)) if store.exists(ledger) else None
    changed = [int(k) for k, time in written.items() if seen is None or seen.get(k) != time]
    if changed or seen is None:
        silver = spark.read.schema(books.schema()).parquet(require_table(spark, books.table))
        sketches = year_sketches(silver.filter(F.col(BUCKET).isin(changed)), BUCKET)
        staged = staging_folder(state)
        try:
            _write_buckets(sketches, staged, len(changed))
            # A bucket may have lost its last book.
            for bucket in set(changed) - set(_buckets_in(store, staged)):
                store.make_folder(f"{staged}/{BUCKET}={bucket}")
            parts = None if seen is None else [f"{BUCKET}={bucket}" for bucket in changed]
            switch(spark, staged, state, parts)
        finally:
            store.delete(staged.rpartition("/")[0])
        store.write(ledger, json.dumps(written))
    sketches = spark.read.schema(_SKETCHES).parquet(require_table(spark, state))
    return publish_table(
        gold_by_year_of(sketches), layers.gold_path("books_by_year"), GOLD_CHECKS["books_by_year"]
    )


_SKETCHES = "year int, nombre_livres long, nombre_auteurs binary, nombre_editeurs binary, bucket int"

