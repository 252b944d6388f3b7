"""Bronze batches in their own time-stamped folder; Silver and Gold tables replaced whole."""

from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..operators.quality import quality_report, violations
from ..sources.layers import batch_format, read_batch
from .switch import Store, settle, staging_folder, switch

# Keeps a CSV file, which may not be split, within the size of one task.
CSV_ROWS_PER_FILE = 500_000
# Likewise a packed JSON file. Packed quickly, lines of JSON take a third of their size.
_PACKED = {
    "json": {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000},
}
# Of tables, whose rows are written more often than they are read.
_TABLE_CODEC = "zstd"

_WRITE_OPTIONS = {
    "csv": {
        "header": True,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "maxRecordsPerFile": CSV_ROWS_PER_FILE,
    },
    "json": {"ignoreNullFields": False},
    "parquet": {},
}
_ROWS = "_rows"  # readers skip files with such a name
_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def batch_name(batch_ts, fmt):
    return f"books_{batch_ts:%Y%m%d_%H%M%S}.{fmt}"


def write_batch(df, layers, source, batch_ts=None, fmt=None, packed=False):
    """Write one batch of a Bronze source and return its path.

    `packed` compresses JSON, which all readers here take as it is. CSV stays plain, so that its files
    can be read in splits.

    Earlier batches stay. Writing the same batch again replaces it, so a retry adds nothing. The number
    of its rows is stored with it: the last stage of a write counts each task's rows once, however
    often the task ran, and later steps need not count what they read.
    """
    fmt = fmt or batch_format(source)
    batch_ts = batch_ts or datetime.now(timezone.utc)
    path = f"{layers.bronze_path(source)}/{batch_name(batch_ts, fmt)}"
    count = RowCount()
    writer = count.watch(df).write.mode("overwrite").format(fmt).options(**_WRITE_OPTIONS[fmt])
    if packed:
        writer = writer.options(**_PACKED.get(fmt, {}))
    if fmt in ("csv", "json"):
        writer = writer.option("timestampFormat", _TIMESTAMP)
    writer.save(path)
    rows = count.rows()
    rows = read_batch(df.sparkSession, path, source, fmt).count() if rows is None else rows
    Store(df.sparkSession, path).write(f"{path}/{_ROWS}", str(rows))
    return path


def batch_rows(spark, layers, source, names=None):
    """Rows of the named Bronze batches, or of all, as stored when they were written.

    None if a batch was written by others, without its number.
    """
    folder = layers.bronze_path(source)
    store, total = Store(spark, folder), 0
    for name in store.written(folder) if names is None else names:
        if not store.exists(f"{folder}/{name}/{_ROWS}"):
            return None
        total += int(store.read(f"{folder}/{name}/{_ROWS}"))
    return total


class TableRejected(RuntimeError):
    """What was to replace a table broke its checks; `report` holds the broken ones."""

    def __init__(self, path, report):
        broken = ", ".join(f"{row['check']}({row['column']}): {row['failed_rows']}" for row in report)
        super().__init__(f"{path} was not replaced: {broken}")
        self.report = report


def overwrite_table(df, path):
    """Replace a Parquet table.

    A table that is there is replaced once the new one is complete: if the write fails, the old rows
    stay. The plan of `df` may read the same path.
    """
    spark = df.sparkSession
    settle(spark, path)
    if not Store(spark, path).exists(path):
        df.write.mode("overwrite").parquet(path, compression=_TABLE_CODEC)
        return path
    staged = staging_folder(path)
    _write_or_clear(spark, staged, lambda: df.write.parquet(staged, compression=_TABLE_CODEC))
    switch(spark, staged, path)
    return path


def publish_table(df, path, checks=(), write=overwrite_table, parts=None):
    """Write a table, check what was written, and only then let it replace the one at `path`.

    `write(df, folder)` fills a new folder. A broken check raises TableRejected, and the old rows stay.
    The checks read the written columns they name, in one aggregation. `parts` names the sub-folders
    to replace, if not all.
    """
    spark = df.sparkSession
    settle(spark, path)
    staged = staging_folder(path)

    def checked():
        write(df, staged)
        if checks:
            broken = violations(quality_report(spark.read.schema(df.schema).parquet(staged), checks))
            found = broken.collect()  # one row a check
            if found:
                raise TableRejected(path, found)

    _write_or_clear(spark, staged, checked)
    switch(spark, staged, path, parts)
    return path


def _write_or_clear(spark, staged, work):
    try:
        work()
    except BaseException:
        Store(spark, staged).delete(staged.rpartition("/")[0])
        raise


class RowCount:
    """Rows passing a point of a plan, counted by the job that runs the plan."""

    def __init__(self):
        self._seen = Observation()

    def watch(self, df):
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"))

    def rows(self):
        """The count, or None where Spark found the plan empty and dropped the observation.

        Call after an action that succeeded: then nothing else can be missing.
        """
        try:
            return self._seen.get.get("rows")
        except Py4JJavaError:
            return None
