"""Session set-up and the folders the jobs share."""

import os
import tempfile
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Sizes a shuffle for large inputs: many small initial partitions, which
# adaptive execution merges up to the advisory size.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.variant.allowDuplicateKeys": "true",
}
# A reducer of this size sorts with spill; more reducers than the cap would cost more in map output
# indexes than they save.
_SHUFFLE_TARGET_BYTES = 1 << 30
_MOST_PARTITIONS = 50_000
# Share of the input that the steps of a layer shuffle: rows to be deduplicated move whole, the sums
# of a Gold table are partial, and extraction moves nothing.
MOVED_SHARE = {"bronze": 0.0, "silver": 1.0, "gold": 0.01}


@dataclass(frozen=True)
class ObjectStore:
    """An S3-compatible store. Without keys the default credential chain applies."""

    endpoint: str | None = None
    access_key: str | None = None
    secret_key: str | None = None
    path_style: bool = True
    tls: bool = False

    @classmethod
    def from_env(cls, env=os.environ):
        return cls(
            endpoint=env.get("S3_ENDPOINT_URL"),
            access_key=env.get("AWS_ACCESS_KEY_ID"),
            secret_key=env.get("AWS_SECRET_ACCESS_KEY"),
        )

    def conf(self):
        conf = {
            "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
            "spark.hadoop.fs.s3a.path.style.access": str(self.path_style).lower(),
            "spark.hadoop.fs.s3a.connection.ssl.enabled": str(self.tls).lower(),
        }
        for key, value in (
            ("endpoint", self.endpoint),
            ("access.key", self.access_key),
            ("secret.key", self.secret_key),
        ):
            if value is not None:
                conf[f"spark.hadoop.fs.s3a.{key}"] = value
        return conf


@dataclass(frozen=True)
class Layers:
    """Root URI of each layer; any scheme Spark can write to."""

    bronze: str = "s3a://bronze"
    silver: str = "s3a://silver"
    gold: str = "s3a://gold"

    @classmethod
    def from_env(cls, env=os.environ):
        roots = {name: env.get(f"{name.upper()}_ROOT") for name in ("bronze", "silver", "gold")}
        return cls(**{name: root for name, root in roots.items() if root})

    @classmethod
    def under(cls, root):
        root = root.rstrip("/")
        return cls(f"{root}/bronze", f"{root}/silver", f"{root}/gold")

    def bronze_path(self, source):
        return f"{self.bronze.rstrip('/')}/{source}"

    def silver_path(self, source):
        return f"{self.silver.rstrip('/')}/{source}"

    def gold_path(self, table):
        return f"{self.gold.rstrip('/')}/{table}"


@dataclass(frozen=True)
class SessionSpec:
    app_name: str = "shelfmark"
    master: str | None = None
    jars: tuple[str, ...] = ()
    store: ObjectStore | None = None
    extra: dict = field(default_factory=dict)

    def conf(self):
        conf = dict(_BASE_CONF)
        if self.jars:
            conf["spark.jars"] = ",".join(self.jars)
        if self.store is not None:
            conf.update(self.store.conf())
        conf.update(self.extra)
        return conf


def shuffle_partitions(moved_bytes, floor=200, cap=_MOST_PARTITIONS):
    """Shuffle partitions for so many shuffled bytes; adaptive execution merges small ones."""
    return min(cap, max(floor, -(-int(moved_bytes) // _SHUFFLE_TARGET_BYTES)))


@contextmanager
def sized_for(spark, layer, input_bytes):
    """The shuffle partitions of a layer's steps while it runs; as before if the size is unknown."""
    if input_bytes is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(shuffle_partitions(input_bytes * MOVED_SHARE[layer])))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build_session(spec=SessionSpec()):
    builder = SparkSession.builder.appName(spec.app_name)
    if spec.master is not None:
        builder = builder.master(spec.master)
    for key, value in spec.conf().items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_folder(spark, label):
    """A new folder every executor can reach, under the cluster's checkpoint folder.

    A machine-local folder is used only by a local session that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
