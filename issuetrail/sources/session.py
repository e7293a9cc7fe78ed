"""Session settings the library relies on, and the shared folder it may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Times are UTC throughout; a session in another zone would move them."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Bytes of archive files that a task reads; gzipped lines of events are twenty to thirty times as long. And the longest
# method that the JVM compiles: Spark's own limit lets the generated code of a scan grow longer, and then it is interpreted.
SCAN_SETTINGS = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.codegen.hugeMethodLimit": 8000}


@contextmanager
def small_scans(spark: SparkSession) -> Iterator[None]:
    """Within, a task is dealt a few files of an archive or one larger file, and its code is such that the JVM compiles it.

    Spark deals files by their size on disk. Of gzipped ones its default is gigabytes of text a task, all of which the sort before a partitioned
    write holds or spills. What the session had, if less, stands.
    """
    before = {name: spark.conf.get(name) for name in SCAN_SETTINGS}
    for name, most in SCAN_SETTINGS.items():
        plain = before[name].lower().removesuffix("b")
        if not plain.isdigit() or int(plain) > most:
            spark.conf.set(name, str(most))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# Fixed value: files that a task of a partitioned write has open at a time, each with its compressor and buffers.
OPEN_FILES = 100


@contextmanager
def side_by_side_writers(spark: SparkSession) -> Iterator[None]:
    """Within, a task of a partitioned write keeps a file open for each partition that it meets, and sorts only what it has beyond that many.

    Without, it sorts all its rows first. What the session had, if not nothing, stands.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    if int(before) <= 0:
        spark.conf.set(name, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a write go when it has ended.

    Without, they stay until the driver happens to collect the objects that stand for them, which one with much memory may never do.
    """
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


# Fixed value: how tables that a run keeps are compressed. Their texts are long and alike; Spark's default leaves them about twice as large.
KEPT_CODEC = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables.

    Only a local session may fall back to a temporary folder: there the driver and the
    executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="issuetrail-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
