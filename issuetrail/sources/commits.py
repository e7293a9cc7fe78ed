"""Numbered commits: of several writers that go for the same number, one gets it."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "number bigint, commit string"


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """The commits of a log: number and what was committed under it."""
    try:
        lines = spark.read.text(folder)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)
    return lines.select(F.col("_metadata.file_name").cast("bigint").alias("number"), F.col("value").alias("commit"))


def last_number(spark: SparkSession, folder: str) -> int:
    """The greatest number of a log, 0 before the first commit."""
    return read_log(spark, folder).agg(F.max("number")).first()[0] or 0


def claim(spark: SparkSession, folder: str, number: int, commit: str) -> bool:
    """Commits under the number unless another writer has; says whether it did.

    The entry is written under a hidden name and then renamed without overwriting, as streaming queries commit their epochs. The file
    system has to do that in one step, as HDFS does; a local one does it for the writers of one machine only as far as they don't meet within it.
    """
    context = spark.sparkContext
    hadoop, configuration = context._jvm.org.apache.hadoop.fs, context._jsc.hadoopConfiguration()
    draft, entry = hadoop.Path(f"{folder}/.{uuid.uuid4().hex}"), hadoop.Path(f"{folder}/{number:012d}")
    files = draft.getFileSystem(configuration)
    out = files.create(draft)
    out.write(bytearray(commit.encode()))
    out.close()
    no_options = context._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(files.getUri(), configuration).rename(draft, entry, no_options)
    except Py4JJavaError as fault:
        if not fault.java_exception.getClass().getName().endswith(".FileAlreadyExistsException"):
            raise
        files.delete(draft, False)
        return False
    return True
