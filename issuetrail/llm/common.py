"""What several operators share: reading tables, ASCII lower case, words, folds, folders, checkpoints."""

from __future__ import annotations

import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words end at ASCII white space only.
SPACE = r"[\x20\x09-\x0D]+"
LEAST, MOST = -(2**63), 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    is_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """The array of words of a text; empty for a text without any."""
    return F.filter(F.split(text, SPACE), lambda word: word != "")


def fold(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def folder(spark: SparkSession) -> str:
    """A new folder's path under the session's shared folder. Only a local session may fall back to a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        base = tempfile.mkdtemp(prefix="issuetrail-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def checkpointed(frame: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder, with their lineage cut."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder(frame.sparkSession))
    return frame.checkpoint(eager=True)


def written(frame: DataFrame) -> DataFrame:
    """The same rows, as a table in the shared folder.

    For the small side of a join whose other side may have a hot key: Spark splits that key only if both sides come straight from a shuffle, not if an
    aggregation, or a checkpoint of one, has placed the rows already.
    """
    path = folder(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def pieces(batches, size: int = 2_000_000):
    """Batches (pandas) cut into runs of rows whose texts have about `size` characters together; a longer text is a piece of its own."""
    for batch in batches:
        batch = batch.reset_index(drop=True)
        ends = batch["text"].str.len().to_numpy().cumsum()
        start = 0
        while start < len(batch):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(ends.searchsorted(base + size, "right")))
            yield batch.iloc[start:stop].reset_index(drop=True)
            start = stop
