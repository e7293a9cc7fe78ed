"""The agent registry: one JSON file per agent, or a table of accepted submissions.

The table is what lies in its folder, if anything, and what was added to it since: ``<folder>-added/verdicts`` holds the judged submissions of each
addition, ``<folder>-added/log`` their numbers. An addition without a number, of a writer that failed or lost, is not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from issuetrail.functions.text import decoded_path, identifier_from_file
from issuetrail.operators.registration import accepted_agents, validate_submissions
from issuetrail.sources.commits import claim, last_number, read_log
from issuetrail.sources.ledger import read_or_none
from issuetrail.sources.schemas import AGENT, REGISTRY, VERDICT


def read_registry_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per ``*.json`` file at any depth, whatever its status; the identifier is the file's base name.

    A file that does not hold one JSON object gives a row of NULLs, so it is counted but never
    active. Hidden folders are skipped by the reader.
    """
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    # as the only element of an array, a text with more than one value or with trailing text does not parse or counts as several
    single = F.size(F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>")) == 1
    entry = F.when(F.col("value").rlike(r"^\s*\{") & single, F.from_json("value", AGENT)).alias("entry")
    return files.select(
        entry,
        identifier_from_file(F.col("_metadata.file_name")).alias("github_identifier"),
        decoded_path(F.col("_metadata.file_path")).alias("file_path"),
    ).select("entry.*", "github_identifier", "file_path")


def write_registry_files(agents: DataFrame, folder: str, shelves: int = 64) -> None:
    """One JSON file per row, dealt over folders that tasks write and commit side by side and that a reader lists side by side.

    A task's files go to their place as it ends (the second form of Spark's file committer); the first has the driver move all of them, one after the other.
    """
    shelf = F.pmod(F.xxhash64(*agents.columns), F.lit(shelves)).alias("shelf")
    dealt = agents.select("*", shelf).repartition(shelves, "shelf")
    files = dealt.write.partitionBy("shelf").option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    files.json(folder)


def read_registry_table(spark: SparkSession, folder: str, up_to: int | None = None) -> DataFrame:
    """One row per identifier: what was added last, or last up to a number. Rows that lay in the folder before are the oldest, by their time if they have one."""
    columns = [*StructType.fromDDL(REGISTRY).names, "added_at", "number"]
    found = []
    base = read_or_none(spark, folder, f"{REGISTRY}, added_at timestamp")
    if base is not None:
        found.append(base.withColumn("number", F.lit(0).cast("bigint")))
    verdicts = read_or_none(spark, f"{folder}-added/verdicts", VERDICT)
    if verdicts is not None:
        log = read_log(spark, f"{folder}-added/log")
        numbered = verdicts.join(log if up_to is None else log.where(F.col("number") <= up_to), "commit")
        found.append(accepted_agents(numbered, "number").withColumn("added_at", F.lit(None).cast("timestamp")))
    if not found:
        return spark.createDataFrame([], REGISTRY)
    rows = reduce(DataFrame.unionByName, found).select(*columns)
    fields = [c for c in rows.columns if c not in ("github_identifier", "number", "added_at")]
    latest = rows.groupBy("github_identifier").agg(F.max(F.struct("number", "added_at", *fields)).alias("entry"))
    return latest.select(*[F.col(c if c == "github_identifier" else f"entry.{c}").alias(c) for c in rows.columns if c not in ("number", "added_at")])


@dataclass(frozen=True)
class Addition:
    """Submissions judged by the registry as it stood at a number; their verdicts are written, but not yet committed."""

    spark: SparkSession
    folder: str
    seen: int
    name: str

    def commit(self) -> bool:
        """Adds the accepted ones as the next number. False if another writer has taken it, so that they have to be judged again."""
        return claim(self.spark, f"{self.folder}-added/log", self.seen + 1, self.name)

    def verdicts(self) -> DataFrame:
        """The submissions with status and reason, as they were written."""
        return self.spark.read.parquet(f"{self.folder}-added/verdicts/commit={self.name}")


def _written(validated: DataFrame, folder: str, seen: int) -> Addition:
    addition = Addition(validated.sparkSession, folder, seen, uuid.uuid4().hex)
    validated.write.parquet(f"{folder}-added/verdicts/commit={addition.name}")
    return addition


def propose(submissions: DataFrame, users: DataFrame, folder: str, order_by: str) -> Addition:
    """Judges submissions by the registry as it stands and writes the verdicts; see ``validate_submissions``."""
    spark = submissions.sparkSession
    seen = last_number(spark, f"{folder}-added/log")
    return _written(validate_submissions(submissions, read_registry_table(spark, folder, seen), users, order_by), folder, seen)


def register(submissions: DataFrame, users: DataFrame, folder: str, order_by: str) -> DataFrame:
    """Judges submissions, adds the accepted ones and returns the verdicts.

    Several writers may do so at once: one that comes second judges again by what the first has added, so an identifier is accepted once.
    """
    while not (addition := propose(submissions, users, folder, order_by)).commit():
        pass
    return addition.verdicts()


def append_to_registry(validated: DataFrame, folder: str) -> None:
    """Adds the accepted submissions as they are judged already; they take the place of older rows of their identifiers."""
    spark, log = validated.sparkSession, f"{folder}-added/log"
    addition = _written(validated, folder, last_number(spark, log))
    while not addition.commit():
        addition = Addition(spark, folder, last_number(spark, log), addition.name)
