"""Results of a run: one table per part, one JSON document of all parts, or several documents with a slice of each.

The tables are the scalable form. A document is written as lines, each with one entry, in files whose names give their order: joined, they are the
document, and no row or task holds more than entries of its own. Several documents hold a slice of every part each; they are independent and their
union is the result.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.functions.timestamps import MISSING
from issuetrail.operators.leaderboard import NO_WEBSITE, UNKNOWN_NAME
from issuetrail.operators.ranking import numbered
from issuetrail.sources.schemas import DOCUMENT, ISSUE, LEADERBOARD, METADATA, MONTHLY, RUN
from issuetrail.sources.schemas import struct_fields as _fields

PARTS = {"leaderboard": LEADERBOARD, "monthly": MONTHLY, "wanted": ISSUE, "run": RUN}


@dataclass(frozen=True)
class Results:
    leaderboard: DataFrame
    monthly: DataFrame
    wanted: DataFrame
    run: DataFrame

    def parts(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in PARTS}


def write_results(results: Results, folder: str) -> None:
    for name, part in results.parts().items():
        part.write.mode("overwrite").parquet(f"{folder}/{name}")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema
    except Exception as missing:  # the reader's only way to say so
        if "PATH_NOT_FOUND" in str(missing):
            return False
        raise
    return True


def read_results(spark: SparkSession, folder: str) -> Results:
    """The parts as written; a part that is not there is empty, with the right columns."""
    def part(name: str, schema: str) -> DataFrame:
        path = f"{folder}/{name}"
        if not _exists(spark, path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(path)

    return Results(**{name: part(name, schema) for name, schema in PARTS.items()})


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("bigint").alias("shard")


def documents(results: Results, shards: int) -> DataFrame:
    """``shards`` rows, each one JSON document with a slice of every part. Choose shards so that a slice fits into a row; ``write_documents`` has no such bound.

    Entries without an identifier or agent name are left out: these are the keys of their parts.
    """
    spark = results.leaderboard.sparkSession
    entry = F.struct("name", "website", "github_identifier", "resolved_issues")
    board = (
        results.leaderboard.where(F.col("github_identifier").isNotNull())
        .groupBy(_shard(F.col("github_identifier"), shards))
        .agg(F.sort_array(F.collect_list(F.struct("github_identifier", entry.alias("entry")))).alias("entries"))
        .select("shard", F.map_from_entries("entries").alias("leaderboard"))
    )
    # One row per agent first, then one per shard: an agent's list is as long as the window has months.
    cells = F.array_sort(F.collect_list(F.struct("month", "resolved")))
    per_agent = results.monthly.where(F.col("agent_name").isNotNull()).groupBy("agent_name").agg(cells.alias("cells"))
    series = F.struct(F.col("cells.resolved").alias("monthly_resolved"))
    monthly = (
        per_agent.groupBy(_shard(F.col("agent_name"), shards))
        .agg(
            F.sort_array(F.collect_list(F.struct("agent_name", series.alias("series")))).alias("entries"),
            F.max("cells.month").alias("months"),
        )
        .select(
            "shard",
            F.struct(
                F.col("entries.agent_name").alias("agents"),
                F.col("months").alias("months"),
                F.map_from_entries("entries").alias("data"),
            ).alias("monthly_metrics"),
        )
    )
    issue = F.struct("url", "repo", "title", "number", "state", "created_at", "closed_at", "labels")
    wanted = results.wanted.groupBy(_shard(F.col("url"), shards)).agg(
        F.sort_array(F.collect_list(issue)).alias("wanted_issues")
    )
    run = results.run.select(
        "last_updated",
        F.struct(*[c for c in results.run.columns if c != "last_updated"]).alias("metadata"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"),
    )
    empty = F.from_json(
        F.lit('{"leaderboard":{},"monthly_metrics":{"agents":[],"months":[],"data":{}},"wanted_issues":[]}'), DOCUMENT
    )
    whole = (
        run.join(board, "shard", "left")
        .join(monthly, "shard", "left")
        .join(wanted, "shard", "left")
        .withColumn("empty", empty)
    )
    keys = ["leaderboard", "monthly_metrics", "wanted_issues"]
    document = F.struct(
        "last_updated", *[F.coalesce(F.col(k), F.col(f"empty.{k}")).alias(k) for k in keys], "metadata"
    )
    return whole.select("shard", F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))


def write_documents(results: Results, folder: str, shards: int) -> None:
    """Writes ``shards`` documents as lines, each as ``write_document`` writes one: ``document=<n>/section=<n>/part-*``.

    As in the rows of ``documents``, an identifier that occurs twice is an error.
    """
    entry = F.struct("github_identifier", F.struct(*results.leaderboard.columns))
    named = results.leaderboard.where(F.col("github_identifier").isNotNull()).groupBy("github_identifier")
    board = named.agg(F.map_from_entries(F.collect_list(entry)).alias("entries")).select(F.explode("entries").alias("key", "entry")).select("entry.*")
    _write_lines(document_lines(replace(results, leaderboard=board), shards), folder, "document", "section")


#: The sections of the document in their order: what opens each, and how one entry of it is read back.
_SECTIONS = ("head", "leaderboard", "agents", "months", "data", "wanted", "tail")
_OPENING = {"leaderboard": '"leaderboard":{', "agents": '},"monthly_metrics":{"agents":[', "months": '],"months":[', "data": '],"data":{', "wanted": '}},"wanted_issues":[', "tail": "]}"}


def document_lines(results: Results, shards: int = 1) -> DataFrame:
    """(document, section, key, line): the documents as lines in the order of section and key, an entry a line; entries of a section are parted by commas before them.

    Entries without an identifier or agent name are left out: these are the keys of their parts.
    """
    spark = results.run.sparkSession
    numbers = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("document")

    def named(key: Column, value: Column) -> Column:
        return F.concat(quoted(key), F.lit(":"), F.to_json(value, {"ignoreNullFields": "false"}))

    def quoted(key: Column) -> Column:
        """A text as JSON: what is between the brackets of a list of it."""
        return F.regexp_extract(F.to_json(F.array(key)), r"(?s)^\[(.*)\]$", 1)

    def dealt(key: Column) -> Column:
        return _shard(key, shards).cast("int").alias("document")

    board = results.leaderboard.where(F.col("github_identifier").isNotNull())
    cells = F.array_sort(F.collect_list(F.struct("month", "resolved")))
    agents = results.monthly.where(F.col("agent_name").isNotNull()).groupBy("agent_name").agg(cells.alias("cells"))
    months = results.monthly.where(F.col("agent_name").isNotNull()).select(dealt(F.col("agent_name")), "month").distinct()
    issue = F.struct("url", "repo", "title", "number", "state", "created_at", "closed_at", "labels")
    entries = {
        "leaderboard": board.select(dealt(F.col("github_identifier")), F.col("github_identifier").alias("key"), named(F.col("github_identifier"), F.struct("name", "website", "github_identifier", "resolved_issues")).alias("line")),
        "agents": agents.select(dealt(F.col("agent_name")), F.col("agent_name").alias("key"), quoted(F.col("agent_name")).alias("line")),
        "months": months.select("document", F.col("month").alias("key"), quoted(F.col("month")).alias("line")),
        "data": agents.select(dealt(F.col("agent_name")), F.col("agent_name").alias("key"), named(F.col("agent_name"), F.struct(F.col("cells.resolved").alias("monthly_resolved"))).alias("line")),
        "wanted": results.wanted.select(dealt(F.col("url")), F.coalesce("url", F.lit("")).alias("key"), F.to_json(issue, {"ignoreNullFields": "false"}).alias("line")),
    }
    metadata = F.struct(*[c for c in results.run.columns if c != "last_updated"])
    opening = F.to_json(F.struct("last_updated", metadata.alias("metadata")), {"ignoreNullFields": "false"})
    # the object stays open
    lines = results.run.select(numbers, F.lit(0).alias("section"), F.lit("").alias("key"), F.concat(opening.substr(F.lit(1), F.length(opening) - 1), F.lit(",")).alias("line"))
    for number, name in enumerate(_SECTIONS[1:], 1):
        opened = spark.createDataFrame([(number, None, _OPENING[name])], "section int, key string, line string").select(numbers, "*")
        lines = lines.unionByName(opened)
        if name in entries:
            lines = lines.unionByName(entries[name].select("document", F.lit(number).alias("section"), "key", "line"))
    return lines


def _write_lines(lines: DataFrame, folder: str, *within: str) -> None:
    """Lines of documents in folders by ``within``, in files whose names give their order.

    Lines are dealt out by ranges and numbered, so that all entries of a section but its first get their comma.
    """
    order = [F.asc("document"), F.asc("section"), F.asc_nulls_first("key"), F.asc("line")]
    ranked = numbered(lines, order)
    # the line after an opening is the first entry of its section
    openings = ranked.where(F.col("key").isNull()).select((F.col("rank") + 1).alias("rank"), F.lit(True).alias("leads"))
    marked = ranked.join(F.broadcast(openings), "rank", "left")
    parted = F.col("key").isNotNull() & F.col("leads").isNull() & (F.col("section") > 0)
    text = F.when(parted, F.concat(F.lit(","), F.col("line"))).otherwise(F.col("line"))
    dealt = marked.select("document", "section", "rank", text.alias("value")).repartitionByRange("rank").sortWithinPartitions("document", "section", "rank")
    dealt.select(*within, "value").write.mode("overwrite").partitionBy(*within).text(folder)


def write_document(results: Results, folder: str) -> None:
    """Writes one document as lines: ``section=<n>/part-*`` in the order of names, which join to a JSON text."""
    _write_lines(document_lines(results), folder, "section")


def _read_lines(lines: DataFrame) -> Results:
    """The parts of documents out of their lines (document, section, value), in any order."""
    section = {name: lines.where(F.col("section") == n) for n, name in enumerate(_SECTIONS)}
    bare = F.regexp_replace("value", "^,", "")

    def entries(name: str, value: str) -> DataFrame:
        opening = _OPENING[name]
        read = F.from_json(F.concat(F.lit("{"), bare, F.lit("}")), f"map<string, {value}>")
        return section[name].where(F.col("value") != opening).select("document", F.explode(read).alias("key", "entry"))

    board = entries("leaderboard", f"struct<{_fields(LEADERBOARD)}>").select("key", "entry.*")
    one = F.from_json(F.concat(F.lit("["), bare, F.lit("]")), "array<string>")[0]
    months = section["months"].where(F.col("value") != _OPENING["months"]).groupBy("document").agg(F.array_sort(F.collect_list(one)).alias("months"))
    data = entries("data", "struct<monthly_resolved: array<bigint>>").select("document", F.col("key").alias("agent_name"), F.posexplode("entry.monthly_resolved").alias("at", "resolved"))
    # for each document at most as many rows as the window has months
    numbered_months = months.select("document", F.posexplode("months").alias("at", "month"))
    monthly = data.join(F.broadcast(numbered_months), ["document", "at"]).select("agent_name", "month", "resolved")
    wanted = section["wanted"].where(F.col("value") != _OPENING["wanted"]).select(F.from_json(bare, ISSUE).alias("issue")).select("issue.*")
    head = F.from_json(F.concat(F.regexp_replace("value", ",$", ""), F.lit("}")), f"last_updated string, metadata struct<{_fields(METADATA)}>")
    run = section["head"].select(head.alias("head")).select("head.last_updated", "head.metadata.*")
    return Results(board, monthly, wanted, run)


def read_document(spark: SparkSession, folder: str) -> Results:
    """The parts of a document that ``write_document`` wrote, read line by line in any order."""
    read = _read_lines(spark.read.schema("value string, section int").text(folder).withColumn("document", F.lit(0)))
    return Results(read.leaderboard.drop("key"), read.monthly, read.wanted, read.run)


def read_documents(spark: SparkSession, path: str, one_per_file: bool = False) -> Results:
    """Parts of all documents under a path, with defaults for missing keys; nothing there gives empty parts.

    Documents that ``write_documents`` wrote are read line by line; others are files of one JSON object a line, or with ``one_per_file`` of one over
    many lines, which are rows and tasks of their size.
    """
    if not one_per_file and _exists(spark, f"{path}/document=0"):
        read = _read_lines(spark.read.schema("value string, document int, section int").text(path))
        return _with_defaults(read.leaderboard, read.monthly, read.wanted, read.run)
    if not _exists(spark, path):
        found = spark.createDataFrame([], DOCUMENT)
    else:
        found = spark.read.schema(DOCUMENT).option("multiLine", str(one_per_file).lower()).json(path)
    board = found.select(F.explode("leaderboard").alias("key", "entry")).select("key", "entry.*")
    series = found.select(
        F.col("monthly_metrics.months").alias("months"),
        F.explode("monthly_metrics.data").alias("agent_name", "series"),
    )
    cells = series.select(
        "agent_name", F.explode(F.arrays_zip("months", F.col("series.monthly_resolved").alias("resolved"))).alias("cell")
    )
    monthly = cells.select("agent_name", F.col("cell.months").alias("month"), F.col("cell.resolved").alias("resolved"))
    wanted = found.select(F.explode("wanted_issues").alias("issue")).select("issue.*")
    return _with_defaults(board, monthly, wanted, found.select("last_updated", "metadata.*"))


def _with_defaults(board: DataFrame, monthly: DataFrame, wanted: DataFrame, run: DataFrame) -> Results:
    """The parts of documents, with what stands for a missing key of an entry."""
    board = board.select(
        F.coalesce("name", F.lit(UNKNOWN_NAME)).alias("name"),
        F.coalesce("website", F.lit(NO_WEBSITE)).alias("website"),
        F.coalesce("github_identifier", "key").alias("github_identifier"),
        F.coalesce("resolved_issues", F.lit(0)).cast("bigint").alias("resolved_issues"),
    )
    text = {"url": "", "repo": "", "title": "", "number": "", "created_at": MISSING}
    wanted = wanted.withColumns(
        {c: F.coalesce(c, F.lit(default)) for c, default in text.items()}
        | {"labels": F.coalesce("labels", F.array().cast("array<string>"))}
    )
    return Results(
        board,
        monthly.withColumn("resolved", F.coalesce("resolved", F.lit(0))),
        wanted,
        run.withColumn("last_updated", F.coalesce("last_updated", F.lit("Unknown"))),
    )
