"""Events, agents and submissions derived from the provided order tables, by fixed rules.

Every order is an issue and every line item an event of a pull request; see FIXTURES.md for the rules.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.functions.timestamps import ISO_OUTPUT
from issuetrail.params import Params
from issuetrail.sources.archive import as_path
from issuetrail.sources.schemas import ISSUE_STRUCT, PULL_STRUCT

PARAMS = Params(as_of=datetime(1998, 7, 1, tzinfo=timezone.utc))

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(moment: str) -> str:
    return f"date_format({moment}, \"{ISO_OUTPUT}\")"


def _repo(key: str) -> str:
    return f"array('apache/r0', 'github/r1', 'huggingface/r2', 'other/r3')[CAST({key} % 4 AS INT)]"


_LABELS = """CASE WHEN startswith(o_orderpriority, '1') THEN '[{"name":"Bug"}]'
                  WHEN startswith(o_orderpriority, '2') THEN '[{"name":"Type: Enhancement"},{"name":"P2"}]'
                  ELSE '[{"name":"question"}]' END"""


def _event(df: DataFrame, kind: str, event_id: str, at: str, issue: str, pull: str) -> DataFrame:
    """Event frame of rows that carry ``repo_name``."""
    return df.selectExpr(
        f"'{kind}' AS type",
        f"CAST({event_id} AS STRING) AS id",
        f"{_iso(at)} AS created_at",
        "named_struct('name', repo_name) AS repo",
        f"named_struct('issue', {issue}, 'pull_request', {pull}) AS payload",
        f"concat(date_format({at}, 'yyyy-MM-dd'), '-', hour({at}), '.json.gz') AS file_path",
        f"CAST({at} AS DATE) AS archive_date",
        f"hour({at}) AS archive_hour",
        f"CAST({at} AS TIMESTAMP) AS event_ts",
    )


def _issue_events(orders: DataFrame) -> list[DataFrame]:
    def snapshot(closed_at: str) -> str:
        return f"""named_struct(
            'html_url', concat('https://github.com/', repo_name, '/issues/', o_orderkey),
            'title', concat('Order ', o_orderkey),
            'number', CAST(o_orderkey AS STRING),
            'created_at', {_iso("o_orderdate")},
            'closed_at', {closed_at},
            'body', CAST(NULL AS STRING),
            'user', CAST(NULL AS STRUCT<login: STRING>),
            'labels', {_LABELS},
            'pull_request', CAST(NULL AS STRUCT<merged_at: STRING>))"""

    no_pull = f"CAST(NULL AS {PULL_STRUCT})"
    named = orders.selectExpr(
        "*",
        f"{_repo('o_orderkey')} AS repo_name",
        "o_orderdate + make_dt_interval(CAST(o_custkey % 90 AS INT)) AS closed",
    )
    still_open, done = snapshot("CAST(NULL AS STRING)"), snapshot(_iso("closed"))
    commented, closed = named.where("o_orderstatus = 'P'"), named.where("o_orderstatus = 'F'")
    return [
        _event(named, "IssuesEvent", "o_orderkey * 10 + 1", "o_orderdate", still_open, no_pull),
        _event(commented, "IssueCommentEvent", "o_orderkey * 10 + 2", "o_orderdate", still_open, no_pull),
        _event(closed, "IssuesEvent", "o_orderkey * 10 + 3", "closed", done, no_pull),
    ]


def _pull_events(lineitem: DataFrame) -> list[DataFrame]:
    named = lineitem.selectExpr(
        "l_shipdate",
        "l_linenumber",
        f"{_repo('l_orderkey')} AS repo_name",
        "l_orderkey * 1000000 + l_linenumber * 10000 + l_suppkey AS number",
        "named_struct('login', concat('agent-', l_suppkey % 10)) AS user",
        f"CASE WHEN l_linestatus = 'F' THEN {_iso('l_shipdate')} END AS merged_at",
        f"""CASE l_returnflag
              WHEN 'R' THEN concat('Fixes #', l_orderkey)
              WHEN 'A' THEN concat('See https://github.com/', {_repo("l_orderkey")}, '/issues/', l_orderkey)
              ELSE 'Refactor' END AS body""",
    )
    url = "concat('https://github.com/', repo_name, '/pull/', number)"
    pull = f"named_struct('html_url', {url}, 'merged_at', merged_at, 'body', body, 'user', user)"
    as_issue = f"""named_struct(
        'html_url', {url},
        'title', 'Pull request',
        'number', CAST(number AS STRING),
        'created_at', CAST(NULL AS STRING),
        'closed_at', CAST(NULL AS STRING),
        'body', body,
        'user', user,
        'labels', CAST(NULL AS STRING),
        'pull_request', named_struct('merged_at', merged_at))"""
    odd, even = named.where("l_linenumber % 2 = 1"), named.where("l_linenumber % 2 = 0")
    event_id = "number * 10 + 5"
    return [
        _event(odd, "PullRequestEvent", event_id, "l_shipdate", f"CAST(NULL AS {ISSUE_STRUCT})", pull),
        _event(even, "IssueCommentEvent", event_id, "l_shipdate", as_issue, f"CAST(NULL AS {PULL_STRUCT})"),
    ]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event frame over all orders and all line items.

    Each event type is a branch with its type as a literal, so a query on one kind of event drops the others'
    scans at planning.
    """
    branches = _issue_events(table(spark, sf_dir, "orders")) + _pull_events(table(spark, sf_dir, "lineitem"))
    return reduce(DataFrame.unionAll, branches)


def smallest_file(spark: SparkSession, archive: str, file_glob: str) -> DataFrame:
    """(path, length) of an archive's smallest file, by its size alone: a row with its content from each task would be files of any size in the driver."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", file_glob).option("recursiveFileLookup", "true").load(archive)
    return files.select("path", "length").orderBy("length", "path").limit(1)


def add_files(spark: SparkSession, archive: str, file_glob: str) -> None:
    """Adds to an archive a copy of its smallest file that is cut short, and an hour of 2030 whose only file is empty.

    Spark's writers make neither, so the file system of the session writes them.
    """
    name = smallest_file(spark, archive, file_glob).first()["path"]
    content = spark.read.format("binaryFile").load(as_path(name)).select("content").first()["content"]
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path, data in ((f"{name.rsplit('/', 1)[0]}/cut.txt.gz", content[: len(content) // 2]), (f"{archive}/slot=2030-01-01-0/empty.txt.gz", b"")):
        target = files.Path(path)
        out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
        out.write(bytearray(data))
        out.close()


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One agent per supplier. Of every ten, the ninth is inactive, the tenth is not an agent, the seventh and
    eighth share a name and the sixth has no website."""
    key = F.col("s_suppkey")
    slot = key % 10
    return table(spark, sf_dir, "supplier").select(
        F.when(slot == 7, F.concat(F.lit("Supplier#"), F.lpad((key - 1).cast("string"), 9, "0")))
        .otherwise(F.col("s_name"))
        .alias("name"),
        F.concat(F.lit("org-"), F.col("s_nationkey").cast("string")).alias("organization"),
        F.concat(F.lit("agent-"), key.cast("string")).alias("github_identifier"),
        F.when(slot != 5, F.concat(F.lit("https://agents.example/"), key.cast("string"))).alias("website"),
        F.when(slot == 8, F.lit("inactive")).when(slot == 9, F.lit("human")).otherwise(F.lit("active")).alias("status"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One submission per customer; neighbours share an identifier, and some nations leave a field blank."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    identifier = F.concat(F.lit(" agent-"), F.floor(key / 2).cast("string"), F.lit(" "))
    return table(spark, sf_dir, "customer").select(
        key.alias("submission_id"),
        F.when(nation != 0, identifier).alias("identifier"),
        F.when(nation == 3, F.lit("")).otherwise(F.col("c_name")).alias("name"),
        F.when(nation == 7, F.lit("  ")).otherwise(F.col("c_mktsegment")).alias("organization"),
        F.when(nation != 11, F.concat(F.lit("https://"), F.col("c_name"))).alias("website"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logins that exist: customers who owe nothing."""
    return table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0).select(
        F.concat(F.lit("agent-"), F.col("c_custkey").cast("string")).alias("login")
    )
