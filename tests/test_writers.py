"""Two writers of the registry table, and curated tables of more than one schema."""

from datetime import date, datetime, timezone

import pytest
from helpers import frame, random_events
from pyspark.sql import functions as F

from issuetrail.params import Params
from issuetrail.plans.mining import mine_curated, mine_events
from issuetrail.sources import curated, registry
from issuetrail.sources.commits import claim, last_number, read_log
from issuetrail.sources.session import new_folder

PARAMS = Params(as_of=datetime(2024, 7, 1, tzinfo=timezone.utc))
SUBMISSION = "n int, identifier string, name string, organization string, website string"
REGISTRY = "name string, organization string, github_identifier string, website string, status string"


def submissions(spark, *rows):
    return spark.createDataFrame([(n, i, name, "o", "w") for n, i, name in rows], SUBMISSION)


def users(spark, *logins):
    return spark.createDataFrame([(i,) for i in logins], "login string")


def verdicts(df):
    return {r["n"]: (r["status"], r["reason"]) for r in df.collect()}


def names(spark, folder):
    return {r["github_identifier"]: r["name"] for r in registry.read_registry_table(spark, folder).collect()}


def test_a_number_is_taken_once(spark):
    folder = new_folder(spark, "test-log")
    assert last_number(spark, folder) == 0 and read_log(spark, folder).collect() == []
    assert claim(spark, folder, 1, "a") and not claim(spark, folder, 1, "b") and claim(spark, folder, 2, "b")
    assert sorted(map(tuple, read_log(spark, folder).collect())) == [(1, "a"), (2, "b")]
    assert last_number(spark, folder) == 2


def test_two_writers_of_one_identifier(spark):
    folder, known = new_folder(spark, "test-registry"), users(spark, "a", "b", "c")
    one = registry.propose(submissions(spark, (1, "a", "first"), (2, "b", "first")), known, folder, "n")
    later = submissions(spark, (1, "a", "second"), (2, "c", "second"))
    two = registry.propose(later, known, folder, "n")
    # both were accepted by what they saw; nothing is in the registry before its commit
    assert verdicts(one.verdicts()) == {1: ("accepted", None), 2: ("accepted", None)} and verdicts(two.verdicts()) == verdicts(one.verdicts())
    assert names(spark, folder) == {}
    assert one.commit() and not two.commit()
    assert names(spark, folder) == {"a": "first", "b": "first"}
    again = registry.register(later, known, folder, "n")
    assert verdicts(again) == {1: ("rejected", "Agent already exists"), 2: ("accepted", None)}
    assert names(spark, folder) == {"a": "first", "b": "first", "c": "second"}
    assert verdicts(again) == {1: ("rejected", "Agent already exists"), 2: ("accepted", None)}, "verdicts stay as they were given"


def test_a_writer_that_loses_tries_again_by_itself(spark, monkeypatch):
    folder, known = new_folder(spark, "test-retry"), users(spark, "a")
    propose, tries = registry.propose, []

    def overtaken(*args):
        tries.append(propose(*args))
        if len(tries) == 1:
            assert propose(submissions(spark, (9, "a", "other")), known, folder, "n").commit()
        return tries[-1]

    monkeypatch.setattr(registry, "propose", overtaken)
    assert verdicts(registry.register(submissions(spark, (1, "a", "mine")), known, folder, "n")) == {1: ("rejected", "Agent already exists")}
    assert len(tries) == 2 and names(spark, folder) == {"a": "other"}


def test_what_lay_there_before_counts(spark):
    folder = new_folder(spark, "test-before")
    spark.createDataFrame([("old", "o", "a", "w", "active")], REGISTRY).write.parquet(folder)
    assert verdicts(registry.register(submissions(spark, (1, "a", "new"), (2, None, "x"), (3, "b", "b"), (4, "b", "b2"), (5, "z", "z")), users(spark, "a", "b"), folder, "n")) == {
        1: ("rejected", "Agent already exists"),
        2: ("rejected", "GitHub identifier is required"),
        3: ("accepted", None),
        4: ("rejected", "Agent already exists"),
        5: ("rejected", "GitHub identifier not found"),
    }
    assert names(spark, folder) == {"a": "old", "b": "b"}
    assert registry.read_registry_table(spark, folder, up_to=0).count() == 1


def test_the_later_of_two_blind_appends_holds(spark):
    folder = new_folder(spark, "test-append")
    judged = f"{SUBMISSION}, status string"
    for name in ("first", "second"):
        registry.append_to_registry(spark.createDataFrame([(1, "a", name, "o", "w", "accepted")], judged), folder)
    assert names(spark, folder) == {"a": "second"}


def test_nobody_registers(spark):
    folder = new_folder(spark, "test-nobody")
    assert registry.register(spark.createDataFrame([], SUBMISSION), users(spark, "a"), folder, "n").count() == 0
    assert names(spark, folder) == {}


# Versions of the curated schema ----------------------------------------------------------------------------


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def versions(spark):
    folder = new_folder(spark, "test-versions")
    found = curated.curated(frame(spark, random_events(5)).withColumn("_corrupt", F.lit(None).cast("string")), PARAMS)
    older = F.col("event_date") < F.lit(date(2024, 3, 1))
    number = F.col("issue").withField("issue_number", F.col("issue.issue_number").cast("bigint")).withField("gone", F.lit(1))
    curated.write_version(found.where(older).withColumn("issue", number).drop("line", "file_path"), folder, 1)
    curated.write_version(found.where(~older), folder, 2)
    return folder


def test_two_schemas_read_as_one(spark, versions):
    mined = mine_curated(spark, versions, read=curated.read_versions)
    expected = mine_events(frame(spark, random_events(5)), PARAMS)
    for part in ("issues", "facts", "links"):
        assert rows(getattr(mined, part)) == rows(getattr(expected, part))


@pytest.mark.parametrize("kind", ["issue", "pull", "corrupt"])
def test_columns_are_those_of_today(spark, versions, tmp_path, kind):
    today = curated.curated_rows(spark.createDataFrame([], curated.CURATED), kind)
    assert curated.read_versions(spark, versions, kind).dtypes == today.dtypes
    nothing = curated.read_versions(spark, str(tmp_path), kind)
    assert nothing.dtypes == today.dtypes and nothing.count() == 0


def test_a_version_of_no_rows(spark, versions):
    folder = new_folder(spark, "test-empty")
    curated.write_version(spark.createDataFrame([], curated.CURATED), folder, 1)
    curated.write_version(spark.read.schema(curated.CURATED).parquet(f"{versions}/schema=2"), folder, 2)
    assert curated.read_versions(spark, folder, "issue").count() == curated.read_curated(spark, f"{versions}/schema=2", "issue").count() > 0


def test_a_value_that_cannot_be_cast_is_null(spark):
    folder = new_folder(spark, "test-cast")
    row = spark.range(1).select(F.lit("issue").alias("kind"), F.lit("2024-01-01").cast("date").alias("event_date"), F.lit("never").alias("event_ts"), F.struct(F.lit("u").alias("issue_url")).alias("issue"))
    curated.write_version(row, folder, 1)
    read = curated.read_versions(spark, folder, "issue").first()
    assert (read["issue_url"], read["event_ts"], read["title"], read["event_date"]) == ("u", None, None, date(2024, 1, 1))


def test_each_version_is_pruned(spark, versions):
    read = curated.read_versions(spark, versions, "pull", date(2024, 4, 1), date(2024, 4, 30)).select("pr_url")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("PartitionFilters: [isnotnull(kind") == 2
    assert "pr_creator" not in plan and "issue_number" not in plan
    assert read.count() == curated.read_versions(spark, versions, "pull").where(F.month("event_date") == 4).count() > 0
