from pyspark.sql import functions as F
import pytest

from issuetrail.functions.labels import has_wanted_label, label_names
from issuetrail.functions.references import tracked_repo
from issuetrail.functions.text import archive_date, archive_hour, identifier_from_file, is_blank, issue_link, number_or_zero
from issuetrail.functions.timestamps import normalize_timestamps, parse_iso, whole_days
from issuetrail.operators.pulls import referenced_issues


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, "N/A"),
        ("", "N/A"),
        ("N/A", "N/A"),
        ("2024-01-01T01:02:03Z", "2024-01-01T01:02:03Z"),
        ("2024-01-01 01:02:03+00", "2024-01-01T01:02:03Z"),
        ("  2024-01-01 \t 01:02:03  ", "2024-01-01T01:02:03Z"),
        ("2024-01-15", "2024-01-15T00:00:00Z"),
        ("20240115", "2024-01-15T00:00:00Z"),
        ("2024-01-15T10:00Z", "2024-01-15T10:00:00Z"),
        ("2024-01-15T10:00", "2024-01-15T10:00:00Z"),
        ("2024-01-15T10:00:00.123456", "2024-01-15T10:00:00Z"),
        ("2024-01-15T10:00:00+02:00", "2024-01-15T08:00:00Z"),
        ("2024-01-15T10:00:00-0330", "2024-01-15T13:30:00Z"),
        ("garbage", "garbage"),
        ("gar  bage", "garTbage"),
        ("2024", "2024"),
        ("10:00", "10:00"),
        ("2024-13-45T99:99:99Z", "2024-13-45T99:99:99Z"),
    ],
)
def test_normalize_timestamps(spark, text, expected):
    df = spark.createDataFrame([(text,)], "c string")
    assert normalize_timestamps(df, ["c"]).first()["c"] == expected


@pytest.mark.parametrize(
    "since, until, days",
    [
        ("2024-01-01T23:30:00Z", "2024-01-30T23:00:00Z", 28),
        ("2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z", 30),
        ("2024-01-01T00:00:01Z", "2024-01-31T00:00:00Z", 29),
        ("2024-01-02T00:00:00Z", "2024-01-01T23:59:59Z", -1),
        ("nothing", "2024-01-01T23:59:59Z", None),
    ],
)
def test_whole_days(spark, since, until, days):
    df = spark.createDataFrame([(since, until)], "a string, b string")
    assert df.select(whole_days(parse_iso(F.col("a")), parse_iso(F.col("b"))).alias("d")).first()["d"] == days


@pytest.mark.parametrize(
    "raw, names",
    [
        ('[{"name":"Bug"},"str",{"x":1},{"name":null},null]', ["bug", "", ""]),
        ('{"name":"Bug"}', []),
        ("null", []),
        (None, []),
        ("[broken", []),
        ("[]", []),
        ('[{"name":"Type: Bug","color":"f00"},{"name":"P2"}]', ["type: bug", "p2"]),
        ('\n [ {"name":"Ärger"} ]', ["ärger"]),
    ],
)
def test_label_names(spark, raw, names):
    assert one(spark, raw, label_names) == names


@pytest.mark.parametrize("names, wanted", [(["debugging"], True), (["question"], False), ([], False), (["x", "enhancement!"], True)])
def test_wanted_label(spark, names, wanted):
    assert one(spark, names, lambda c: has_wanted_label(c, ("Bug", "enhancement")), "array<string>") is wanted


def test_references(spark):
    def found(pr_url, body):
        df = spark.createDataFrame([(pr_url, body)], "u string, b string")
        return df.select(referenced_issues(F.col("u"), F.col("b")).alias("r")).first()["r"]

    site = "https://github.com"
    body = f"Fixes #12, {site}/a-b/c/issues/7#issuecomment-9 and apache/kafka#55, again #12"
    assert found(f"{site}/o/r/pull/1", body) == [f"{site}/o/r/issues/12", f"{site}/a-b/c/issues/7", f"{site}/o/r/issues/55"]
    assert found(f"{site}/o/r/pull/1", "http://github.com/a/b/issues/3") == ["http://github.com/a/b/issues/3"]
    assert found(f"{site}/o/r/pull/1", "HTTPS://GITHUB.com/a/b/ISSUES/3") == ["HTTPS://GITHUB.com/a/b/ISSUES/3"]
    assert found(f"{site}/o/r/pull/1", f"{site}/a/next.js/issues/3") == []
    assert found("a/b", f"#1 {site}/a/b/issues/3") == [f"{site}/a/b/issues/3"]
    assert found(f"{site}/o/r/pull/1", f"{site}/ünder/c/issues/7 #٣") == [f"{site}/ünder/c/issues/7", f"{site}/o/r/issues/٣"]
    assert found(f"{site}/o/r/pull/1", None) is None


def test_reference_at_the_end_of_a_long_body(spark):
    df = spark.createDataFrame([("https://github.com/o/r/pull/1", "x " * 500_000 + "closes #77")], "u string, b string")
    assert df.select(referenced_issues(F.col("u"), F.col("b")).alias("r")).first()["r"] == ["https://github.com/o/r/issues/77"]


@pytest.mark.parametrize(
    "repo, kept",
    [("apache/kafka", True), ("Apache/kafka", False), ("apache/a/b", False), ("apache", False), ("apachex/a", False), ("apache/", True), ("other/a", False)],
)
def test_tracked_repo(spark, repo, kept):
    assert one(spark, repo, lambda c: tracked_repo(c, ("apache", "github"))) is kept


def test_file_names(spark):
    assert one(spark, "my-agent%5Bbot%5D.json", identifier_from_file) == "my-agent[bot]"
    assert one(spark, "a+b.json.json", identifier_from_file) == "a+b"
    stamp = "file:/data/2020-01-01-5/x/2024-03-04-7.json.gz"
    assert str(one(spark, stamp, archive_date)) == "2024-03-04"
    assert one(spark, stamp, archive_hour) == 7
    assert str(one(spark, "file:/data/2024-03-04-17/part-0.gz", archive_date)) == "2024-03-04"
    assert one(spark, "file:/data/readme.json", archive_date) is None


def test_small_text(spark):
    assert one(spark, "12x", number_or_zero) == 0.0
    assert one(spark, "12", number_or_zero) == 12.0
    assert one(spark, "  ", is_blank) is True
    assert one(spark, None, is_blank) is True
    link = one(spark, None, lambda c: issue_link(F.lit("u"), c, F.lit("3")))
    assert link == '<a href="u" target="_blank">#3</a>'
