"""What is kept between runs: the file ledger, dead letters, maintained outcomes; and rank numbers, the one document, variants, long lines, empty files."""

import json
import os
import random
from datetime import date, datetime, timezone

import pytest
from helpers import agents, comment_on_pull, frame, issue_event, pull_event, random_events, write_archive
from pyspark.sql import functions as F

from issuetrail.functions.labels import label_names
from issuetrail.functions.payload import field, payload
from issuetrail.operators import audit, monthly
from issuetrail.operators.ranking import numbered
from issuetrail.operators.resolution import resolved_issues, wanted_issues
from issuetrail.params import Params
from issuetrail.plans import mining
from issuetrail.plans.mining import mine_curated, mine_events
from issuetrail.sources import archive, curated, ledger, results
from issuetrail.sources.session import new_folder
from issuetrail.streaming import incremental, maintained

PARAMS = Params(as_of=datetime(2024, 7, 1, tzinfo=timezone.utc))


def rows(df):
    return sorted(map(repr, df.collect()))


def relations(mined):
    return [rows(part) for part in (mined.issues, mined.facts, mined.links)]


def by_hour(events):
    found = {}
    for e in events:
        found.setdefault(f"{e['created_at'][:10]}-{int(e['created_at'][11:13])}", []).append(e)
    return found


# File ledger --------------------------------------------------------------------------------------------


def test_only_new_and_changed_files_are_opened(spark, tmp_path):
    source, folder = str(tmp_path / "archive"), new_folder(spark, "test-ledger")
    files = by_hour(random_events(21))
    stamps = sorted(files)
    write_archive(source, {s: files[s] for s in stamps[:20]})
    assert ledger.parse_new_files(spark, source, folder, PARAMS) == 20
    # an old file that could not be read any more, in its old size and time
    old = os.path.join(source, f"{stamps[0]}.json.gz")
    stat = os.stat(old)
    with open(old, "wb") as out:
        out.write(b"x" * stat.st_size)
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    # one that has changed, and new ones
    write_archive(source, {stamps[1]: files[stamps[1]][:-1] + [issue_event(999, "2024-01-01T00:00:00Z", at=f"{stamps[1][:10]}T00:00:00Z")]} | {s: files[s] for s in stamps[20:]})
    assert ledger.parse_new_files(spark, source, folder, PARAMS) == 1 + len(stamps) - 20
    assert ledger.parse_new_files(spark, source, folder, PARAMS) == 0

    events = [e for s in stamps if s != stamps[1] for e in files[s]] + files[stamps[1]][:-1] + [issue_event(999, "2024-01-01T00:00:00Z", at=f"{stamps[1][:10]}T00:00:00Z")]
    expected = relations(mine_events(frame(spark, events), PARAMS))
    assert relations(mine_curated(spark, folder, read=ledger.read_parsed)) == expected

    # days written anew take the place of what the target has of them, and of no other
    target = new_folder(spark, "test-days")
    first, last = date.fromisoformat(stamps[0][:10]), date.fromisoformat(stamps[-1][:10])
    ledger.rewrite_days(spark, folder, target, first, last)
    assert relations(mine_curated(spark, target)) == expected
    day = date.fromisoformat(stamps[5][:10])
    ledger.rewrite_days(spark, folder, target, day, day)
    assert relations(mine_curated(spark, target)) == expected


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    source, folder = str(tmp_path / "archive"), new_folder(spark, "test-unfinished")
    write_archive(source, {"2024-03-01-0": [issue_event(1, "2024-03-01T00:00:00Z")]})
    ledger.parse_new_files(spark, source, folder, PARAMS)
    curated.write_curated(archive.scan_archive(spark, source), PARAMS, f"{folder}/parsed/version=2")
    assert ledger.read_parsed(spark, folder, "issue").count() == 1
    write_archive(source, {"2024-03-01-1": [issue_event(2, "2024-03-01T00:00:00Z")]})
    assert ledger.parse_new_files(spark, source, folder, PARAMS) == 1
    assert rows(ledger.read_parsed(spark, folder, "issue").select("issue_number")) == ["Row(issue_number='1')", "Row(issue_number='2')"]


def test_other_organisations_are_parsed_again(spark, tmp_path):
    source, folder = str(tmp_path / "archive"), new_folder(spark, "test-orgs")
    write_archive(source, {"2024-03-01-0": [issue_event(1, "2024-03-01T00:00:00Z"), issue_event(2, "2024-03-01T00:00:00Z", repo="other/x")]})
    ledger.parse_new_files(spark, source, folder, PARAMS)
    assert ledger.parse_new_files(spark, source, folder, Params(as_of=PARAMS.as_of, orgs=("other",))) == 1
    assert [r["issue_number"] for r in ledger.read_parsed(spark, folder, "issue").collect()] == ["2"]


def test_a_window_leaves_out_files_without_a_day(spark, tmp_path):
    """The same for a scan, a curated table, a ledger and kept state; without a window they count, and they are listed."""
    source, folder = str(tmp_path / "archive"), new_folder(spark, "test-unstamped")
    write_archive(source, {"2024-03-01-0": [issue_event(1, "2024-03-01T00:00:00Z")], "more": [issue_event(5, "2024-03-01T00:00:00Z")]})
    first, last = PARAMS.start.date(), PARAMS.end.date()
    incremental.fold_new_files(spark, source, folder, PARAMS)
    ledger.parse_new_files(spark, source, folder, PARAMS)
    scanned = mine_events(archive.read_events(spark, source, first=first, last=last), PARAMS)
    for windowed in (incremental.read_state(spark, folder, first, last), mine_curated(spark, folder, first, last, read=ledger.read_parsed)):
        assert relations(windowed) == relations(scanned)
    assert [r["number"] for r in scanned.issues.collect()] == ["1"]
    assert incremental.read_state(spark, folder).issues.count() == 2 == mine_curated(spark, folder, read=ledger.read_parsed).issues.count()
    assert [os.path.basename(r["file_path"]) for r in archive.unstamped_files(spark, source).collect()] == ["more.json.gz"]


def test_a_second_run_parses_nothing_again(spark, tmp_path):
    source, registry, output = str(tmp_path / "archive"), tmp_path / "registry", str(tmp_path / "out")
    registry.mkdir()
    (registry / "a.json").write_text('{"name":"A","status":"active"}')
    write_archive(source, by_hour(random_events(22)))
    first = mining.run(spark, source, str(registry), output, PARAMS)
    expected = [rows(part) for part in first.parts().values()]
    again = mining.run(spark, source, str(registry), output, PARAMS)
    assert [rows(part) for part in again.parts().values()] == expected
    assert ledger.read_ledger(spark, output).select("version").distinct().count() == 1


# Dead letters -------------------------------------------------------------------------------------------


def test_damaged_files_are_kept_and_folded_once_mended(spark, tmp_path):
    source, folder = str(tmp_path / "archive"), new_folder(spark, "test-dead")
    write_archive(source, {"2024-03-01-0": [issue_event(1, "2024-03-01T00:00:00Z")], "2024-03-01-1": b"no gzip"})
    fold = lambda: incremental.fold_new_files(spark, source, folder, PARAMS, skip_damaged_files=True)
    fold()
    dead = incremental.dead_letters(spark, folder).collect()
    assert [(os.path.basename(r["file_path"]), r["epoch"]) for r in dead] == [("2024-03-01-1.json.gz", 0)] and dead[0]["fault"]
    fold()
    assert incremental.dead_letters(spark, folder).count() == 1 and incremental.read_state(spark, folder).issues.count() == 1
    write_archive(source, {"2024-03-01-1": [issue_event(2, "2024-03-01T00:00:00Z"), issue_event(3, "2024-03-01T00:00:00Z")]})
    fold()
    assert incremental.dead_letters(spark, folder).count() == 0 and incremental.read_state(spark, folder).issues.count() == 3
    fold()
    assert relations(incremental.read_state(spark, folder)) == relations(mine_events(archive.read_events(spark, source), PARAMS))


# Maintained outcomes ------------------------------------------------------------------------------------


def check_outcomes(spark, folder, known):
    """The outcomes against a run over all kept state."""
    mined, outcomes = incremental.read_state(spark, folder), maintained.read_outcomes(spark, folder)
    resolution = mined.resolution(known)
    columns = ["url", "title", "state", "created_at", "closed_at", "labels", "agent", "pr_url", "merged_at"]
    expected = mined.issues.join(resolution.withColumnRenamed("issue_url", "url"), "url", "left")
    assert rows(outcomes.select(*columns)) == rows(expected.select(*columns))
    assert rows(maintained.resolved_outcomes(outcomes, PARAMS).select(*columns)) == rows(resolved_issues(mined.issues, resolution, PARAMS).select(*columns))
    assert rows(maintained.wanted_outcomes(outcomes, PARAMS).select("url")) == rows(wanted_issues(mined.issues, resolution, PARAMS).select("url"))


def test_each_fold_resolves_what_it_touches(spark, tmp_path):
    source, folder = str(tmp_path / "archive"), new_folder(spark, "test-maintained")
    known = agents(spark, "a")
    files = by_hour(random_events(31))
    stamps = sorted(files)
    random.Random(1).shuffle(stamps)
    for part in (stamps[:60], stamps[60:90], stamps[90:]):
        write_archive(source, {s: files[s] for s in part})
        incremental.fold_new_files(spark, source, folder, PARAMS)
        assert maintained.refresh(spark, folder, known, buckets=8) > 0
        check_outcomes(spark, folder, known)
    assert maintained.refresh(spark, folder, known) == 0

    # one pull request that is merged now touches the one issue it links to, which nothing of this batch names
    lone = [issue_event(5000, "2024-01-01T00:00:00Z", at="2024-01-01T00:00:00Z"), comment_on_pull(900, "a", body="#5000", at="2024-02-01T00:00:00Z")]
    write_archive(source, {"2024-02-02-0": lone})
    incremental.fold_new_files(spark, source, folder, PARAMS)
    assert maintained.refresh(spark, folder, known) == 1
    write_archive(source, {"2024-02-03-0": [pull_event(900, "a", merged="2024-02-03T00:00:00Z", at="2024-02-03T00:00:00Z")]})
    incremental.fold_new_files(spark, source, folder, PARAMS)
    assert maintained.refresh(spark, folder, known) == 1
    assert [r["agent"] for r in maintained.read_outcomes(spark, folder).where(F.col("url").endswith("/5000")).collect()] == ["a"]
    check_outcomes(spark, folder, known)

    # another agent in the registry touches the issues of its pull requests; a removed one too
    for more in (agents(spark, "a", "b"), agents(spark, "b")):
        assert 0 < maintained.refresh(spark, folder, more)
        check_outcomes(spark, folder, more)


def test_an_unfinished_refresh_leaves_no_trace(spark, tmp_path, monkeypatch):
    source, folder = str(tmp_path / "archive"), new_folder(spark, "test-failing")
    known = agents(spark, "a")
    write_archive(source, {"2024-03-01-0": [issue_event(1, "2024-03-01T00:00:00Z")]})
    incremental.fold_new_files(spark, source, folder, PARAMS)
    maintained.refresh(spark, folder, known)
    write_archive(source, {"2024-03-01-1": [issue_event(2, "2024-03-01T00:00:00Z")]})
    incremental.fold_new_files(spark, source, folder, PARAMS)
    with monkeypatch.context() as broken:
        broken.setattr(maintained, "read_or_none", lambda s, path, schema, whole=ledger.read_or_none: 1 / 0 if "rows" in path else whole(s, path, schema))
        with pytest.raises(ZeroDivisionError):
            maintained.refresh(spark, folder, known)
    assert maintained.read_outcomes(spark, folder).count() == 1
    assert maintained.refresh(spark, folder, known) == 1
    check_outcomes(spark, folder, known)


# Ranks, documents, months -------------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_numbers_follow_the_order(spark, partitions):
    pick = random.Random(2)
    data = [(i, pick.randrange(20)) for i in range(500)]
    found = numbered(spark.createDataFrame(data, "k long, n long").repartition(5), [F.desc("n"), F.asc("k")], partitions=partitions).collect()
    expected = sorted(data, key=lambda r: (-r[1], r[0]))
    assert sorted((r["rank"], r["k"], r["n"]) for r in found) == [(i, *r) for i, r in enumerate(expected, 1)]
    assert numbered(spark.createDataFrame([], "k long, n long"), [F.desc("n")]).count() == 0


def test_joined_lines_are_one_document(spark, tmp_path):
    board = agents(spark, "a", 'b"c', "é\\x", names={"a": "x,\n]"}).withColumn("resolved_issues", F.lit(3).cast("bigint"))
    board = board.select("name", "website", "github_identifier", "resolved_issues")
    months = spark.createDataFrame([(n, m, len(n) + i) for n in ("N1", 'N"2') for i, m in enumerate(("2024-01", "2024-02"))], results.MONTHLY)
    issue = lambda n: (f"u{n}", "r", 'title, with "marks"\n}', str(n), "open", "2024-01-01T00:00:00Z", None, ["bug", "x,y"])
    wanted = spark.createDataFrame([issue(n) for n in range(200)], results.ISSUE)
    made = results.Results(board, months, wanted, mining.run_parameters(spark, PARAMS))
    folder = str(tmp_path / "document")
    results.write_document(made, folder)
    names = sorted(os.path.join(d, f) for d, _, files in os.walk(folder) for f in files if f.startswith("part-"))
    document = json.loads("".join(open(name).read() for name in names))
    assert list(document) == ["last_updated", "metadata", "leaderboard", "monthly_metrics", "wanted_issues"]
    assert document["monthly_metrics"] == {"agents": ['N"2', "N1"], "months": ["2024-01", "2024-02"], "data": {"N1": {"monthly_resolved": [2, 3]}, 'N"2': {"monthly_resolved": [3, 4]}}}
    assert len(document["wanted_issues"]) == 200 and document["wanted_issues"][0]["labels"] == ["bug", "x,y"] and set(document["leaderboard"]) == {"a", 'b"c', "é\\x"}
    read = results.read_document(spark, folder)
    assert [rows(part) for part in read.parts().values()] == [rows(part) for part in made.parts().values()]

    nothing = results.Results(board.limit(0), months.limit(0), wanted.limit(0), made.run)
    results.write_document(nothing, folder)
    names = sorted(os.path.join(d, f) for d, _, files in os.walk(folder) for f in files if f.startswith("part-"))
    assert json.loads("".join(open(name).read() for name in names))["wanted_issues"] == []
    assert all(part.count() == (name == "run") for name, part in results.read_document(spark, folder).parts().items())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_grid_does_not_depend_on_the_session(spark, zone):
    """A count of the window's last month, three hours into it."""
    params = Params(as_of=datetime(2024, 7, 1, 3, tzinfo=timezone.utc))
    counts = spark.createDataFrame([("x", "2024-07", 2), ("x", "2024-01", 1), ("y", "2024-03", 1)], "agent_name string, month string, resolved bigint")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = {(r["agent_name"], r["month"]): r["resolved"] for r in monthly.monthly_grid(counts, params).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == {("x", "2024-07"): 2, ("x", "2024-01"): 1, ("x", "2024-03"): 0, ("y", "2024-07"): 0, ("y", "2024-01"): 0, ("y", "2024-03"): 1}


# Lines and fields ---------------------------------------------------------------------------------------


def test_payloads_are_single_values(spark):
    texts = ['{"k": 1, "z": {"q": [1, 2]}}', '{"k": 1} x', '[{"k": 1}] []', "[1, 2]", "", None, "nope", '1, "k": 2', ' {"k": "s"}  ']
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", payload(F.col("t")).alias("v"))
    got = {r["i"]: (r["k"], r["q"], r["there"]) for r in found.select("i", field(F.col("v"), "$.k").alias("k"), field(F.col("v"), "$.z.q[1]", "int").alias("q"), F.col("v").isNotNull().alias("there")).collect()}
    none = (None, None, False)
    assert got == {0: ("1", 2, True), 1: none, 2: none, 3: (None, None, True), 4: none, 5: none, 6: none, 7: none, 8: ("s", None, True)}


@pytest.mark.parametrize("text", ['[{"name":"a"}] x', '[{"name":"a"}][]', '[{"name":"a"}'])
def test_text_after_the_labels_is_no_list(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(label_names(F.col("t")).alias("n")).first()["n"] == []


def test_long_lines_are_told_by_size(spark, tmp_path):
    source = str(tmp_path / "archive")
    long = json.dumps(issue_event(2, "2024-03-01T00:00:00Z", title="x" * 5000))
    write_archive(source, {"2024-03-01-0": [issue_event(1, "2024-03-01T00:00:00Z"), long, "{bad", ""]})
    events, too_long = archive.scan_lines(spark, source, largest_line=4000)
    assert [r["payload"]["issue"]["number"] for r in archive.readable(events).collect()] == ["1"]
    assert archive.quarantine(events).count() == 1
    (row,) = too_long.collect()
    assert (row["bytes"], row["archive_hour"], os.path.basename(row["file_path"])) == (len(long), 0, "2024-03-01-0.json.gz")
    whole = relations(mine_events(archive.readable(archive.scan_lines(spark, source, 10**6)[0]), PARAMS))
    assert whole == relations(mine_events(archive.read_events(spark, source), PARAMS))


def test_empty_files_are_no_missing_hours(spark, tmp_path):
    source = str(tmp_path / "archive")
    write_archive(source, {"2024-03-01-0": [issue_event(1, "2024-03-01T00:00:00Z")], "2024-03-01-1": b"", "2024-03-01-3": [issue_event(1, "2024-03-01T00:00:00Z")]})
    files = archive.file_inventory(spark, source)
    day = date(2024, 3, 1)
    assert files.count() == 3 and [r["archive_hour"] for r in audit.empty_hours(files).collect()] == [1]
    missing = {r["archive_hour"] for r in audit.missing_hours(spark, files, day, day).collect()}
    assert missing == set(range(24)) - {0, 1, 3}
