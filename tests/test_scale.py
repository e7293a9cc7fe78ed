"""What keeps time, memory and disk in step with the data."""

import contextlib
import glob
import io
import json
import os
import time

import pytest
from helpers import agents, comment_on_pull, frame, issue_event, pull_event, random_events, write_archive
from pyspark.sql import functions as F

import __spark_entry__ as entry
from issuetrail.functions.references import references
from issuetrail.functions.text import archive_hour
from issuetrail.plans import queries
from issuetrail.sources import archive, curated, registry, results, testdata
from issuetrail.sources.session import SCAN_SETTINGS, dropped_shuffles, new_folder, side_by_side_writers, small_scans
from issuetrail.streaming import incremental, maintained

SF = "/root/testdata/sf0.001"
PARAMS = testdata.PARAMS


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def settings(spark):
    return {name: spark.conf.get(name) for name in SCAN_SETTINGS}


def test_scans_are_dealt_in_small_tasks_while_the_curated_table_is_written(spark, tmp_path, monkeypatch):
    before, seen, make = settings(spark), [], curated.curated
    monkeypatch.setattr(curated, "curated", lambda *given: seen.append(settings(spark)) or make(*given))
    write_archive(str(tmp_path / "a"), {"2024-01-02-0": [pull_event(1, "a")]})
    curated.write_curated(archive.scan_archive(spark, str(tmp_path / "a")), PARAMS, new_folder(spark, "test-scale"))
    assert seen == [{name: str(most) for name, most in SCAN_SETTINGS.items()}] and settings(spark) == before


def test_settings_come_back_and_smaller_ones_stay(spark):
    before = settings(spark)
    with pytest.raises(KeyError), small_scans(spark):
        raise KeyError
    assert settings(spark) == before
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        with small_scans(spark):
            assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1000"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before["spark.sql.files.maxPartitionBytes"])


def test_rows_of_a_kind_are_told_once_by_a_scan(spark, tmp_path):
    """Also that a pull request without URL or creator is left out."""
    unnamed = [pull_event(2, ""), pull_event(3, None)]
    write_archive(str(tmp_path / "a"), {"2024-01-02-0": [pull_event(1, "a"), issue_event(1, "2024-01-02T00:00:00Z"), "{bad", *unnamed]})
    rows = curated.curated(archive.scan_archive(spark, str(tmp_path / "a")), PARAMS)
    assert sorted(r["kind"] for r in rows.collect()) == ["corrupt", "issue", "pull"]
    condition = plan(rows).split("Condition :")[1].split("\n")[0]
    assert condition.count("PullRequestEvent") == 1


def test_registry_files_are_written_side_by_side(spark):
    folder = new_folder(spark, "test-registry-files")
    rows = spark.range(300).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"), F.lit("active").alias("status"))
    registry.write_registry_files(rows, folder, shelves=8)
    files = glob.glob(f"{folder}/*/*.json")
    assert len(files) == 300 and len({os.path.dirname(f) for f in files}) == 8
    found = registry.read_registry_files(spark, folder)
    assert sorted(r["name"] for r in found.select("name", "status").where("status = 'active'").collect()) == sorted(f"n{i}" for i in range(300))


def test_only_what_tells_references_apart_is_shuffled(spark):
    text = plan(entry.queries()["reference_forms"](spark, SF))
    exchanges = [block for block in text.split("\n\n") if ") Exchange" in block]
    assert len(exchanges) == 1 and "issue_url" not in exchanges[0]
    # operators are listed from the scan up: nothing is told apart below the shuffle
    assert text.index(") Exchange") < text.index(") HashAggregate")


def test_the_smallest_file_is_found_without_its_content(spark, tmp_path):
    write_archive(str(tmp_path / "a"), {"2024-01-02-0": b"12345", "2024-01-02-1": b"123", "2024-01-02-2": b"1234"})
    found = testdata.smallest_file(spark, str(tmp_path / "a"), "*.gz")
    assert "content" not in plan(found) and found.first()["path"].endswith("2024-01-02-1.json.gz")


def test_a_first_refresh_and_one_by_the_same_agents_join_no_more_than_they_need(spark, tmp_path):
    source, folder = str(tmp_path / "archive"), new_folder(spark, "test-touched")
    link = "https://github.com/apache/r/issues/7"
    write_archive(source, {"2024-03-01-0": [issue_event(7, "2021-01-01T00:00:00Z"), issue_event(8, "2021-01-01T00:00:00Z"), pull_event(1, "a", body=link)]})
    incremental.fold_new_files(spark, source, folder, PARAMS)
    epochs = maintained._new_epochs(spark, folder, 0)
    changed = agents(spark, "a").select("github_identifier")
    kinds = [maintained.touched_issues(spark, folder, epochs, changed, first=True), maintained.touched_issues(spark, folder, epochs, None), maintained.touched_issues(spark, folder, epochs, changed)]
    assert [plan(found).count("Join") > 0 for found in kinds] == [False, True, True]
    assert [sorted(r[0][-1] for r in found.collect()) for found in kinds] == [["7", "8"]] * 3
    # without any new epoch, a changed agent still touches what it is linked to
    assert [r[0] for r in maintained.touched_issues(spark, folder, [], changed).collect()] == [link]
    assert maintained.touched_issues(spark, folder, [], None).count() == 0


def test_an_event_is_made_into_its_lines_once(spark):
    events = [
        issue_event(1, "2024-01-01T00:00:00Z", event_id="1"),
        issue_event(2, "2024-01-01T00:00:00Z", closed="2024-01-02T00:00:00Z", event_id="2"),
        comment_on_pull(3, "a", event_id="3"),
        pull_event(4, "a", event_id="4"),
        pull_event(5, "a", event_id=None),
    ]
    found = queries._archive_lines(frame(spark, events), F.lit("s"))
    texts = [r["value"].split("\n") for r in found.collect()]
    assert len(texts) == 5 and sorted(map(len, texts)) == [1, 1, 2, 2, 2]
    seen = sorted(line for text in texts for line in text if not line.startswith('{"'))
    assert seen == ["", "{broken 4"]
    ghosts = [line for text in texts for line in text if '"user":"ghost"' in line]
    assert len(ghosts) == 1 and ghosts[0].replace('"user":"ghost",', "") == next(t[0] for t in texts if '"id":"1"' in t[0])
    tables = plan(queries._archive_lines(testdata.events(spark, SF), F.lit("s")))
    assert tables.count(") Scan parquet") == 5


def test_an_archive_is_written_without_a_sort(spark, monkeypatch):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen, make = spark.conf.get(name), [], queries._archive_lines
    monkeypatch.setattr(queries, "_archive_lines", lambda *given: seen.append(int(spark.conf.get(name))) or make(*given))
    queries._write_archive(spark, SF, new_folder(spark, "test-writers"))
    assert seen[0] > 1 and spark.conf.get(name) == before
    spark.conf.set(name, "3")
    try:
        with side_by_side_writers(spark):
            assert spark.conf.get(name) == "3"
    finally:
        spark.conf.set(name, before)


def test_more_partitions_than_open_files_are_written_whole(spark):
    folder = new_folder(spark, "test-many-files")
    with side_by_side_writers(spark):
        spark.range(3000).coalesce(1).select(F.col("id").cast("string").alias("value"), (F.col("id") % 150).alias("slot")).write.partitionBy("slot").text(folder)
    assert spark.read.text(folder).select("value").distinct().count() == 3000


def test_fields_of_a_payload_are_taken_in_one_pass(spark, tmp_path):
    issues = ['{"user":"ghost","title":"t"}', '{"user":{"login":"a"},"title":7}', '{"user":"{x","title":null}', '{"title":["t"]}', '{}', '"text"', "null"]
    lines = [f'{{"type":"{i}","payload":{{"issue":{text},"more":1}}}}' for i, text in enumerate(issues)]
    lines += ['{"type":"7","payload":{}}', '{"type":"8"}', '{"type":"9","payload":[1]}', '{"type":"10","payload":"text"}']
    write_archive(str(tmp_path / "a"), {"2024-01-02-0": lines})
    found = queries._payload_fields(archive.scan_payloads(spark, str(tmp_path / "a")))
    expected = {"0": ("ghost", "t"), "1": ("account", "7"), "2": ("account", None), "3": (None, '["t"]')}
    assert {r["type"]: (r["author"], r["title"]) for r in found.collect()} == {str(i): expected.get(str(i), (None, None)) for i in range(11)}
    assert plan(found).count("try_variant_get") == 1


def test_payloads_are_scanned_in_small_tasks(spark, monkeypatch):
    before, seen, deal = settings(spark), [], queries.small_scans

    @contextlib.contextmanager
    def watched(session):
        with deal(session):
            yield seen.append(settings(session))

    monkeypatch.setattr(queries, "small_scans", watched)
    found = entry.queries()["payload_fields"](spark, SF)
    assert seen == [{name: str(most) for name, most in SCAN_SETTINGS.items()}] and settings(spark) == before
    # what is left to do afterwards is to read the counts
    assert "try_variant_get" not in plan(found) and found.count() == 5


def test_no_document_is_one_row(spark):
    """Each of several documents is written an entry a line; joined, its lines are a JSON text of its own."""
    folder = new_folder(spark, "test-lines")
    board = spark.createDataFrame([(f"N{n}", None, f"a{n}", n) for n in range(40)] + [("no one", None, None, 1)], results.LEADERBOARD)
    monthly = spark.createDataFrame([(f'N"{n}', month, n) for n in range(40) for month in ("2024-02", "2024-01")], results.MONTHLY)
    wanted = spark.createDataFrame([(f"u{n}" if n % 50 else None, "o/r", "t\n,", str(n), "open", "N/A", None, ["x"]) for n in range(1000)], results.ISSUE)
    run = spark.createDataFrame([("now", 180, 30, ["a"], ["bug"])], results.RUN)
    results.write_documents(results.Results(board, monthly, wanted, run), folder, shards=4)
    found = []
    for n in range(4):
        names = sorted(glob.glob(f"{folder}/document={n}/section=*/part-*"), key=lambda name: (os.path.basename(os.path.dirname(name)), name))
        lines = [line for name in names for line in open(name).read().splitlines()]
        assert max(map(len, lines)) < 300
        found.append(json.loads("".join(lines)))
    assert sum(len(d["wanted_issues"]) for d in found) == 1000 and all(d["monthly_metrics"]["months"] == ["2024-01", "2024-02"] for d in found)
    assert sorted(key for d in found for key in d["leaderboard"]) == sorted(f"a{n}" for n in range(40))
    assert {key: series["monthly_resolved"] for d in found for key, series in d["monthly_metrics"]["data"].items()} == {f'N"{n}': [n, n] for n in range(40)}
    read = results.read_documents(spark, folder)
    assert (read.leaderboard.count(), read.monthly.count(), read.wanted.count(), read.run.count()) == (40, 80, 1000, 4)
    assert read.wanted.where("url = ''").count() == 20 and read.leaderboard.where("website = 'N/A'").count() == 40
    twice = results.Results(board.union(board), monthly, wanted, run)
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        results.write_documents(twice, new_folder(spark, "test-twice"), shards=4)


def test_documents_made_elsewhere_are_read_by_line(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "one.json").write_text('{"leaderboard":{"x":{}}}\n{"wanted_issues":[{"url":"u"}]}\n')
    read = results.read_documents(spark, str(tmp_path / "d"))
    assert tuple(read.leaderboard.first()) == ("Unknown", "N/A", "x", 0) and read.wanted.first()["labels"] == [] and read.run.count() == 2


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_shuffles_of_an_archive_go_when_it_is_written(spark):
    before = shuffle_files(spark)
    queries._write_archive(spark, SF, new_folder(spark, "test-shuffles"))
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_settings_of_shuffles_come_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(KeyError), dropped_shuffles(spark):
        assert spark.conf.get(name) == "true"
        raise KeyError
    assert spark.conf.get(name) == before


def test_curated_rows_are_written_small_and_without_a_sort(spark, tmp_path, monkeypatch):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    seen, make = [], curated.curated
    monkeypatch.setattr(curated, "curated", lambda *given: seen.append(int(spark.conf.get(name))) or make(*given))
    write_archive(str(tmp_path / "a"), {"2024-01-02-0": [pull_event(1, "a"), issue_event(1, "2024-01-02T00:00:00Z"), "{bad"], "more": [pull_event(2, "a")]})
    folder = new_folder(spark, "test-codec")
    curated.write_curated(archive.scan_archive(spark, str(tmp_path / "a")), PARAMS, folder)
    files = glob.glob(f"{folder}/*/*/*.parquet")
    assert seen[0] > 1 and len(files) == 4 and all(name.endswith(".zstd.parquet") for name in files)


def test_only_the_end_of_a_path_is_searched_for_its_hour(spark):
    paths = ["/a/2024-01-02-3/x/2024-01-02-4.json.gz", "/a/slot=2024-01-02-5/part-0.gz", "/a/2024-01-02-3/x/part-0.gz", "2024-01-02-6.json.gz", "2024-01-02-7/x", "/a/12024-01-02-8.json", None, ""]
    found = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string").select("i", archive_hour(F.col("p")).alias("hour"))
    assert {r["i"]: r["hour"] for r in found.collect()} == {0: 4, 1: 5, 2: None, 3: 6, 4: 7, 5: 8, 6: None, 7: None}
    assert "substring_index" in plan(found)


def test_texts_that_can_have_no_reference_are_not_searched(spark):
    texts = ["Refactor", "#12 and #12", "see HTTPS://GitHub.com/a/b/ISSUES/3", "http://x", "# 1", "", None, "github.com/a/b/issues/3"]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", references(F.col("t")).alias("r"))
    assert {r["i"]: r["r"] for r in found.collect()} == {0: [], 1: ["#12"], 2: ["HTTPS://GitHub.com/a/b/ISSUES/3"], 3: [], 4: [], 5: [], 6: None, 7: []}
    assert "contains" in plan(found).lower()


def test_kept_state_is_small_and_leaves_no_shuffles(spark, tmp_path):
    source, folder = str(tmp_path / "archive"), new_folder(spark, "test-state")
    write_archive(source, {"2024-01-02-0": [pull_event(1, "a", body="#7"), issue_event(7, "2024-01-02T00:00:00Z")]})
    before = shuffle_files(spark)
    incremental.fold_new_files(spark, source, folder, PARAMS)
    files = glob.glob(f"{folder}/state/*/*/*/*/*.parquet")
    assert len(files) == 3 and all(name.endswith(".zstd.parquet") for name in files)
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


@pytest.mark.parametrize("large, at_once", [(1, 1), (1 << 40, 3)])
def test_state_tables_of_a_large_batch_are_written_one_by_one(spark, tmp_path, monkeypatch, large, at_once):
    source, folder = str(tmp_path / "archive"), new_folder(spark, "test-large")
    write_archive(source, {"2024-01-02-0": [pull_event(1, "a", body="#7"), issue_event(7, "2024-01-02T00:00:00Z")]})
    seen, pool = [], incremental.ThreadPoolExecutor
    monkeypatch.setattr(incremental, "LARGE_BATCH", large)
    monkeypatch.setattr(incremental, "ThreadPoolExecutor", lambda most: seen.append(most) or pool(most))
    incremental.fold_new_files(spark, source, folder, PARAMS)
    mined = incremental.read_state(spark, folder)
    assert seen == [at_once] and [part.count() for part in (mined.issues, mined.facts, mined.links)] == [1, 1, 1]


def test_much_new_state_is_resolved_as_a_whole(spark, tmp_path, monkeypatch):
    """The outcomes are those of a refresh that looks for what is touched."""
    source, one, other, known = str(tmp_path / "archive"), new_folder(spark, "test-much"), new_folder(spark, "test-little"), agents(spark, "a", "b")
    events = sorted(random_events(31), key=lambda e: e["created_at"])
    shown = lambda folder: sorted(map(repr, maintained.read_outcomes(spark, folder).collect()))
    for number, part in enumerate((events[:150], events[150:])):
        write_archive(source, {f"2024-01-02-{number}": part})
        for folder in (one, other):
            incremental.fold_new_files(spark, source, folder, PARAMS)
        with monkeypatch.context() as watched:
            watched.setattr(maintained, "touched_issues", lambda *given, **named: 1 / 0)
            assert maintained.refresh(spark, one, known, buckets=8, much=1) == len(shown(one)) > 0
        maintained.refresh(spark, other, known, buckets=8)
        assert shown(one) == shown(other)
    # a small part of the state, or none that is new, is looked for
    write_archive(source, {"2024-01-02-2": [issue_event(5000, "2024-01-02T00:00:00Z")]})
    incremental.fold_new_files(spark, source, one, PARAMS)
    last = maintained._new_epochs(spark, one, 2)
    assert len(last) == 1 and maintained.is_much(spark, one, last, 1 << 40) is False and maintained.is_much(spark, one, [], 1) is False
    assert maintained.refresh(spark, one, known) == 1


def test_versions_are_made_of_rows_that_are_parsed_once(spark, monkeypatch):
    seen, write = [], curated.write_version
    monkeypatch.setattr(curated, "write_version", lambda rows, *given: seen.append(plan(rows)) or write(rows, *given))
    assert entry.queries()["versioned_leaderboard"](spark, SF).count() == 8
    assert len(seen) == 2 and all("Scan parquet" in text and "Scan json" not in text for text in seen)
