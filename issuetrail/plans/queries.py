"""The registered queries. Each reads whole tables of a test-data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.functions.labels import joined_labels
from issuetrail.functions.payload import field, first_field, payload
from issuetrail.functions.references import own_issue_prefix, referenced_issue, references
from issuetrail.functions.text import archive_date, archive_hour, identifier_from_file
from issuetrail.functions.timestamps import ISO_OUTPUT, normalize_timestamps, parse_iso, whole_days
from issuetrail.operators import audit, issues, leaderboard, monthly, pulls, registration, resolution
from issuetrail.plans.mining import Mined, mine_curated, mine_events, results_of
from issuetrail.sources import archive, curated, ledger, registry, results, testdata
from issuetrail.sources.session import dropped_shuffles, new_folder, side_by_side_writers, small_scans, use_utc
from issuetrail.sources.testdata import PARAMS, table
from issuetrail.streaming import incremental, maintained

Query = Callable[[SparkSession, str], DataFrame]


def _agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registration.active_agents(testdata.registry(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.events(spark, sf_dir)


def _mined(spark: SparkSession, sf_dir: str, params=PARAMS) -> Mined:
    return mine_events(_events(spark, sf_dir), params)


def _resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mined(spark, sf_dir).resolution(_agents(spark, sf_dir))


def _resolved(spark: SparkSession, sf_dir: str, params=PARAMS) -> DataFrame:
    mined = _mined(spark, sf_dir, params)
    return resolution.resolved_issues(mined.issues, mined.resolution(_agents(spark, sf_dir), params), params)


def _wanted(spark: SparkSession, sf_dir: str, params=PARAMS) -> DataFrame:
    if not params.require_agent_pr_on_open:
        return resolution.wanted_issues(issues.latest_issues(_events(spark, sf_dir), params), None, params)
    mined = _mined(spark, sf_dir, params)
    return resolution.wanted_issues(mined.issues, mined.resolution(_agents(spark, sf_dir), params), params)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.monthly_counts(_resolved(spark, sf_dir), _agents(spark, sf_dir))


def _flat(found: DataFrame, *more: str) -> DataFrame:
    """Issue columns with the labels as text."""
    return found.select(
        "url", "repo", "title", "number", "state", "created_at", "closed_at",
        joined_labels(F.col("labels")).alias("labels"), *more,
    )


# Issues and pull requests -------------------------------------------------------------------------------


def issue_snapshots(spark, sf_dir):
    return _flat(issues.latest_issues(_events(spark, sf_dir), PARAMS))


def issue_variants(spark, sf_dir):
    return issues.issue_variants(_events(spark, sf_dir))


def issue_labels(spark, sf_dir):
    return issues.issue_labels(issues.latest_issues(_events(spark, sf_dir), PARAMS), PARAMS)


def pull_versions(spark, sf_dir):
    return pulls.pull_versions(_events(spark, sf_dir))


def pr_facts(spark, sf_dir):
    facts = pulls.pull_facts(_events(spark, sf_dir))
    return facts.withColumn("merged", F.col("merged_at").isNotNull())


def issue_links(spark, sf_dir):
    return pulls.issue_links(_events(spark, sf_dir))


def reference_forms(spark, sf_dir):
    """Every form a reference can take, in a text made of each line item; one row per reference found."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("item"),
        F.col("l_orderkey").cast("string").alias("o"),
        F.col("l_partkey").cast("string").alias("p"),
        F.col("l_suppkey").cast("string").alias("s"),
        F.when(F.col("l_returnflag") == "N", F.lit("https://short/1"))
        .otherwise(F.concat(F.lit("https://github.com/own/"), F.lower("l_returnflag"), F.lit("/pull/9")))
        .alias("pr_url"),
    )
    text = F.format_string(
        "Fixes #%s, HTTPS://GitHub.com/a-b/c/issues/%s#issuecomment-%s and x/y#%s\n"
        "see http://github.com/m/n/issues/%s or https://github.com/a/next.js/issues/%s",
        "o", "p", "s", "p", "s", "o",
    )
    # the issue follows from what is shuffled, and isn't; few rows are equal, so that telling them apart before the shuffle too would spill nearly all
    found = rows.select("item", "pr_url", F.explode(references(text)).alias("reference"))
    found = found.repartition("item", "pr_url", "reference").distinct()
    prefix = own_issue_prefix(F.col("pr_url"))
    return found.select("item", "pr_url", "reference", referenced_issue(F.col("reference"), prefix).alias("issue_url"))


# Resolution ---------------------------------------------------------------------------------------------


def issue_resolution(spark, sf_dir):
    return _resolution(spark, sf_dir)


def resolved_issues(spark, sf_dir):
    return _flat(_resolved(spark, sf_dir), "agent", "pr_url", "merged_at")


def wanted_issues(spark, sf_dir):
    return _flat(_wanted(spark, sf_dir))


# The documented rule differs from the computed one in three points.
DOCUMENTED = replace(
    PARAMS, require_label_on_closed=True, require_agent_pr_on_open=False, require_closed_after_merge=True
)


def resolved_issues_documented_rule(spark, sf_dir):
    return _flat(_resolved(spark, sf_dir, DOCUMENTED), "agent", "pr_url", "merged_at")


def wanted_issues_documented_rule(spark, sf_dir):
    return _flat(_wanted(spark, sf_dir, DOCUMENTED))


def resolved_by_agent(spark, sf_dir):
    """Nested lists, counted and summed up so that a flat engine can check them."""
    nested = resolution.resolved_by_agent(_resolved(spark, sf_dir), issues_per_row=10)
    return nested.groupBy("agent").agg(
        F.sum(F.size("issues")).cast("bigint").alias("issue_count"),
        F.sum(F.aggregate("issues", F.lit(0).cast("bigint"), lambda a, i: a + i["number"].cast("bigint"))).alias("number_sum"),
    )


# Leaderboard and views ----------------------------------------------------------------------------------


def resolved_counts(spark, sf_dir):
    return leaderboard.resolved_counts(_resolved(spark, sf_dir))


def leaderboard_rows(spark, sf_dir):
    return leaderboard.leaderboard(_agents(spark, sf_dir), _resolved(spark, sf_dir))


def leaderboard_view(spark, sf_dir):
    return leaderboard.leaderboard_view(leaderboard_rows(spark, sf_dir))


def leaderboard_search(spark, sf_dir):
    return leaderboard.leaderboard_view(leaderboard_rows(spark, sf_dir), low=2, high=500, term="SUPPLIER#000000006")


def windowed_leaderboard(spark, sf_dir):
    """The leaderboard of a run that opens only the archive days of its window."""
    seen = audit.within_window(_events(spark, sf_dir), PARAMS)
    mined = mine_events(seen, PARAMS)
    agents = _agents(spark, sf_dir)
    found = resolution.resolved_issues(mined.issues, mined.resolution(agents, PARAMS), PARAMS)
    return leaderboard.leaderboard(agents, found)


def wanted_view(spark, sf_dir):
    return leaderboard.wanted_view(_wanted(spark, sf_dir), PARAMS)


def monthly_long(spark, sf_dir):
    return _counts(spark, sf_dir)


def monthly_dense(spark, sf_dir):
    return monthly.monthly_grid(monthly.kept_counts(_counts(spark, sf_dir)), PARAMS)


def monthly_matrix(spark, sf_dir):
    matrix = monthly.monthly_matrix(monthly_dense(spark, sf_dir))
    return matrix.select(
        "agent_name",
        F.array_join("months", ",").alias("months"),
        F.array_join(F.col("monthly_resolved").cast("array<string>"), ",").alias("monthly_resolved"),
    )


def months_present(spark, sf_dir):
    return monthly.months_present(_counts(spark, sf_dir))


def agent_totals(spark, sf_dir):
    return monthly.agent_totals(_counts(spark, sf_dir))


def top_agents(spark, sf_dir):
    return monthly.top_agents(_counts(spark, sf_dir), PARAMS.top_n)


def top_agents_series(spark, sf_dir):
    return monthly.top_agents_series(_counts(spark, sf_dir), PARAMS.top_n)


# Registry -----------------------------------------------------------------------------------------------


def active_agents(spark, sf_dir):
    return _agents(spark, sf_dir).select("github_identifier", "name", "organization", "website", "status")


def registry_summary(spark, sf_dir):
    return registration.registry_summary(testdata.registry(spark, sf_dir))


def agent_identifiers(spark, sf_dir):
    """Identifiers out of file names that carry brackets, folders and repeated suffixes."""
    name = F.concat(F.lit("agent%20"), F.col("c_custkey").cast("string"), F.lit(".json+%5Bbot%5D.json"))
    return table(spark, sf_dir, "customer").select("c_custkey", identifier_from_file(name).alias("github_identifier"))


def _validated(spark, sf_dir):
    return registration.validate_submissions(
        testdata.submissions(spark, sf_dir),
        registration.active_agents(testdata.registry(spark, sf_dir)),
        testdata.users(spark, sf_dir),
        order_by="submission_id",
    )


def submission_validation(spark, sf_dir):
    return _validated(spark, sf_dir)


def registry_append(spark, sf_dir):
    """The registry table after the accepted submissions were added to it."""
    folder = new_folder(spark, "registry")
    columns = ["name", "organization", "github_identifier", "website", "status"]
    testdata.registry(spark, sf_dir).select(*columns).write.parquet(folder)
    registry.append_to_registry(_validated(spark, sf_dir), folder)
    return registry.read_registry_table(spark, folder)


def registry_of_two_writers(spark, sf_dir):
    """The verdicts of two writers that judge all submissions at once: the second finds its number taken and judges again."""
    folder = new_folder(spark, "registry-writers")
    columns = ["name", "organization", "github_identifier", "website", "status"]
    _agents(spark, sf_dir).select(*columns).write.parquet(folder)
    asked, users = testdata.submissions(spark, sf_dir), testdata.users(spark, sf_dir)
    first, second = (registry.propose(asked, users, folder, "submission_id") for _ in range(2))
    if not first.commit() or second.commit():
        raise AssertionError("the number was not taken once")
    again = registry.register(asked, users, folder, "submission_id")
    both = first.verdicts().withColumn("writer", F.lit(1)).unionByName(again.withColumn("writer", F.lit(2)))
    return both.select("writer", "submission_id", "identifier", "reason", "status")


def registry_scan(spark, sf_dir):
    """The registry written as one JSON file per agent and read back; identifiers, which are file names, aside."""
    folder = new_folder(spark, "registry-files")
    columns = ["name", "organization", "website", "status"]
    registry.write_registry_files(testdata.registry(spark, sf_dir).select(*columns), folder)
    return registry.read_registry_files(spark, folder).select(*columns)


# Audit --------------------------------------------------------------------------------------------------


def batch_stats(spark, sf_dir):
    return audit.batch_stats(_events(spark, sf_dir), PARAMS)


def run_summary(spark, sf_dir):
    mined = _mined(spark, sf_dir)
    summary = audit.run_summary(mined.issues, mined.resolution(_agents(spark, sf_dir), PARAMS), PARAMS)
    echoed = summary.select("*", *audit.parameter_columns(PARAMS))
    lists = ("tracked_orgs", "patch_wanted_labels")
    return echoed.withColumns({c: F.array_join(c, ",") for c in lists})


# The event table covers January 2024; the range asked about is wider on both sides.
COVERAGE = (date(2023, 12, 28), date(2024, 2, 2))


def _stamped(spark, sf_dir):
    """Archive files as the event table implies them: one per hour, named by it."""
    stamp = F.concat(
        F.date_format("ts", "yyyy-MM-dd"), F.lit("-"), F.hour("ts").cast("string"), F.lit(".json.gz")
    )
    files = table(spark, sf_dir, "events").select(F.concat(F.lit("/archive/"), stamp).alias("path"))
    return files.select(archive_date(F.col("path")).alias("archive_date"), archive_hour(F.col("path")).alias("archive_hour"))


def coverage_gaps(spark, sf_dir):
    gaps = audit.missing_days(spark, _stamped(spark, sf_dir), *COVERAGE)
    return gaps.select(F.col("archive_date").cast("string").alias("archive_date"))


def coverage_missing_hours(spark, sf_dir):
    """Hours of the range without any event."""
    gaps = audit.missing_hours(spark, _stamped(spark, sf_dir), *COVERAGE)
    return gaps.select(F.col("archive_date").cast("string").alias("archive_date"), "archive_hour", "stamp")


# Scalars ------------------------------------------------------------------------------------------------


def event_props(spark, sf_dir):
    props = table(spark, sf_dir, "events").select("event_id", payload(F.col("props")).alias("props"))
    return props.select(
        "event_id",
        field(F.col("props"), "$.k").alias("k"),
        field(F.col("props"), "$.missing").alias("missing"),
        first_field(F.col("props"), "$.missing", "$.k").alias("k_or_missing"),
    )


def payload_fields(spark, sf_dir):
    """Events read with their payload as a variant: a field that the schema of events gives up as odd, and one that it does not name."""
    folder = new_folder(spark, "payloads")
    _write_archive(spark, sf_dir, f"{folder}/archive")
    found = _payload_fields(archive.scan_payloads(spark, f"{folder}/archive", file_glob=_WRITTEN))
    counted = found.where(F.col("type").isNotNull()).groupBy("type", "author").agg(F.count("*").alias("events"), F.count_if(F.col("title").startswith("Order ")).alias("titled"))
    with small_scans(spark):
        counted.write.parquet(f"{folder}/counted")
    return spark.read.parquet(f"{folder}/counted")


def _payload_fields(seen):
    """Type, author and title of events with their payload as a variant; both fields are taken in one pass over it."""
    issue = field(F.col("payload"), "$", "struct<issue: struct<user: string, title: string>>")["issue"]
    user, title = F.col("issue.user"), F.col("issue.title")
    return seen.select("type", issue.alias("issue")).select("type", F.when(user.startswith("{"), F.lit("account")).otherwise(user).alias("author"), title.alias("title"))


def oversized_lines(spark, sf_dir):
    """Lines over and under a bound: those under it are parsed, those over it are listed by size."""
    folder = new_folder(spark, "oversized")
    bodies = table(spark, sf_dir, "orders").select(
        F.to_json(F.struct(F.lit("IssuesEvent").alias("type"), F.col("o_orderkey").cast("string").alias("id"), F.repeat(F.lit("x"), (F.col("o_orderkey") % 50).cast("int")).alias("padding"))).alias("value")
    )
    bodies.write.option("compression", "gzip").text(f"{folder}/slot=1998-01-01-0")
    events, too_long = archive.scan_lines(spark, folder, largest_line=60, file_glob=_WRITTEN)
    kept = archive.readable(events).groupBy().agg(F.lit("event").alias("kind"), F.count("*").alias("lines"), F.sum(F.col("id").cast("bigint")).alias("amount"))
    passed = too_long.groupBy().agg(F.lit("too long").alias("kind"), F.count("*").alias("lines"), F.sum("bytes").alias("amount"))
    return kept.unionByName(passed)


def normalized_timestamps(spark, sf_dir):
    """Ten spellings of a time, by order key: canonical, spaced, offsets, dates, and three that are no time."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    spellings = [
        F.concat(day, F.lit("T01:02:03Z")),
        F.concat(day, F.lit(" 01:02:03+00")),
        F.concat(day, F.lit("T10:00:00+02:00")),
        F.concat(F.lit("  "), day, F.lit("   01:02:03.456 ")),
        day,
        F.lit(None).cast("string"),
        F.lit(""),
        F.lit("N/A"),
        F.concat(F.lit("garbage "), day),
        F.date_format("o_orderdate", "yyyy"),
    ]
    slot = F.col("o_orderkey") % len(spellings)
    text = reduce(lambda c, i: c.when(slot == i, spellings[i]), range(1, len(spellings)), F.when(slot == 0, spellings[0]))
    return normalize_timestamps(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("created_at")), ["created_at"])


def days_open(spark, sf_dir):
    """Whole days from an order to a moment that is not midnight."""
    since = parse_iso(F.date_format(F.col("o_orderdate") + F.expr("interval '23:30:00' hour to second"), ISO_OUTPUT))
    until = parse_iso(F.concat(F.lit("1998-07-01T"), F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0"), F.lit(":00:00Z")))
    return table(spark, sf_dir, "orders").select("o_orderkey", whole_days(since, until).alias("days_open"))


# Sources, sinks and incremental runs --------------------------------------------------------------------


def _archive_lines(found, slot):
    """The lines of each event as one text, so that each is made and moved once: the event, a broken line, and the event with an author that is no object."""
    # Labels are raw JSON text in the frame and an array in the archive.
    labels = F.from_json("payload.issue.labels", "array<struct<name: string>>")
    payload = F.col("payload").withField("issue.labels", labels).alias("payload")
    opened = (F.col("type") == "IssuesEvent") & F.col("payload.issue.closed_at").isNull()
    shown = found.select(
        F.to_json(F.struct("type", "id", "created_at", "repo", payload)).alias("event"),
        F.when(F.col("type") == "PullRequestEvent", F.coalesce(F.concat(F.lit("{broken "), F.col("id")), F.lit(""))).alias("broken"),
        opened.alias("opened"),
        slot.alias("slot"),
    )
    odd = F.when(F.col("opened"), F.regexp_replace("event", '"labels":', '"user":"ghost","labels":'))
    return shown.select(F.concat_ws("\n", "event", "broken", odd).alias("value"), "slot")


def _write_archive(spark, sf_dir, folder, daily=False, days=None):
    """The events as gzipped JSON lines. A folder is one archive file's worth, named by month to keep them few; with ``daily``
    by day in the window, and outside by the end of the month that is farther from it.

    The rebalance spreads a month that holds much of the data over several files. Each opened issue is shown once more, with an
    author that is no object. With ``days`` only of these, added to what is there.
    """
    found = _events(spark, sf_dir) if days is None else _events(spark, sf_dir).where(days)
    day = F.col("archive_date")
    file_day = F.trunc(day, "month")
    if daily:
        after, before = day > F.lit(PARAMS.end.date()), day < F.lit(PARAMS.start.date())
        file_day = F.when(after, F.last_day(day)).when(before, file_day).otherwise(day)
    slot = F.concat(F.date_format(file_day, "yyyy-MM-dd"), F.lit("-0"))
    with side_by_side_writers(spark), dropped_shuffles(spark):
        (
            _archive_lines(found, slot)
            .hint("rebalance", "slot")
            .write.partitionBy("slot")
            .option("compression", "gzip")
            .option("zlib.compress.level", "BEST_SPEED")
            .mode("append")
            .text(folder)
        )


# Spark names its own text files; only the ending is known.
_WRITTEN = "*.gz"


def scan_roundtrip(spark, sf_dir):
    """Archive written, then its window read back: counts per month and type, broken lines as their own type."""
    folder = new_folder(spark, "archive")
    _write_archive(spark, sf_dir, folder)
    scanned = archive.scan_archive(spark, folder, first=date(1998, 1, 1), last=date(1998, 7, 1), file_glob=_WRITTEN)
    kind = F.when(archive.is_unreadable(), F.lit("(broken)")).otherwise(F.col("type"))
    return scanned.groupBy(F.col("archive_date").cast("string").alias("slot"), kind.alias("type")).agg(
        F.count("*").alias("lines")
    )


def curated_leaderboard(spark, sf_dir):
    """The leaderboard by way of archive files and the curated table."""
    folder = new_folder(spark, "curated")
    _write_archive(spark, sf_dir, f"{folder}/archive")
    scanned = archive.scan_archive(spark, f"{folder}/archive", file_glob=_WRITTEN)
    curated.write_curated(scanned, PARAMS, f"{folder}/curated")
    mined = mine_curated(spark, f"{folder}/curated")
    agents = _agents(spark, sf_dir)
    found = resolution.resolved_issues(mined.issues, mined.resolution(agents, PARAMS), PARAMS)
    return leaderboard.leaderboard(agents, found)


def versioned_leaderboard(spark, sf_dir):
    """The leaderboard of a curated table of two schema versions: the older has issue numbers as numbers, no lines and paths, and a column that is gone."""
    folder = new_folder(spark, "versions")
    _write_archive(spark, sf_dir, f"{folder}/archive")
    # both versions are of rows that are parsed once
    curated.write_curated(archive.scan_archive(spark, f"{folder}/archive", file_glob=_WRITTEN), PARAMS, f"{folder}/parsed")
    rows = spark.read.schema(curated.CURATED).parquet(f"{folder}/parsed")
    older = F.coalesce(F.col("event_ts") < F.lit("1995-01-01").cast("timestamp"), F.lit(False))
    number = F.col("issue").withField("issue_number", F.col("issue.issue_number").cast("bigint"))
    first = rows.where(older).withColumn("issue", number).withColumn("host", F.lit("h")).drop("line", "file_path")
    curated.write_version(first, f"{folder}/curated", 1)
    curated.write_version(rows.where(~older), f"{folder}/curated", 2)
    mined = mine_curated(spark, f"{folder}/curated", read=curated.read_versions)
    agents = _agents(spark, sf_dir)
    found = resolution.resolved_issues(mined.issues, mined.resolution(agents, PARAMS), PARAMS)
    return leaderboard.leaderboard(agents, found)


def single_document_roundtrip(spark, sf_dir):
    """All parts of the result written as one document, an entry a line, and read back."""
    folder = new_folder(spark, "document")
    kept = results_of(_mined(spark, sf_dir), _agents(spark, sf_dir), PARAMS, keep_in=f"{folder}/kept")
    results.write_document(kept, f"{folder}/document")
    return _part_rows(results.read_document(spark, f"{folder}/document"))


def document_roundtrip(spark, sf_dir):
    """All parts of the result written as documents and read back, one row per entry."""
    folder = new_folder(spark, "documents")
    kept = results_of(_mined(spark, sf_dir), _agents(spark, sf_dir), PARAMS, keep_in=f"{folder}/kept")
    results.write_documents(kept, f"{folder}/documents", shards=4)
    return _part_rows(results.read_documents(spark, f"{folder}/documents"))


def results_roundtrip(spark, sf_dir):
    """All parts of the result written as tables and read back, one row per entry."""
    folder = new_folder(spark, "results")
    kept = results_of(_mined(spark, sf_dir), _agents(spark, sf_dir), PARAMS, keep_in=f"{folder}/kept")
    results.write_results(kept, f"{folder}/results")
    return _part_rows(results.read_results(spark, f"{folder}/results"))


def _part_rows(read: results.Results) -> DataFrame:
    board = read.leaderboard.select(
        F.lit("leaderboard").alias("part"), F.col("github_identifier").alias("entry"),
        F.concat_ws("|", "name", "website").alias("detail"), F.col("resolved_issues").alias("amount"),
    )
    months = read.monthly.select(
        F.lit("monthly").alias("part"), F.col("agent_name").alias("entry"), F.col("month").alias("detail"),
        F.col("resolved").alias("amount"),
    )
    wanted = read.wanted.select(
        F.lit("wanted").alias("part"), F.col("url").alias("entry"),
        F.concat_ws("|", "repo", "title", "state", "created_at", joined_labels(F.col("labels"))).alias("detail"),
        F.col("number").cast("bigint").alias("amount"),
    )
    return board.unionByName(months).unionByName(wanted)


def incremental_leaderboard(spark, sf_dir):
    """The leaderboard of a stream that folds the archive a few files at a time."""
    folder = new_folder(spark, "incremental")
    _write_archive(spark, sf_dir, f"{folder}/archive")
    incremental.fold_new_files(
        spark, f"{folder}/archive", folder, PARAMS, files_per_batch=40, file_glob=_WRITTEN
    )
    mined = incremental.read_state(spark, folder)
    agents = _agents(spark, sf_dir)
    found = resolution.resolved_issues(mined.issues, mined.resolution(agents, PARAMS), PARAMS)
    return leaderboard.leaderboard(agents, found)


def incremental_windowed_leaderboard(spark, sf_dir):
    """The leaderboard of the window's archive days, from the kept state of a stream that has folded all days."""
    folder = new_folder(spark, "incremental-window")
    _write_archive(spark, sf_dir, f"{folder}/archive", daily=True)
    incremental.fold_new_files(
        spark, f"{folder}/archive", folder, PARAMS, files_per_batch=200, skip_damaged_files=True, file_glob=_WRITTEN
    )
    mined = incremental.read_state(spark, folder, PARAMS.start.date(), PARAMS.end.date(), PARAMS.orgs)
    agents = _agents(spark, sf_dir)
    found = resolution.resolved_issues(mined.issues, mined.resolution(agents, PARAMS), PARAMS)
    return leaderboard.leaderboard(agents, found)


def maintained_leaderboard(spark, sf_dir):
    """The leaderboard of outcomes that were brought up to date after each batch of a stream."""
    folder = new_folder(spark, "maintained")
    _write_archive(spark, sf_dir, f"{folder}/archive")
    agents = _agents(spark, sf_dir)
    incremental.fold_new_files(
        spark, f"{folder}/archive", folder, PARAMS, files_per_batch=40, file_glob=_WRITTEN, after_batch=lambda: maintained.refresh(spark, folder, agents)
    )
    found = maintained.resolved_outcomes(maintained.read_outcomes(spark, folder), PARAMS)
    return leaderboard.leaderboard(agents, found)


def ledger_leaderboard(spark, sf_dir):
    """The leaderboard of an archive that came in two parts, each parsed once, by way of the file ledger."""
    folder = new_folder(spark, "ledger")
    _write_archive(spark, sf_dir, f"{folder}/archive", days=F.col("archive_date") < F.lit(date(1995, 1, 1)))
    parsed = [ledger.parse_new_files(spark, f"{folder}/archive", folder, PARAMS, file_glob=_WRITTEN)]
    _write_archive(spark, sf_dir, f"{folder}/archive", days=F.col("archive_date") >= F.lit(date(1995, 1, 1)))
    parsed += [ledger.parse_new_files(spark, f"{folder}/archive", folder, PARAMS, file_glob=_WRITTEN) for _ in range(2)]
    files = archive.archive_files(spark, f"{folder}/archive", _WRITTEN).count()
    if parsed != [parsed[0], files - parsed[0], 0]:
        raise AssertionError(f"{parsed} of {files} files")
    mined = mine_curated(spark, folder, read=ledger.read_parsed)
    agents = _agents(spark, sf_dir)
    found = resolution.resolved_issues(mined.issues, mined.resolution(agents, PARAMS), PARAMS)
    return leaderboard.leaderboard(agents, found)


def damaged_leaderboard(spark, sf_dir):
    """The leaderboard of a stream that goes on past a file that was cut short, with the number of dead letters; the file's lines are in another as well."""
    folder = new_folder(spark, "damaged")
    _write_archive(spark, sf_dir, f"{folder}/archive")
    testdata.add_files(spark, f"{folder}/archive", _WRITTEN)
    incremental.fold_new_files(spark, f"{folder}/archive", folder, PARAMS, files_per_batch=400, skip_damaged_files=True, file_glob=_WRITTEN)
    mined = incremental.read_state(spark, folder)
    agents = _agents(spark, sf_dir)
    found = resolution.resolved_issues(mined.issues, mined.resolution(agents, PARAMS), PARAMS)
    dead = incremental.dead_letters(spark, folder).where("fault is not null").count()
    return leaderboard.leaderboard(agents, found).withColumn("dead_letters", F.lit(dead).cast("bigint"))


def archive_inventory(spark, sf_dir):
    """The files of an archive by day, also an hour whose only file is empty."""
    folder = new_folder(spark, "inventory")
    _write_archive(spark, sf_dir, folder)
    testdata.add_files(spark, folder, _WRITTEN)
    files = archive.file_inventory(spark, folder, _WRITTEN)
    days = files.groupBy("archive_date", "archive_hour").agg(F.max("bytes").alias("most"))
    empty = audit.empty_hours(files).withColumn("empty", F.lit(True))
    return days.join(empty, ["archive_date", "archive_hour"], "left").select(
        F.col("archive_date").cast("string").alias("archive_date"), "archive_hour", F.coalesce("empty", F.lit(False)).alias("empty")
    )


QUERIES: dict[str, Query] = {
    "issue_snapshots": issue_snapshots,
    "issue_variants": issue_variants,
    "issue_labels": issue_labels,
    "pull_versions": pull_versions,
    "pr_facts": pr_facts,
    "issue_links": issue_links,
    "reference_forms": reference_forms,
    "issue_resolution": issue_resolution,
    "resolved_issues": resolved_issues,
    "wanted_issues": wanted_issues,
    "resolved_issues_documented_rule": resolved_issues_documented_rule,
    "wanted_issues_documented_rule": wanted_issues_documented_rule,
    "resolved_by_agent": resolved_by_agent,
    "resolved_counts": resolved_counts,
    "leaderboard": leaderboard_rows,
    "leaderboard_view": leaderboard_view,
    "leaderboard_search": leaderboard_search,
    "windowed_leaderboard": windowed_leaderboard,
    "wanted_view": wanted_view,
    "monthly_long": monthly_long,
    "monthly_dense": monthly_dense,
    "monthly_matrix": monthly_matrix,
    "months_present": months_present,
    "agent_totals": agent_totals,
    "top_agents": top_agents,
    "top_agents_series": top_agents_series,
    "active_agents": active_agents,
    "registry_summary": registry_summary,
    "agent_identifiers": agent_identifiers,
    "submission_validation": submission_validation,
    "registry_append": registry_append,
    "registry_of_two_writers": registry_of_two_writers,
    "registry_scan": registry_scan,
    "batch_stats": batch_stats,
    "run_summary": run_summary,
    "coverage_gaps": coverage_gaps,
    "coverage_missing_hours": coverage_missing_hours,
    "event_props": event_props,
    "payload_fields": payload_fields,
    "oversized_lines": oversized_lines,
    "archive_inventory": archive_inventory,
    "normalize_timestamps": normalized_timestamps,
    "days_open": days_open,
    "scan_roundtrip": scan_roundtrip,
    "curated_leaderboard": curated_leaderboard,
    "document_roundtrip": document_roundtrip,
    "results_roundtrip": results_roundtrip,
    "incremental_leaderboard": incremental_leaderboard,
    "incremental_windowed_leaderboard": incremental_windowed_leaderboard,
    "single_document_roundtrip": single_document_roundtrip,
    "ledger_leaderboard": ledger_leaderboard,
    "versioned_leaderboard": versioned_leaderboard,
    "damaged_leaderboard": damaged_leaderboard,
    "maintained_leaderboard": maintained_leaderboard,
}


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: _in_utc(query) for name, query in QUERIES.items()}
