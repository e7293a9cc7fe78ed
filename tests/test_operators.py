import random
from dataclasses import replace
from datetime import datetime, timezone

from helpers import agents, comment_on_pull, frame, issue_event, pull_event, random_events
from pyspark.sql import functions as F

from issuetrail.operators import audit, issues, leaderboard, monthly, pulls, registration, resolution
from issuetrail.params import Params
from issuetrail.plans.mining import mine_events

PARAMS = Params(as_of=datetime(2024, 7, 1, tzinfo=timezone.utc))


def snapshot(spark, *events, params=PARAMS):
    return {r["number"]: r.asDict() for r in issues.latest_issues(frame(spark, events), params).collect()}


def mined(spark, events, agent_frame, params=PARAMS):
    found = mine_events(frame(spark, events), params)
    return found.issues, found.resolution(agent_frame)


def test_snapshot_is_the_latest_event(spark):
    got = snapshot(
        spark,
        issue_event(1, "2024-01-01T00:00:00Z", closed="2024-01-03T00:00:00Z", labels=["old"], event_id="5"),
        issue_event(1, "2024-01-01T00:00:00Z", at="2024-01-04T00:00:00Z", labels=["New"], event_id="6", title="renamed"),
    )
    assert got["1"]["state"] == "open" and got["1"]["closed_at"] is None
    assert got["1"]["labels"] == ["new"] and got["1"]["title"] == "renamed"


def test_event_ids_order_by_length_first(spark):
    same = dict(at="2024-01-04T00:00:00Z")
    got = snapshot(
        spark,
        issue_event(1, "2024-01-01T00:00:00Z", event_id="9", title="nine", **same),
        issue_event(1, "2024-01-01T00:00:00Z", event_id="10", title="ten", **same),
    )
    assert got["1"]["title"] == "ten"


def test_which_events_are_issues(spark):
    got = snapshot(
        spark,
        issue_event(1, "2024-01-01T00:00:00Z"),
        issue_event(2, "2024-01-01T00:00:00Z", kind="IssueCommentEvent"),
        issue_event(3, "2024-01-01T00:00:00Z", kind="WatchEvent"),
        issue_event(4, "2024-01-01T00:00:00Z", kind="IssueCommentEvent", pull_request={}),
        issue_event(5, "2024-01-01T00:00:00Z", pull_request=None),
        issue_event(6, "2024-01-01T00:00:00Z", repo="other/r"),
        issue_event(7, "2024-01-01T00:00:00Z", html_url=None),
        issue_event(8, "2024-01-01T00:00:00Z", html_url=""),
        issue_event(9, None),
        issue_event(10, "2024-01-01T00:00:00Z", closed="soon", at="2024-01-01T00:00:00Z"),
    )
    assert sorted(got) == ["1", "10", "2", "5", "9"]
    assert got["9"]["created_at"] == "N/A"
    assert got["10"]["state"] == "closed" and got["10"]["closed_at"] == "soon"


def test_merged_is_final_and_creator_is_latest(spark):
    for order in (1, -1):
        events = [
            pull_event(1, "a", merged="2024-02-01T00:00:00Z", at="2024-02-01T00:00:00Z", event_id="1"),
            pull_event(1, "renamed", at="2024-02-02T00:00:00Z", event_id="2"),
            comment_on_pull(2, "b", merged="2024-02-03T00:00:00Z"),
            pull_event(3, "", merged="2024-02-03T00:00:00Z"),
        ][::order]
        facts = {r["pr_url"][-1]: (r["creator"], r["merged_at"]) for r in pulls.pull_facts(frame(spark, events)).collect()}
        assert facts == {"1": ("renamed", "2024-02-01T00:00:00Z"), "2": ("b", "2024-02-03T00:00:00Z")}


def test_links_come_from_every_body_version(spark):
    events = [pull_event(1, "a", body="#1"), pull_event(1, "a", body="#1 and #2"), comment_on_pull(1, "a", body="#3")]
    links = {r["issue_url"][-1] for r in pulls.issue_links(frame(spark, events)).collect()}
    assert links == {"1", "2", "3"}
    assert pulls.issue_links(frame(spark, events)).count() == 3


def test_earliest_agent_merge_wins_then_smallest_url(spark):
    events = [
        pull_event(9, "late", merged="2024-02-02T00:00:00Z", body="#1 #2"),
        pull_event(8, "early", merged="2024-02-01T00:00:00Z", body="#1"),
        pull_event(7, "human", merged="2024-01-01T00:00:00Z", body="#1 #2 #3"),
        pull_event(6, "early", body="#3"),
        pull_event(5, "tied", merged="2024-02-02T00:00:00Z", body="#2"),
    ]
    _, found = mined(spark, events, agents(spark, "late", "early", "tied", ""))
    assert {r["issue_url"][-1]: r["agent"] for r in found.collect()} == {"1": "early", "2": "tied"}


def outcome(spark, events, params=PARAMS):
    every = mined(spark, events, agents(spark, "bot"), params)
    resolved = sorted(int(r["number"]) for r in resolution.resolved_issues(*every, params).collect())
    wanted = sorted(int(r["number"]) for r in resolution.wanted_issues(*every, params).collect())
    return resolved, wanted


def test_window_and_gap_boundaries(spark):
    # The window is 2024-01-03 .. 2024-07-01 with both ends.
    fix = pull_event(90, "bot", merged="2024-01-02T00:00:00Z", body=" ".join(f"#{n}" for n in range(1, 20)))
    events = [
        fix,
        issue_event(1, "2023-01-01T00:00:00Z", closed="2024-01-03T00:00:00Z"),
        issue_event(2, "2023-01-01T00:00:00Z", closed="2024-01-02T23:59:59Z"),
        issue_event(3, "2023-01-01T00:00:00Z", closed="2024-07-01T00:00:00Z"),
        issue_event(4, "2023-01-01T00:00:00Z", closed="2024-07-01T00:00:01Z"),
        issue_event(5, "2024-01-05T00:00:01Z", closed="2024-02-04T00:00:00Z"),
        issue_event(6, "2024-01-05T00:00:00Z", closed="2024-02-04T00:00:00Z"),
        issue_event(7, "2023-01-01T00:00:00Z", closed="2024-03-01T00:00:00Z", labels=["question"]),
        issue_event(8, "2023-01-01T00:00:00Z", closed="some day", at="2024-01-01T00:00:00Z"),
        issue_event(11, "2024-06-01T00:00:00Z"),
        issue_event(12, "2024-06-01T01:00:00Z"),
        issue_event(13, "2024-01-01T00:00:00Z", labels=["debugging"]),
        issue_event(14, "2024-01-01T00:00:00Z", labels=["question"]),
        issue_event(15, "whenever", at="2024-01-01T00:00:00Z"),
        issue_event(30, "2024-01-01T00:00:00Z"),
    ]
    assert outcome(spark, events) == ([1, 3, 6, 7], [11, 13])
    assert outcome(spark, events, replace(PARAMS, require_label_on_closed=True))[0] == [1, 3, 6]
    assert outcome(spark, events, replace(PARAMS, require_agent_pr_on_open=False))[1] == [11, 13, 30]


def test_closed_after_merge_switch(spark):
    events = [
        pull_event(1, "bot", merged="2024-03-01T00:00:00Z", body="#1 #2"),
        issue_event(1, "2023-01-01T00:00:00Z", closed="2024-02-29T00:00:00Z"),
        issue_event(2, "2023-01-01T00:00:00Z", closed="2024-03-01T00:00:00Z"),
    ]
    assert outcome(spark, events)[0] == [1, 2]
    assert outcome(spark, events, replace(PARAMS, require_closed_after_merge=True))[0] == [2]


def some_resolved(spark, *rows):
    return spark.createDataFrame(
        [(a, f"u{i}", c) for i, (a, c) in enumerate(rows)], "agent string, url string, closed_at string"
    )


def test_monthly_names_grid_and_top(spark):
    found = some_resolved(
        spark,
        ("a", "2024-02-01T00:00:00Z"), ("b", "2024-02-02T00:00:00Z"), ("b", "2024-04-02T00:00:00Z"),
        ("c", "2024-04-30T23:59:59Z"), ("stranger", "2024-05-01T00:00:00Z"),
    )
    known = agents(spark, "a", "b", "c", "idle", names={"a": "Shared", "b": "Shared", "c": "Cee"})
    counts = monthly.monthly_counts(found, known)
    assert {tuple(r) for r in counts.collect()} == {
        ("Shared", "2024-02", 2), ("Shared", "2024-04", 1), ("Cee", "2024-04", 1), ("stranger", "2024-05", 1)
    }
    grid = monthly.monthly_grid(counts, PARAMS)
    matrix = {r["agent_name"]: (r["months"], r["monthly_resolved"]) for r in monthly.monthly_matrix(grid).collect()}
    months = ["2024-02", "2024-04", "2024-05"]
    assert matrix == {"Shared": (months, [2, 1, 0]), "Cee": (months, [0, 1, 0]), "stranger": (months, [0, 0, 1])}
    assert [r["agent_name"] for r in monthly.top_agents(counts, 2).collect()] == ["Shared", "Cee"]
    assert monthly.top_agents(counts, 0).count() == 3 and monthly.top_agents(counts, None).count() == 3
    series = monthly.top_agents_series(grid, 2).collect()
    assert all(r["resolved"] > 0 for r in series) and {r["agent_name"] for r in series} == {"Shared", "Cee"}


def test_leaderboard_defaults_and_view(spark):
    found = some_resolved(spark, *[("a", "2024-02-01T00:00:00Z")] * 3, *[("b", "2024-02-01T00:00:00Z")] * 3)
    known = spark.createDataFrame(
        [("b", None, None), ("a", "Aye", "https://aye"), ("idle", "Idle", "https://idle")],
        "github_identifier string, name string, website string",
    )
    board = leaderboard.leaderboard(known, found)
    assert {tuple(r) for r in board.collect()} == {
        ("Unknown", "N/A", "b", 3), ("Aye", "https://aye", "a", 3), ("Idle", "https://idle", "idle", 0)
    }
    view = leaderboard.leaderboard_view(board)
    assert view.columns == ["rank", "Agent Name", "Website", "Resolved Issues"]
    assert [tuple(r) for r in view.collect()] == [(1, "Aye", "https://aye", 3), (2, "Unknown", "N/A", 3)]
    assert leaderboard.leaderboard_view(board, low=4).count() == 0
    assert leaderboard.leaderboard_view(board, high=3, term="AYE").count() == 1


def test_wanted_view_age(spark):
    rows = [("u1", "o/r", "t", "1", "2024-05-01T00:00:00Z", ["bug", "x"]), ("u2", "o/r", None, None, "N/A", None)]
    wanted = spark.createDataFrame(rows, "url string, repo string, title string, number string, created_at string, labels array<string>")
    view = leaderboard.wanted_view(wanted, PARAMS).select("Title", "Age (days)", "Labels", "issue_name").collect()
    assert [tuple(r) for r in view] == [("t", 61, "bug, x", "o/r#1"), ("", 0, "", "o/r#")]


def test_submission_reasons(spark):
    good = ("id", "n", "o", "w")
    rows = [
        (1, " ", "n", "o", "w"), (2, "id2", None, "o", "w"), (3, "id3", "n", "", "w"), (4, "id4", "n", "o", "  "),
        (5, "ghost", "n", "o", "w"), (6, "taken", "n", "o", "w"), (7, " new ", " N ", "o", "w"), (8, "new", "n", "o", "w"),
        (9, "", "", "", ""), (0, "new", "n", "", "w"),
    ]
    subs = spark.createDataFrame(rows, "k long, identifier string, name string, organization string, website string")
    users = spark.createDataFrame([("taken",), ("new",), ("id2",), ("new",)], "login string")
    known = spark.createDataFrame([("taken",)], "github_identifier string")
    got = {r["k"]: (r["status"], r["reason"]) for r in registration.validate_submissions(subs, known, users, "k").collect()}
    assert got == {
        0: ("rejected", registration.MISSING_ORGANIZATION),
        1: ("rejected", registration.MISSING_IDENTIFIER),
        2: ("rejected", registration.MISSING_NAME),
        3: ("rejected", registration.MISSING_ORGANIZATION),
        4: ("rejected", registration.MISSING_WEBSITE),
        5: ("rejected", registration.UNKNOWN_USER),
        6: ("rejected", registration.DUPLICATE),
        7: ("accepted", None),
        8: ("rejected", registration.DUPLICATE),
        9: ("rejected", registration.MISSING_IDENTIFIER),
    }
    added = registration.accepted_agents(registration.validate_submissions(subs, known, users, "k")).collect()
    assert [tuple(r) for r in added] == [("N", "o", "new", "w", "active")]


def everything(spark, events):
    known = agents(spark, "a", "b")
    pair = mined(spark, events, known)
    return (
        sorted(tuple(map(str, r)) for r in pair[0].collect()),
        sorted(tuple(r) for r in pair[1].collect()),
        tuple(audit.run_summary(*pair, PARAMS).first()),
    )


def test_order_and_repeats_of_events_do_not_matter(spark):
    events = random_events(3)
    expected = everything(spark, events)
    shuffled = events + events[::3]
    random.Random(4).shuffle(shuffled)
    assert everything(spark, shuffled) == expected


def test_pipeline_against_plain_python(spark):
    """The whole rule once more, issue by issue, over the same events."""
    events = random_events(5)
    key = lambda e: (e["created_at"], len(e["id"]), e["id"])
    latest, creators, merges, links = {}, {}, {}, set()
    for e in sorted(events, key=key):
        issue, pull = e["payload"].get("issue"), e["payload"].get("pull_request")
        if issue and "pull_request" not in issue:
            latest[issue["html_url"]] = issue
            continue
        url, user = (issue or pull)["html_url"], (issue or pull)["user"]["login"]
        merged = issue["pull_request"]["merged_at"] if issue else pull["merged_at"]
        creators[url] = user
        if merged:
            merges[url] = max(merged, merges.get(url, ""))
        links.add((f"https://github.com/apache/r/issues/{(issue or pull)['body'][1:]}", url))
    winner = {}
    for target, url in links:
        if url in merges and creators[url] in ("a", "b"):
            winner[target] = min(winner.get(target, ("~",)), (merges[url], url, creators[url]))
    resolved, wanted = set(), set()
    for url, issue in latest.items():
        if url not in winner:
            continue
        if issue["closed_at"] and "2024-01-03" <= issue["closed_at"] <= "2024-07-01T00:00:00Z":
            resolved.add((url, winner[url][2]))
        elif not issue["closed_at"] and issue["labels"][0]["name"] == "bug":
            wanted.add(url)
    pair = mined(spark, events, agents(spark, "a", "b"))
    assert {(r["url"], r["agent"]) for r in resolution.resolved_issues(*pair, PARAMS).collect()} == resolved
    assert {r["url"] for r in resolution.wanted_issues(*pair, PARAMS).collect()} == wanted
    summary = audit.run_summary(*pair, PARAMS).first()
    assert tuple(summary) == (len(latest), len(wanted), len(resolved), len({a for _, a in resolved}))


def test_nested_lists_stay_whole_and_short(spark):
    rows = [("hot" if n % 3 else f"a{n % 5}", f"u{n}", "r", "t", str(n), "closed", "c", "d", ["x"]) for n in range(3000)]
    found = spark.createDataFrame(
        rows,
        "agent string, url string, repo string, title string, number string, state string, "
        "created_at string, closed_at string, labels array<string>",
    )
    nested = resolution.resolved_by_agent(found, issues_per_row=100)
    sizes = nested.select("agent", F.size("issues").alias("n")).collect()
    assert sum(r["n"] for r in sizes) == 3000
    assert sum(r["n"] for r in sizes if r["agent"] == "hot") == 2000
    assert max(r["n"] for r in sizes) < 200


def test_coverage(spark):
    from datetime import date

    present = spark.createDataFrame([(date(2024, 1, 1), 0), (date(2024, 1, 3), 5)], "archive_date date, archive_hour int")
    days = audit.missing_days(spark, present, date(2024, 1, 1), date(2024, 1, 4)).collect()
    assert sorted(str(r[0]) for r in days) == ["2024-01-02", "2024-01-04"]
    hours = audit.missing_hours(spark, present, date(2024, 1, 1), date(2024, 1, 1))
    assert hours.count() == 23
    assert {r["stamp"] for r in hours.collect()} == {f"2024-01-01-{h}" for h in range(1, 24)}


def test_no_agents_no_results(spark):
    events = [pull_event(1, "bot", merged="2024-03-01T00:00:00Z", body="#1"), issue_event(1, "2023-01-01T00:00:00Z", closed="2024-03-01T00:00:00Z")]
    nobody = agents(spark, "x").where("false")
    pair = mined(spark, events, nobody)
    found = resolution.resolved_issues(*pair, PARAMS)
    assert found.count() == 0
    assert leaderboard.leaderboard(nobody, found).count() == 0
    assert monthly.monthly_grid(monthly.monthly_counts(found, nobody), PARAMS).count() == 0
    assert tuple(audit.run_summary(*pair, PARAMS).first()) == (1, 0, 0, 0)
