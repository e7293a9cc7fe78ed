"""Issue snapshots from events.

The latest snapshot is the greatest ``(event time, event id, content)`` seen for a URL, and the
creation time the smallest one seen. Both are maxima and minima, so partial results merge in any
order and repeats change nothing: map-side combining, incremental folding and replays all agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuetrail.functions.grouping import KEY_HASH, group_by_text
from issuetrail.functions.labels import has_wanted_label, joined_labels, label_names
from issuetrail.functions.references import tracked_repo
from issuetrail.functions.text import is_filled
from issuetrail.functions.timestamps import MISSING, normalize_iso
from issuetrail.params import Params

# The event types that carry an issue.
ISSUE_EVENTS = ("IssuesEvent", "IssueCommentEvent")


def is_issue_event() -> Column:
    """The event shows an issue, not a pull request under an issue's number."""
    return (
        F.col("type").isin(*ISSUE_EVENTS)
        & F.col("payload.issue.pull_request").isNull()
        & F.col("payload.issue.html_url").isNotNull()
    )


def issue_fields() -> list[Column]:
    issue = "payload.issue"
    return [
        F.col(f"{issue}.html_url").alias("issue_url"),
        F.col("repo.name").alias("repo_name"),
        F.col(f"{issue}.title").alias("title"),
        F.col(f"{issue}.number").alias("issue_number"),
        F.col(f"{issue}.created_at").alias("created_at"),
        F.col(f"{issue}.closed_at").alias("closed_at"),
        F.col(f"{issue}.labels").alias("labels"),
    ]


def issue_is_tracked(params: Params) -> Column:
    return (
        is_filled(F.col("payload.issue.html_url"))
        & is_filled(F.col("repo.name"))
        & tracked_repo(F.col("repo.name"), params.orgs)
    )


def issue_rows(events: DataFrame, params: Params) -> DataFrame:
    """One row per event that shows a tracked issue."""
    return events.where(is_issue_event() & issue_is_tracked(params)).select(
        *issue_fields(), F.col("event_ts"), F.col("id").alias("event_id")
    )


def issue_variants(events: DataFrame, *within: str) -> DataFrame:
    """Every distinct form an issue was seen in (per ``within`` columns), with its time span as text. No org filter."""
    return (
        events.where(is_issue_event())
        .select(*within, *issue_fields())
        .groupBy(*within, "issue_url", "repo_name", "title", "issue_number", "labels")
        .agg(F.min("created_at").alias("created_at"), F.max("closed_at").alias("closed_at"))
    )


def issue_state(rows: DataFrame, *within: str) -> DataFrame:
    """Event rows in the mergeable form: the snapshot as one ordered struct, beside the ``within`` columns.

    Times are put in normal form here, before the aggregation, so that nothing above it repeats the work.
    """
    return rows.select(
        *within,
        "issue_url",
        F.struct(
            F.col("event_ts"),
            F.length("event_id").alias("id_length"),
            F.col("event_id"),
            normalize_iso(F.col("closed_at")).alias("closed_at"),
            F.col("repo_name").alias("repo"),
            F.col("title"),
            F.col("issue_number").alias("number"),
            F.col("labels"),
        ).alias("latest"),
        normalize_iso(F.col("created_at")).alias("created_at"),
    )


def merge_issue_state(state: DataFrame, *within: str) -> DataFrame:
    merged = group_by_text(state, "issue_url", *within).agg(F.max("latest").alias("latest"), F.min("created_at").alias("created_at"))
    return merged.drop(KEY_HASH)


def issue_snapshots(merged: DataFrame) -> DataFrame:
    """One row per issue. Labels are parsed here, once per issue instead of once per event."""
    closed = F.col("latest.closed_at")
    return merged.select(
        F.col("issue_url").alias("url"),
        F.col("latest.repo").alias("repo"),
        F.col("latest.title").alias("title"),
        F.col("latest.number").alias("number"),
        # Any closing time counts, readable or not; an unreadable one drops out at the window test.
        F.when(closed.isNotNull(), F.lit("closed")).otherwise(F.lit("open")).alias("state"),
        F.coalesce(F.col("created_at"), F.lit(MISSING)).alias("created_at"),
        closed.alias("closed_at"),
        label_names(F.col("latest.labels")).alias("labels"),
    )


def latest_issues(events: DataFrame, params: Params) -> DataFrame:
    return issue_snapshots(merge_issue_state(issue_state(issue_rows(events, params))))


def issue_labels(issues: DataFrame, params: Params) -> DataFrame:
    """Label text of every issue and whether it asks for a patch."""
    return issues.select(
        "url",
        joined_labels(F.col("labels")).alias("labels"),
        F.size("labels").alias("label_count"),
        has_wanted_label(F.col("labels"), params.wanted_labels).alias("wanted"),
    )
