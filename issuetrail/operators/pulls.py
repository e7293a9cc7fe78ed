"""Pull-request facts and issue links from events.

As for issues, everything kept per pull request is a maximum or a distinct set, so it merges in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuetrail.functions.grouping import KEY_HASH, group_by_text
from issuetrail.functions.references import own_issue_prefix, referenced_issue, references
from issuetrail.functions.text import is_filled
from issuetrail.functions.timestamps import normalize_iso


def is_pull_event() -> Column:
    """A comment on a pull request, or an event of the pull request itself."""
    return (
        (F.col("type") == "IssueCommentEvent") & F.col("payload.issue.pull_request").isNotNull()
    ) | (F.col("type") == "PullRequestEvent")


def pull_fields() -> list[Column]:
    """The same four facts from either event shape, in one pass over the events."""
    issue, pull = "payload.issue", "payload.pull_request"
    return [
        F.coalesce(f"{issue}.html_url", f"{pull}.html_url").alias("pr_url"),
        F.coalesce(f"{issue}.user.login", f"{pull}.user.login").alias("pr_creator"),
        F.coalesce(f"{issue}.pull_request.merged_at", f"{pull}.merged_at").alias("merged_at"),
        F.coalesce(f"{issue}.body", f"{pull}.body").alias("pr_body"),
    ]


def pull_is_named() -> Column:
    """The event names a pull request and its creator."""
    url, creator = pull_fields()[:2]
    return is_filled(url) & is_filled(creator)


def pull_versions(events: DataFrame) -> DataFrame:
    """Every distinct (URL, creator, merge time, body) seen."""
    return events.where(is_pull_event()).select(*pull_fields()).distinct()


def pull_rows(events: DataFrame) -> DataFrame:
    """One row per pull-request event that names a pull request and its creator."""
    return (
        events.where(is_pull_event())
        .select(*pull_fields(), F.col("event_ts"), F.col("id").alias("event_id"))
        .where(is_filled(F.col("pr_url")) & is_filled(F.col("pr_creator")))
    )


def referenced_issues(pr_url: Column, body: Column) -> Column:
    """URLs of all issues a body refers to, as an array."""
    prefix = own_issue_prefix(pr_url)
    return F.array_compact(F.transform(references(body), lambda r: referenced_issue(r, prefix)))


def pull_state(rows: DataFrame, *within: str) -> DataFrame:
    """Event rows in the mergeable form, beside the ``within`` columns."""
    return rows.select(
        *within,
        "pr_url",
        F.struct(
            F.col("event_ts"),
            F.length("event_id").alias("id_length"),
            F.col("event_id"),
            F.col("pr_creator").alias("creator"),
        ).alias("latest"),
        normalize_iso(F.col("merged_at")).alias("merged_at"),
    )


def merge_pull_state(state: DataFrame, *within: str) -> DataFrame:
    """A merge is final: a merged row wins over any number of unmerged ones."""
    merged = group_by_text(state, "pr_url", *within).agg(F.max("latest").alias("latest"), F.max("merged_at").alias("merged_at"))
    return merged.drop(KEY_HASH)


def pull_facts_of(merged: DataFrame) -> DataFrame:
    return merged.select("pr_url", F.col("latest.creator").alias("creator"), "merged_at")


def pull_facts(events: DataFrame) -> DataFrame:
    return pull_facts_of(merge_pull_state(pull_state(pull_rows(events))))


def link_rows(rows: DataFrame) -> DataFrame:
    """(issue, pull request) pairs of every event row. The body ends here and is never shuffled."""
    return rows.select(
        F.explode(referenced_issues(F.col("pr_url"), F.col("pr_body"))).alias("issue_url"), "pr_url"
    )


def issue_links(events: DataFrame) -> DataFrame:
    """Distinct links over every body version seen."""
    return link_rows(pull_rows(events)).distinct()


def curated_links(rows: DataFrame, *within: str) -> DataFrame:
    """Distinct links of curated rows, whose references are already extracted."""
    return rows.select(*within, F.explode("issue_urls").alias("issue_url"), "pr_url").distinct()
