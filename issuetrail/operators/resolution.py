"""Which registered agent's merged pull request addressed which issue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuetrail.functions.grouping import group_by_text
from issuetrail.functions.labels import has_wanted_label
from issuetrail.functions.text import is_filled
from issuetrail.functions.timestamps import instant_of, whole_days
from issuetrail.params import Params


def agent_merges(facts: DataFrame, agents: DataFrame) -> DataFrame:
    """Merged pull requests whose creator is a registered agent.

    No broadcast hint: the registry is broadcast while its size is under the session's threshold,
    and otherwise joined by shuffle with skewed creators split at run time.
    """
    creators = agents.where(is_filled(F.col("github_identifier"))).select(F.col("github_identifier").alias("creator"))
    return facts.where(F.col("merged_at").isNotNull()).join(creators, "creator", "left_semi").select(
        "pr_url", "creator", "merged_at"
    )


def candidate_links(links: DataFrame, issues: DataFrame, params: Params) -> DataFrame:
    """Links of issues that the run can use: wanted, or closed in the window. The others needn't meet the merges."""
    used = issues.where(is_wanted(params) | is_closed_in_window(params)).select(F.col("url").alias("issue_url"))
    return links.join(used, "issue_url", "left_semi")


def issue_resolution(links: DataFrame, merges: DataFrame) -> DataFrame:
    """One agent per issue: the earliest merge, then the smallest pull-request URL.

    The minimum is combined before the shuffle, so an issue that very many pull requests mention
    reaches its reducer as one row per map task.
    """
    first = F.min(F.struct("merged_at", "pr_url", "creator")).alias("first")
    return group_by_text(links.join(merges, "pr_url"), "issue_url").agg(first).select(
        "issue_url",
        F.col("first.creator").alias("agent"),
        F.col("first.pr_url").alias("pr_url"),
        F.col("first.merged_at").alias("merged_at"),
    )


def is_wanted(params: Params) -> Column:
    """Open, labelled as wanted, and open for the gap or longer. Unreadable dates fail."""
    return (
        (F.col("state") == "open")
        & has_wanted_label(F.col("labels"), params.wanted_labels)
        & (whole_days(instant_of(F.col("created_at")), params.end_column) >= params.gap_days)
    )


def is_closed_in_window(params: Params) -> Column:
    """Closed inside the window, both ends included, after being open for the gap or longer."""
    closed = instant_of(F.col("closed_at"))
    fits = (
        (F.col("state") == "closed")
        & closed.between(params.start_column, params.end_column)
        & (whole_days(instant_of(F.col("created_at")), closed) >= params.gap_days)
    )
    if params.require_label_on_closed:
        fits = fits & has_wanted_label(F.col("labels"), params.wanted_labels)
    return fits


def _on_issue(issues: DataFrame, resolution: DataFrame) -> Column:
    return issues["url"] == resolution["issue_url"]


def wanted_issues(issues: DataFrame, resolution: DataFrame | None, params: Params) -> DataFrame:
    """Long-standing open issues that an agent's merged pull request refers to; any, if the rule needs none."""
    wanted = issues.where(is_wanted(params))
    if not params.require_agent_pr_on_open:
        return wanted
    return wanted.join(resolution, _on_issue(wanted, resolution), "left_semi")


def resolved_issues(issues: DataFrame, resolution: DataFrame, params: Params) -> DataFrame:
    """Long-standing issues closed in the window, with the agent that addressed each."""
    closed = issues.where(is_closed_in_window(params))
    resolved = closed.join(resolution, _on_issue(closed, resolution)).drop("issue_url")
    if params.require_closed_after_merge:
        # The kept merge is the earliest, so it decides for all of them.
        resolved = resolved.where(instant_of(F.col("closed_at")) >= instant_of(F.col("merged_at")))
    return resolved


def resolved_by_agent(resolved: DataFrame, issues_per_row: int = 1000) -> DataFrame:
    """Nested form: an agent and a list of its issues.

    An agent's issues are spread over as many rows as their number asks for, so no list grows
    with the data. Rows of one agent are numbered by ``part``.
    """
    counts = resolved.groupBy("agent").agg(F.count("*").alias("n"))
    parts = counts.select("agent", F.ceil(F.col("n") / issues_per_row).cast("int").alias("parts"))
    issue = F.struct("url", "repo", "title", "number", "state", "created_at", "closed_at", "labels")
    return (
        resolved.join(parts, "agent")
        .withColumn("part", F.pmod(F.xxhash64("url"), F.col("parts")).cast("int"))
        .groupBy("agent", "part")
        .agg(F.array_sort(F.collect_list(issue)).alias("issues"))
    )
