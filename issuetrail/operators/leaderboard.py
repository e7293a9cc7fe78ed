"""Resolved-issue counts per agent and the views over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuetrail.functions.text import issue_link, number_or_zero
from issuetrail.functions.labels import joined_labels
from issuetrail.functions.timestamps import instant_of, whole_days
from issuetrail.operators.ranking import numbered
from issuetrail.params import Params

# What stands in for a missing name or website.
UNKNOWN_NAME = "Unknown"
NO_WEBSITE = "N/A"


def resolved_counts(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("agent").agg(F.count("*").alias("resolved_issues"))


def leaderboard(agents: DataFrame, resolved: DataFrame) -> DataFrame:
    """Every registered agent with its count; an agent without any has zero."""
    counts = resolved_counts(resolved)
    return agents.join(counts, agents["github_identifier"] == counts["agent"], "left").select(
        F.coalesce(agents["name"], F.lit(UNKNOWN_NAME)).alias("name"),
        F.coalesce(agents["website"], F.lit(NO_WEBSITE)).alias("website"),
        agents["github_identifier"],
        F.coalesce(counts["resolved_issues"], F.lit(0)).cast("bigint").alias("resolved_issues"),
    )


def leaderboard_view(board: DataFrame, low: float | None = None, high: float | None = None, term: str | None = None) -> DataFrame:
    """Ranked display rows: non-zero agents, and optionally a count range with both ends and a search term. `rank` numbers what is shown."""
    shown = board.select(
        F.coalesce("name", F.lit(UNKNOWN_NAME)).alias("Agent Name"),
        F.coalesce("website", F.lit(NO_WEBSITE)).alias("Website"),
        number_or_zero(F.col("resolved_issues")).cast("bigint").alias("Resolved Issues"),
        F.col("github_identifier"),
    ).where(F.col("Resolved Issues") != 0)
    if low is not None:
        shown = shown.where(F.col("Resolved Issues") >= low)
    if high is not None:
        shown = shown.where(F.col("Resolved Issues") <= high)
    if term:
        needle = term.lower()
        shown = shown.where(
            F.lower("Agent Name").contains(needle) | F.lower("Website").contains(needle)
        )
    ranked = numbered(shown, [F.desc("Resolved Issues"), F.asc("github_identifier")])
    return ranked.drop("github_identifier").orderBy("rank")


def wanted_view(wanted: DataFrame, params: Params) -> DataFrame:
    """Display rows of the wanted list, numbered, oldest first. An unreadable creation time shows as age zero."""
    age = F.coalesce(whole_days(instant_of(F.col("created_at")), params.end_column), F.lit(0)).cast("bigint")
    shown = (
        wanted.select(
            F.coalesce("title", F.lit("")).alias("Title"),
            issue_link(F.col("url"), F.col("repo"), F.col("number")).alias("URL"),
            age.alias("Age (days)"),
            joined_labels(F.col("labels")).alias("Labels"),
            F.col("url").alias("issue_url"),
            F.concat(F.coalesce("repo", F.lit("")), F.lit("#"), F.coalesce("number", F.lit(""))).alias("issue_name"),
        )
    )
    return numbered(shown, [F.desc("Age (days)"), F.asc("issue_url")]).orderBy("rank")
