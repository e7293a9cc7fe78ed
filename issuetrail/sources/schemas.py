"""Fixed schemas. Nothing is inferred from data."""

from __future__ import annotations

EVENT = """
    type string, id string, created_at string,
    repo struct<name: string>,
    payload struct<
        issue: struct<html_url: string, title: string, number: string, created_at: string, closed_at: string,
                      body: string, user: struct<login: string>, labels: string,
                      pull_request: struct<merged_at: string>>,
        pull_request: struct<html_url: string, merged_at: string, body: string, user: struct<login: string>>>
"""

CORRUPT = "_corrupt"

EVENT_WITH_CORRUPT = f"{EVENT}, {CORRUPT} string"

ISSUE_STRUCT = (
    "struct<html_url: string, title: string, number: string, created_at: string, closed_at: string, body: string, "
    "user: struct<login: string>, labels: string, pull_request: struct<merged_at: string>>"
)
PULL_STRUCT = "struct<html_url: string, merged_at: string, body: string, user: struct<login: string>>"

AGENT = "name string, organization string, website string, status string"
REGISTRY = "name string, organization string, github_identifier string, website string, status string"
VERDICT = "identifier string, name string, organization string, website string, status string, commit string"

ISSUE = (
    "url string, repo string, title string, number string, state string, "
    "created_at string, closed_at string, labels array<string>"
)

LEADERBOARD = "name string, website string, github_identifier string, resolved_issues bigint"
MONTHLY = "agent_name string, month string, resolved bigint"
METADATA = (
    "leaderboard_time_frame_days int, longstanding_gap_days int, "
    "tracked_orgs array<string>, patch_wanted_labels array<string>"
)
RUN = f"last_updated string, {METADATA}"


def struct_fields(ddl: str) -> str:
    """The same columns as struct fields."""
    return ", ".join(f"{name}: {kind}" for name, kind in (c.strip().split(" ", 1) for c in ddl.split(",")))


DOCUMENT = f"""
    last_updated string,
    leaderboard map<string, struct<{struct_fields(LEADERBOARD)}>>,
    monthly_metrics struct<agents: array<string>, months: array<string>,
                           data: map<string, struct<monthly_resolved: array<bigint>>>>,
    wanted_issues array<struct<{struct_fields(ISSUE)}>>,
    metadata struct<{struct_fields(METADATA)}>
"""
