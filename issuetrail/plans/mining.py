"""The mining run: archive to curated table to resolution to results."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from issuetrail.operators.audit import run_parameters
from issuetrail.operators.issues import issue_snapshots, issue_state, latest_issues, merge_issue_state
from issuetrail.operators.leaderboard import leaderboard
from issuetrail.operators.monthly import kept_counts, monthly_counts, monthly_grid
from issuetrail.operators.pulls import (
    curated_links,
    issue_links,
    merge_pull_state,
    pull_facts,
    pull_facts_of,
    pull_state,
)
from issuetrail.operators.registration import active_agents, matching_agents
from issuetrail.operators.resolution import agent_merges, candidate_links, issue_resolution, resolved_issues, wanted_issues
from issuetrail.params import Params
from issuetrail.sources.curated import read_curated
from issuetrail.sources.ledger import parse_new_files, read_parsed
from issuetrail.sources.registry import read_registry_files
from issuetrail.sources.results import Results, write_document, write_results
from issuetrail.sources.session import use_utc


@dataclass(frozen=True)
class Mined:
    """The three relations everything else is computed from."""

    issues: DataFrame
    facts: DataFrame
    links: DataFrame

    def resolution(self, agents: DataFrame, params: Params | None = None) -> DataFrame:
        """The agent of each linked issue; with ``params`` only of the issues that a run with these can use."""
        links = candidate_links(self.links, self.issues, params) if params else self.links
        return issue_resolution(links, agent_merges(self.facts, matching_agents(agents)))


def mine_events(events: DataFrame, params: Params) -> Mined:
    return Mined(latest_issues(events, params), pull_facts(events), issue_links(events))


def mine_curated(
    spark: SparkSession, folder: str, first: date | None = None, last: date | None = None, read: Callable[..., DataFrame] = read_curated
) -> Mined:
    """From the curated table, or with ``read_parsed`` from that of a ledger: each relation reads only its own kind, days and columns."""
    issues = read(spark, folder, "issue", first, last)
    pulls = read(spark, folder, "pull", first, last)
    return Mined(
        issue_snapshots(merge_issue_state(issue_state(issues))),
        pull_facts_of(merge_pull_state(pull_state(pulls))),
        curated_links(pulls),
    )


def results_of(mined: Mined, agents: DataFrame, params: Params, keep_in: str | None = None) -> Results:
    """All parts of the result.

    With ``keep_in`` the resolution and the resolved issues are written there and read back, so that the
    parts share them: the fact tables are shuffled once, and a lost executor costs no more than its last stage.
    """
    spark = agents.sparkSession
    if keep_in:
        mined = replace(mined, issues=_kept(mined.issues, f"{keep_in}/issues"))
    issues, resolution = mined.issues, mined.resolution(agents, params)
    if keep_in:
        resolution = _kept(resolution, f"{keep_in}/resolution")
    resolved = resolved_issues(issues, resolution, params)
    if keep_in:
        resolved = _kept(resolved, f"{keep_in}/resolved")
    return Results(
        leaderboard=leaderboard(agents, resolved),
        monthly=monthly_grid(kept_counts(monthly_counts(resolved, agents)), params),
        wanted=wanted_issues(issues, resolution, params),
        run=run_parameters(spark, params),
    )


def _kept(df: DataFrame, folder: str) -> DataFrame:
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def run(spark: SparkSession, archive: str, registry: str, output: str, params: Params) -> Results:
    """Mines an archive for the registered agents and writes result tables and a document under ``output``.

    Archive files that an earlier run with this output has parsed are not opened again; see ``sources.ledger``.
    """
    use_utc(spark)
    agents = active_agents(read_registry_files(spark, registry))
    if matching_agents(agents).isEmpty():
        raise ValueError(f"no active agents in {registry}")
    first, last = params.start.date(), params.end.date()
    parse_new_files(spark, archive, output, params, first, last)
    mined = mine_curated(spark, output, first, last, read=read_parsed)
    results = results_of(mined, agents, params, keep_in=f"{output}/kept")
    write_results(results, f"{output}/results")
    write_document(results, f"{output}/document")
    return results
