"""Coverage of an archive, statistics per batch, and the summary of a run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.operators.issues import is_issue_event, issue_fields
from issuetrail.operators.pulls import is_pull_event, pull_fields
from issuetrail.operators.resolution import is_closed_in_window, is_wanted
from issuetrail.functions.timestamps import instant_of
from issuetrail.params import Params


def hour_grid(spark: SparkSession, first: date, last: date) -> DataFrame:
    """Every hour of every day from first to last, with the stamp its archive file carries."""
    hours = ((last - first).days + 1) * 24
    day = F.date_add(F.lit(first), F.floor(F.col("id") / 24).cast("int"))
    return (
        spark.range(hours)
        .select(day.alias("archive_date"), F.pmod("id", F.lit(24)).cast("int").alias("archive_hour"))
        .withColumn("stamp", F.format_string("%s-%d", F.col("archive_date").cast("string"), F.col("archive_hour")))
    )


def missing_hours(spark: SparkSession, present: DataFrame, first: date, last: date) -> DataFrame:
    """Hours of the range that no row of ``present(archive_date, archive_hour)`` covers."""
    seen = present.select("archive_date", "archive_hour").distinct()
    return hour_grid(spark, first, last).join(seen, ["archive_date", "archive_hour"], "left_anti")


def missing_days(spark: SparkSession, present: DataFrame, first: date, last: date) -> DataFrame:
    """Days of the range without any hour present."""
    seen = present.select("archive_date").distinct()
    days = hour_grid(spark, first, last).where(F.col("archive_hour") == 0).select("archive_date")
    return days.join(seen, "archive_date", "left_anti")


def empty_hours(inventory: DataFrame) -> DataFrame:
    """Hours that have files, all of them empty; inventory: of ``archive.file_inventory``. They are no missing hours, whose files never came."""
    sized = inventory.where(F.col("archive_date").isNotNull()).groupBy("archive_date", "archive_hour").agg(F.max("bytes").alias("most"))
    return sized.where(F.col("most") == 0).select("archive_date", "archive_hour")


def within_window(events: DataFrame, params: Params) -> DataFrame:
    """Events of the archive days from the window's first to its last, both included."""
    return events.where(F.col("archive_date").between(F.lit(params.start.date()), F.lit(params.end.date())))


def with_batch(events: DataFrame, params: Params) -> DataFrame:
    """Number of the batch an event's archive day falls into, counted from the window's first day."""
    day = F.datediff(F.col("archive_date"), F.lit(params.start.date()))
    return events.withColumn("batch", F.floor(day / params.batch_days).cast("int"))


def batch_stats(events: DataFrame, params: Params) -> DataFrame:
    """Per batch: archive files, issue and pull-request events, and the distinct forms among them.

    One pass: every event gives its file and the digest of its form, so that neither bodies nor titles are shuffled.
    """
    batched = with_batch(within_window(events, params), params)

    def digest(fields: Column) -> Column:
        return F.sha2(F.to_json(fields), 256)

    form = F.when(is_issue_event(), F.struct(F.lit("issue").alias("kind"), digest(F.struct(*issue_fields()).dropFields("created_at", "closed_at")).alias("key"))).when(
        is_pull_event(), F.struct(F.lit("pull").alias("kind"), digest(F.struct(*pull_fields())).alias("key"))
    )
    file = F.struct(F.lit("file").alias("kind"), F.col("file_path").alias("key"))
    told = batched.select("batch", F.explode(F.array_compact(F.array(file, form))).alias("seen"))
    counted = told.groupBy("batch", "seen.kind", "seen.key").agg(F.count("*").alias("n"))

    def events_of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))

    return counted.groupBy("batch").agg(
        F.count_if(F.col("kind") == "file").alias("files"),
        events_of("issue").alias("issue_events"),
        events_of("pull").alias("pr_events"),
        F.count_if(F.col("kind") == "issue").alias("issue_rows"),
        F.count_if(F.col("kind") == "pull").alias("pr_rows"),
    )


def run_summary(issues: DataFrame, resolution: DataFrame, params: Params) -> DataFrame:
    """One row: issues seen, wanted, resolved, and agents with at least one. Issues are read once."""
    agent_known = F.col("agent").isNotNull()
    wanted = is_wanted(params)
    if params.require_agent_pr_on_open:
        wanted = wanted & agent_known
    resolved = is_closed_in_window(params) & agent_known
    if params.require_closed_after_merge:
        resolved = resolved & (instant_of(F.col("closed_at")) >= instant_of(F.col("merged_at")))
    per_agent = (
        issues.join(resolution, issues["url"] == resolution["issue_url"], "left")
        .select("agent", wanted.alias("wanted"), resolved.alias("resolved"))
        .groupBy("agent")
        .agg(
            F.count("*").alias("seen"),
            F.count_if("wanted").alias("wanted"),
            F.count_if("resolved").alias("resolved"),
        )
    )
    return per_agent.agg(
        F.coalesce(F.sum("seen"), F.lit(0)).alias("issues_seen"),
        F.coalesce(F.sum("wanted"), F.lit(0)).alias("wanted_issues"),
        F.coalesce(F.sum("resolved"), F.lit(0)).alias("resolved_issues"),
        F.count_if(F.col("resolved") > 0).alias("agents_with_resolved"),
    )


def parameter_columns(params: Params) -> list[Column]:
    """What the run was asked to do, as constant columns."""
    return [
        F.lit(params.last_updated).alias("last_updated"),
        F.lit(params.window_days).alias("leaderboard_time_frame_days"),
        F.lit(params.gap_days).alias("longstanding_gap_days"),
        F.array(*[F.lit(o) for o in params.orgs]).cast("array<string>").alias("tracked_orgs"),
        F.array(*[F.lit(w) for w in params.wanted_labels]).cast("array<string>").alias("patch_wanted_labels"),
    ]


def run_parameters(spark: SparkSession, params: Params) -> DataFrame:
    return spark.range(1).select(*parameter_columns(params))
