"""The agent registry: who is active, and which submissions are accepted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuetrail.functions.text import is_blank, is_filled, stripped

# Fixed value: the status of an agent that takes part.
ACTIVE = "active"

# Reasons for turning a submission down, in the order they are checked.
MISSING_IDENTIFIER = "GitHub identifier is required"
MISSING_NAME = "Agent name is required"
MISSING_ORGANIZATION = "Organization name is required"
MISSING_WEBSITE = "Website URL is required"
UNKNOWN_USER = "GitHub identifier not found"
DUPLICATE = "Agent already exists"


def active_agents(registry: DataFrame) -> DataFrame:
    """Active agents, one row per identifier; of several, the one from the last source file."""
    fields = [c for c in registry.columns if c not in ("github_identifier", "file_path")]
    order = ["file_path"] if "file_path" in registry.columns else []
    return (
        registry.where(F.col("status") == ACTIVE)
        .groupBy("github_identifier")
        .agg(F.max(F.struct(*order, *fields)).alias("entry"))
        .select("github_identifier", *[F.col(f"entry.{f}").alias(f) for f in fields])
    )


def matching_agents(agents: DataFrame) -> DataFrame:
    """Agents whose identifier can be matched with a pull request's creator."""
    return agents.where(is_filled(F.col("github_identifier")))


def registry_summary(registry: DataFrame) -> DataFrame:
    return registry.agg(
        F.count_if(F.coalesce(F.col("status") == ACTIVE, F.lit(False))).alias("active_agents"),
        F.count("*").alias("total_files"),
    )


def _field_problem() -> Column:
    checks = [
        ("identifier", MISSING_IDENTIFIER),
        ("name", MISSING_NAME),
        ("organization", MISSING_ORGANIZATION),
        ("website", MISSING_WEBSITE),
    ]
    problem = F.lit(None).cast("string")
    for column, reason in reversed(checks):
        problem = F.when(is_blank(F.col(column)), F.lit(reason)).otherwise(problem)
    return problem


def validate_submissions(submissions: DataFrame, registry: DataFrame, users: DataFrame, order_by: str) -> DataFrame:
    """Accept or reject each submission, with the first reason that applies.

    ``users`` lists the logins that exist, ``registry`` the identifiers already taken, and ``order_by`` is a
    unique column: of several good submissions of one identifier the smallest is accepted.

    Identifiers are reduced to one row each before they meet the users and the registry, so a much repeated
    identifier weighs nothing there. Its own rows are then looked up in that verdict table, where
    each key is single and the runtime can split a skewed left side. Incomplete rows skip the lookup.
    """
    fields = ["identifier", "name", "organization", "website"]
    checked = submissions.select(
        order_by, _field_problem().alias("problem"), *[stripped(F.col(c)).alias(c) for c in fields]
    )
    complete = checked.where(F.col("problem").isNull())
    first = complete.groupBy("identifier").agg(F.min(order_by).alias("first_of_identifier"))

    logins = users.select(F.col("login").alias("identifier")).distinct().withColumn("is_user", F.lit(True))
    taken = (
        registry.select(F.col("github_identifier").alias("identifier")).distinct().withColumn("is_taken", F.lit(True))
    )
    verdicts = first.join(logins, "identifier", "left").join(taken, "identifier", "left")

    reason = (
        F.when(F.col("is_user").isNull(), F.lit(UNKNOWN_USER))
        .when(F.col("is_taken").isNotNull() | (F.col(order_by) != F.col("first_of_identifier")), F.lit(DUPLICATE))
    )
    looked_up = complete.join(verdicts, "identifier", "left").select(order_by, *fields, reason.alias("reason"))
    incomplete = checked.where(F.col("problem").isNotNull()).select(order_by, *fields, F.col("problem").alias("reason"))
    return looked_up.unionByName(incomplete).withColumn(
        "status", F.when(F.col("reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    )


def accepted_agents(validated: DataFrame, *more: str) -> DataFrame:
    """Accepted submissions as registry rows, with more columns if named."""
    return validated.where(F.col("status") == "accepted").select(
        "name",
        "organization",
        F.col("identifier").alias("github_identifier"),
        "website",
        F.lit(ACTIVE).alias("status"),
        *more,
    )
