"""The month-by-agent matrix. Names that several agents share are counted together."""

from __future__ import annotations

from datetime import timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuetrail.functions.timestamps import month_key, instant_of
from issuetrail.params import Params
from issuetrail.sources.session import new_folder


def monthly_counts(resolved: DataFrame, agents: DataFrame) -> DataFrame:
    """(agent name, month, resolved), only where something was resolved.

    Counted per identifier first: what meets the registry is agents x months, not issues.
    """
    per_agent = (
        resolved.where(F.col("closed_at").isNotNull())
        .select("agent", month_key(instant_of(F.col("closed_at"))).alias("month"))
        .where(F.col("month").isNotNull())
        .groupBy("agent", "month")
        .agg(F.count("*").alias("n"))
    )
    names = agents.select(F.col("github_identifier").alias("agent"), "name")
    return (
        per_agent.join(names, "agent", "left")
        .groupBy(F.coalesce("name", "agent").alias("agent_name"), "month")
        .agg(F.sum("n").alias("resolved"))
    )


def months_present(counts: DataFrame) -> DataFrame:
    return counts.select("month").distinct()


def monthly_grid(counts: DataFrame, params: Params) -> DataFrame:
    """The counts with a zero for every month an agent missed.

    A resolved issue closed inside the window, so the window gives every month that can occur, in UTC like the counts. One aggregation makes a map from
    month to count of each agent, which is exploded over the window; months nobody has a count in are dropped by a semi join: the grid needs no
    cross join. That join reads the counts once more, so hand in a table (``kept_counts``) where making them is dear.
    """
    by_month = F.map_from_entries(F.collect_list(F.struct("month", "resolved")))
    rows = counts.groupBy("agent_name").agg(by_month.alias("by_month"))
    months = F.array(*[F.lit(month) for month in window_months(params)])
    grid = rows.select("agent_name", "by_month", F.explode(months).alias("month"))
    filled = grid.select("agent_name", "month", F.coalesce(F.element_at("by_month", F.col("month")), F.lit(0)).cast("bigint").alias("resolved"))
    return filled.join(months_present(counts), "month", "left_semi").select("agent_name", "month", "resolved")


def window_months(params: Params) -> list[str]:
    """The months that the window touches, from its two bounds."""
    first, last = (moment.year * 12 + moment.month - 1 for moment in (params.start.astimezone(timezone.utc), params.end.astimezone(timezone.utc)))
    return [f"{n // 12:04d}-{n % 12 + 1:02d}" for n in range(first, last + 1)]


def kept_counts(counts: DataFrame) -> DataFrame:
    """The counts as a written table: agents times months at most, however many issues they were made of."""
    folder = new_folder(counts.sparkSession, "monthly-counts")
    counts.write.parquet(folder)
    return counts.sparkSession.read.schema(counts.schema).parquet(folder)


def monthly_matrix(grid: DataFrame) -> DataFrame:
    """Per agent, the counts as an array in month order, beside the months they stand for.

    An array has one entry per window month at most.
    """
    cells = F.array_sort(F.collect_list(F.struct("month", "resolved")))
    return grid.groupBy("agent_name").agg(cells.alias("cells")).select(
        "agent_name",
        F.col("cells.month").alias("months"),
        F.col("cells.resolved").alias("monthly_resolved"),
    )


def agent_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("agent_name").agg(F.sum("resolved").alias("total"))


def top_agents(counts: DataFrame, top_n: int | None) -> DataFrame:
    """The agents with the largest totals; ties go by name. No limit when ``top_n`` is empty or not positive."""
    ranked = agent_totals(counts).orderBy(F.desc("total"), F.asc("agent_name"))
    return ranked.limit(top_n) if top_n is not None and top_n > 0 else ranked


def top_agents_series(counts: DataFrame, top_n: int | None) -> DataFrame:
    """Chart series: the positive monthly counts of the top agents.

    One aggregation gives each agent's total and its months, as many as the window has at most; the leaders' months are exploded.
    """
    months = F.collect_list(F.when(F.col("resolved") > 0, F.struct("month", "resolved"))).alias("months")
    rows = counts.groupBy("agent_name").agg(F.sum("resolved").alias("total"), months)
    if top_n is not None and top_n > 0:
        rows = rows.orderBy(F.desc("total"), F.asc("agent_name")).limit(top_n)
    return rows.select("agent_name", F.explode("months").alias("cell")).select("agent_name", "cell.month", "cell.resolved")
