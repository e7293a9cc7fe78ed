"""Operator 8, mixing sources to target weights: Poisson replication with hash-seeded draws, and a global shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.llm.common import checkpointed, table

#: Shares of the mixture; sources that are not named share what is left in proportion to their rows.
TARGETS = {"src0": 0.15, "src1": 0.10, "src2": 0.10}
SEED = "mix-1"
#: The greatest mean of a single draw.
MOST_RATE = 600


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the MD5 of the parts, the same in any engine and on any run."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def rates(documents: DataFrame, targets: dict[str, float]) -> DataFrame:
    """(source, rate): how often each document of a source is wanted on average, for a mixture of as many rows as there are."""
    sizes = documents.groupBy("source").agg(F.count("*").alias("n"))
    totals = sizes.agg(F.sum("n").alias("all"), F.sum(F.when(~_named(targets), F.col("n"))).alias("other")).first()
    share = F.lit(None).cast("double")
    for source, weight in targets.items():
        share = F.when(F.col("source") == source, F.lit(float(weight))).otherwise(share)
    every, other, rest = totals["all"] or 0, totals["other"] or 1, max(0.0, 1.0 - sum(targets.values()))
    return sizes.select("source", F.coalesce(share * every / F.col("n"), F.lit(rest) * every / other).alias("rate"))


def _named(targets: dict[str, float]) -> Column:
    return F.coalesce(F.col("source").isin(*targets), F.lit(False)) if targets else F.lit(False)


def poisson_steps(rate: Column) -> Column:
    """The distribution function of Poisson(rate) at 0, 1, ... up to far beyond any draw; its probabilities are built one from another."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    begin = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("steps"))

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(state["steps"], F.array(F.element_at(state["steps"], -1) + p)).alias("steps"))

    return F.aggregate(F.sequence(F.lit(1), last), begin, add, lambda state: state["steps"])


def replicate(documents: DataFrame, targets: dict[str, float], seed: str = SEED, most_sent: int = 16 << 20) -> DataFrame:
    """Each row as often as a Poisson draw says (not at all, once, or more), with its copy's number from 1, in an order shuffled globally.

    The mean of the draw is the source's target share over its actual one. The draw inverts the distribution at a number hashed from seed and
    doc_id, so runs and retries agree, and the same id (also null, or of repeated rows) draws the same. A null source is a source of its own,
    like any that is not named; an empty table gives no rows; other columns are kept, a column `copy` is replaced. Above MOST_RATE a distribution would start
    below what a double can hold: such a rate is split evenly among as many draws as it needs, of which the sum is Poisson too, each with a number of its
    own. The steps of all sources are sent to every task while they have at most `most_sent` bytes; beyond, they meet the documents by shuffle.
    """
    prefix = "_mix_"
    drawn = checkpointed(rates(documents, targets))
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / MOST_RATE)).cast("int")
    steps = drawn.select(F.col("source").alias(f"{prefix}source"), poisson_steps(F.col("rate") / draws).alias(f"{prefix}steps"), draws.alias(f"{prefix}draws"))
    # a row is a name and at most a thousand steps; beyond so many sources the join shuffles
    if drawn.agg(F.coalesce(F.sum(F.octet_length("source") + 8 * (F.least("rate", F.lit(MOST_RATE)) * 2 + 60)), F.lit(0))).first()[0] <= most_sent:
        steps = F.broadcast(steps)
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    met = documents.join(steps, F.col("source").eqNullSafe(F.col(f"{prefix}source")))
    below = lambda u: F.size(F.filter(f"{prefix}steps", lambda step: step < u)).cast("long")
    further = F.transform(F.sequence(F.lit(2), f"{prefix}draws"), lambda i: uniform(F.lit(seed), id_text, i.cast("string")))
    further = F.when(F.col(f"{prefix}draws") > 1, F.aggregate(further, F.lit(0).cast("long"), lambda n, u: n + below(u))).otherwise(F.lit(0))
    times = below(uniform(F.lit(seed), id_text)) + further
    kept = [c for c in documents.columns if c != "copy"]
    copies = met.withColumn(f"{prefix}n", times).where(F.col(f"{prefix}n") > 0).select(*kept, F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{prefix}n").cast("long"))).alias("copy"))
    return copies.orderBy(F.xxhash64(F.lit(seed), "doc_id", "copy"), "doc_id", "copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return replicate(documents, TARGETS).select("doc_id", "source", "copy", "n_chars", "text")


SQL = """
WITH sizes AS (
    SELECT source, count(*) AS n, max(CASE source WHEN 'src0' THEN 0.15 WHEN 'src1' THEN 0.10 WHEN 'src2' THEN 0.10 END) AS share FROM documents GROUP BY source
), rates AS (
    SELECT source, CAST(coalesce(
        CAST(share AS DOUBLE) * (SELECT sum(n) FROM sizes) / n,
        CAST(0.65 AS DOUBLE) * (SELECT sum(n) FROM sizes) / (SELECT sum(n) FROM sizes WHERE share IS NULL)) AS DOUBLE) AS rate
    FROM sizes
), steps AS (
    SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS step
    FROM (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM rates, (SELECT unnest(range(0, 60)) AS k) AS ks)
), drawn AS (
    SELECT d.doc_id, d.source, d.n_chars, d.text,
        (CAST(CAST('0x' || substr(md5('mix-1|' || CAST(d.doc_id AS VARCHAR)), 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656 AS u
    FROM documents d
), times AS (
    SELECT d.doc_id, d.source, d.n_chars, d.text, count(*) AS n
    FROM drawn d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source AND s.step < d.u GROUP BY ALL
)
SELECT doc_id, source, unnest(range(1, n + 1)) AS copy, n_chars, text FROM times
"""
