"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, mixing, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.llm import decontamination, line_dedup, mixing, near_dedup, toxicity
from issuetrail.llm.common import folder, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.7, by a model of those that are labelled and not held out."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with repeated runs of lines taken out of text and n_chars put right."""
    return line_dedup.remove_repeated(docs).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash the one of the smallest id."""
    return near_dedup.deduplicate(docs)


def reject_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, shuffled, with the number of each copy."""
    return mixing.replicate(docs, mixing.TARGETS)


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", remove_repeated_lines),
    ("near-dedup", keep_one_of_each_group),
    ("decontamination", reject_benchmark),
    ("mixing", mix_sources),
]

#: The toxicity model and the hashes of near-dedup are beyond SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of the documents of a folder of tables; what each stage gives is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    written = folder(spark)
    for number, (_, stage) in enumerate(STAGES):
        path = f"{written}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs.select("doc_id", "text", "lang", "source", F.col("n_chars"), "copy")
