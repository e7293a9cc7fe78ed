"""Rank numbers over the whole of an ordered table, without bringing it together in one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from issuetrail.sources.session import new_folder


def numbered(rows: DataFrame, order: list[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """The rows with their number from 1 in the order, which should leave no ties; as a table in that order.

    Rows are dealt out by ranges of the order and written; each range is numbered by itself, and begins after the counts of those before it. The driver sees
    one count for each range.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, "ranked")
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    ranged.withColumn("_range", F.spark_partition_id()).write.parquet(folder)
    kept = spark.read.schema(StructType([*rows.schema.fields, StructField("_range", IntegerType())])).parquet(folder)
    before, starts = 0, []
    for row in kept.groupBy("_range").count().orderBy("_range").collect():
        starts.append((row["_range"], before))
        before += row["count"]
    offsets = F.create_map(*[F.lit(x) for pair in starts for x in pair]) if starts else F.create_map(F.lit(-1), F.lit(0))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    found = kept.withColumn(name, (within + F.element_at(offsets, F.col("_range"))).cast("bigint"))
    return found.select(name, *[c for c in rows.columns if c != name])
