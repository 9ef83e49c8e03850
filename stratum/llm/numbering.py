"""Gapless numbers within groups, without a group ever sitting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.session import scratch_path


def number_within(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2 ... within each value of ``group``, in ``order``.

    Rows are range-partitioned on (group, order, spread), so a group - or one
    order value - that holds a third of the rows spans many tasks. The layout is
    written once to the shared scratch folder, which fixes the row positions; a
    count per partition and a running sum over partitions (one row for each
    group and partition) turn them into gapless numbers. Rows that tie on all
    order columns are interchangeable. What is passed is written and read once:
    pass narrow rows.
    """
    spark = df.sparkSession
    # Ties are spread by their place in the input partition; the local sort
    # before makes a re-run task number them as the first attempt did.
    keys = [group, *order, "__spread"]
    laid = (df.sortWithinPartitions(*order).withColumn("__spread", F.monotonically_increasing_id())
            .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
            .sortWithinPartitions(*keys)
            .withColumn("__part", F.spark_partition_id())
            .withColumn("__pos", F.monotonically_increasing_id()).drop("__spread"))
    path = scratch_path(spark, "numbered")
    laid.write.parquet(path)
    laid = spark.read.parquet(path)
    runs = laid.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__first"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__base")
    runs = runs.select(F.col(group).alias("__group"), F.col("__part").alias("__run"), base)
    same = laid[group].eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__run"))
    return (laid.join(runs, same).withColumn(name, (F.col("__base") + F.col("__pos")).cast("long"))
            .drop("__part", "__pos", "__base", "__group", "__run"))
