"""Global prefix sums: range partitions, their totals, and running sums inside each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.shared import Workspace


def before_each(totals: DataFrame, part: str, over: list[str], values: list[str]) -> DataFrame:
    """For each row of ``totals`` the sums of ``values`` over rows with smaller ``part``; ``totals`` has a row per partition and key."""
    w = Window.partitionBy(*over).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, *over, *[F.coalesce(F.sum(v).over(w), F.lit(0)).cast("long").alias(f"{v}_before") for v in values])


def prefix_sums(df: DataFrame, order: list[Column], value: str, ws: Workspace, name: str) -> DataFrame:
    """Adds ``before`` (sum of ``value`` over all rows ahead in ``order``) and ``row`` (how many are).

    Rows equal in ``order`` get distinct places, in any order. The range partitions are written
    down first, so that their bounds hold for both passes; each pass sees a bounded partition,
    and only a row per partition passes through the one task that adds the totals up.
    """
    placed = ws.save(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    totals = placed.groupBy("_part").agg(F.sum(value).cast("long").alias("v"), F.count(F.lit(1)).alias("n"))
    totals = before_each(totals, "_part", [], ["v", "n"])
    w = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumn("_sum", F.sum(value).over(w)).withColumn("_n", F.row_number().over(w))
    return (
        local.join(F.broadcast(totals), "_part")  # a row per partition
        .withColumn("before", (F.col("v_before") + F.col("_sum") - F.col(value)).cast("long"))
        .withColumn("row", (F.col("n_before") + F.col("_n") - 1).cast("long"))
        .drop("_part", "_sum", "_n", "v_before", "n_before")
    )
