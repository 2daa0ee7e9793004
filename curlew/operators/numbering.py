"""Numbers in a global order, without a task that sees all rows or a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curlew.session import materialize


def surrogate_ids(df: DataFrame, order: list[str], name: str = "id") -> DataFrame:
    """``df`` with ids 1..n in ``order``: range-partitioned and sorted by Spark, numbered by partition offsets."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    ranged = ranged.withColumn("_p", F.shiftright("_m", 33)).withColumn("_i", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
    ranged = materialize(ranged, "ranged")  # partition numbers must not change when a task runs again
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_o"))  # one row for each partition
    return ranged.join(offsets, "_p").withColumn(name, F.col("_o") + F.col("_i") + 1).drop("_m", "_p", "_i", "_o")


def ranks(df: DataFrame, group: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """``df`` with each row's rank 1..n in its group by ``order``.

    Rows are numbered over all groups and less the first number of their group, so a
    group that holds a third of all rows is sorted by many tasks.
    """
    numbered = surrogate_ids(df, [*group, *order], "_id")
    first = numbered.groupBy(*group).agg(F.min("_id").alias("_first"))
    return numbered.join(first, group).withColumn(name, F.col("_id") - F.col("_first") + 1).drop("_id", "_first")
