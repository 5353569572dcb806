"""Top rows of hot groups, and numbers for all rows of a table, without one task holding a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import checkpoint

#: Parts that a group is cut into before its best rows are compared.
SALTS = 32


def top_k(df: DataFrame, group: str, order: list[Column | str], k: int, rank: str = "place") -> DataFrame:
    """The first ``k`` rows of each group in ``order``, with their place from 1 as ``rank``.

    Two stages: the first k of each of a group's parts, then of these few. In both the
    engine stops each task at k rows of a part, so a group of any size spreads over
    SALTS tasks and at most SALTS * k rows of it meet. ``order`` should tell all rows
    apart; ties are broken arbitrarily otherwise. Null groups are a group.
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
    few = df.withColumn("__part", part).withColumn(rank, F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order))).where(F.col(rank) <= k).drop("__part", rank)
    return few.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col(rank) <= k)


def numbered(df: DataFrame, order: str, name: str = "n") -> DataFrame:
    """All rows with their place from 1 in ``order``, numbered by the sizes of ordered parts.

    The rows are cut into ranges, each range is numbered on its own, and the number of
    rows before it is added: one row for each range comes together, and no task sorts all.
    """
    cut = checkpoint(df.repartitionByRange(F.col(order)).withColumn("__part", F.spark_partition_id()))
    sizes = cut.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy(F.lit(1)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    # One row for each partition.
    inside = cut.withColumn(name, F.row_number().over(Window.partitionBy("__part").orderBy(order)))
    return inside.join(F.broadcast(before), "__part").withColumn(name, F.col(name) + F.col("__before")).drop("__part", "__before")
