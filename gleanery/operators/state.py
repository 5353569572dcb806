"""Keyed state on plain files: upserts, set-adds, first and last seen, snapshots."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import checkpoint, small_side


def upsert(current: DataFrame, changes: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``current`` with the latest change of each key put in place of its row.

    Both have the same columns. Rows with a null key stay as they are on the left and are
    ignored on the right.
    """
    cols = current.columns
    rest = [c for c in cols if c not in key]
    latest = changes.dropna(subset=key).groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__new"))
    return current.join(latest.select(*key), key, "left_anti").select(*cols).unionByName(latest.select(*key, "__new.*").select(*cols))


def insert_missing(current: DataFrame, offered: DataFrame, key: list[str]) -> DataFrame:
    """``current`` and those offered rows whose key it lacks, one for each key."""
    new = offered.join(current.select(*key).distinct(), key, "left_anti").dropDuplicates(key)
    return current.unionByName(new.select(*current.columns))


def set_add(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct values of each key, sorted."""
    return df.where(F.col(value).isNotNull()).select(key, value).distinct().groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("values"))


def first_last_seen(df: DataFrame, key: str, ts: str, after_s: int = 1800) -> DataFrame:
    """First and last time of each key and whether it has been seen for longer than ``after_s``."""
    seen = df.where(F.col(ts).isNotNull()).groupBy(key).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count("*").alias("n_seen"))
    span = F.unix_timestamp(F.col("last_seen").cast("timestamp")) - F.unix_timestamp(F.col("first_seen").cast("timestamp"))
    return seen.withColumn("promoted", span > after_s)


def mismatches(old: DataFrame, new: DataFrame, key: list[str], value: str) -> DataFrame:
    """Old values that the new snapshot lacks or has otherwise, disregarding case and outer spaces."""
    a = old.select(*key, F.col(value).alias("old_value"))
    b = new.select(*key, F.col(value).alias("new_value"))
    norm = lambda c: F.lower(F.trim(F.col(c)))
    return a.join(b, key, "left").where(~norm("old_value").eqNullSafe(norm("new_value")))


def failure_cut(df: DataFrame, group: str, order: str, ok: str, most: int = 20) -> DataFrame:
    """Rows of each group up to the point where more than ``most`` failures followed each other, with ``failures``.

    ``failures`` is the length of the run of failures that a row ends, 0 for a good row; a
    null ``ok`` is a failure. ``order`` has to tell the rows of a group apart. Null groups
    are a group.

    Rows are cut into ranges of group and order, so that a hot group spreads over many
    tasks. Each range says how many failures it begins and ends with; from these few rows
    each range learns what it goes on from, and then runs are counted where the rows are.
    """
    names, kinds = [f"`{f.name}`" for f in df.schema], df.schema
    good = F.coalesce(F.col(ok), F.lit(False))
    cut = checkpoint(df.withColumn("__ok", good).repartitionByRange(F.col(group), F.col(order)).sortWithinPartitions(group, order).withColumn("__part", F.spark_partition_id()))
    # Of each range of each group the place of its last good row, and the failures after it.
    ends = cut.groupBy(F.col(group).alias("__g"), F.col("__part").alias("__p")).agg(F.max(F.when(F.col("__ok"), F.col(order))).alias("__last"))
    here = F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p"))
    tail = F.count_if(F.col("__last").isNull() | (F.col(order) > F.col("__last"))).alias("tail")
    parts = cut.join(small_side(ends), here).groupBy("__g", F.col("__p").alias("part")).agg(tail, F.first("__last").isNull().alias("all_failed"))
    # A row for each range of a group, at most as many as there are ranges.
    lists = parts.groupBy("__g").agg(F.array_sort(F.collect_list(F.struct("part", "all_failed", "tail"))).alias("all"))
    before = F.filter("all", lambda x: x["part"] < F.col("__p"))
    carried = F.aggregate(before, F.lit(0).cast("long"), lambda acc, x: F.when(x["all_failed"], acc + x["tail"]).otherwise(x["tail"]))
    carry = lists.select("__g", "all", F.explode("all.part").alias("__p")).select("__g", "__p", carried.alias("__carry"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, run = object(), 0
        for pdf in batches:
            out = []
            for g, fine, carry in zip(pdf[group], pdf["__ok"], pdf["__carry"]):
                if not (g == now or pd.isna(g) and now is None):
                    now, run = None if pd.isna(g) else g, int(carry)
                run = 0 if fine else run + 1
                out.append(run)
            yield pdf.drop(columns=["__ok", "__carry"]).assign(failures=out)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + ", failures long"
    joined = cut.join(small_side(carry), here, "left")
    counted = checkpoint(joined.select(*names, "__ok", F.coalesce("__carry", F.lit(0)).alias("__carry"), "__part").repartition("__part").sortWithinPartitions("__part", group, order).drop("__part").mapInPandas(count, ddl))
    stop = counted.where(F.col("failures") > most).groupBy(F.col(group).alias("__g")).agg(F.min(order).alias("__stop"))
    kept = counted.join(small_side(stop), F.col(group).eqNullSafe(F.col("__g")), "left").where(F.col("__stop").isNull() | (F.col(order) < F.col("__stop")))
    return kept.select(*names, "failures")
