"""Joins by closeness: a range join over logarithmic buckets, and agreement of records."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def near_join(left: DataFrame, right: DataFrame, a: str, b: str, low: float = 0.99, high: float = 1.01) -> DataFrame:
    """Pairs with ``a / b`` between ``low`` and ``high``, both included, of positive values.

    Values fall into buckets as wide as the tolerance; the right side goes into its own
    bucket and both neighbours, which makes the range condition an equi-join. Zero,
    negative and null values pair with nothing.
    """
    width = math.log(max(high, 1 / low)) * 1.01
    x = left.where(F.col(a) > 0).withColumn("__bucket", F.floor(F.log(F.col(a)) / width))
    y = right.where(F.col(b) > 0).withColumn("__bucket", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.floor(F.log(F.col(b)) / width) + k)))
    ratio = F.col(a) / F.col(b)
    return x.join(y, "__bucket").where(ratio.between(low, high)).drop("__bucket")


def same_item(size_a: Column, size_b: Column, hash_a: Column, hash_b: Column, title_a: Column, title_b: Column, longer: int = 0, whole_halves: bool = False, tolerance: float = 0.01) -> Column:
    """Whether two records may describe one item; each test counts only where both sides state it.

    Sizes within ``tolerance``, digests equal without case, and at least half the words of
    the first title in the second: rounded up, or down with ``whole_halves``. With
    ``longer`` only words of more letters than that count, on both sides.
    """
    long = lambda t: F.filter(F.split(F.lower(t), r"[^\p{L}\p{N}]+"), lambda w: (w != "") & (F.length(w) > longer))
    words, other = long(title_a), F.array_join(long(title_b), " ") if longer else F.lower(title_b)
    hits = F.size(F.filter(words, lambda w: other.contains(w)))
    half = F.floor(F.size(words) / 2) if whole_halves else F.ceil(F.size(words) / 2)
    return (
        F.coalesce((size_a / size_b).between(1 - tolerance, 1 + tolerance), F.lit(True))
        & F.coalesce(F.lower(hash_a) == F.lower(hash_b), F.lit(True))
        & F.coalesce(hits >= half, F.lit(True))
    )
