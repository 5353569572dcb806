"""Duplicates hidden by formatting: recursive radix partitioning and tries with counters.

Values are reduced to canonical bytes. Buckets are prefixes of those bytes: a histogram
finds the prefixes that hold more rows than fit a task, only those are split by further
bytes, and so on until each bucket fits. A bucket of a single value that is still too
large, one record with very many copies, is split by row and its counters are added up.
In each bucket a trie over the remaining bytes counts copies at its terminal nodes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import checkpoint, small_side

#: Rows that one bucket's trie may hold.
BUCKET_ROWS = 200_000
#: Labels of the parts of a labelled value.
LABELS = ("xt", "dn", "xl", "kt")
# Letters and digits of Unicode 14.0 to 15.1 that the patterns of Java 17 do not take for such.
_NEWER = (
    r"\x{870}-\x{887}\x{889}-\x{88e}\x{8b5}\x{8c8}-\x{8c9}\x{c5d}\x{cdd}\x{170d}\x{171f}\x{1b4c}\x{2c2f}\x{2c5f}\x{9ffd}-\x{9fff}\x{a7c0}-\x{a7c1}"
    r"\x{a7d0}-\x{a7d1}\x{a7d3}\x{a7d5}-\x{a7d9}\x{a7f2}-\x{a7f4}\x{10570}-\x{1057a}\x{1057c}-\x{1058a}\x{1058c}-\x{10592}\x{10594}-\x{10595}"
    r"\x{10597}-\x{105a1}\x{105a3}-\x{105b1}\x{105b3}-\x{105b9}\x{105bb}-\x{105bc}\x{10780}-\x{10785}\x{10787}-\x{107b0}\x{107b2}-\x{107ba}"
    r"\x{10f70}-\x{10f81}\x{11071}-\x{11072}\x{11075}\x{1123f}-\x{11240}\x{11740}-\x{11746}\x{11ab0}-\x{11abf}\x{11f02}\x{11f04}-\x{11f10}"
    r"\x{11f12}-\x{11f33}\x{11f50}-\x{11f59}\x{12f90}-\x{12ff0}\x{1342f}\x{13441}-\x{13446}\x{16a70}-\x{16abe}\x{16ac0}-\x{16ac9}\x{1aff0}-\x{1aff3}"
    r"\x{1aff5}-\x{1affb}\x{1affd}-\x{1affe}\x{1b11f}-\x{1b122}\x{1b132}\x{1b155}\x{1d2c0}-\x{1d2d3}\x{1df00}-\x{1df1e}\x{1df25}-\x{1df2a}"
    r"\x{1e030}-\x{1e06d}\x{1e290}-\x{1e2ad}\x{1e4d0}-\x{1e4eb}\x{1e4f0}-\x{1e4f9}\x{1e7e0}-\x{1e7e6}\x{1e7e8}-\x{1e7eb}\x{1e7ed}-\x{1e7ee}"
    r"\x{1e7f0}-\x{1e7fe}\x{2a6de}-\x{2a6df}\x{2b735}-\x{2b739}\x{2ebf0}-\x{2ee5d}\x{31350}-\x{323af}"
)
#: A character that is no letter and no digit.
SIGN = rf"[^\p{{L}}\p{{N}}[\p{{Cn}}&&[{_NEWER}]]]"
_CHUNK = 8


def canonical_bytes(value: Column, labels: Sequence[str] = LABELS) -> Column:
    """Canonical bytes of a digest or of labelled parts; null if ``value`` is no record.

    A bare value must have 40 hexadecimal digits among its letters and digits; labelled
    parts are ordered by label and keep their letters and digits. Case, white space,
    punctuation and other signs are dropped. The first byte keeps both kinds apart.
    """
    names = "|".join(labels)
    # Lower-casing alone would write a capital sigma in two ways, by the signs around it.
    low = F.lower(F.replace(value, F.lit("\u03a3"), F.lit("\u03c3")))
    part = rf"(?s)(?:^|{SIGN})({names})\s*[=:](.*?)(?={SIGN}(?:{names})\s*[=:]|$)"
    found = F.regexp_extract_all(low, F.lit(part), F.lit(1)), F.regexp_extract_all(low, F.lit(part), F.lit(2))
    # Labels downwards: the digest, which tells most records apart, comes first.
    parts = F.sort_array(F.zip_with(*found, lambda k, v: F.concat(k, F.lit("="), F.regexp_replace(v, SIGN, ""))), asc=False)
    bare = F.regexp_replace(low, SIGN, "")
    return (
        F.when(low.rlike(rf"(?:^|{SIGN})(?:{names})\s*[=:]"), F.concat(F.unhex(F.lit("01")), F.encode(F.array_join(parts, "\x1f"), "UTF-8")))
        .when(bare.rlike("^[0-9a-f]{40}$"), F.concat(F.unhex(F.lit("00")), F.unhex(bare)))
    )


class Trie:
    """A trie over byte strings, a few bytes to an edge, with a counter at each terminal node."""

    def __init__(self) -> None:
        self.root: dict = {}
        self.keep: list[int] = []
        self.count: list[int] = []

    def insert(self, key: bytes, row: int) -> int:
        """Count one row under ``key``; returns the number of its terminal node."""
        node = self.root
        at = 0
        last = len(key) - _CHUNK
        while at < last:
            edge = key[at : at + _CHUNK]
            child = node.get(edge)
            if child is None:
                child = node[edge] = {}
            node = child
            at += _CHUNK
        edge = (key[at:],)  # a tuple: an ending is no inner edge
        end = node.get(edge)
        if end is None:
            end = node[edge] = len(self.keep)
            self.keep.append(row)
            self.count.append(1)
            return end
        self.count[end] += 1
        if row < self.keep[end]:
            self.keep[end] = row
        return end


def radix_buckets(keyed: DataFrame, bucket_rows: int = BUCKET_ROWS, step: int = 1) -> tuple[DataFrame, bool]:
    """Add ``bucket`` (binary prefix of ``key``) and ``salt`` so that no pair exceeds ``bucket_rows``.

    The second result says whether any bucket had to be split by row.

    The oversized buckets stay a table, joined by broadcast only where they were counted to
    be few. What all values of a bucket share, the common prefix of the smallest and the
    largest, is skipped at once, so a long shared beginning costs no extra pass. ``salt`` is
    above 0 only in buckets of one single value.
    """

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            same = [low == high for low, high in zip(pdf.low, pdf.high)]
            depth = [None if x else len(os.path.commonprefix([bytes(low), bytes(high)])) + step for x, low, high in zip(same, pdf.low, pdf.high)]
            ways = [-(-n // bucket_rows) if x else None for x, n in zip(same, pdf.n)]
            yield pd.DataFrame({"bucket": pdf.bucket, "depth": pd.array(depth, dtype="Int32"), "ways": pd.array(ways, dtype="Int32")})

    rows = part = keyed.withColumn("bucket", F.substring("key", 1, 1 + step))
    single: DataFrame | None = None
    while True:
        sizes = part.groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        large = checkpoint(sizes.where(F.col("n") > bucket_rows).mapInPandas(measure, "bucket binary, depth int, ways int"))
        ones = large.where("ways IS NOT NULL").select("bucket", "ways")
        single = ones if single is None else single.unionByName(ones)
        split = large.where("depth IS NOT NULL").select("bucket", "depth")
        if split.isEmpty():
            break
        depths, deeper = small_side(split), F.expr("substring(key, 1, depth)")
        rows = rows.join(depths, "bucket", "left").withColumn("bucket", F.coalesce(deeper, "bucket")).drop("depth")
        part = part.join(depths, "bucket").withColumn("bucket", deeper).drop("depth")
    if single.isEmpty():
        return rows.withColumn("salt", F.lit(0)), False
    salt = F.coalesce(F.expr("1 + pmod(xxhash64(row_id), ways)"), F.lit(0)).cast("int")
    return rows.join(small_side(single), "bucket", "left").withColumn("salt", salt).drop("ways"), True


def collapse(df: DataFrame, group: str, row_id: str, value: Column, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Each row that is a record, with the smallest id of its record and the number of copies.

    Result: group, row_id, keep_id, copies. Rows whose value is null or no record are left
    out. Values of different ``group`` are never the same record.
    """
    keyed = checkpoint(
        df.select(F.col(group).alias("grp"), F.col(row_id).cast("long").alias("row_id"), canonical_bytes(value).alias("k"))
        .where(F.col("k").isNotNull())
        .select("grp", "row_id", F.concat("k", F.lit(b"\x00"), F.encode("grp", "UTF-8")).alias("key"))
    )

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        trie, skip = Trie(), len(pdf.bucket.iat[0])
        ends = np.fromiter((trie.insert(k[skip:], r) for k, r in zip(pdf.key, pdf.row_id)), dtype=np.int64, count=len(pdf))
        return pd.DataFrame({"grp": pdf.grp, "row_id": pdf.row_id, "bucket": pdf.bucket, "salt": pdf.salt, "keep_id": np.array(trie.keep)[ends], "copies": np.array(trie.count)[ends]})

    buckets, salted = radix_buckets(keyed, bucket_rows)
    counted = buckets.groupBy("bucket", "salt").applyInPandas(count, "grp string, row_id long, bucket binary, salt int, keep_id long, copies long")
    if not salted:
        return counted.select(F.col("grp").alias(group), "row_id", "keep_id", "copies")
    counted = checkpoint(counted)
    # One row for each split record; counted before it is broadcast.
    totals = counted.where("salt > 0").groupBy("bucket", "salt").agg(F.min("keep_id").alias("k"), F.max("copies").alias("c")).groupBy("bucket").agg(F.min("k").alias("k"), F.sum("c").alias("c"))
    whole = counted.join(small_side(totals), "bucket", "left")
    return whole.select(F.col("grp").alias(group), "row_id", F.coalesce("k", "keep_id").alias("keep_id"), F.coalesce("c", "copies").alias("copies"))

