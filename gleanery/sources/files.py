"""Seed lists in, item rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_seeds(spark: SparkSession, path: str, token: str, blacklist: tuple[str, ...] = ()) -> DataFrame:
    """Domains of a list of (rank, domain) lines that contain ``token`` and are not blacklisted, each once."""
    rows = spark.read.schema("rank string, domain string").csv(path)
    return rows.where(F.col("domain").contains(token) & ~F.col("domain").isin(list(blacklist))).select("domain").distinct()


def write_hourly(lines: DataFrame, path: str, ts: str = "ts", line: str = "line") -> None:
    """Text files of one line for each row, in a folder for each hour."""
    lines.select(F.date_format(F.date_trunc("hour", ts), "yyyy-MM-dd-HH").alias("hour"), line).write.mode("overwrite").partitionBy("hour").text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def report_lines(df: DataFrame, site: str, field: str, value: str) -> DataFrame:
    """site, pos and line of an HTML report for each site: its fields and values as rows of a table, escaped and in order.

    A site may have any number of rows: each is a line of its own, and its place is
    computed from the sorted whole and not from a list.
    """
    esc = lambda c: F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    row = F.concat(F.lit("<tr><td>"), F.coalesce(esc(field), F.lit("")), F.lit("</td><td>"), F.coalesce(esc(value), F.lit("")), F.lit("</td></tr>"))
    rows = df.select(F.col(site).alias("site"), F.lit(1).alias("part"), row.alias("line"))
    sites = rows.select("site").distinct()
    ends = [sites.select("site", F.lit(k).alias("part"), F.lit(line).alias("line")) for k, line in ((0, "<table>"), (2, "</table>"))]
    return rows.unionByName(ends[0]).unionByName(ends[1])


def write_report(lines: DataFrame, path: str) -> None:
    """The lines of ``report_lines`` as text files in a folder for each site; file names and lines keep the order.

    A site's lines are cut into ranges and each is sorted where it is, so no task holds a site.
    """
    ordered = lines.repartitionByRange("site", "part", "line").sortWithinPartitions("site", "part", "line")
    ordered.select("site", "line").write.mode("overwrite").partitionBy("site").text(path)
