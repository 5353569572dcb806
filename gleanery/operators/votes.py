"""Group, count and vote: modes, thresholds, trust, and agreement between pages of a site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import checkpoint, small_side


def votes(df: DataFrame, *by: str) -> DataFrame:
    """Number of rows for each combination, as ``votes``."""
    return df.groupBy(*by).agg(F.count("*").alias("votes"))


def mode_of(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The most frequent value of each group; the smallest value where counts tie.

    Nulls are no values. Counts are aggregated before the pick, so a hot group costs one
    row for each of its values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*group).agg(F.min_by(value, F.struct(-F.col("n"), value)).alias(value), F.max("n").alias("n"))


def prune_weak(voted: DataFrame, group: list[str], divisor: int = 3) -> DataFrame:
    """Rows of groups in which some option has more than a third (whole) of all votes."""
    w = Window.partitionBy(*group)
    strong = F.max("votes").over(w) > F.expr(f"sum(votes) over (partition by {', '.join(group)}) div {divisor}")
    return voted.withColumn("__keep", strong).where("__keep").drop("__keep")


def trust_bar(voted: DataFrame, group: list[str], share: float = 0.3) -> DataFrame:
    """Add ``bar`` (a share of the votes of options with more than one) and ``trusted``; options with one vote go."""
    many = voted.where("votes > 1")
    return many.withColumn("bar", F.sum("votes").over(Window.partitionBy(*group)) * F.lit(share)).withColumn("trusted", F.col("votes") > F.col("bar"))


def common_prefix(low: Column, high: Column) -> Column:
    """Longest common prefix of two strings: of a whole set, if they are its smallest and largest."""
    least = F.least(F.length(low), F.length(high))
    same = F.transform(F.sequence(F.lit(1), F.greatest(least, F.lit(1))), lambda i: (i <= least) & (F.substring(low, 1, i) == F.substring(high, 1, i)))
    return F.substring(low, F.lit(1), F.size(F.filter(same, lambda x: x)))


def prefix_and_suffix(df: DataFrame, group: str, url: str) -> DataFrame:
    """Longest common prefix and suffix and the smallest number of segments of a group's addresses.

    A set's prefix is that of its smallest and its largest string, so two aggregates do.
    """
    agg = df.where(F.col(url).isNotNull()).groupBy(group).agg(
        F.min(url).alias("lo"), F.max(url).alias("hi"), F.min(F.reverse(url)).alias("rlo"), F.max(F.reverse(url)).alias("rhi"), F.min(F.size(F.split(url, "/"))).alias("n_segments"), F.count("*").alias("n_urls")
    )
    return agg.select(group, common_prefix(F.col("lo"), F.col("hi")).alias("prefix"), F.reverse(common_prefix(F.col("rlo"), F.col("rhi"))).alias("suffix"), "n_segments", "n_urls")


def shape_outliers(df: DataFrame, group: str, url: str) -> DataFrame:
    """Addresses whose shape differs from their group's modes, with the number of violations.

    The shape is the number of segments, and of parts between underscores and between
    dashes of what precedes the last segment.
    """
    before = F.regexp_replace(F.col(url), "/[^/]*$", "")
    shape = F.size(F.split(url, "/")).alias("a"), F.size(F.split(before, "_")).alias("b"), F.size(F.split(before, "-")).alias("c")
    shaped = df.where(F.col(url).isNotNull()).select(group, url, *shape)
    # Shapes are counted once; the modes come from the counts, a row for each group, and are counted before a broadcast.
    counts = checkpoint(shaped.groupBy(group, "a", "b", "c").agg(F.count("*").alias("n")))
    best = None
    for k in "abc":
        per = counts.groupBy(group, k).agg(F.sum("n").alias("n")).groupBy(group).agg(F.min_by(k, F.struct(-F.col("n"), k)).alias(f"mode_{k}"))
        best = per if best is None else best.join(per, group)
    out = shaped.join(small_side(best), group)
    wrong = sum((F.col(k) != F.col(f"mode_{k}")).cast("int") for k in "abc")
    return out.withColumn("violations", wrong).where("violations > 0").select(group, url, "violations")


def template_positions(df: DataFrame, site: str, page: str, tokens: str) -> DataFrame:
    """Which token positions of a site vary between its pages.

    The base is the page with the smallest id. A position is variable if at least two
    pages differ from the base there; a page that is too short differs. Positions run to
    the length of the base.
    """
    pages = df.where(F.col(tokens).isNotNull()).select(F.col(site).alias("site"), F.col(page).alias("page"), F.col(tokens).alias("tokens"))
    # One row for each site; counted before it is broadcast, so that a hot site stays where its pages are.
    base = small_side(pages.groupBy("site").agg(F.min_by("tokens", "page").alias("base")))
    # A page is compared as a whole with the base, so the join is on the site alone and tokens are exploded once.
    both = pages.join(base, "site")
    at = F.transform("base", lambda b, i: F.when(~F.get("tokens", i).eqNullSafe(b), 1).otherwise(0))
    return both.select("site", F.posexplode(at).alias("pos", "differs")).groupBy("site", "pos").agg(F.sum("differs").alias("n_differ"), (F.sum("differs") >= 2).alias("is_variable"))
