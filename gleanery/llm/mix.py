"""Mixing sources to target weights by Pareto order sampling.

The largest total is taken that every source can supply its weight of within its cap on
repeats. Within a source a document is expected to be used in proportion to its odds, by
default its size: that often, but never more often than the cap, as makes the source's
tokens add up. The whole part of that number are certain copies. For the rest, a chance
that differs from document to document, each gets the odds of a random number divided by
the odds of its inclusion, and those with the smallest ratio are taken until the source's
tokens are reached. Random numbers are hashes of the document id, so that a lost and
recomputed task draws the same sample.
"""

from __future__ import annotations

import base64
import math
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import checkpoint

#: Vocabulary of a public tokenizer, as ranks (a path that all executors see), and its pattern.
VOCABULARY = os.environ.get("GLEANERY_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bins of one histogram of ratios; the bin at the cut gets a histogram of its own.
BINS = 4096
#: Bins of odds to a factor of e, from which the level of a source's expected copies is solved.
ODDS_BINS = 64


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The byte-level BPE tokenizer whose ranks are in ``path``."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, keys: list[str], text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``keys`` and n_tokens of whole texts; null and empty texts have none."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema) + ", n_tokens long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(vocabulary).encode_ordinary
        for pdf in batches:
            yield pdf.assign(n_tokens=[len(encode(t)) if t else 0 for t in pdf.pop("__text")])

    return df.select(*keys, F.col(text).alias("__text")).mapInPandas(run, ddl)


def allocate(available: dict[str, int], targets: list[tuple[str, float, int]], total: float | None = None) -> tuple[float, dict[str, float]]:
    """Total tokens, and the tokens that each source has to supply.

    A source without tokens cannot supply a weight; it is left out and the others keep
    their proportions.

    >>> allocate({"a": 100, "b": 100}, [("a", 0.5, 1), ("b", 0.5, 3)])
    (200.0, {'a': 100.0, 'b': 100.0})
    """
    usable = [(s, w, m) for s, w, m in targets if available.get(s, 0) > 0 and w > 0 and m > 0]
    weights = sum(w for _, w, _ in usable)
    if not usable:
        return 0.0, {}
    most = min(m * available[s] / (w / weights) for s, w, m in usable)
    total = most if total is None else min(total, most)
    return total, {s: total * w / weights for s, w, _ in usable}


def level(bins: list[tuple[float, float]], need: float, cap: int) -> float:
    """The factor by which odds become expected copies, so that these supply ``need`` tokens.

    ``bins`` has the mean odds of some documents and their tokens; no document is expected
    more than ``cap`` times.

    >>> level([(1.0, 100.0), (9.0, 100.0)], 110.0, 1)
    0.11
    """
    bins = sorted((o, t) for o, t in bins if o > 0 and t > 0)
    full = 0.0  # tokens of documents that reach the cap, from the largest odds on
    for k in range(len(bins), -1, -1):
        below = sum(o * t for o, t in bins[:k])
        if not below:
            return math.inf
        factor = (need - cap * full) / below
        if factor * bins[k - 1][0] <= cap:
            return max(factor, 0.0)
        full += bins[k - 1][1]
    return math.inf


def mix(docs: DataFrame, key: str, source: str, size: str, targets: DataFrame, weight: str = "weight", cap: str = "max_repeats", total: float | None = None, seed: int = 1, odds: Column | None = None) -> DataFrame:
    """key, source, size and copies (at least 1) of the documents of the mixture.

    ``targets`` (source, weight, cap) is a short list and is collected. ``odds`` says how
    much likelier than another of its source a document is to be used; the default is its
    size. Documents of no listed source, without size, of size 0 or without positive odds
    are not used. No document is used more than its cap. Repeated rows are documents of
    their own. A listed source's share is exact to within one document.
    """
    spark = docs.sparkSession
    wanted = [(r[0], float(r[1]), int(r[2])) for r in targets.select(source, weight, cap).where(F.col(source).isNotNull() & F.col(weight).isNotNull() & F.col(cap).isNotNull()).collect()]
    odds = (F.col(size) if odds is None else odds).cast("double")
    rows = docs.where((F.col(size) > 0) & (odds > 0) & F.col(source).isin([w[0] for w in wanted])).select(key, source, F.col(size).cast("long").alias(size), odds.alias("odds"))
    # Sources times some bins of odds: bounded by the list and the range of a double.
    spectrum: dict[str, list] = {}
    for r in rows.groupBy(source, F.floor(F.log("odds") * ODDS_BINS).alias("bin")).agg(F.avg("odds").alias("o"), F.sum(size).alias("n")).collect():
        spectrum.setdefault(r[0], []).append((r.o, r.n))
    available = {s: sum(n for _, n in bins) for s, bins in spectrum.items()}
    _, needs = allocate(available, wanted, total)
    if not needs:
        return rows.drop("odds").limit(0).withColumn("copies", F.lit(0))
    caps = {s: m for s, _, m in wanted}
    factors = [(s, min(level(spectrum[s], need * (1 - 1e-12), caps[s]), 1e300), caps[s], float(need)) for s, need in needs.items()]
    table = F.broadcast(spark.createDataFrame(factors, f"`{source}` string, factor double, cap int, need double"))
    expected = F.least(F.col("factor") * F.col("odds"), F.col("cap").cast("double"))
    drawn = rows.join(table, source).withColumn("whole", F.floor(expected + 1e-9).cast("int")).withColumn("p", F.when(F.col("whole") < F.col("cap"), F.least(F.greatest(expected - F.col("whole"), F.lit(1e-9)), F.lit(1 - 1e-9))))
    u = (F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 11) + 0.5) / float(1 << 53)
    drawn = drawn.withColumn("ratio", (u / (1 - u)) / (F.col("p") / (1 - F.col("p"))))
    certain = {r[0]: r[1] for r in drawn.groupBy(source).agg(F.sum(F.col("whole") * F.col(size))).collect()}
    plan = {s: need - certain.get(s, 0) for s, need in needs.items()}
    # Bins rise with the ratio.
    score = F.col("ratio") / (1 + F.col("ratio"))
    drawn = drawn.withColumn("bin", F.floor(score * BINS)).withColumn("fine", F.floor((score * BINS - F.col("bin")) * BINS))

    def cut(part: DataFrame, by: str, rest: dict[str, float]) -> dict[str, tuple[int, float]]:
        """The bin in which each source reaches what it needs, and what is missing before it."""
        sums: dict[str, list] = {}
        for r in part.groupBy(source, by).agg(F.sum(size).alias("n")).collect():
            sums.setdefault(r[0], []).append((r[1], r[2]))
        out = {}
        for s, need in rest.items():
            for b, n in sorted(sums.get(s, [])):
                if n >= need:
                    out[s] = int(b), need
                    break
                need -= n
        return out

    open_rows = drawn.where(F.col("ratio").isNotNull())
    first = cut(open_rows, "bin", {s: rest for s, rest in plan.items() if rest > 0})
    edge = spark.createDataFrame([(s, b, need) for s, (b, need) in first.items()], f"`{source}` string, edge long, need double")
    at_edge = open_rows.join(F.broadcast(edge), source).where(F.col("bin") == F.col("edge"))
    second = cut(at_edge, "fine", {s: need for s, (_, need) in first.items()})
    cuts = spark.createDataFrame([(s, b, *second[s]) for s, (b, _) in first.items() if s in second], f"`{source}` string, edge long, edge2 long, missing double")
    marked = drawn.join(F.broadcast(cuts), source, "left")
    before = (F.col("bin") < F.col("edge")) | (F.col("bin") == F.col("edge")) & (F.col("fine") < F.col("edge2"))
    within = (F.col("bin") == F.col("edge")) & (F.col("fine") == F.col("edge2"))
    # About one document in BINS * BINS is left for the exact order; they are a bounded few.
    last = marked.where(within).withColumn("sum", F.expr(f"sum(`{size}`) over (partition by `{source}` order by ratio, `{key}` rows unbounded preceding)"))
    # The document that crosses the target is taken if that comes nearer to it.
    last = last.withColumn("more", F.col("sum") - F.col(size) / 2 <= F.col("missing"))
    rest = marked.where(~F.coalesce(within, F.lit(False))).withColumn("more", F.coalesce(before, F.lit(False)))
    both = rest.select(key, source, size, "whole", "more").unionByName(last.select(key, source, size, "whole", "more"))
    return both.withColumn("copies", F.col("whole") + F.col("more").cast("int")).where("copies > 0").select(key, source, size, "copies")


def shares(mixed: DataFrame, source: str, size: str, targets: DataFrame, weight: str = "weight", cap: str = "max_repeats") -> DataFrame:
    """Of each listed source: documents and copies used, tokens, and the share reached."""
    used = mixed.groupBy(source).agg(F.count("*").alias("n_docs"), F.sum("copies").alias("n_copies"), F.max("copies").alias("most_copies"), F.sum(F.col(size) * F.col("copies")).alias("tokens"))
    all_tokens = F.sum(F.coalesce("tokens", F.lit(0))).over(_everything())
    out = targets.select(source, weight, cap).join(F.broadcast(used), source, "left")
    return out.withColumn("share", F.coalesce(F.coalesce("tokens", F.lit(0)) / F.nullif(all_tokens, F.lit(0)), F.lit(0.0))).na.fill(0, ["n_docs", "n_copies", "most_copies", "tokens"])


def _everything():
    """One window over the short list of sources."""
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))


def counted(docs: DataFrame, key: str, source: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Tokens of each document, counted once and checkpointed: several passes follow."""
    return checkpoint(count_tokens(docs.where(F.col(source).isNotNull()), [key, source], text, vocabulary))
