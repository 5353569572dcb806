"""Evaluation texts leaking into a corpus: a prefix-filtered set join with exact verification.

A document leaks an item if it holds a passage of at least a third of the item's words in
the item's order, with at most one word in ten changed, dropped or added. Such a passage
keeps a known number of the item's word shingles whole, so of the item's shingles, put in
order of rarity in the corpus, only a prefix needs to be joined: a document that shares
none of the prefix cannot reach the number. Candidates pass bounds on length and position
and are then aligned word by word over windows of the item's size.

Shingles have five words; items so short that a passage of theirs may have fewer use
shingles of as many words as the passage has.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import BROADCAST_ROWS, checkpoint, small_side

#: Words in a shingle, share of an item that leaks, share of a passage that may differ.
SHINGLE, SHARE, NOISE = 5, 1 / 3, 0.1
#: Fewer words than this are a short quote, unless they are the whole item.
QUOTE = 4
#: A shingle of this many items or more, and of this share of all items, is a standing instruction.
SHARED_ITEMS, SHARED_SHARE = 3, 0.02
#: So many item shingles (8 bytes each) travel to the executors as a filter; more are joined by shuffle.
FILTER_SHINGLES = 5_000_000

# An element's attributes have values, or are of the few that need none: "<b and c>" is no tag.
# Each alternative begins with a look at one character, which is all that most places need.
_ATTRIBUTE = r"""\s+(?:[A-Za-z_:][\w:.\-]*\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s<>"']+)|hidden|checked|selected|disabled|controls|noshade|nowrap|async|defer)"""
_TAG = rf"(?s)(?=[<&\[\]\\])(?:<!--.*?-->|</?[A-Za-z][A-Za-z0-9:\-]*(?:{_ATTRIBUTE})*\s*/?>|&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[xX][0-9A-Fa-f]+);|\[/?[A-Za-z]+(?:=[^\[\]\n]*)?\]|\\[A-Za-z]+\*?|\]\([^()\s]*\))"


def plain_words(text: Column) -> Column:
    """Words of a text without letter case, punctuation, spacing and markup."""
    bare = F.regexp_replace(F.lower(text), _TAG, " ")
    # Signs inside a word (emphasis, apostrophes) vanish, those between words part them.
    joined = F.regexp_replace(bare, r"(?=['’*_~`^{}])(?<=[\p{L}\p{N}])['’*_~`^{}]+(?=[\p{L}\p{N}])", "")
    return F.regexp_extract_all(joined, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def word_hashes(words: Column) -> Column:
    """A hash for each word."""
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` word hashes, in order; fewer words have none.

    >>> len(shingle_hashes(np.arange(7), 5)), len(shingle_hashes(np.arange(3), 5))
    (3, 0)
    """
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, dtype=np.int64)
    words, out = hashes.astype(np.int64).view(np.uint64), np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = (out ^ words[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def shortest(n: int) -> int:
    """Words of the shortest passage of an item of ``n`` words."""
    return max(-int(-n * SHARE // 1), min(n, QUOTE))


def shingle_size(n: int) -> int:
    """Words of a shingle for an item of ``n`` words."""
    return min(SHINGLE, shortest(n))


def kept_whole(n: int) -> int:
    """Shingles that any passage of an item of ``n`` words shares with it.

    A passage of L words has L - size + 1 shingles, and each of its wrong words, of which
    it may have one in ten, breaks at most ``size`` of them. The least is at the shortest
    passage or at the first length after it that allows one more wrong word.
    """
    least, size, step = shortest(n), shingle_size(n), round(1 / NOISE)
    left = lambda words: words - size + 1 - size * (words // step)
    return max(1, min(left(least), left(-(-least // step) * step)))


def passage(item: list[str], doc: list[str], common: set[int] | frozenset[int] = frozenset()) -> int:
    """Words of the longest admissible passage of ``item`` in ``doc``; 0 if there is none.

    ``common`` holds the positions of the item's standing instruction: a passage of these
    alone does not count. The alignment is tried with and without the instruction, which
    may stand elsewhere in the window, as another item's.
    """
    best = _aligned(item, doc, common)
    if common and len(common) < len(item):
        best = max(best, _aligned([None if k in common else w for k, w in enumerate(item)], doc, common))
    return best


def _aligned(item: list[str | None], doc: list[str], common: set[int] | frozenset[int]) -> int:
    n, least = len(item), shortest(len(item))
    pairs = [(b.a + k, b.b + k) for b in SequenceMatcher(None, item, doc, autojunk=False).get_matching_blocks() for k in range(b.size)]
    own = [0]
    for i, _ in pairs:
        own.append(own[-1] + (i not in common))
    best = 0
    for s in range(len(pairs)):
        for e in range(len(pairs) - 1, s - 1, -1):
            wide, far, same = pairs[e][0] - pairs[s][0] + 1, pairs[e][1] - pairs[s][1] + 1, e - s + 1
            if same < best or same < least * (1 - NOISE) - 1:
                break
            wrong = max(wide, far) - same
            if wide >= least and wrong <= wide * NOISE and own[e + 1] - own[s] >= min(SHINGLE, least):
                best = max(best, wide)
                break
    return best


def _positions(df: DataFrame, key: str, sizes: list[int] | None, wanted=None) -> DataFrame:
    """key, n (words), pos and h of the shingles of texts given as ``hw``, the hashes of their words.

    ``sizes`` are those asked for, None the one that suits the text as an item. With
    ``wanted`` (a broadcast sorted array) only shingles that it holds leave the task.
    """
    kind = df.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep = wanted.value if wanted is not None else None
        for pdf in batches:
            row, n, pos, h = [], [], [], []
            for k, words in enumerate(pdf.hw):
                for size in sizes or [shingle_size(len(words))]:
                    got = shingle_hashes(words, size) if size else np.zeros(0, dtype=np.int64)
                    at = np.arange(len(got))
                    if keep is not None and len(got):
                        near = np.minimum(np.searchsorted(keep, got), len(keep) - 1)
                        at = np.flatnonzero(keep[near] == got)
                        got = got[at]
                    if len(got):
                        row.append(np.full(len(got), k))
                        n.append(np.full(len(got), len(words)))
                        pos.append(at)
                        h.append(got)
            flat = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
            yield pd.DataFrame({key: pdf[key].to_numpy()[flat(row)], "n": flat(n), "pos": flat(pos), "h": flat(h)})

    return df.select(key, "hw").mapInPandas(run, f"{key} {kind}, n int, pos int, h long")


def leaked(docs: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """doc_id, item_id and matched (words of the item's passage) of every leak.

    ``items`` is a list of evaluation items and is counted before anything of it is
    broadcast. Null and blank texts match nothing. A passage has at least four words, or
    all of a shorter item. Repeated documents are each reported.
    """
    spark = docs.sparkSession
    its = checkpoint(items.select(F.col(item_id).alias("item"), plain_words(F.col(item_text)).alias("iw")).where(F.size("iw") > 0))
    grams = checkpoint(_positions(its.select("item", word_hashes(F.col("iw")).alias("hw")), "item", None).select("item", "n", F.col("pos").alias("ipos"), "h"))
    n_items, sizes = its.count(), sorted({shingle_size(r.n) for r in its.select(F.size("iw").alias("n")).distinct().collect()})
    words = docs.select(F.col(doc_id).alias("doc"), word_hashes(plain_words(F.col(doc_text))).alias("hw")).where(F.size("hw") > 0)
    distinct = grams.select("h").distinct()
    if grams.count() <= FILTER_SHINGLES:
        wanted = np.array(sorted(distinct.toPandas().h), dtype=np.int64)
        hits = _positions(words, "doc", sizes, spark.sparkContext.broadcast(wanted)) if len(wanted) else _positions(words.limit(0), "doc", sizes)
    else:
        hits = _positions(words, "doc", sizes).join(distinct, "h", "left_semi")
    # Of the corpus only shingles that some item has are kept.
    hits = checkpoint(hits.select("doc", F.col("n").alias("m"), F.col("pos").alias("dpos"), "h"))
    spread = grams.groupBy("h").agg(F.countDistinct("item").alias("in_items"))
    grams = small_side(grams.join(spread, "h").withColumn("shared", (F.col("in_items") >= SHARED_ITEMS) & (F.col("in_items") >= SHARED_SHARE * n_items)), BROADCAST_ROWS)
    # Lengths that items have, with what follows from them; a short list.
    lengths = [r.n for r in grams.select("n").distinct().collect()]
    bounds = F.broadcast(spark.createDataFrame([(n, shortest(n), kept_whole(n)) for n in lengths], "n int, least int, whole int"))
    rarity = hits.groupBy("h").agg(F.count("*").alias("df"))
    rare = grams.join(rarity, "h", "left").withColumn("rank", F.expr("row_number() over (partition by item order by coalesce(df, 0), h, ipos)"))
    prefix = rare.withColumn("all", F.expr("count(*) over (partition by item)")).join(bounds, "n").where(F.col("rank") <= F.col("all") - F.col("whole") + 1)
    fewest = F.col("least") - F.floor(F.col("least") * NOISE)
    probe = hits.join(small_side(prefix.select("item", "h", "least")), "h").where(F.col("m") >= fewest).select("doc", "item").distinct()
    # Bounds on position: enough of the item's shingles near one diagonal.
    near = probe.join(hits, "doc").join(grams, ["item", "h"]).withColumn("band", F.floor((F.col("dpos") - F.col("ipos")) / F.col("n")))
    near = near.select("doc", "item", "n", "ipos", "dpos", "shared", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    dense = near.groupBy("doc", "item", "band", "n").agg(F.countDistinct("ipos").alias("got"), F.max((~F.col("shared")).cast("int")).alias("own"), F.min("dpos").alias("low"), F.max("dpos").alias("high"))
    sure = dense.join(bounds, "n").where((F.col("own") == 1) & (F.col("got") >= F.col("whole")))
    # Windows of about the item's size around the shared shingles; two bands may have the same.
    sure = sure.select("doc", "item", F.greatest(F.col("low") - F.col("n"), F.lit(0)).alias("low"), (F.col("high") + F.col("n") + SHINGLE).alias("high")).distinct()
    common = grams.where("shared").join(bounds, "n").groupBy("item").agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("ipos", F.col("ipos") + F.least(F.col("least"), F.lit(SHINGLE)) - 1)))).alias("common"))
    # Few documents leak: their ids, counted first, go to the texts and not all texts to the ids.
    sure = small_side(sure)
    texts = docs.select(F.col(doc_id).alias("doc"), F.col(doc_text).alias("text")).join(sure, "doc").select("doc", "item", "low", "high", plain_words(F.col("text")).alias("dw"))
    texts = texts.select("doc", "item", F.expr("slice(dw, cast(low + 1 as int), cast(high - low as int))").alias("dw"))
    pairs = texts.join(small_side(its.join(common, "item", "left")), "item")
    ids = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in ("doc", "item"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [passage(list(i), list(d), frozenset(c) if c is not None else frozenset()) for i, d, c in zip(pdf.iw, pdf.dw, pdf.common)]
            yield pd.DataFrame({"doc": pdf.doc, "item": pdf["item"], "matched": got})

    found = pairs.select("doc", "item", "iw", "dw", "common").mapInPandas(verify, f"{ids}, matched long").where("matched > 0")
    return found.groupBy(F.col("doc").alias(doc_id), F.col("item").alias(item_id)).agg(F.max("matched").alias("matched"))
