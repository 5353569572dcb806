"""Free-entered values mapped to a reference list: token repair and soft TF-IDF.

Only distinct values and distinct tokens are looked at. Each distinct token is joined to
the vocabulary of the reference list by edit distance; the join runs over shared segments
(a string within k edits of another keeps one of its k + 2 segments nearly in place),
never over all pairs. A value is read in two ways, as its tokens and as one token without
separators, and so is each entry. Complete entries are ranked by soft TF-IDF over the
repaired tokens, of the better of both readings. Values near no entry, or equally near
two, are reported as unmatched.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import checkpoint, small_side, spread

#: A vocabulary of so many words travels to the executors as an index; a larger one is joined by shuffle.
INDEX_WORDS = 100_000
#: Soft TF-IDF over several tokens from which a value counts as an entry. One token is near enough if it was repaired at all.
SOFT = 0.92
# Digits and signs typed for letters.
_LEET = str.maketrans("0134579@$", "oieastgas")
_SPLIT = regex.compile(r"[^\p{L}\p{N}\p{M}@$]+")


def normal(value: str) -> tuple[str, ...]:
    """Tokens without letter case, accents, decoration and digits typed for letters.

    >>> normal("[Animación_3D]"), normal("  H1gh D3finition ")
    (('animacion', 'ed'), ('high', 'definition'))
    """
    s = unicodedata.normalize("NFKD", value).casefold()
    if not s.isascii():
        # Accents of letters that have a case; signs of other scripts stay.
        s = unicodedata.normalize("NFC", regex.sub(r"(?<=[\p{Latin}\p{Greek}\p{Cyrillic}]\p{M}*)\p{M}", "", s))
    return tuple(t for t in _SPLIT.split(s.translate(_LEET)) if t)


def allowed(unit: str) -> int:
    """Edits that a word of the vocabulary may differ by."""
    n = len(unit)
    return 0 if n <= 2 else 1 if n <= 4 or sum(c.isdigit() for c in unit) > 1 else 2 if n < 10 else 3


def edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, changes and swaps of neighbours from a to b; most + 1 if more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = row[j - 1] if x == y else 1 + min(row[j - 1], row[j], now[j - 1])
            if x != y and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        if min(now) > most:
            return most + 1
        before, row = row, now
    return row[-1]


class Segments:
    """An index of a vocabulary that finds all words within their allowed edits."""

    def __init__(self, words: list[str]):
        self.exact = set(words)
        self.index: dict[tuple[int, int, str], list[str]] = defaultdict(list)
        self.plans: dict[int, tuple[int, list[tuple[int, int, int]]]] = {}
        for w in self.exact:
            if k := allowed(w):
                for i, a, b in self.plan(len(w), k)[1]:
                    self.index[len(w), i, w[a:b]].append(w)

    def plan(self, n: int, k: int) -> tuple[int, list[tuple[int, int, int]]]:
        # One segment more than edits + 1, since a swap may touch two.
        k = max(k, self.plans.get(n, (0,))[0])
        parts = min(n, k + 2)
        cuts = [n * i // parts for i in range(parts + 1)]
        self.plans[n] = k, [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        return self.plans[n]

    def near(self, unit: str) -> list[tuple[str, int]]:
        found = {unit: 0} if unit in self.exact else {}
        tried = set(found)
        for n, (k, segments) in self.plans.items():
            if abs(n - len(unit)) > k:
                continue
            for i, a, b in segments:
                for at in range(max(0, a - k), min(len(unit) - (b - a), a + k) + 1):
                    for w in self.index.get((n, i, unit[at : at + b - a]), ()):
                        if w not in tried:
                            tried.add(w)
                            most = allowed(w)
                            d = edits(unit, w, most)
                            if d <= most:
                                found[w] = d
        return list(found.items())


def segment_keys(word: str) -> list[str]:
    """Keys under which a word of the vocabulary is found: itself, and its segments with their place."""
    n, k = len(word), allowed(word)
    parts = min(n, k + 2)
    cuts = [n * i // parts for i in range(parts + 1)]
    return [f"={word}"] + ([f"{n}.{k}.{i}.{word[a:b]}" for i, (a, b) in enumerate(zip(cuts, cuts[1:]))] if k else [])


def probe_keys(unit: str) -> list[str]:
    """Keys of all words that ``unit`` may be within the allowed edits of.

    >>> set(segment_keys("korean")) & set(probe_keys("koraen")) != set()
    True
    """
    out = {f"={unit}": None}
    for n in range(max(3, len(unit) - 3), len(unit) + 4):
        for k in {1} | ({2} if 4 < n < 10 else set()) | ({3} if n > 9 else set()):
            if abs(n - len(unit)) <= k:
                parts = min(n, k + 2)
                cuts = [n * i // parts for i in range(parts + 1)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    for at in range(max(0, a - k), min(len(unit) - (b - a), a + k) + 1):
                        out[f"{n}.{k}.{i}.{unit[at : at + b - a]}"] = None
    return list(out)


def _repaired(units: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """f, unit, word and edits of every word of the field's vocabulary within its allowed edits of a unit."""
    if vocabulary.count() <= INDEX_WORDS:
        words: dict[str, list[str]] = defaultdict(list)
        for r in vocabulary.collect():
            words[r.f].append(r.word)
        shared = units.sparkSession.sparkContext.broadcast(dict(words))

        def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            indexes = {f: Segments(v) for f, v in shared.value.items()}
            for pdf in batches:
                rows = [(f, u, w, d) for f, u in zip(pdf.f, pdf.unit) if f in indexes for w, d in indexes[f].near(u)]
                yield pd.DataFrame(rows, columns=["f", "unit", "word", "edits"])

        return spread(units, "unit").mapInPandas(look_up, "f string, unit string, word string, edits int")

    def keyed(name: str, keys):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pdf.assign(k=[keys(x) for x in pdf[name]]).explode("k")

        return run

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["edits"] = [edits(u, w, allowed(w)) for u, w in zip(pdf.unit, pdf.word)]
            yield pdf[pdf.edits <= [allowed(w) for w in pdf.word]]

    asked = spread(units, "unit").mapInPandas(keyed("unit", probe_keys), "f string, unit string, k string")
    listed = vocabulary.mapInPandas(keyed("word", segment_keys), "f string, word string, k string")
    pairs = asked.join(listed, ["f", "k"]).select("f", "unit", "word").distinct()
    return pairs.mapInPandas(verify, "f string, unit string, word string, edits int")


def map_values(values: DataFrame, field: str, value: str, reference: DataFrame, term: str, name: str, aliases: str) -> DataFrame:
    """Every distinct pair of ``field`` and ``value`` with its entry of the reference list.

    ``reference`` has the columns field, term, name and aliases (array). Result: field,
    value, term (null if unmatched), distance (edits of the whole value, if it is near the
    whole entry) and score (soft TF-IDF). Null values are left out; empty values and values
    of signs alone are unmatched. Aliases that are null count as none.
    """
    kind = reference.select(term).schema[0].dataType.simpleString()

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = {(f, t, normal(p)) for f, t, n, al in zip(pdf.f, pdf.term, pdf.name, pdf.aliases) for p in [n, *(al if al is not None else [])] if p}
            yield pd.DataFrame([(f, t, list(p), "".join(p)) for f, t, p in sorted(rows) if p], columns=["f", "term", "words", "joined"])

    def take_apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            tokens = [normal(v) for v in pdf.v]
            yield pdf.assign(tokens=[list(t) for t in tokens], whole=["".join(t) for t in tokens])

    listed = reference.select(F.col(field).alias("f"), F.col(term).alias("term"), F.col(name).alias("name"), F.col(aliases).alias("aliases")).where("f IS NOT NULL AND term IS NOT NULL")
    listed = checkpoint(listed.mapInPandas(entries, f"f string, term {kind}, words array<string>, joined string").distinct())
    distinct = values.select(F.col(field).alias("f"), F.col(value).alias("v")).where(F.col("v").isNotNull()).distinct()
    apart = checkpoint(spread(distinct, "v").mapInPandas(take_apart, "f string, v string, tokens array<string>, whole string"))
    # Values that agree once taken apart are looked at once.
    forms = apart.select("f", "tokens", "whole").distinct()
    units = forms.select("f", F.explode(F.array_distinct(F.concat("tokens", F.array("whole")))).alias("unit")).where("unit != ''").distinct()
    vocabulary = listed.select("f", F.explode(F.array_union("words", F.array("joined"))).alias("word")).distinct()
    repaired = checkpoint(_repaired(units, vocabulary))

    total = listed.groupBy("f").agg(F.count("*").alias("n"))
    words = listed.select("f", "term", "words", F.explode("words").alias("word"))
    idf = words.distinct().groupBy("f", "word").agg(F.count("*").alias("df")).join(total, "f").select("f", "word", F.log(1 + F.col("n") / F.col("df")).alias("idf"))
    weighed = words.join(idf, ["f", "word"])
    postings = small_side(weighed)
    norm = small_side(weighed.groupBy("f", "term", "words").agg(F.sqrt(F.sum(F.col("idf") ** 2)).alias("norm")))

    likeness = 1 - F.col("edits") / F.greatest(F.length("unit"), F.length("word"))
    # As one token, soft TF-IDF is the likeness of the token, whatever its weight.
    single = forms.join(repaired, (forms.f == repaired.f) & (forms.whole == repaired.unit)).select(forms.f, "tokens", "unit", "word", "edits")
    single = single.join(small_side(listed.select("f", "term", F.col("joined").alias("word")).distinct()), ["f", "word"])
    single = single.groupBy("f", "tokens", "term").agg(F.min("edits").alias("distance"), F.max(likeness).alias("alike"))
    parts = forms.select("f", "tokens", F.posexplode("tokens").alias("pos", "unit")).join(repaired, ["f", "unit"]).join(postings, ["f", "word"])
    best = parts.groupBy("f", "tokens", "term", "words", "pos").agg(F.max(F.struct(likeness.alias("like"), "idf")).alias("b"))
    soft = best.groupBy("f", "tokens", "term", "words").agg(F.sum(F.col("b.like") * F.col("b.idf") ** 2).alias("dot"), F.sum(F.col("b.idf") ** 2).alias("known"), F.avg("b.idf").alias("typical"), F.count("*").alias("k"))
    # A token that is near no word of the entry weighs as much as its others do on average.
    soft = soft.join(norm, ["f", "term", "words"]).withColumn("score", F.col("dot") / F.col("norm") / F.sqrt(F.col("known") + (F.size("tokens") - F.col("k")) * F.col("typical") ** 2))
    soft = soft.groupBy("f", "tokens", "term").agg(F.max("score").alias("score"))
    both = single.join(soft, ["f", "tokens", "term"], "full").where(F.col("alike").isNotNull() | (F.col("score") >= SOFT))
    both = both.withColumn("score", F.round(F.greatest(F.coalesce("alike", F.lit(0.0)), F.coalesce("score", F.lit(0.0))), 6))
    first = both.groupBy("f", "tokens").agg(F.max("score").alias("score"), F.max_by(F.struct("term", "distance"), "score").alias("b"))
    # How many entries reach the best score; two make the value ambiguous.
    ties = both.join(first.select("f", "tokens", "score"), ["f", "tokens", "score"]).groupBy("f", "tokens").agg(F.count("*").alias("ties"))
    chosen = first.join(ties, ["f", "tokens"]).select("f", "tokens", F.when(F.col("ties") == 1, F.col("b.term")).alias("term"), F.col("b.distance").alias("distance"), "score")
    out = apart.select("f", "v", "tokens").join(chosen, ["f", "tokens"], "left")
    return out.select(F.col("f").alias(field), F.col("v").alias(value), F.col("term").alias(term), "distance", "score")
