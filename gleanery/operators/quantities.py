"""Quantities recorded in different units and notations.

A stated size is read into every number of bytes it can mean: "1.234 MB" may hold a
decimal fraction or a group of thousands, a bare number is in the unit of its source.
What it does mean follows from identities among columns: a page and the item it points to
state one size, and so do an item and the sum of its files' sizes. For each source the unit
of its bare numbers is the one with the smallest log residuals over all its rows at once;
for each row with several readings the one nearest to what must equal it. Solutions that
another one rivals, or that fit nothing, are flagged as not unique.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Powers of 1024 by the prefix of a unit, short and long.
PREFIX = {"": 0, "k": 1, "m": 2, "g": 3, "t": 4, "p": 5, "e": 6, "kilo": 1, "mega": 2, "giga": 3, "tera": 4, "peta": 5, "exa": 6, "kibi": 1, "mebi": 2, "gibi": 3, "tebi": 4, "pebi": 5, "к": 1, "м": 2, "г": 3, "т": 4, "кило": 1, "мега": 2, "гига": 3, "тера": 4}
# Counting words, as powers of ten.
COUNT = {"thousand": 3, "mil": 3, "mille": 3, "tausend": 3, "million": 6, "millions": 6, "millón": 6, "millones": 6, "millionen": 6, "milhão": 6, "milhões": 6, "billion": 9, "milliard": 9, "milliards": 9, "milliarde": 9, "milliarden": 9}
#: Bytes in one of a bare number's unit, by the name a source gives it.
SOURCE_UNIT = {"B": 1, "KiB": 1024, "MiB": 1024**2, "GiB": 1024**3, "512B": 512}

#: Quantities within this share of one another agree.
FIT = 0.01
#: A residual counts at most so much: a row that states another quantity tells nothing about units.
CAP = 1.0
#: Rows from which the unit of a source may be inferred, and by how much its mean residual must beat the next unit's.
ROWS, GAP = 3, 0.2

_BYTE = r"(?:bytes?|octets?|octetos?|octeto|байт(?:а|ов)?|b|o|б)"
_BIT = r"(?:bits?|бит(?:а|ов)?)"
_LONG = "|".join(sorted((k for k in PREFIX if len(k) > 1), key=len, reverse=True))
_UNIT = re.compile(rf"(?P<p>{_LONG}|[kmgtpeкмгт]?)(?:i)?\s?(?P<u>{_BIT}|{_BYTE})(?![^\W\d_])|(?P<l>{_LONG})s?(?![^\W\d_])|(?P<s>[kmgt])(?![^\W\d_])")
_NUM = re.compile(r"\d+(?:[.,]\d+)?e[+-]?\d+|\d{1,3}(?:[ '’.,]\d{3})+(?!\d)(?:[.,]\d+(?!\d))?|\d+(?:[.,]\d+)?")
#: Only before three digits may a sign part groups as well as a fraction.
_TWO_WAYS = re.compile(r"\d[.,]\d{3}(?!\d)")
_COUNTED = re.compile(r"/\s*\d+\s*[^\W\d_]+\s*$")
_TIMES = re.compile(r"\s*(?:[x×*])\s*")
_WORD = re.compile(r"([^\W\d_]+)(?:\s+(?:de|of)\b)?")


def readings(number: str, whole: bool) -> list[float]:
    """The values a number may have; ``whole`` if only integers make sense.

    >>> readings("1.234", False), readings("1.234", True), readings("3,48", False)
    ([1.234, 1234.0], [1234.0], [3.48])
    """
    if "e" in number:
        return [float(number.replace(",", "."))]
    seps = re.findall(r"[ '’.,]", number)
    if not seps:
        return [float(number)]
    digits = re.sub(r"[ '’.,]", "", number)
    last = len(number) - 1 - max(number.rfind(c) for c in seps)
    grouped, fraction = float(digits), float(re.sub(r"[ '’.,]", "", number[: len(number) - last - 1]) + "." + number[len(number) - last :])
    if seps[-1] in " '’" or len(seps) > 1 and len(set(seps)) == 1:
        return [grouped]
    if len(seps) > 1:
        return [fraction]
    if last == 3 and not number.startswith("0"):
        return [grouped] if whole else [fraction, grouped]
    return [fraction]


def parse_size(text: str | None, bare: tuple[float, ...] = (1.0,)) -> list[float]:
    """All numbers of bytes ``text`` can mean, the likeliest first; none if it states no size.

    ``bare`` holds the factors a number without unit may have. Sums ("2 GB 806 MB",
    "1 MB + 3 KB") and multiples ("4 x 87 MB") are worked out, remarks in brackets and
    counts of files are passed over. A text keeps to one notation and one unit of bare
    numbers. Zero, and what no double can hold, state no size.

    >>> parse_size("2 GB 1 MB"), parse_size("4 x 2 KB"), parse_size("8 Mbit"), parse_size("?? MB")
    ([2148532224.0], [8192.0], [1048576.0], [])
    """
    if not isinstance(text, str):
        return []
    s = re.sub(r"\s+", " ", re.sub(r"\([^)]*\)|\[[^\]]*\]", " ", text.lower())).strip()
    s = _COUNTED.sub("", s)
    totals = [_total(s, notation, b) for b in bare for notation in ((0, -1) if _TWO_WAYS.search(s) else (0,))]
    return [t for t in dict.fromkeys(totals) if t is not None and 0 < t < math.inf]


def _total(s: str, notation: int, bare: float) -> float | None:
    """Bytes that ``s`` states in one notation; None if it states none."""
    total, factor, pos, any_ = 0.0, 1.0, 0, False
    while m := _NUM.search(s, pos):
        rest = s[m.end() :]
        if (t := _TIMES.match(rest)) and t.end() and re.match(r"\d", rest[t.end() :]):
            factor *= readings(m[0], True)[0]
            pos = m.end() + t.end()
            continue
        after = rest.lstrip()
        scale = None
        if (w := _WORD.match(after)) and w[1] in COUNT:
            scale = 10.0 ** COUNT[w[1]]
            after = after[w.end() :].lstrip()
        u = _UNIT.match(after)
        if u:
            power = PREFIX[u["p"] or u["l"] or u["s"] or ""]
            unit = 1024.0**power * (scale or 1) / (8 if u["u"] and re.fullmatch(_BIT, u["u"]) else 1)
            value = readings(m[0], power == 0 and scale is None and unit == 1)[notation] * unit
            pos = len(s) - len(after) + u.end()
        elif scale:
            value = readings(m[0], False)[notation] * scale
            pos = len(s) - len(after)
        elif after and re.match(r"[^\W\d_]", after) or re.search(r"[^\W\d_]", s[pos : m.start()]) and any_:
            return None  # a number of something else
        else:
            value = readings(m[0], bare == 1.0)[notation] * bare
            pos = m.end()
        total += factor * value
        factor, any_ = 1.0, True
    return total if any_ else None


def _parse(texts: pd.Series, units: pd.Series) -> pd.Series:
    codes, uniques = pd.factorize(texts.fillna("") + "\x1f" + units.fillna(""))
    parsed = []
    for key in uniques:
        text, unit = key.rsplit("\x1f", 1)
        bare = (float(SOURCE_UNIT[unit]),) if unit in SOURCE_UNIT else tuple(float(v) for v in dict.fromkeys(SOURCE_UNIT.values())) if unit == "?" else (1.0,)
        parsed.append(parse_size(text, bare))
    return pd.Series([parsed[c] for c in codes])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _parse_udf(texts: pd.Series, units: pd.Series) -> pd.Series:
    return _parse(texts, units)


def size_readings(text: Column, unit: Column) -> Column:
    """Numbers of bytes that ``text`` can mean; ``unit`` is that of a bare number, "?" if unknown.

    Plain integers, the bulk, never leave the JVM; only other notations go through Arrow.
    Null and text without a quantity give an empty array.
    """
    known = F.create_map(*[F.lit(x) for k, v in SOURCE_UNIT.items() for x in (k, float(v))])
    plain = text.rlike("^ *[0-9]{1,18} *$") & (unit != "?")
    number = F.trim(text).try_cast("double") * F.coalesce(F.try_element_at(known, unit), F.lit(1.0))
    odd = F.when(plain, F.lit(None)).otherwise(text)
    return F.when(plain & (number > 0), F.array(number)).when(plain | text.isNull(), F.array().cast("array<double>")).otherwise(_parse_udf(odd, unit))


def residual(a: Column, b: Column) -> Column:
    """The pair of readings with the smallest log residual, as r, a, b; null if either has none."""
    pairs = F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.struct(F.abs(F.log(x) - F.log(y)).alias("r"), x.alias("a"), y.alias("b")))))
    return F.array_min(pairs)


def bare_number(text: Column) -> Column:
    """The number of a text that holds one and nothing else, in its source's unit; null for any other.

    Only numbers that every notation reads alike: digits, with a fraction of other than
    three digits.
    """
    return F.when(text.rlike(r"^\s*[0-9]{1,15}(?:\.(?:[0-9]{1,2}|[0-9]{4,15}))?\s*$"), F.trim(text).try_cast("double"))


def infer_units(evidence: DataFrame, group: str, number: str, known: str, units: dict[str, float] = SOURCE_UNIT) -> DataFrame:
    """group, factor, n, residual, second and unique: the unit in which each group states its bare numbers.

    ``evidence`` has a row for each bare ``number`` and a ``known`` quantity in bytes that
    must equal it. The factor is the one of ``units`` with the smallest mean log residual
    over all rows of the group. It is unique if at least ROWS rows speak for it, more than
    half of all within FIT, and if the next unit's mean is larger by GAP. Rows without a
    positive number on both sides, and null groups, tell nothing. One row for each group
    leaves the map side, so a hot group is no burden.
    """
    rows = evidence.select(F.col(group).alias("g"), (F.log(F.col(known)) - F.log(F.col(number))).alias("ratio")).where(F.col("g").isNotNull() & (F.col(known) > 0) & (F.col(number) > 0))
    off = {k: F.abs(F.col("ratio") - math.log(f)) for k, f in units.items()}
    sums = [F.struct(F.avg(F.least(off[k], F.lit(CAP))).alias("r"), F.count_if(off[k] < FIT).alias("fits"), F.lit(float(f)).alias("f")) for k, f in units.items()]
    per = rows.groupBy("g").agg(F.count("*").alias("n"), *[x.alias(f"u{k}") for k, x in enumerate(sums)])
    ranked = per.select("g", "n", F.array_sort(F.array(*[f"u{k}" for k in range(len(sums))])).alias("u"))
    best, second = F.col("u")[0], F.col("u")[1]
    unique = (best["fits"] >= ROWS) & (best["fits"] * 2 > F.col("n")) & (second["r"] >= best["r"] + GAP)
    return ranked.select(F.col("g").alias(group), best["f"].alias("factor"), "n", best["r"].alias("residual"), second["r"].alias("second"), unique.alias("unique"))


def settle(rows: DataFrame, row_id: str, key: str, partners: DataFrame, value: str) -> DataFrame:
    """row_id, bytes and unique of each row with ``readings``: the reading that what must equal it speaks for.

    ``partners`` has the columns key and value, any number of them for each key. A row with
    one reading keeps it and is unique. Of several readings the one with the smallest sum
    of log residuals is taken, unique if it is within FIT of a partner and the next reading's
    sum is larger by more than FIT; without any partner the first reading is taken, not unique.
    Rows without a reading give none. Only rows with several readings are joined.
    """
    one = rows.where(F.size("readings") == 1).select(row_id, F.col("readings")[0].alias("bytes"), F.lit(True).alias("unique"))
    many = rows.where(F.size("readings") > 1).select(row_id, key, F.posexplode("readings").alias("pos", "x"))
    near = F.least(F.abs(F.log("x") - F.log("v")), F.lit(CAP))
    tried = many.join(partners.select(key, F.col(value).alias("v")).where("v > 0"), key, "left").groupBy(row_id, "pos", "x")
    tried = tried.agg(F.coalesce(F.sum(near), F.lit(0.0)).alias("r"), F.coalesce(F.min(near), F.lit(CAP)).alias("nearest"))
    two = tried.groupBy(row_id).agg(F.slice(F.array_sort(F.collect_list(F.struct("r", "pos", "x", "nearest"))), 1, 2).alias("u"))  # a text has at most twice as many readings as units
    best, second = F.col("u")[0], F.col("u")[1]
    return one.unionByName(two.select(row_id, best["x"].alias("bytes"), ((best["nearest"] < FIT) & (second["r"] > best["r"] + FIT)).alias("unique")))


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Join two tables whose ``readings`` state one quantity and choose their readings.

    Result: all columns but the readings, with bytes_left, bytes_right, log_residual and
    unique (one choice of readings, and no other, agrees within FIT; false if none does).
    Columns of these names are replaced; others that both sides have get the suffix ``_right`` on the
    right. Rows of either
    side without partner or without a size give no row; null keys never match. Repeated
    keys match each with each, as in any join.
    """
    made = ("bytes_left", "bytes_right", "log_residual", "unique")
    left, right = left.drop(*made), right.drop(*made)
    for c in set(left.columns) & set(right.columns) - {key, "readings"}:
        right = right.withColumnRenamed(c, f"{c}_right")
    # A side whose key repeats a lot is split by the adaptive skew join.
    j = left.withColumnRenamed("readings", "__l").join(right.withColumnRenamed("readings", "__r"), key)
    fits = F.flatten(F.transform("__l", lambda x: F.transform("__r", lambda y: F.abs(F.log(x) - F.log(y)))))
    return (
        j.where((F.size("__l") > 0) & (F.size("__r") > 0))
        .withColumn("__best", residual(F.col("__l"), F.col("__r")))
        .withColumn("unique", F.size(F.filter(fits, lambda r: r < FIT)) == 1)
        .select("*", F.col("__best.a").alias("bytes_left"), F.col("__best.b").alias("bytes_right"), F.col("__best.r").alias("log_residual"))
        .drop("__best", "__l", "__r")
    )


def differing(reconciled: DataFrame, share: float = 0.01) -> DataFrame:
    """Rows whose two quantities differ by more than ``share`` of the larger."""
    return reconciled.where(F.abs(F.col("bytes_left") - F.col("bytes_right")) > share * F.greatest("bytes_left", "bytes_right"))
