"""Timestamps in mixed formats, precisions and zones to one UTC second each.

A reading is masked to its shape: digits become one class, words and signs stay. All
readings with one mask have their fields at the same places, so a parser is chosen once
for each distinct mask and then cuts and converts whole columns of characters with numpy.
Zones, named or implied, are applied through tables of their transitions, made from the
installed time-zone data and kept under its version; a task whose machine has another
version than the driver fails instead of mixing the two, and the version goes out with
the instants.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import TZPATH, ZoneInfo

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import checkpoint

# Month names and abbreviations of English, Spanish, French, German, Portuguese.
MONTHS = {
    1: "jan january enero ene janvier janv januar januar jän janeiro", 2: "feb february febrero février fevrier févr februar fevereiro fev",
    3: "mar march marzo mars märz marz mär março marco", 4: "apr april abril abr avril avr", 5: "may mayo mai maio",
    6: "jun june junio juin juni junho", 7: "jul july julio juillet juil juli julho", 8: "aug august agosto ago août aout",
    9: "sep sept september septiembre setiembre set septembre setembro", 10: "oct october octubre octobre okt oktober outubro out",
    11: "nov november noviembre novembre novembro", 12: "dec december diciembre dic décembre decembre déc dez dezember dezembro",
}
# Zone abbreviations, as seconds east of UTC.
ABBREVIATIONS = {"UTC": 0, "GMT": 0, "Z": 0, "UT": 0, "WET": 0, "WEST": 3600, "BST": 3600, "CET": 3600, "CEST": 7200, "MEZ": 3600, "MESZ": 7200, "EET": 7200, "EEST": 10800, "MSK": 10800, "IST": 19800, "NPT": 20700, "JST": 32400, "AEST": 36000, "AEDT": 39600, "ART": -10800, "EST": -18000, "EDT": -14400, "CST": -21600, "CDT": -18000, "MST": -25200, "MDT": -21600, "PST": -28800, "PDT": -25200}

_MONTH = {n: k for k, names in MONTHS.items() for n in names.split()}
_ZONE = r"(?:\s*(?P<off>[+\-][0-9]{2}(?::?[0-9]{2})?)(?:\[(?P<region>[^\]]+)\])?|\s*(?P<abbr>[A-Za-z]{1,5})|\[(?P<only>[^\]]+)\])?"
_TIME = r"(?P<H>[0-9]{1,2}):(?P<M>[0-9]{2})(?::(?P<S>[0-9]{2})(?:[.,](?P<f>[0-9]+))?)?(?:\s*(?P<ampm>[AaPp]\.?[Mm]\.?)(?![A-Za-z]))?"
_WEEKDAY = r"(?:[^\W\d_]+\.?,?\s+)?"
#: Patterns of whole readings, tried in this order on one example of each mask.
FORMATS = [
    re.compile(p)
    for p in (
        r"(?P<epoch>-?[0-9]{9,10})(?:\.[0-9]+)?", r"(?P<milli>[0-9]{12,13})", r"(?P<micro>[0-9]{15,16})", r"(?P<nano>[0-9]{18,19})",
        rf"(?P<Y>[0-9]{{4}})(?P<m>[0-9]{{2}})(?P<d>[0-9]{{2}})[T ]?(?P<H>[0-9]{{2}})(?P<M>[0-9]{{2}})(?:(?P<S>[0-9]{{2}})(?:[.,](?P<f>[0-9]+))?)?{_ZONE}",
        rf"(?P<Y>[0-9]{{4}})(?P<sep>[-./])(?P<m>[0-9]{{1,2}})(?P=sep)(?P<d>[0-9]{{1,2}})(?:[T]|,?\s+){_TIME}{_ZONE}",
        rf"(?P<d>[0-9]{{1,2}})(?P<sep>[-.])(?P<m>[0-9]{{1,2}})(?P=sep)(?P<Y>[0-9]{{4}})(?:[T]|,?\s+){_TIME}{_ZONE}",
        rf"(?P<m>[0-9]{{1,2}})/(?P<d>[0-9]{{1,2}})/(?P<Y>[0-9]{{4}})(?:[T]|,?\s+){_TIME}{_ZONE}",
        rf"{_WEEKDAY}(?P<d>[0-9]{{1,2}})(?:\.|º)?[\s\-]+(?:de\s+)?(?P<b>[^\W\d_]+)\.?,?[\s\-]+(?:de\s+)?(?P<Y>[0-9]{{4}}),?\s+(?:(?:at|um|à|a las)\s+)?{_TIME}{_ZONE}",
        rf"{_WEEKDAY}(?P<b>[^\W\d_]+)\.?\s+(?P<d>[0-9]{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<Y>[0-9]{{4}}),?\s+(?:at\s+)?{_TIME}{_ZONE}",
        rf"{_WEEKDAY}(?P<b>[^\W\d_]+)\s+(?P<d>[0-9]{{1,2}})\s+{_TIME}\s+(?P<abbr2>[A-Z]{{2,4}}\s+)?(?P<Y>[0-9]{{4}})",
    )
]
_CLASSES = str.maketrans({c: "9" for c in "0123456789"})
#: Years that transition tables cover; readings of other years are looked up one by one.
_YEARS = (1900, 2100)


@lru_cache(maxsize=1)
def tz_version() -> str:
    """Version of the time-zone data that ``zoneinfo`` reads: the system's, else the package's."""
    for folder in TZPATH:
        for name in ("tzdata.zi", "+VERSION"):
            try:
                with open(os.path.join(folder, name)) as f:
                    return f.readline().replace("version", "").strip("# \n")
            except OSError:
                continue
        # Data without a statement of its version: a digest of rules that change often.
        digest = hashlib.sha256()
        for zone in ("Africa/Casablanca", "America/New_York", "Asia/Gaza", "Europe/Moscow", "Pacific/Fiji"):
            try:
                with open(os.path.join(folder, zone), "rb") as f:
                    digest.update(f.read())
            except OSError:
                break
        else:
            return f"unnamed {digest.hexdigest()[:12]}"
    from importlib.metadata import PackageNotFoundError, version

    try:
        return version("tzdata")
    except PackageNotFoundError:
        return "none"


def transitions(zone: str, version: str | None = None) -> tuple[np.ndarray, np.ndarray] | None:
    """Instants from which an offset holds, and the offsets, of one zone from 1900 to 2100; None for no zone.

    ``version`` is the one that the table has to be of.
    """
    here = tz_version()
    if version is not None and version != here:
        raise RuntimeError(f"time-zone data {here} here, {version} on the driver")
    return _transitions(zone, here)


@lru_cache(maxsize=1024)
def _transitions(zone: str, version: str) -> tuple[np.ndarray, np.ndarray] | None:
    try:
        tz = ZoneInfo(zone)
    except Exception:
        return None

    def offset(t: int) -> int:
        return int((datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=t)).astimezone(tz).utcoffset().total_seconds())

    begin, end = (int(datetime(y, 1, 1, tzinfo=timezone.utc).timestamp()) for y in _YEARS)
    at, offsets, step, t = [begin - 10**12], [offset(begin)], 21 * 86400, begin
    while t < end:
        low, high = t, min(t + step, end)
        if offset(high) != offsets[-1]:
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (low, mid) if offset(mid) != offsets[-1] else (mid, high)
            at.append(high)
            offsets.append(offset(high))
            t = high
        else:
            t = high
    return np.array(at, dtype=np.int64), np.array(offsets, dtype=np.int64)


def _one_by_one(local: np.ndarray, zone: str) -> tuple[np.ndarray, np.ndarray]:
    """As ``zone_to_utc``, for the few readings of years without a table."""
    tz, out, good = ZoneInfo(zone), np.zeros_like(local), np.zeros(len(local), dtype=bool)
    for k, t in enumerate(local):
        try:
            naive = datetime(1970, 1, 1) + timedelta(seconds=int(t))
            hits = {naive.replace(tzinfo=tz, fold=f).astimezone(timezone.utc) for f in (0, 1)}
            hits = {u for u in hits if u.astimezone(tz).replace(tzinfo=None) == naive}
        except (OverflowError, ValueError):
            continue
        if len(hits) == 1:
            out[k], good[k] = (hits.pop().replace(tzinfo=None) - datetime(1970, 1, 1)) // timedelta(seconds=1), True
    return out, good


def zone_to_utc(local: np.ndarray, zone: str, version: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """UTC seconds of local seconds and whether each names one instant.

    A local reading that the zone's clock shows twice or never names none.
    """
    table = transitions(zone, version)
    if table is None:
        return np.zeros_like(local), np.zeros(len(local), dtype=bool)
    at, offsets = table
    hits, found = np.zeros(len(local), dtype=np.int64), np.zeros(len(local), dtype=np.int64)
    for off in np.unique(offsets):
        utc = local - off
        ok = offsets[np.searchsorted(at, utc, side="right") - 1] == off
        hits += ok
        found = np.where(ok, utc, found)
    good = hits == 1
    begin, end = ((datetime(y, 1, 1) - datetime(1970, 1, 1)) // timedelta(seconds=1) for y in _YEARS)
    if (far := np.flatnonzero((local < begin + 2 * 86400) | (local >= end - 2 * 86400))).size:
        found[far], good[far] = _one_by_one(local[far], zone)
    return found, good


class Parser:
    """Cuts the fields out of all readings with one mask."""

    def __init__(self, example: str, version: str | None = None):
        self.version = version
        self.spans: dict[str, tuple[int, int]] = {}
        for form in FORMATS:
            if m := form.fullmatch(example):
                self.spans = {k: m.span(k) for k, v in m.groupdict().items() if v is not None}
                return

    def __bool__(self) -> bool:
        return bool(self.spans)

    def text(self, chars: np.ndarray, field: str) -> np.ndarray:
        a, b = self.spans[field]
        return np.ascontiguousarray(chars[:, a:b]).view(f"<U{b - a}").ravel()

    def number(self, chars: np.ndarray, field: str, default: int = 0) -> np.ndarray:
        if field not in self.spans:
            return np.full(len(chars), default, dtype=np.int64)
        a, b = self.spans[field]
        out = np.zeros(len(chars), dtype=np.int64)
        for k in range(a, b):
            out = out * 10 + (chars[:, k].view(np.uint32).astype(np.int64) - 48)
        return out

    def __call__(self, readings: np.ndarray, zones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTC seconds, and which readings name one; ``zones`` are those of readings without zone."""
        n, width = len(readings), len(readings[0])
        chars = readings.astype(f"<U{width}").view("<U1").reshape(n, width)
        for k, unit in (("epoch", 1), ("milli", 10**3), ("micro", 10**6), ("nano", 10**9)):
            if k in self.spans:
                sec = self.text(chars, k).astype(np.int64) // unit
                return sec, sec > 0
        year, day = self.number(chars, "Y"), self.number(chars, "d")
        if "b" in self.spans:
            names = self.text(chars, "b")
            month = np.array([_MONTH.get(x.lower(), 0) for x in names], dtype=np.int64)
        else:
            month = self.number(chars, "m")
        hour, minute, sec = (self.number(chars, k) for k in "HMS")
        ok = (month >= 1) & (month <= 12) & (day >= 1) & (minute < 60) & (sec < 60) & (hour < 24) & (year >= 1)
        if "ampm" in self.spans:
            half = np.char.lower(self.text(chars, "ampm"))
            ok &= (hour >= 1) & (hour <= 12)
            hour = hour % 12 + np.where(np.char.startswith(half, "p"), 12, 0)
        month, year = np.where(ok, month, 1), np.where(ok, year, 1970)
        first = (year - 1970).astype("datetime64[Y]").astype("datetime64[M]") + (month - 1)
        days = (first + 1).astype("datetime64[D]") - first.astype("datetime64[D]")
        ok &= day <= days.astype(np.int64)
        local = first.astype("datetime64[D]").astype(np.int64) * 86400 + (day - 1) * 86400 + hour * 3600 + minute * 60 + sec
        ok &= ~((year == 1970) & (month == 1) & (day == 1))  # the placeholder
        return self.zoned(chars, local, ok, zones)

    def zoned(self, chars: np.ndarray, local: np.ndarray, ok: np.ndarray, zones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if "off" in self.spans:
            a, b = self.spans["off"]
            digits = [k for k in range(a + 1, b) if chars[0, k] != ":"]
            v = [chars[:, k].view(np.uint32).astype(np.int64) - 48 for k in digits]
            seconds = (v[0] * 10 + v[1]) * 3600 + ((v[2] * 10 + v[3]) * 60 if len(v) > 2 else 0)
            ok = ok & (seconds <= 18 * 3600)
            return local - np.where(chars[:, a] == "-", -seconds, seconds), ok
        field = next((k for k in ("abbr", "abbr2", "only") if k in self.spans), None)
        names = np.char.strip(self.text(chars, field)) if field else zones
        utc, good = np.zeros(len(local), dtype=np.int64), np.zeros(len(local), dtype=bool)
        for name in pd.unique(pd.Series(names, dtype=object).dropna()):
            at = names == name
            if field in ("abbr", "abbr2"):
                if name.upper() in ABBREVIATIONS:
                    utc[at], good[at] = local[at] - ABBREVIATIONS[name.upper()], True
            else:
                utc[at], good[at] = zone_to_utc(local[at], name, self.version)
        return utc, good & ok


#: Parsers by mask; a worker keeps them. Emptied when strange readings have filled it.
_PARSERS: dict[tuple[str, str | None], Parser] = {}


def to_utc(readings: pd.Series, zones: pd.Series, version: str | None = None) -> pd.Series:
    """UTC second of each reading as nullable integer; ``version`` is that of the time-zone data to use.

    >>> to_utc(pd.Series(["2010-05-05T11:07:39Z", "05/06/2010 01:10:24 PM", "05-05-2010"]), pd.Series(["UTC"] * 3)).tolist()
    [1273057659, 1273151424, <NA>]
    """
    out = np.zeros(len(readings), dtype=np.int64)
    good = np.zeros(len(readings), dtype=bool)
    text = readings.fillna("").str.strip()
    # Words stay in the mask: months, zones and halves of the day are few, and a word's role follows from it.
    masks = text.str.translate(_CLASSES)
    values, zone = text.to_numpy(dtype=object), zones.to_numpy(dtype=object)
    for mask, rows in masks.groupby(masks, sort=False).indices.items():
        parser = _PARSERS.get((mask, version))
        if parser is None:
            if len(_PARSERS) > 50_000:
                _PARSERS.clear()
            parser = _PARSERS[mask, version] = Parser(values[rows[0]], version)
        if parser:
            out[rows], good[rows] = parser(values[rows], zone[rows])
    return pd.Series(out).astype("Int64").where(pd.Series(good))


def normalise(df: DataFrame, reading: str, zone: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, utc_second (null where ``reading`` names no single instant) and tz_version.

    ``zone`` is the column with the zone of readings that say none; null means there is
    no such zone. Fractions are cut off; bare days, impossible or unreadable times, the
    1970 placeholder and local readings that occur twice or never give null.
    """
    schema = df.select(*[F.col(f"`{c}`") for c in keep]).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", utc_second bigint, tz_version string"
    version = tz_version()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[keep].assign(utc_second=to_utc(pdf["__reading"], pdf["__zone"], version), tz_version=version)

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{reading}`").alias("__reading"), F.col(f"`{zone}`").alias("__zone")).mapInPandas(run, ddl)


def same_second(df: DataFrame, group: list[str], key: str) -> DataFrame:
    """Pairs key_a < key_b of rows of one group that name the same UTC second.

    Null groups and null seconds pair with nothing. The join is on group and second
    together, so a hot group spreads over its seconds, and the adaptive skew join splits
    what is left. Readings are parsed once: they are checkpointed before the self-join.
    """
    w = checkpoint(df.where(F.col("utc_second").isNotNull()).dropna(subset=group).select(*group, "utc_second", key))
    a, b = w.withColumnRenamed(key, "key_a"), w.withColumnRenamed(key, "key_b")
    return a.join(b, [*group, "utc_second"]).where("key_a < key_b")


def second_classes(df: DataFrame, group: list[str], key: str) -> DataFrame:
    """group, utc_second, class_id (smallest key) and n_rows of all rows that name one second.

    The form of ``same_second`` that stays linear in the rows: a class of n rows is one row
    here and n (n - 1) / 2 pairs there. Null groups and seconds are in no class; classes of
    one row are left out.
    """
    named = df.where(F.col("utc_second").isNotNull()).dropna(subset=group)
    return named.groupBy(*group, "utc_second").agg(F.min(key).alias("class_id"), F.count("*").alias("n_rows")).where("n_rows > 1")
