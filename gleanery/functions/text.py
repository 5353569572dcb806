"""Classification of strings by patterns and by the lexicon, as native column expressions."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions import lexicon as lx


def _array(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def stripped(s: Column) -> Column:
    """Without spaces, common or unbreakable, at both ends."""
    return F.regexp_replace(s, "^[ \u00a0]+|[ \u00a0]+$", "")


def word_count(s: Column) -> Column:
    """Number of words between single spaces; blank text has one, as a split has."""
    return F.size(F.split(s, " "))


def is_phrase_of(s: Column, words, most: int) -> Column:
    """Whether a text of at most ``most`` words holds one of ``words`` as a whole phrase; null is false."""
    low = F.concat(F.lit(" "), F.lower(s), F.lit(" "))
    held = F.exists(_array(words), lambda w: low.contains(F.concat(F.lit(" "), w, F.lit(" "))))
    return F.coalesce((word_count(s) <= most) & held, F.lit(False))


def is_category(s: Column) -> Column:
    return is_phrase_of(s, lx.words("category"), 2)


def is_language(s: Column) -> Column:
    return is_phrase_of(s, lx.words("language"), 2)


def is_quality(s: Column) -> Column:
    return is_phrase_of(s, lx.words("quality"), 2)


def is_genre(s: Column) -> Column:
    return is_phrase_of(s, lx.words("genre"), 4)


def first_contained(s: Column, words) -> Column:
    """The first of ``words``, in their order, that is a substring of the text; null if none."""
    return F.try_element_at(F.filter(_array(words), lambda w: F.lower(s).contains(w)), F.lit(1))


def extract_category(s: Column) -> Column:
    return first_contained(s, lx.words("category"))


def word_class(s: Column) -> Column:
    """The first class that has the text as a word, without case; null if none."""
    out = F.lit(None).cast("string")
    for name, words in reversed(lx.CLASSES.items()):
        out = F.when(F.lower(s).isin(list(words)), F.lit(name)).otherwise(out)
    return out


def keywords(s: Column) -> Column:
    """Distinct words of more than two letters that the lexicon has, sorted."""
    every = sorted({w for ws in lx.CLASSES.values() for w in ws})
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(s), r"[^a-z0-9]+"), lambda w: (F.length(w) > 2) & w.isin(every))))


def season_episode(s: Column) -> tuple[Column, Column]:
    """Season and episode of the first ``s<digits>e<digits>``, as text; null if there is none."""
    pattern = r"(?i)s([0-9]+)e([0-9]+)"
    return tuple(F.nullif(F.regexp_extract(s, pattern, k), F.lit("")) for k in (1, 2))


def tags_of(category: Column) -> Column:
    """Tags of a category by ordered rules, comma-joined, repeats kept; null for null."""
    rules = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(t).alias("t")) for w, t in lx.TAG_RULES])
    return F.when(category.isNotNull(), F.array_join(F.transform(F.filter(rules, lambda r: F.lower(category).contains(r["w"])), lambda r: r["t"]), ","))


def class_with(s: Column, prefix: str) -> Column:
    """The last class of a kind (say genre) one of whose words the text contains; null if none."""
    out = F.lit(None).cast("string")
    for name, words in lx.CLASSES.items():
        if name.startswith(prefix):
            out = F.when(F.exists(_array(words), lambda w: F.lower(s).contains(w)), F.lit(name)).otherwise(out)
    return out


def category_of_subcategory(s: Column) -> Column:
    return F.try_element_at(_map(lx.CATEGORY_OF_SUBCATEGORY), F.lower(stripped(s)))


def category_of_genre(s: Column) -> Column:
    """Category of the part before a bar; the last genre class that matches wins."""
    return F.try_element_at(_map(lx.CATEGORY_OF_GENRE), class_with(F.substring_index(F.trim(s), "|", 1), "genre"))


def schema_of(category: Column, genre: Column, quality: Column) -> Column:
    """Kind of item by category, else genre, else quality, else the default."""
    return F.coalesce(
        F.try_element_at(_map(lx.SCHEMA_OF_CATEGORY), F.lower(category)),
        F.try_element_at(_map(lx.SCHEMA_OF_GENRE), class_with(genre, "genre")),
        F.try_element_at(_map(lx.SCHEMA_OF_QUALITY), class_with(quality, "quality")),
        F.lit(lx.DEFAULT_SCHEMA),
    )


def is_synonym(a: Column, b: Column) -> Column:
    """Whether two terms mean the same: equal, listed either way, or one of them empty or "other"."""
    a, b = F.lower(stripped(a)), F.lower(stripped(b))
    listed = F.lit(False)
    for k, vs in lx.SYNONYMS.items():
        listed = listed | ((a == k) & b.isin(list(vs))) | ((b == k) & a.isin(list(vs)))
    return F.coalesce(a, F.lit("")).isin("", "other") | F.coalesce(b, F.lit("")).isin("", "other") | F.coalesce((a == b) | listed, F.lit(False))


# Marks of program text (spaces are taken out of a text before they are looked for), those
# that count only when nothing milder is asked for, and line ends of code, with the milder ones first.
SCRIPT_MARKS = ("text/javascript", "function", "<iframe", "text-decoration", "font-size", "=[", "={", "returnfalse", "returntrue")
HARD_MARKS = ("src=", "href=")
SOFT_ENDS = (";", "}", "{", "+")
HARD_ENDS = (">", ",")
# Parts of pages that are no description.
NO_DESCRIPTION = ("/announce", "add your comment", 'id="comment', 'class="comment', "id='comment", "class='comment")


def is_script(s: Column, soft: bool = False) -> Column:
    """Whether a text looks like program text: a mark in it, or more code-like line ends than half its lines.

    Marks of two words are meant to be found, so they are listed without their space.
    """
    tight = F.replace(F.lower(s), F.lit(" "), F.lit(""))
    held = F.exists(_array(SCRIPT_MARKS if soft else SCRIPT_MARKS + HARD_MARKS), lambda m: tight.contains(m))
    count = sum(((F.length(tight) - F.length(F.replace(tight, F.lit(f"{e}\n"), F.lit("")))) / 2).cast("int") for e in (SOFT_ENDS if soft else SOFT_ENDS + HARD_ENDS))
    lines = F.length(tight) - F.length(F.replace(tight, F.lit("\n"), F.lit("")))
    return F.coalesce(held | (count > F.floor(lines / 2)), F.lit(False))


def is_description(s: Column) -> Column:
    """A text of 33 to 4095 characters that is no program text, no form of the page and no short thanks."""
    n = F.length(s)
    form = F.exists(_array(NO_DESCRIPTION), lambda m: s.contains(m))
    return F.coalesce((n > 32) & (n < 4096) & ~(s.contains("thank") & (n < 50)) & ~form & ~is_script(s, soft=True), F.lit(False))


def infohash(s: Column) -> Column:
    """The first run of 40 hexadecimal digits, in capitals; null if none."""
    return F.upper(F.nullif(F.regexp_extract(s, "([0-9a-fA-F]{40})", 1), F.lit("")))


def page_size(s: Column) -> Column:
    """Bytes of a size as a page states it: one number and a unit, or a fraction in megabytes; null otherwise."""
    low = F.lower(s)
    numbers = F.regexp_extract_all(low, F.lit(r"([0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    number = F.when(F.size(numbers) == 1, numbers[0].try_cast("double"))
    power = F.when(low.rlike(r"[0-9] ?[tт]i?b"), 4).when(low.rlike(r"[0-9] ?gi?b"), 3).when(low.rlike(r"[0-9] ?mi?b"), 2).when(low.rlike(r"[0-9] ?ki?b"), 1).when(low.rlike(r"[0-9] ?b"), 0).when(low.contains("size") & number.isNotNull() & numbers[0].contains("."), 2).when(low.contains("size"), 0)
    return F.floor(number * F.pow(F.lit(1024.0), power)).cast("long")


def title_words(title: Column) -> Column:
    return F.regexp_extract_all(F.lower(title), F.lit(r"[\p{L}\p{N}_']+"), F.lit(0))


def is_title(title: Column, url: Column, full: bool = False) -> Column:
    """All words of the title in the last part of the address, or over 70 % of more than five; ``full``: in all of its path."""
    words = title_words(title)
    where = F.lower(F.array_join(F.slice(F.split(url, "/"), 4, 1_000_000), "/") if full else F.substring_index(url, "/", -1))
    hits = F.size(F.filter(words, lambda w: where.contains(w)))
    return F.coalesce((F.size(words) > 0) & ((hits == F.size(words)) | ((F.size(words) > 5) & (hits > F.size(words) * 0.7))), F.lit(False))


def valid_meta(field: str, s: Column, url: Column) -> Column:
    """Struct (valid, kind, value) of a string offered for a field; unknown fields are tried as a word class."""
    season, episode = season_episode(s)
    by = {
        "title": (s.isNotNull(), s), "category": (is_category(s), extract_category(s)), "language": (is_language(s), F.lower(s)), "quality": (is_quality(s), F.lower(s)),
        "genre": (is_genre(s), F.lower(s)), "size": (page_size(s).isNotNull(), page_size(s).cast("string")), "infohash": (infohash(s).isNotNull(), infohash(s)), "description": (is_description(s), s),
        "image": (F.size(F.split(s, "/")) > 3, s), "season": (s.rlike("^[0-9]+$") | season.isNotNull(), F.coalesce(season, s)), "episode": (s.rlike("^[0-9]+$") | episode.isNotNull(), F.coalesce(episode, s)),
    }
    valid, value = by.get(field, (word_class(s).isNotNull(), word_class(s)))
    valid = F.coalesce(valid, F.lit(False))
    return F.struct(valid.alias("valid"), F.lit(field if field in by else "class").alias("kind"), F.when(valid, value).alias("value"))


# Replacements that turn HTML into text, in this order, and entities, the ampersand last. ``\1`` is the group.
STRIPPING = (
    (r">\s+", ">"), (r"\s+", " "), (r"\s*<br\s*/?>\s*", "\n"), (r"</(?:div)\s*>\s*", "\n"), (r"</(?:p|h[0-9])\s*>\s*", "\n\n"), (r"<head>.*<\s*(?:/head|body)[^>]*>", ""),
    (r'<a\s+href="([^"]+)"[^>]*>.*</a>', r"\1"), (r"[ \t]*<[^<]*?/?>", ""), (r"^\s+", ""),
)
ENTITIES = (("&nbsp;", " "), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def strip_tags(html: Column) -> Column:
    """Text of HTML by ordered replacements: breaks and ends of blocks to line ends, links for anchors, other tags away, entities last."""
    s = html
    for pattern, to in STRIPPING:
        s = F.regexp_replace(s, pattern, to.replace("\\", "$"))
    for entity, to in ENTITIES:
        s = F.replace(s, F.lit(entity), F.lit(to))
    return s


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def unescaped(s: Column) -> Column:
    """HTML entities resolved; texts without an ampersand, the bulk, never leave the JVM."""
    return F.when(s.contains("&"), _unescape(F.when(s.contains("&"), s))).otherwise(s)


def field_of_class(name: Column) -> Column:
    """The field that a word class belongs to: the part before the first underscore."""
    return F.split_part(name, F.lit("_"), F.lit(1))


@F.pandas_udf(T.StringType())
def _other_charset(raw: pd.Series) -> pd.Series:
    def read(b: bytes | None) -> str | None:
        if b is None:
            return None
        for mark, name in ((b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
            if b.startswith(mark):
                return b.decode(name, "replace")
        declared = re.search(rb"(?i)charset=[\"']?([a-z0-9_\-]+)", b[:2048])
        for name in (declared and declared[1].decode(), "cp1252"):
            try:
                if name:
                    return b.decode(name)
            except (UnicodeDecodeError, LookupError):
                pass
        return b.decode("latin-1")

    return raw.map(read)


def coerced(raw: Column) -> Column:
    """Text of bytes in an unknown encoding: UTF-8 where they are valid, else by their mark or declaration, else Western.

    Valid UTF-8, the bulk, never leaves the JVM. Null stays null; no bytes are an empty text.
    """
    return F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(_other_charset(F.when(~F.is_valid_utf8(raw.cast("string")), raw)))
