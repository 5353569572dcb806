"""Queries of the engine's own operators, each with its SQL.

Where the operator works on page trees, files or streams, which SQL cannot read, there is
no SQL and tests check it instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.functions import lexicon as lx
from gleanery.functions import text as tx
from gleanery.functions import urls as ur
from gleanery.operators import matching, paths, quantities, ranking, state, votes
from gleanery.operators.packed import split_packed
from gleanery.session import checkpoint, drained, shared_folder, small_side, table
from gleanery.sources import dom, files, images, metainfo
from gleanery.streaming import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _in(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _list(words) -> str:
    return f"[{_in(words)}]"


# SQL of a category without white space around it.
_TRIM = r"regexp_replace(category, '^[ \x{00A0}]+|[ \x{00A0}]+$', '', 'g')"

# SQL of the host of an address, as ur.host reads it.
_HOST = r"regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:www\.)?([^/?#:]+)', 1)"


def _host(u: str) -> str:
    return _HOST.format(u=u)


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each discovery page of each record: row_id, pos, link."""
    return table(spark, sf_dir, "torrent", "row_id", "disc").select("row_id", F.posexplode("disc").alias("pos", "link"))


_LINKS = "(SELECT row_id, CAST(i AS INTEGER) - 1 AS pos, disc[i] AS link FROM torrent, unnest(range(1, len(disc) + 1)) t(i))"

#: Words of links that lead to advertisements or listings, and static files.
BAD_WORDS = ("banner", "adserver", "doubleclick", "facebook", "twitter")
# Extensions of files that no link is followed to.
STATIC = ("jpg", "jpeg", "gif", "png", "js", "css")
_BAD = "|".join(BAD_WORDS)
_STATIC = r"(?i)\.(?:" + "|".join(STATIC) + r")$"
LISTING = "(?:/search|/find|/browse)"


@query(f"""
WITH l AS (SELECT DISTINCT {_host('link')} AS site, split_part(link, '#', 1) AS link FROM {_LINKS} WHERE NOT regexp_matches(link, '{_BAD}') AND NOT regexp_matches(link, '{_STATIC}')),
     c AS (SELECT site, coalesce(string_split(link, '/')[4], '') AS section, count(*) AS n_links FROM l GROUP BY 1, 2)
SELECT site, section, n_links FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY n_links DESC, section) AS r FROM c) WHERE r <= 5
""")
def link_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top five first path segments of each site's distinct links, without fragments and blacklisted ones."""
    link = F.col("link")
    ok = _links(spark, sf_dir).where(~link.rlike(_BAD) & ~link.rlike(_STATIC))
    distinct = ok.select(ur.host(link).alias("site"), ur.without_fragment(link).alias("link")).distinct()
    counts = distinct.groupBy("site", F.coalesce(ur.segment(F.col("link"), 3), F.lit("")).alias("section")).agg(F.count("*").alias("n_links"))
    rank = F.row_number().over(Window.partitionBy("site").orderBy(F.desc("n_links"), "section"))
    return counts.withColumn("r", rank).where("r <= 5").drop("r")


@query(f"SELECT row_id, pos, link FROM {_LINKS}")
def page_links_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir)


_SHAPE = """
WITH s AS (SELECT {host} AS site, url, len(string_split(url, '/')) AS a,
                  len(string_split(regexp_replace(url, '/[^/]*$', ''), '_')) AS b, len(string_split(regexp_replace(url, '/[^/]*$', ''), '-')) AS c FROM meta WHERE url IS NOT NULL),
     ma AS (SELECT site, arg_min(a, ord) AS m FROM (SELECT site, a, row(-count(*), a) AS ord FROM s GROUP BY 1, 2) GROUP BY 1),
     mb AS (SELECT site, arg_min(b, ord) AS m FROM (SELECT site, b, row(-count(*), b) AS ord FROM s GROUP BY 1, 2) GROUP BY 1),
     mc AS (SELECT site, arg_min(c, ord) AS m FROM (SELECT site, c, row(-count(*), c) AS ord FROM s GROUP BY 1, 2) GROUP BY 1)
SELECT site, url, (a <> ma.m)::INT + (b <> mb.m)::INT + (c <> mc.m)::INT AS violations FROM s JOIN ma USING (site) JOIN mb USING (site) JOIN mc USING (site)
WHERE a <> ma.m OR b <> mb.m OR c <> mc.m
"""


@query(_SHAPE.format(host=_host("url")))
def url_shape_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "meta", "url").withColumn("site", ur.host(F.col("url")))
    return votes.shape_outliers(urls, "site", "url")


@query(f"""
WITH u AS (SELECT {_host('url')} AS site, url FROM meta WHERE url IS NOT NULL),
     a AS (SELECT site, min(url) AS lo, max(url) AS hi, min(reverse(url)) AS rlo, max(reverse(url)) AS rhi, min(len(string_split(url, '/'))) AS n_segments, count(*) AS n_urls FROM u GROUP BY 1)
SELECT site, substr(lo, 1, len(list_filter(range(1, least(len(lo), len(hi)) + 1), lambda i: substr(lo, 1, i) = substr(hi, 1, i)))) AS prefix,
       reverse(substr(rlo, 1, len(list_filter(range(1, least(len(rlo), len(rhi)) + 1), lambda i: substr(rlo, 1, i) = substr(rhi, 1, i))))) AS suffix, n_segments, n_urls FROM a
""")
def site_url_prefix_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "meta", "url").withColumn("site", ur.host(F.col("url")))
    return votes.prefix_and_suffix(urls, "site", "url")


@query(f"""
WITH u AS (SELECT {_host('url')} AS site, meta_id, url FROM meta),
     m AS (SELECT site, min(url) AS lo, max(url) AS hi, min(reverse(url)) AS rlo, max(reverse(url)) AS rhi, min(len(string_split(url, '/'))) AS n FROM u GROUP BY 1),
     p AS (SELECT site, n, substr(lo, 1, len(list_filter(range(1, least(len(lo), len(hi)) + 1), lambda i: substr(lo, 1, i) = substr(hi, 1, i)))) AS prefix,
                  reverse(substr(rlo, 1, len(list_filter(range(1, least(len(rlo), len(rhi)) + 1), lambda i: substr(rlo, 1, i) = substr(rhi, 1, i))))) AS suffix FROM m)
SELECT d.doc_id, coalesce(starts_with(d.url, prefix) AND ends_with(d.url, suffix) AND len(string_split(d.url, '/')) = n, true) AS is_detail
FROM documents d LEFT JOIN p ON {_host('d.url')} = p.site
""")
def detail_by_learned_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an address has the learned prefix, suffix and number of segments of its site; unknown sites pass."""
    learned = site_url_prefix_suffix(spark, sf_dir)
    docs = table(spark, sf_dir, "documents", "doc_id", "url").withColumn("site", ur.host(F.col("url")))
    fits = F.col("url").startswith(F.col("prefix")) & F.col("url").endswith(F.col("suffix")) & (ur.segment_count(F.col("url")) == F.col("n_segments"))
    return docs.join(learned, "site", "left").select("doc_id", F.coalesce(fits, F.lit(True)).alias("is_detail"))


@query(f"SELECT row_id, pos, link, lag(link) OVER (PARTITION BY row_id ORDER BY pos) AS found_on, CASE WHEN ends_with(link, '.torrent') OR contains(link, '.torrent?') THEN 10 WHEN pos = 0 THEN 9 ELSE 5 END AS priority FROM {_LINKS}")
def link_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each discovery page with the one before it and its priority."""
    link = F.col("link")
    l = table(spark, sf_dir, "torrent", "row_id", "disc").select("row_id", F.posexplode("disc").alias("pos", "link"), "disc")
    before = F.when(F.col("pos") > 0, F.get("disc", F.col("pos") - 1))
    return l.select("row_id", "pos", "link", before.alias("found_on"), F.when(link.endswith(".torrent") | link.contains(".torrent?"), 10).when(F.col("pos") == 0, 9).otherwise(5).alias("priority"))


@query("SELECT meta_id, nullif(upper(regexp_extract(infohash, '([0-9a-fA-F]{40})', 1)), '') AS digest, len(list_distinct(regexp_extract_all(infohash, '([0-9a-fA-F]{40})', 1))) AS n_digests FROM meta WHERE infohash IS NOT NULL")
def digest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("infohash", F.lit("([0-9a-fA-F]{40})"), F.lit(1))
    return table(spark, sf_dir, "meta", "meta_id", "infohash").where("infohash IS NOT NULL").select("meta_id", tx.infohash(F.col("infohash")).alias("digest"), F.size(F.array_distinct(found)).alias("n_digests"))


@query(r"""
SELECT meta_id, coalesce(NOT regexp_matches(url, '(?:/search|/find|/browse)') AND regexp_matches(lower(description), 'seed|peer|files')
       AND NOT regexp_matches(lower(description), '[0-9]+ (?:results|items) found')
       AND (len(list_distinct(regexp_extract_all(description, '(magnet:\?[^"\s<>]+)', 1))) = 1 OR len(list_distinct(regexp_extract_all(description, 'href="([^"]+\.torrent)"', 1))) = 1
            OR len(list_distinct(regexp_extract_all(' ' || infohash || ' ', '[^0-9A-Za-z_]([0-9a-fA-F]{40})[^0-9A-Za-z_]', 1))) = 1), false) AS is_detail_page FROM meta
""")
def detail_page_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages: no listing address, a required word, no hit count, and exactly one magnet, file link or digest."""
    low, one = F.lower("description"), lambda c, p: F.size(F.array_distinct(F.regexp_extract_all(c, F.lit(p), F.lit(1)))) == 1
    single = one(F.col("description"), r'(magnet:\?[^"\s<>]+)') | one(F.col("description"), r'href="([^"]+\.torrent)"') | one(F.concat(F.lit(" "), "infohash", F.lit(" ")), "[^0-9A-Za-z_]([0-9a-fA-F]{40})[^0-9A-Za-z_]")
    ok = ~F.col("url").rlike(LISTING) & low.rlike("seed|peer|files") & ~low.rlike("[0-9]+ (?:results|items) found") & single
    return table(spark, sf_dir, "meta", "meta_id", "url", "description", "infohash").select("meta_id", F.coalesce(ok, F.lit(False)).alias("is_detail_page"))


def _script_sql(col: str, soft: bool) -> str:
    marks = tx.SCRIPT_MARKS if soft else tx.SCRIPT_MARKS + tx.HARD_MARKS
    t = f"replace(lower({col}), ' ', '')"
    held = " OR ".join(f"contains({t}, '{m}')" for m in marks)
    ends = tx.SOFT_ENDS if soft else tx.SOFT_ENDS + tx.HARD_ENDS
    count = " + ".join(f"(len({t}) - len(replace({t}, '{e}' || chr(10), ''))) // 2" for e in ends)
    return f"coalesce({held} OR ({count}) > (len({t}) - len(replace({t}, chr(10), ''))) // 2, false)"


@query(f"SELECT doc_id, {_script_sql('text', False)} AS hard, {_script_sql('text', True)} AS soft FROM documents")
def script_like_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", tx.is_script(F.col("text")).alias("hard"), tx.is_script(F.col("text"), soft=True).alias("soft"))


_FORMS = " OR ".join("contains(description, '" + m.replace("'", "''") + "')" for m in tx.NO_DESCRIPTION)
_DESCRIPTION = f"coalesce(len(description) > 32 AND len(description) < 4096 AND NOT (contains(description, 'thank') AND len(description) < 50) AND NOT ({_FORMS}) AND NOT {_script_sql('description', True)}, false)"


@query(f"SELECT {_host('url')} AS site, arg_min(meta_id, row(-len(description), meta_id)) AS meta_id, max(len(description)) AS n_chars FROM meta WHERE {_DESCRIPTION} GROUP BY 1")
def description_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest acceptable description of each site; the smallest id where lengths tie."""
    ok = table(spark, sf_dir, "meta", "meta_id", "url", "description").where(tx.is_description(F.col("description")))
    n = F.length("description")
    return ok.groupBy(ur.host(F.col("url")).alias("site")).agg(F.min_by("meta_id", F.struct(-n, "meta_id")).alias("meta_id"), F.max(n).alias("n_chars"))


@query(r"""
WITH s AS (SELECT meta_id, lower(size) AS low, regexp_extract_all(lower(size), '([0-9]+(?:\.[0-9]+)?)', 1) AS n FROM meta WHERE size IS NOT NULL),
     p AS (SELECT *, CASE WHEN regexp_matches(low, '[0-9] ?ti?b') THEN 4 WHEN regexp_matches(low, '[0-9] ?gi?b') THEN 3 WHEN regexp_matches(low, '[0-9] ?mi?b') THEN 2 WHEN regexp_matches(low, '[0-9] ?ki?b') THEN 1 WHEN regexp_matches(low, '[0-9] ?b') THEN 0
                          WHEN contains(low, 'size') AND len(n) = 1 AND contains(n[1], '.') THEN 2 WHEN contains(low, 'size') THEN 0 END AS power FROM s)
SELECT meta_id, CASE WHEN len(n) = 1 THEN CAST(floor(TRY_CAST(n[1] AS DOUBLE) * pow(1024.0, power)) AS BIGINT) END AS bytes FROM p
""")
def size_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "meta", "meta_id", "size").where("size IS NOT NULL").select("meta_id", tx.page_size(F.col("size")).alias("bytes"))


@query("SELECT item_id, nullif(regexp_extract(filename, '(?i)s([0-9]+)e([0-9]+)', 1), '') AS season, nullif(regexp_extract(filename, '(?i)s([0-9]+)e([0-9]+)', 2), '') AS episode, CASE WHEN regexp_matches(filename, '(?i)s([0-9]+)e([0-9]+)') THEN 'TV' END AS category FROM torrents_item WHERE filename IS NOT NULL")
def season_episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    season, episode = tx.season_episode(F.col("filename"))
    return table(spark, sf_dir, "torrents_item", "item_id", "filename").where("filename IS NOT NULL").select("item_id", season.alias("season"), episode.alias("episode"), F.when(season.isNotNull(), F.lit("TV")).alias("category"))


_TITLE = "coalesce(len(w) > 0 AND (len(list_filter(w, lambda x: contains({t}, x))) = len(w) OR (len(w) > 5 AND len(list_filter(w, lambda x: contains({t}, x))) > len(w) * 0.7)), false)"


@query(f"""
SELECT meta_id, {_TITLE.format(t='tail')} AS is_title, {_TITLE.format(t='path')} AS is_title_of_path
FROM (SELECT meta_id, regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}_'']+') AS w, lower(string_split(url, '/')[-1]) AS tail, lower(array_to_string(string_split(url, '/')[4:], '/')) AS path FROM meta)
""")
def title_url_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the words of the title stand in the last part of the address, and in all of its path."""
    t, u = F.col("title"), F.col("url")
    return table(spark, sf_dir, "meta", "meta_id", "title", "url").select("meta_id", tx.is_title(t, u).alias("is_title"), tx.is_title(t, u, full=True).alias("is_title_of_path"))


def _phrase_sql(col: str, words, most: int) -> str:
    return f"coalesce(len(string_split({col}, ' ')) <= {most} AND len(list_filter({_list(words)}, lambda w: contains(' ' || lower({col}) || ' ', ' ' || w || ' '))) > 0, false)"


def _class_sql(col: str) -> str:
    return "CASE " + " ".join(f"WHEN lower({col}) IN ({_in(ws)}) THEN '{c}'" for c, ws in lx.CLASSES.items()) + " END"


def _first_sql(col: str, words) -> str:
    return f"list_filter({_list(words)}, lambda w: contains(lower({col}), w))[1]"


@query(f"""
SELECT meta_id, {_phrase_sql('category', lx.words('category'), 2)} AS is_category, {_first_sql('category', lx.words('category'))} AS found_category, {_phrase_sql('language', lx.words('language'), 2)} AS is_language,
       {_phrase_sql('quality', lx.words('quality'), 2)} AS is_quality, {_phrase_sql('genre', lx.words('genre'), 4)} AS is_genre, {_class_sql('genre')} AS word_class FROM meta
""")
def lexicon_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "meta", "meta_id", "category", "genre", "quality", "language").select(
        "meta_id", tx.is_category(c("category")).alias("is_category"), tx.extract_category(c("category")).alias("found_category"), tx.is_language(c("language")).alias("is_language"),
        tx.is_quality(c("quality")).alias("is_quality"), tx.is_genre(c("genre")).alias("is_genre"), tx.word_class(c("genre")).alias("word_class"),
    )


_WORDS = sorted({w for ws in lx.CLASSES.values() for w in ws})


@query(f"""
SELECT item_id, array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower(filename), '[^a-z0-9]+'), lambda w: len(w) > 2 AND list_contains({_list(_WORDS)}, w)))), ',') AS keywords FROM torrents_item WHERE filename IS NOT NULL
""")
def keyword_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "torrents_item", "item_id", "filename").where("filename IS NOT NULL").select("item_id", F.array_join(tx.keywords(F.col("filename")), ",").alias("keywords"))


@query(f"""
WITH w AS (SELECT item_id, i, string_split_regex(lower(filename), '[^a-z0-9]+')[i] AS word FROM torrents_item, unnest(range(1, len(string_split_regex(lower(filename), '[^a-z0-9]+')) + 1)) t(i)),
     c AS (SELECT item_id, word, min(i) AS i, {_class_sql('word')} AS word_class FROM w WHERE {_class_sql('word')} IS NOT NULL GROUP BY 1, 2)
SELECT item_id, word_class, string_agg(word, ',' ORDER BY i) AS words FROM c GROUP BY 1, 2
""")
def words_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each name the distinct words of each class, in their order."""
    words = F.array_distinct(F.split(F.lower("filename"), "[^a-z0-9]+"))
    w = table(spark, sf_dir, "torrents_item", "item_id", "filename").select("item_id", F.posexplode(words).alias("pos", "word")).withColumn("word_class", tx.word_class(F.col("word"))).where("word_class IS NOT NULL")
    # As few as the words of one name.
    return w.groupBy("item_id", "word_class").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("ws")).select("item_id", "word_class", F.array_join("ws.word", ",").alias("words"))


def _has_class_sql(col: str, prefix: str) -> str:
    held = [(n, ws) for n, ws in lx.CLASSES.items() if n.startswith(prefix)]
    return "CASE " + " ".join(f"WHEN len(list_filter({_list(ws)}, lambda w: contains(lower({col}), w))) > 0 THEN '{n}'" for n, ws in reversed(held)) + " END"


def _map_sql(pairs: dict, key: str) -> str:
    return "CASE " + key + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


@query(f"""
SELECT meta_id, coalesce({_map_sql(lx.SCHEMA_OF_CATEGORY, f"{_map_sql(lx.CATEGORY_OF_SUBCATEGORY, f'lower({_TRIM})')}")}, {_map_sql(lx.SCHEMA_OF_GENRE, _has_class_sql('genre', 'genre'))},
       {_map_sql(lx.SCHEMA_OF_QUALITY, _has_class_sql('quality', 'quality'))}, '{lx.DEFAULT_SCHEMA}') AS item_schema,
       {_map_sql(lx.CATEGORY_OF_SUBCATEGORY, f'lower({_TRIM})')} AS broad_category, {_map_sql(lx.CATEGORY_OF_GENRE, _has_class_sql("string_split(trim(genre, ' '), '|')[1]", 'genre'))} AS genre_category,
       CASE WHEN category IS NOT NULL THEN concat_ws(',', {', '.join(f"CASE WHEN contains(lower(category), '{w}') THEN '{t}' END" for w, t in lx.TAG_RULES)}) END AS tags FROM meta
""")
def schema_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    broad = tx.category_of_subcategory(c("category"))
    return table(spark, sf_dir, "meta", "meta_id", "category", "genre", "quality").select("meta_id", tx.schema_of(broad, c("genre"), c("quality")).alias("item_schema"), broad.alias("broad_category"), tx.category_of_genre(c("genre")).alias("genre_category"), tx.tags_of(c("category")).alias("tags"))


_SYN = " OR ".join(f"(a = '{k}' AND b IN ({_in(v)})) OR (b = '{k}' AND a IN ({_in(v)}))" for k, v in lx.SYNONYMS.items())


@query(f"""
WITH m AS (SELECT meta_id, lower({_TRIM}) AS a, {_map_sql(lx.CATEGORY_OF_GENRE, _has_class_sql("string_split(trim(genre, ' '), '|')[1]", 'genre'))} AS b FROM meta)
SELECT meta_id, coalesce(a, '') IN ('', 'other') OR coalesce(b, '') IN ('', 'other') OR coalesce(a = b OR {_SYN}, false) AS congruent FROM m
""")
def synonym_congruence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the category stated and the one that follows from the genre agree."""
    return table(spark, sf_dir, "meta", "meta_id", "category", "genre").select("meta_id", tx.is_synonym(F.col("category"), tx.category_of_genre(F.col("genre"))).alias("congruent"))


_STRIP = "description"
for _p, _t in tx.STRIPPING:
    _STRIP = f"regexp_replace({_STRIP}, '{_p}', '{_t}', 'g')"
for _p, _t in tx.ENTITIES:
    _STRIP = f"replace({_STRIP}, '{_p}', '{_t}')"


@query(f"SELECT meta_id, {_STRIP} AS plain FROM meta WHERE description IS NOT NULL")
def strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "meta", "meta_id", "description").where("description IS NOT NULL").select("meta_id", tx.strip_tags(F.col("description")).alias("plain"))


@query(r"""
SELECT d.doc_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:www\.)?([^/?#:]+)', 1) AS host, split_part(url, '#', 1) AS bare, string_split(url, '/')[4] AS section, len(string_split(url, '/')) AS n_segments,
       regexp_replace(split_part(url, '#', 1), '^[A-Za-z][A-Za-z0-9+.\-]*://', '') AS site_key, list_aggregate(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:www\.)?([^/?#:]+)', 1), '.')[-2:], 'string_agg', '.') AS domain,
       regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) || '/img/' || doc_id || '.png' AS image, regexp_matches(md5(text), '^[0-9a-fA-F]*$') AS is_hex FROM documents d
""")
def url_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "documents", "doc_id", "url", "text").select(
        "doc_id", ur.host(u).alias("host"), ur.without_fragment(u).alias("bare"), ur.segment(u, 3).alias("section"), ur.segment_count(u).alias("n_segments"), ur.site_key(u).alias("site_key"), ur.registered_domain(u).alias("domain"),
        ur.resolve(u, F.concat(F.lit("/img/"), "doc_id", F.lit(".png"))).alias("image"), ur.is_hex(F.md5("text")).alias("is_hex"),
    )


# Text of a description as positioned tokens, one to a line of its stripped text.
_TOKENS = f"(SELECT meta_id, {_host('url')} AS site, list_filter(string_split({_STRIP}, chr(10)), lambda x: x <> '') AS tokens FROM meta WHERE description IS NOT NULL)"


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "meta", "meta_id", "url", "description").where("description IS NOT NULL")
    return rows.select("meta_id", ur.host(F.col("url")).alias("site"), F.filter(F.split(tx.strip_tags(F.col("description")), "\n"), lambda x: x != "").alias("tokens"))


@query(f"SELECT meta_id, CAST(i AS INTEGER) - 1 AS pos, tokens[i] AS token FROM {_TOKENS}, unnest(range(1, len(tokens) + 1)) t(i)")
def page_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens(spark, sf_dir).select("meta_id", F.posexplode("tokens").alias("pos", "token"))


_TEMPLATE = f"""
p AS {_TOKENS}, b AS (SELECT site, arg_min(tokens, meta_id) AS base FROM p GROUP BY 1),
tpl AS (SELECT site, CAST(i AS INTEGER) - 1 AS pos, count_if(p.tokens[i] IS DISTINCT FROM base[i]) AS n_differ, count_if(p.tokens[i] IS DISTINCT FROM base[i]) >= 2 AS is_variable
        FROM p JOIN b USING (site), unnest(range(1, len(base) + 1)) t(i) GROUP BY 1, 2)
"""


@query(f"WITH {_TEMPLATE} SELECT * FROM tpl")
def template_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token positions that vary between the pages of a site."""
    return votes.template_positions(checkpoint(_tokens(spark, sf_dir)), "site", "meta_id", "tokens")


# Metadata of items as positioned tokens: key and value of each part in turn. A page is an item, its site the source with
# the keys that it states, as other items of the source have other templates.
_PAIRS = r"""(SELECT item_id AS meta_id, source_id || regexp_replace(meta, '=[^\t]*', '', 'g') AS site, list_filter(string_split_regex(regexp_replace(meta, '(^|\t)[^:\t]*:', '\1', 'g'), '[\t=]'), lambda x: x <> '') AS tokens FROM torrents_item WHERE meta IS NOT NULL AND source_id IS NOT NULL)"""


@query(f"""
WITH {_TEMPLATE.replace(_TOKENS, _PAIRS)}, t AS (SELECT meta_id, site, CAST(i AS INTEGER) - 1 AS pos, tokens[i] AS token FROM p, unnest(range(1, len(tokens) + 1)) t(i)),
w AS (SELECT t.*, is_variable, lag(token) OVER o AS label, lag(is_variable) OVER o AS before FROM t JOIN tpl USING (site, pos) WINDOW o AS (PARTITION BY meta_id ORDER BY pos))
SELECT meta_id AS item_id, pos, lower(replace(label, ':', '')) AS label, token AS value FROM w
WHERE is_variable AND NOT before AND len(label) > 2 AND len(label) < 20 AND NOT regexp_matches(label, '^[0-9.]+$') AND len(label) - len(replace(label, ' ', '')) < 2
""")
def label_value_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A variable token right after a constant one is a value, and the constant one its label."""
    t = table(spark, sf_dir, "torrents_item", "item_id", F.concat(F.col("source_id").cast("string"), F.regexp_replace("meta", r"=[^\t]*", "")).alias("site"), "meta").where("site IS NOT NULL")
    tokens = F.filter(F.split(F.regexp_replace("meta", r"(^|\t)[^:\t]*:", "$1"), r"[\t=]"), lambda x: x != "")
    # Read twice below, so the tokens are made once.
    pages = checkpoint(t.select("item_id", "site", tokens.alias("tokens")))
    # One row for each position of each site: counted before it is broadcast.
    learned = small_side(votes.template_positions(pages, "site", "item_id", "tokens").select("site", "pos", "is_variable"))
    rows = pages.select("item_id", "site", F.posexplode("tokens").alias("pos", "token"), "tokens").withColumn("label", F.when(F.col("pos") > 0, F.get("tokens", F.col("pos") - 1))).drop("tokens")
    before = learned.select("site", (F.col("pos") + 1).alias("pos"), F.col("is_variable").alias("before"))
    rows = rows.join(learned, ["site", "pos"]).join(before, ["site", "pos"])
    n = F.length("label")
    ok = F.col("is_variable") & ~F.col("before") & (n > 2) & (n < 20) & ~F.col("label").rlike("^[0-9.]+$") & (n - F.length(F.replace("label", F.lit(" "), F.lit(""))) < 2)
    return rows.where(ok).select("item_id", "pos", F.lower(F.replace("label", F.lit(":"), F.lit(""))).alias("label"), F.col("token").alias("value"))


_ENDING = "please seed|thanks to|short answer"


@query(f"""
WITH t AS (SELECT meta_id, CAST(i AS INTEGER) - 1 AS pos, len(tokens) AS n, tokens[i] AS token FROM {_TOKENS}, unnest(range(1, len(tokens) + 1)) t(i)),
g AS (SELECT *, max((len(token) > 5)::INT) OVER o AS started, max((regexp_matches(lower(token), '{_ENDING}') AND pos * 10 > n * 4 OR pos * 4 > n * 3)::INT) OVER o AS stopped,
             max(regexp_matches(lower(token), '{_ENDING}')::INT) OVER o AS no_tags, lag(contains(lower(token), 'description')) OVER (PARTITION BY meta_id ORDER BY pos) AS next_is
      FROM t WINDOW o AS (PARTITION BY meta_id ORDER BY pos ROWS UNBOUNDED PRECEDING))
SELECT meta_id, pos, token, no_tags = 0 AS may_tag, coalesce(next_is, false) AS after_label FROM g WHERE started = 1 AND stopped = 0
""")
def scan_gate_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens from the first long one up to an ending word after 40 % or to 75 % of the page."""
    o = Window.partitionBy("meta_id").orderBy("pos")
    so_far = o.rowsBetween(Window.unboundedPreceding, 0)
    t = _tokens(spark, sf_dir).select("meta_id", F.size("tokens").alias("n"), F.posexplode("tokens").alias("pos", "token"))
    ending = F.lower("token").rlike(_ENDING)
    stop = ending & (F.col("pos") * 10 > F.col("n") * 4) | (F.col("pos") * 4 > F.col("n") * 3)
    g = t.select("meta_id", "pos", "token", F.max(F.length("token") > 5).over(so_far).alias("started"), F.max(stop).over(so_far).alias("stopped"), F.max(ending).over(so_far).alias("no_tags"), F.lag(F.lower("token").contains("description")).over(o).alias("next_is"))
    return g.where("started AND NOT stopped").select("meta_id", "pos", "token", (~F.col("no_tags")).alias("may_tag"), F.coalesce("next_is", F.lit(False)).alias("after_label"))


@query(f"""
WITH t AS (SELECT meta_id, tokens, list_filter(range(1, len(tokens) + 1), lambda i: len(tokens[i]) BETWEEN 33 AND 4095) AS ok FROM {_TOKENS})
SELECT meta_id, arg_max(tokens[i], row(len(tokens[i]), -i)) AS longest, min(i) - 1 AS first_pos FROM t, unnest(ok) u(i) GROUP BY 1
""")
def longest_and_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each page the longest acceptable token, the earlier where lengths tie, and the first one's position."""
    t = _tokens(spark, sf_dir).select("meta_id", F.posexplode("tokens").alias("pos", "token")).where(F.length("token").between(33, 4095))
    return t.groupBy("meta_id").agg(F.max_by("token", F.struct(F.length("token"), -F.col("pos"))).alias("longest"), F.min("pos").cast("long").alias("first_pos"))


# Votes: each page of a site votes, for each field it has, for the shape of its address.
_BALLOTS = " UNION ALL ".join(f"SELECT {_host('url')} AS site, '{f}' AS field, len(string_split(url, '/')) || ':' || substr(coalesce(string_split(url, '/')[4], ''), 1, 4) AS path FROM meta WHERE {f} IS NOT NULL" for f in ("category", "genre", "quality", "language"))


def _ballots(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("category", "genre", "quality", "language")
    u = F.col("url")
    path = F.concat_ws(":", ur.segment_count(u).cast("string"), F.substring(F.coalesce(ur.segment(u, 3), F.lit("")), 1, 4))
    wide = table(spark, sf_dir, "meta", "url", *fields)
    named = F.filter(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return wide.select(ur.host(u).alias("site"), F.explode(named).alias("field"), path.alias("path"))


@query(f"""
WITH v AS (SELECT site, field, path, count(*) AS votes FROM ({_BALLOTS}) GROUP BY 1, 2, 3),
     k AS (SELECT *, max(votes) OVER (PARTITION BY site, field) > sum(votes) OVER (PARTITION BY site, field) // 3 AS strong FROM v)
SELECT site, field, path, votes, row_number() OVER (PARTITION BY site, field ORDER BY votes DESC, path) AS place FROM k WHERE strong
""")
def path_votes_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes of each field's paths, best first, without fields in which no path has over a third of them."""
    strong = votes.prune_weak(votes.votes(_ballots(spark, sf_dir), "site", "field", "path"), ["site", "field"])
    return strong.withColumn("place", F.row_number().over(Window.partitionBy("site", "field").orderBy(F.desc("votes"), "path")))


@query(f"""
WITH v AS (SELECT site, field, path, count(*) AS votes FROM ({_BALLOTS}) GROUP BY 1, 2, 3 HAVING count(*) > 1)
SELECT *, votes > bar AS trusted FROM (SELECT *, sum(votes) OVER (PARTITION BY site, field) * CAST(0.3 AS DOUBLE) AS bar FROM v)
""")
def path_trust_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.trust_bar(votes.votes(_ballots(spark, sf_dir), "site", "field", "path"), ["site", "field"])


@query(f"""
WITH v AS (SELECT site, field, path, count(*) AS votes FROM ({_BALLOTS}) GROUP BY 1, 2, 3)
SELECT site, field, path, votes FROM (SELECT *, row_number() OVER (PARTITION BY site, field ORDER BY votes, path) AS r FROM v) WHERE NOT (r = 1 AND votes < 40)
""")
def least_voted_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each field's paths without the least voted one, if that has fewer than 40 votes."""
    r = F.row_number().over(Window.partitionBy("site", "field").orderBy("votes", "path"))
    return votes.votes(_ballots(spark, sf_dir), "site", "field", "path").withColumn("r", r).where(~((F.col("r") == 1) & (F.col("votes") < 40))).drop("r")


_NORM = f"SELECT meta_id, {_host('url')} AS site, category, url FROM meta"


@query(f"""
WITH m AS ({_NORM}), n AS (SELECT site, count(*) AS pages FROM m GROUP BY 1), v AS (SELECT site, category, count(*) AS votes FROM m WHERE {_phrase_sql('category', lx.words('category'), 2)} GROUP BY 1, 2)
SELECT site, category, votes, votes > pages * 0.6 AS replaces, sum(votes) OVER (PARTITION BY site) > pages // 3 AS enough FROM v JOIN n USING (site)
""")
def category_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes of the categories of each site: which replace all others, and whether there are enough."""
    m = table(spark, sf_dir, "meta", "url", "category").withColumn("site", ur.host(F.col("url")))
    pages = m.groupBy("site").agg(F.count("*").alias("pages"))
    v = votes.votes(m.where(tx.is_category(F.col("category"))), "site", "category").join(pages, "site")
    return v.select("site", "category", "votes", (F.col("votes") > F.col("pages") * 0.6).alias("replaces"), (F.sum("votes").over(Window.partitionBy("site")) > F.expr("pages div 3")).alias("enough"))


#: Words of an address that say what kind of page it is.
SECTIONS = ("torrent", "get", "details", "view")


@query(f"""
WITH s AS (SELECT meta_id, i - 1 AS pos, string_split(url, '/')[i] AS part FROM meta, unnest(range(4, len(string_split(url, '/')) + 1)) t(i)),
     c AS (SELECT meta_id, pos, {_first_sql('part', SECTIONS)} AS category FROM s WHERE {_first_sql('part', SECTIONS)} IS NOT NULL)
SELECT meta_id, '@url[' || max(pos) || ']' AS path, arg_max(category, pos) AS category FROM c GROUP BY 1
""")
def url_segment_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last segment of an address that names its section, as a path and as the section."""
    found = F.filter(F.transform(F.split("url", "/"), lambda part, i: F.struct(i.alias("pos"), tx.first_contained(part, SECTIONS).alias("category"))), lambda x: (x["pos"] > 2) & x["category"].isNotNull())
    last = table(spark, sf_dir, "meta", "meta_id", "url").select("meta_id", F.try_element_at(found, F.lit(-1)).alias("x")).where("x IS NOT NULL")
    return last.select("meta_id", F.concat(F.lit("@url["), F.col("x.pos").cast("string"), F.lit("]")).alias("path"), "x.category")


@query(f"""
WITH m AS (SELECT meta_id, {_host('url')} AS site, string_split(regexp_replace(description, ' (?:>|») ', chr(1), 'g'), chr(1)) AS crumbs FROM meta WHERE regexp_matches(description, ' (?:->|>|») ')),
     n AS (SELECT site, count(*) AS pages FROM m GROUP BY 1), c AS (SELECT site, meta_id, i - 1 AS pos, lag(crumbs[i]) OVER (PARTITION BY meta_id ORDER BY i) AS before FROM m, unnest(range(1, len(crumbs) + 1)) t(i))
SELECT site, pos, count(*) AS votes, count(*) > 0.75 * any_value(pages) AS accepted FROM c JOIN n USING (site) WHERE before IS NOT NULL GROUP BY 1, 2
""")
def breadcrumb_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions after a breadcrumb sign, accepted if over three quarters of a site's pages have them."""
    m = table(spark, sf_dir, "meta", "meta_id", "url", "description").where(F.col("description").rlike(" (?:->|>|») "))
    m = m.select("meta_id", ur.host(F.col("url")).alias("site"), F.split("description", " (?:>|») ").alias("crumbs"))
    pages = m.groupBy("site").agg(F.count("*").alias("pages"))
    c = m.select("site", "meta_id", F.posexplode("crumbs").alias("pos", "crumb")).withColumn("before", F.lag("crumb").over(Window.partitionBy("meta_id").orderBy("pos"))).where("before IS NOT NULL")
    v = c.groupBy("site", F.col("pos").cast("long").alias("pos")).agg(F.count("*").alias("votes")).join(pages, "site")
    return v.select("site", "pos", "votes", (F.col("votes") > F.col("pages") * 0.75).alias("accepted"))


_IMGS = f"(SELECT meta_id, {_host('url')} AS site, unnest(list_distinct(regexp_extract_all(description, 'src=\"([^\"]+)\"', 1))) AS src FROM meta WHERE description IS NOT NULL)"


@query(f"""
WITH i AS {_IMGS}, n AS (SELECT site, count(DISTINCT meta_id) AS pages FROM i GROUP BY 1), c AS (SELECT site, src, count(*) AS n_src FROM i GROUP BY 1, 2),
     k AS (SELECT i.* FROM i JOIN c USING (site, src) JOIN n USING (site) WHERE n_src <= greatest(pages // 2, 1) AND NOT contains(src, 'logo')),
     v AS (SELECT site, regexp_extract(src, '^[a-z]+://([^/]+)', 1) AS place, count(*) AS votes FROM k GROUP BY 1, 2)
SELECT site, arg_min(place, row(-votes, place)) AS place, max(votes) AS votes FROM v GROUP BY 1
""")
def best_image_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a site's images come from: pictures on over half the pages and logos do not count."""
    m = table(spark, sf_dir, "meta", "meta_id", "url", "description").where("description IS NOT NULL")
    i = m.select("meta_id", ur.host(F.col("url")).alias("site"), F.explode(F.array_distinct(F.regexp_extract_all("description", F.lit('src="([^"]+)"'), F.lit(1)))).alias("src"))
    pages, c = i.groupBy("site").agg(F.countDistinct("meta_id").alias("pages")), i.groupBy("site", "src").agg(F.count("*").alias("n_src"))
    kept = i.join(c, ["site", "src"]).join(pages, "site").where(F.expr("n_src <= greatest(pages div 2, 1)") & ~F.col("src").contains("logo"))
    v = votes.votes(kept.withColumn("place", F.regexp_extract("src", "^[a-z]+://([^/]+)", 1)), "site", "place")
    return v.groupBy("site").agg(F.min_by("place", F.struct(-F.col("votes"), "place")).alias("place"), F.max("votes").alias("votes"))


@query("SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_acctbal > 0 AND s_acctbal > 0 AND c_acctbal / s_acctbal BETWEEN 0.99 AND 1.01")
def near_match_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of balances within 1 % of each other."""
    return matching.near_join(table(spark, sf_dir, "customer", "c_custkey", "c_acctbal"), table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal"), "c_acctbal", "s_acctbal").select("c_custkey", "s_suppkey")


@query(r"""
WITH j AS (SELECT m.meta_id, i.info_id, m.infohash AS a, i.infohash AS b, list_filter(string_split_regex(lower(m.title), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w, lower(i.filedir) AS d FROM meta m JOIN torrent_info i USING (item_id))
SELECT meta_id, info_id, coalesce(lower(a) = lower(b), true) AND coalesce(len(list_filter(w, lambda x: contains(d, x))) >= ceil(len(w) / 2), true) AS same_item FROM j
""")
def page_file_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a page and a file of one item agree in digest and title, as far as both state them, as its SQL has it; sized_page_file_agreement compares sizes too."""
    m, i = table(spark, sf_dir, "meta", "item_id", "meta_id", F.col("infohash").alias("a"), "title"), table(spark, sf_dir, "torrent_info", "item_id", "info_id", F.col("infohash").alias("b"), "filedir")
    none = F.lit(None).cast("double")
    return m.join(i, "item_id").select("meta_id", "info_id", matching.same_item(none, none, F.col("a"), F.col("b"), F.col("title"), F.col("filedir")).alias("same_item"))


@query(r"""
WITH j AS (SELECT m.meta_id, i.info_id, m.infohash AS a, i.infohash AS b, list_filter(string_split_regex(lower(m.title), '[^\p{L}\p{N}]+'), lambda w: len(w) > 3) AS w, array_to_string(list_filter(string_split_regex(lower(i.filedir), '[^\p{L}\p{N}]+'), lambda w: len(w) > 3), ' ') AS d, i.filedir IS NOT NULL AS filed,
                  CASE WHEN regexp_full_match(m.size, '[0-9]{1,15}') THEN m.size::DOUBLE END AS s, CASE WHEN regexp_full_match(i.filesizes, '[0-9]{1,15}') THEN i.filesizes::DOUBLE END AS t FROM meta m JOIN torrent_info i USING (item_id))
SELECT meta_id, info_id, coalesce(s / t BETWEEN 0.99 AND 1.01, true) AND coalesce(lower(a) = lower(b), true) AND coalesce(CASE WHEN filed THEN len(list_filter(w, lambda x: contains(d, x))) >= len(w) // 2 END, true) AS by_words,
       coalesce(s / t BETWEEN 1 AND 1, true) AND coalesce(lower(a) = lower(b), true) AS by_size FROM j
""")
def spider_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a page and a file agree as single sites are compared (long words, half rounded down) and as many at once are (size to the byte)."""
    plain = lambda c: F.when(F.col(c).rlike("^[0-9]{1,15}$"), F.col(c).try_cast("double"))
    m = table(spark, sf_dir, "meta", "item_id", "meta_id", F.col("infohash").alias("a"), "title", plain("size").alias("s"))
    i = table(spark, sf_dir, "torrent_info", "item_id", "info_id", F.col("infohash").alias("b"), "filedir", plain("filesizes").alias("t"))
    c, none = F.col, F.lit(None).cast("string")
    by_words = matching.same_item(c("s"), c("t"), c("a"), c("b"), F.when(c("filedir").isNotNull(), c("title")), c("filedir"), longer=3, whole_halves=True)
    return m.join(i, "item_id").select("meta_id", "info_id", by_words.alias("by_words"), matching.same_item(c("s"), c("t"), c("a"), c("b"), none, none, tolerance=0.0).alias("by_size"))


def agreement(pages: DataFrame, info: DataFrame) -> DataFrame:
    """meta_id, info_id and same_item: whether a page and a file of one item agree in size, digest and title, as far as both state them.

    A file's size is the sum of its sizes; of what the page's size can mean, the nearest counts.
    """
    m = pages.select("item_id", "meta_id", F.col("infohash").alias("a"), "title", quantities.size_readings(F.col("size"), F.lit("B")).alias("readings"))
    # A file of no bytes states no size.
    total = totals(info).select("info_id", F.when(F.col("total") > 0, F.col("total").cast("double")).alias("total"))
    i = info.select("item_id", "info_id", F.col("infohash").alias("b"), "filedir").where("item_id IS NOT NULL").join(total, "info_id")
    size = F.when(F.col("total").isNotNull(), quantities.residual(F.col("readings"), F.array("total"))["a"])
    # same_item takes a missing second title for one that holds no word.
    title = F.when(F.col("filedir").isNotNull(), F.col("title"))
    return m.join(i, "item_id").select("meta_id", "info_id", matching.same_item(size, F.col("total"), F.col("a"), F.col("b"), title, F.col("filedir")).alias("same_item"))


@query()
def sized_page_file_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a page and a file of one item agree in size, digest and title, as far as both state them."""
    m = table(spark, sf_dir, "meta", "item_id", "meta_id", "infohash", "title", "size").where("item_id IS NOT NULL")
    return agreement(m, table(spark, sf_dir, "torrent_info", "item_id", "info_id", "infohash", "filedir", "filesizes", "trackers"))


@query("SELECT t.item_id, i.info_id FROM (SELECT item_id, upper(regexp_extract(meta, 'infohash=([0-9a-fA-F]{40})', 1)) AS h FROM torrents_item) t JOIN torrent_info i ON t.h = upper(i.infohash) WHERE t.h <> ''")
def digest_equality_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and files with one digest, which items state among their metadata."""
    t = table(spark, sf_dir, "torrents_item", "item_id", F.upper(F.regexp_extract("meta", "infohash=([0-9a-fA-F]{40})", 1)).alias("h")).where("h != ''")
    return t.join(table(spark, sf_dir, "torrent_info", "info_id", F.upper("infohash").alias("h")), "h").select("item_id", "info_id")


@query(f"""
SELECT meta_id, {_host('url')} AS host, coalesce(s._id, -1) AS source_id, coalesce(s.crbl, 0) = 0 AS may_crawl FROM meta LEFT JOIN sources s ON {_host('url')} = s.d
""")
def source_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of each page's host, with a default for unknown ones, and whether it is blocked."""
    s = table(spark, sf_dir, "sources", F.col("_id").alias("sid"), F.col("d").alias("host"), "crbl")
    m = table(spark, sf_dir, "meta", "meta_id", ur.host(F.col("url")).alias("host"))
    return m.join(s, "host", "left").select("meta_id", "host", F.coalesce("sid", F.lit(-1)).alias("source_id"), (F.coalesce("crbl", F.lit(0)) == 0).alias("may_crawl"))


_TRACKER = r"^[A-Za-z]+://([^/:|;, \"]+)"


@query(f"""
WITH h AS (SELECT DISTINCT regexp_extract(trackers, '{_TRACKER}', 1) AS d FROM torrent_info WHERE trackers IS NOT NULL), n AS (SELECT d FROM h WHERE d <> '' AND d NOT IN (SELECT d FROM sources WHERE d IS NOT NULL))
SELECT d, (SELECT max(_id) FROM sources) + row_number() OVER (ORDER BY d) AS source_id FROM n
""")
def new_source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of tracker hosts that are no source yet, from the largest id on, in one job."""
    known = table(spark, sf_dir, "sources", "d", "_id")
    hosts = table(spark, sf_dir, "torrent_info", F.regexp_extract("trackers", _TRACKER, 1).alias("d")).where("d != ''").distinct()
    top = known.agg(F.max("_id").alias("top"))  # one row
    return ranking.numbered(hosts.join(known.select("d"), "d", "left_anti"), "d").crossJoin(F.broadcast(top)).select("d", (F.col("top") + F.col("n")).alias("source_id"))


@query(f"SELECT d FROM sources WHERE d IS NOT NULL UNION SELECT DISTINCT regexp_extract(trackers, '{_TRACKER}', 1) FROM torrent_info WHERE regexp_matches(trackers, '{_TRACKER}')")
def insert_missing_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known hosts, and tracker hosts that were missing among them."""
    offered = table(spark, sf_dir, "torrent_info", F.regexp_extract("trackers", _TRACKER, 1).alias("d")).where("d != ''")
    return state.insert_missing(table(spark, sf_dir, "sources", "d").where("d IS NOT NULL"), offered, ["d"])


@query("""
WITH o AS (SELECT user_id, event_type, arg_min(props, row(ts, event_id)) AS v FROM events GROUP BY 1, 2), n AS (SELECT user_id, event_type, arg_max(props, row(ts, event_id)) AS v FROM events WHERE value > 0 GROUP BY 1, 2)
SELECT user_id, event_type, o.v AS old_value, n.v AS new_value FROM o LEFT JOIN n USING (user_id, event_type) WHERE lower(trim(o.v, ' ')) IS DISTINCT FROM lower(trim(n.v, ' '))
""")
def snapshot_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First values of each key that the latest good ones lack or have otherwise."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    first = e.groupBy("user_id", "event_type").agg(F.min_by("props", F.struct("ts", "event_id")).alias("v"))
    latest = e.where("value > 0").groupBy("user_id", "event_type").agg(F.max_by("props", F.struct("ts", "event_id")).alias("v"))
    return state.mismatches(first, latest, ["user_id", "event_type"], "v")


@query("SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n_seen, floor(epoch(max(ts))) - floor(epoch(min(ts))) > 1800 AS promoted FROM events WHERE ts IS NOT NULL GROUP BY 1")
def first_last_seen_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.first_last_seen(table(spark, sf_dir, "events", "user_id", "ts"), "user_id", "ts")


@query("SELECT time_bucket(INTERVAL 60 minutes, ts) AS hour, event_type, count(*) AS n_lines, count_if(value < 0) AS n_errors FROM events GROUP BY 1, 2")
def hourly_rotation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and errors of each hour's file."""
    e = table(spark, sf_dir, "events", "ts", "event_type", "value")
    return e.groupBy(F.window("ts", "60 minutes").alias("w"), "event_type").agg(F.count("*").alias("n_lines"), F.count_if(F.col("value") < 0).alias("n_errors")).select(F.col("w.start").alias("hour"), "event_type", "n_lines", "n_errors")


@query(f"""
WITH m AS (SELECT {_host('url')} AS site, category, language, season FROM meta)
SELECT site, count(DISTINCT category) > 1 OR count(category) < 2 AS category_ok, count(DISTINCT language) > 1 OR count(language) < 2 AS language_ok, count(DISTINCT season) > 1 OR count(season) < 2 AS season_ok FROM m GROUP BY 1
""")
def constant_field_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that never vary on a site are not learned."""
    m = table(spark, sf_dir, "meta", ur.host(F.col("url")).alias("site"), "category", "language", "season")
    return m.groupBy("site").agg(*[((F.countDistinct(c) > 1) | (F.count(c) < 2)).alias(f"{c}_ok") for c in ("category", "language", "season")])


@query(f"""
WITH l AS (SELECT row_id, pos, link, ends_with(link, '.torrent') OR contains(link, '.torrent?') AS is_file FROM {_LINKS}),
     f AS (SELECT *, CASE WHEN is_file THEN 10 WHEN pos = 0 THEN 9 ELSE 5 END AS priority FROM l), s AS (SELECT *, row_number() OVER (PARTITION BY {_host('link')} ORDER BY priority DESC, link, row_id, pos) AS r FROM f)
SELECT row_id, pos, link, priority, CAST(CASE WHEN r <= 20 THEN (r - 1) % 4 ELSE row_id % 4 END AS INTEGER) AS lane FROM s WHERE r <= 20 OR is_file
""")
def frontier_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty links of each site by priority, dealt out to four lanes in turn, and all other file links, by their row."""
    link = F.col("link")
    f = _links(spark, sf_dir).withColumn("is_file", link.endswith(".torrent") | link.contains(".torrent?"))
    f = f.withColumn("priority", F.when(F.col("is_file"), 10).when(F.col("pos") == 0, 9).otherwise(5)).withColumn("site", ur.host(link))
    first = ranking.top_k(f, "site", [F.desc("priority"), "link", "row_id", "pos"], 20)
    first = first.select("row_id", "pos", "link", "priority", ((F.col("place") - 1) % 4).cast("int").alias("lane"))
    # The links that must be kept need no place: they are the rest of a plain filter.
    rest = f.where("is_file").join(first.select("row_id", "pos"), ["row_id", "pos"], "left_anti")
    return first.unionByName(rest.select("row_id", "pos", "link", "priority", (F.col("row_id") % 4).cast("int").alias("lane")))


@query(f"""
WITH l AS (SELECT row_id, link, contains(link, '.torrent') AS is_file FROM {_LINKS}), d AS (SELECT url FROM documents), m AS (SELECT url FROM meta),
     one AS (SELECT row_id, min(link) AS link FROM l WHERE is_file GROUP BY 1)
SELECT 'rest' AS part, row_id, link FROM (SELECT row_id, link FROM l EXCEPT SELECT row_id, link FROM l WHERE is_file) UNION ALL SELECT 'first file', row_id, link FROM one
UNION ALL SELECT 'pages', NULL, url FROM (SELECT url FROM d UNION SELECT url FROM m) UNION ALL SELECT 'both', NULL, url FROM (SELECT url FROM d INTERSECT SELECT url FROM m)
""")
def link_set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links without files, the first file of each page, and union and intersection of pages."""
    l = _links(spark, sf_dir).select("row_id", "link", F.col("link").contains(".torrent").alias("is_file"))
    files = l.where("is_file").select("row_id", "link")
    rest = l.select("row_id", "link").subtract(files).select(F.lit("rest").alias("part"), "row_id", "link")
    first = files.groupBy("row_id").agg(F.min("link").alias("link")).select(F.lit("first file").alias("part"), "row_id", "link")
    d, m = table(spark, sf_dir, "documents", "url"), table(spark, sf_dir, "meta", "url")
    named = lambda df, part: df.select(F.lit(part).alias("part"), F.lit(None).cast("long").alias("row_id"), F.col("url").alias("link"))
    return rest.unionByName(first).unionByName(named(d.union(m).distinct(), "pages")).unionByName(named(d.intersect(m), "both"))


@query(f"""
WITH want AS (SELECT replace(d, '.', '_') AS name FROM sources WHERE coalesce(crbl, 0) = 0), run AS (SELECT DISTINCT replace(_id, '.', '_') AS name, ok FROM torrents_domain WHERE _id IS NOT NULL)
SELECT 'start' AS what, name FROM want WHERE name NOT IN (SELECT name FROM run) UNION ALL SELECT DISTINCT 'stop', name FROM run r WHERE name IN (SELECT name FROM run WHERE NOT ok) AND name NOT IN (SELECT name FROM run WHERE ok)
""")
def anti_semi_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites to start because they do not run, and to stop because none of their visits was good."""
    want = table(spark, sf_dir, "sources", "d", "crbl").where(F.coalesce("crbl", F.lit(0)) == 0).select(F.replace("d", F.lit("."), F.lit("_")).alias("name"))
    run = table(spark, sf_dir, "torrents_domain", F.replace(F.col("_id"), F.lit("."), F.lit("_")).alias("name"), "ok").where("name IS NOT NULL")
    start = want.join(run.select("name").distinct(), "name", "left_anti").select(F.lit("start").alias("what"), "name")
    bad = run.join(run.where("NOT ok"), "name", "left_semi").join(run.where("ok").select("name"), "name", "left_anti")
    return start.unionByName(bad.select(F.lit("stop").alias("what"), "name").distinct())


@query("""
WITH c AS (SELECT user_id, event_type, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1),
     n AS (SELECT user_id, event_type, arg_max(props, row(ts, event_id)) AS props FROM events WHERE value > 0 GROUP BY 1, 2)
SELECT user_id, event_type, CASE WHEN n.user_id IS NOT NULL THEN n.props ELSE c.props END AS props FROM c LEFT JOIN n USING (user_id, event_type)
""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first value of each key, with the latest good one put in its place."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    first = e.groupBy("user_id", "event_type").agg(F.min_by(F.struct("ts", "event_id", "props"), F.struct("ts", "event_id")).alias("x")).select("user_id", "event_type", "x.ts", "x.event_id", "x.props")
    new = e.where("value > 0").select("user_id", "event_type", "ts", "event_id", "props")
    return state.upsert(first, new, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "props")


@query("SELECT _id, count_if(NOT coalesce(ok, false)) AS fail_count, array_to_string(list_sort(list(DISTINCT crawler_id) FILTER (crawler_id IS NOT NULL)), ',') AS crawlers FROM torrents_domain WHERE _id IS NOT NULL GROUP BY 1")
def counters_and_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures counted and crawlers collected for each site."""
    t = table(spark, sf_dir, "torrents_domain", "_id", "ok", "crawler_id").where("_id IS NOT NULL")
    sets = state.set_add(t, "_id", "crawler_id").select("_id", F.array_join(F.col("values").cast("array<string>"), ",").alias("crawlers"))
    return t.groupBy("_id").agg(F.count_if(~F.coalesce("ok", F.lit(False))).alias("fail_count")).join(sets, "_id", "left")


@query("""
WITH v AS (SELECT _id, visit_id, coalesce(ok, false) AS ok FROM torrents_domain WHERE _id IS NOT NULL), s AS (SELECT *, sum(ok::INT) OVER (PARTITION BY _id ORDER BY visit_id) AS run FROM v),
     f AS (SELECT *, sum((NOT ok)::INT) OVER (PARTITION BY _id, run ORDER BY visit_id) AS failures FROM s)
SELECT _id, visit_id, ok, failures FROM (SELECT *, max((failures > 3)::INT) OVER (PARTITION BY _id ORDER BY visit_id) AS cut FROM f) WHERE cut = 0
""")
def failure_run_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits of a site up to its fourth failure in a row."""
    v = table(spark, sf_dir, "torrents_domain", "_id", "visit_id", "ok").where("_id IS NOT NULL").withColumn("ok", F.coalesce("ok", F.lit(False)))
    return state.failure_cut(v, "_id", "visit_id", "ok", 3)


@query(r"""
SELECT item_id, concat_ws(chr(9), '88 - ' || strftime(ingested_at, '%d-%m-%Y %H:%M:%S'), regexp_replace(coalesce(filename, ''), '[\t\n\r\f\v]', ' ', 'g'), coalesce(size, ''), coalesce(origins, ''), coalesce(item_schema, ''), coalesce(meta, '')) AS line
FROM torrents_item WHERE error_type IS NULL
UNION ALL SELECT item_id, concat_ws(chr(9), '*88 - ' || strftime(ingested_at, '%d-%m-%Y %H:%M:%S'), coalesce(origins, ''), error_type) FROM torrents_item WHERE error_type IS NOT NULL
""")
def item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered rows: six fields of an item, three of an error."""
    t = table(spark, sf_dir, "torrents_item", "item_id", "filename", "size", "origins", "item_schema", "meta", "error_type", "ingested_at")
    c, stamp = lambda x: F.coalesce(x, F.lit("")), F.date_format("ingested_at", "dd-MM-yyyy HH:mm:ss")
    good = F.concat_ws("\t", F.concat(F.lit("88 - "), stamp), ur.squeezed(c("filename")), c("size"), c("origins"), c("item_schema"), c("meta"))
    bad = F.concat_ws("\t", F.concat(F.lit("*88 - "), stamp), c("origins"), "error_type")
    return t.select("item_id", F.when(F.col("error_type").isNull(), good).otherwise(bad).alias("line"))


@query(r"""
WITH p AS (SELECT item_id, unnest(string_split(meta, chr(9))) AS kv FROM torrents_item WHERE meta IS NOT NULL AND meta <> ''),
     k AS (SELECT item_id, split_part(kv, ':', 1) AS ns, regexp_extract(kv, '^[^:]*:([^=]*)=', 1) AS key, regexp_extract(kv, '^[^=]*=(.*)$', 1) AS value FROM p)
SELECT item_id, array_to_string(list_sort(list(ns || ':' || CASE WHEN key = 'image' THEN 'thumbnail' ELSE key END || '=' || trim(value, ' '))), chr(9)) AS line FROM k GROUP BY 1
""")
def meta_serialisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of an item's metadata parsed, renamed, trimmed and written again in order."""
    t = table(spark, sf_dir, "torrents_item", "item_id", "meta").where("meta IS NOT NULL AND meta != ''")
    def again(kv: Column) -> Column:
        ns, key, value = F.substring_index(kv, ":", 1), F.regexp_extract(kv, "^[^:]*:([^=]*)=", 1), F.regexp_extract(kv, "^[^=]*=(.*)$", 1)
        return F.concat(ns, F.lit(":"), F.when(key == "image", F.lit("thumbnail")).otherwise(key), F.lit("="), F.trim(value))
    return t.select("item_id", F.array_join(F.array_sort(F.transform(F.split("meta", "\t"), again)), "\t").alias("line"))


@query(r"""
SELECT item_id, coalesce(CASE WHEN NOT regexp_matches(filename, '^[0-9]*$|^[0-9A-Fa-f]{40}$|[<>{}]|&[a-z]+;|^(?i:unknown|noname)$') THEN filename END, title, filedir, split_part(filepaths, '///', 1), 'no name') AS name
FROM torrents_item t LEFT JOIN (SELECT item_id, min(title) AS title FROM meta WHERE item_id IS NOT NULL GROUP BY 1) USING (item_id)
LEFT JOIN (SELECT item_id, min(filedir) AS filedir, min(filepaths) AS filepaths FROM torrent_info WHERE item_id IS NOT NULL GROUP BY 1) USING (item_id)
""")
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of items: placeholders give way to the title, the folder, the first path, or a literal."""
    t = table(spark, sf_dir, "torrents_item", "item_id", "filename")
    m = table(spark, sf_dir, "meta", "item_id", "title").where("item_id IS NOT NULL").groupBy("item_id").agg(F.min("title").alias("title"))
    i = table(spark, sf_dir, "torrent_info", "item_id", "filedir", "filepaths").where("item_id IS NOT NULL").groupBy("item_id").agg(F.min("filedir").alias("filedir"), F.min("filepaths").alias("filepaths"))
    good = F.when(~F.col("filename").rlike("^[0-9]*$|^[0-9A-Fa-f]{40}$|[<>{}]|&[a-z]+;|^(?i:unknown|noname)$"), F.col("filename"))
    return t.join(m, "item_id", "left").join(i, "item_id", "left").select("item_id", F.coalesce(good, "title", "filedir", F.split_part("filepaths", F.lit("///"), F.lit(1)), F.lit("no name")).alias("name"))


@query(f"""
WITH RECURSIVE e AS (SELECT DISTINCT {_host('url')} AS a, {_host('link')} AS b FROM documents d JOIN {_LINKS} l ON l.row_id = d.doc_id WHERE {_host('url')} <> {_host('link')}),
s AS (SELECT min(a) AS start FROM e), r(node, depth) AS (SELECT start, 0 FROM s UNION SELECT b, depth + 1 FROM r JOIN e ON e.a = r.node WHERE depth < 3)
SELECT node, min(depth) AS depth FROM r GROUP BY 1
""")
def crawl_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites within three links of the first one, with their distance."""
    docs = table(spark, sf_dir, "documents", F.col("doc_id").alias("row_id"), ur.host(F.col("url")).alias("a"))
    edges = docs.join(_links(spark, sf_dir).select("row_id", ur.host(F.col("link")).alias("b")), "row_id").where("a != b").select("a", "b").distinct()
    reach = edges.agg(F.min("a").alias("node")).where("node IS NOT NULL").withColumn("depth", F.lit(0))
    front = reach
    for depth in range(1, 4):  # a step for each level; a node keeps the level that reached it first
        front = front.join(edges, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct().join(reach, "node", "left_anti").withColumn("depth", F.lit(depth))
        reach = reach.unionByName(front)
    return reach


@query("SELECT row_number() OVER (ORDER BY p.k, e.k) AS n, 'http://example.test/' || p.v || e.v AS url FROM (VALUES (1, 'index'), (2, 'new'), (3, 'latest'), (4, 'home')) p(k, v), (VALUES (1, ''), (2, '.html'), (3, '.php'), (4, '.asp')) e(k, v)")
def fresh_start_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses at which a fresh crawl starts: a product of two lists of four literals."""
    pages, ends = ("index", "new", "latest", "home"), ("", ".html", ".php", ".asp")
    return spark.createDataFrame([(n + 1, f"http://example.test/{p}{e}") for n, (p, e) in enumerate((p, e) for p in pages for e in ends)], "n long, url string")


@query(f"""
WITH v AS (SELECT _id, ls, ok, cko, n_tp, visit_id FROM torrents_domain WHERE _id IS NOT NULL), s AS (SELECT _id, max(cko) AS fails, bool_or(coalesce(ok, false)) AS done, max(coalesce(n_tp, 0)) AS n_tp FROM v GROUP BY 1)
SELECT s._id, fails, n_tp FROM s WHERE coalesce(fails, 0) <= 5 AND NOT done AND n_tp > 0 AND NOT EXISTS (SELECT 1 FROM s o WHERE o._id = 'www.' || s._id)
""")
def site_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites to learn: few failures, not done, with pages, and no twin under www."""
    v = table(spark, sf_dir, "torrents_domain", "_id", "ok", "cko", "n_tp").where("_id IS NOT NULL")
    s = v.groupBy("_id").agg(F.max("cko").alias("fails"), F.max(F.coalesce("ok", F.lit(False))).alias("done"), F.max(F.coalesce("n_tp", F.lit(0))).alias("n_tp"))
    twins = s.where(F.col("_id").startswith("www.")).select(F.substring("_id", 5, 1000).alias("_id"))
    return s.where((F.coalesce("fails", F.lit(0)) <= 5) & ~F.col("done") & (F.col("n_tp") > 0)).join(twins, "_id", "left_anti").select("_id", "fails", "n_tp")


_BARE = r"https?://[^\"'><\s\[\]()|]+"


@query(f"SELECT meta_id, i - 1 AS pos, regexp_extract_all(description, '{_BARE.replace(chr(39), chr(39) * 2)}')[i] AS link FROM meta, unnest(range(1, len(regexp_extract_all(description, '{_BARE.replace(chr(39), chr(39) * 2)}')) + 1)) t(i)")
def bare_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every address in a body, in attributes and outside of them, in order."""
    found = F.regexp_extract_all("description", F.lit(_BARE), F.lit(0))
    return table(spark, sf_dir, "meta", "meta_id", "description").select("meta_id", F.posexplode(found).alias("pos", "link")).withColumn("pos", F.col("pos").cast("long"))


@query(f"""
WITH l AS (SELECT {_host('link')} AS host, count(*) AS n_links, count_if(regexp_matches(link, '/[0-9]+$')) AS n_items FROM (SELECT unnest(regexp_extract_all(description, '{_BARE.replace(chr(39), chr(39) * 2)}')) AS link FROM meta) GROUP BY 1)
SELECT list_aggregate(string_split(host, '.')[-2:], 'string_agg', '.') AS domain, sum(n_links)::BIGINT AS n_links FROM l WHERE host NOT IN (SELECT d FROM sources WHERE d IS NOT NULL) AND n_items > 0 GROUP BY 1
""")
def new_site_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains of hosts that descriptions link to, that are no source and have numbered items."""
    link = F.col("link")
    l = bare_links(spark, sf_dir).groupBy(ur.host(link).alias("host")).agg(F.count("*").alias("n_links"), F.count_if(link.rlike("/[0-9]+$")).alias("n_items"))
    new = l.join(table(spark, sf_dir, "sources", F.col("d").alias("host")), "host", "left_anti").where("n_items > 0")
    labels = F.split("host", r"\.")
    return new.groupBy(F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("domain")).agg(F.sum("n_links").alias("n_links"))


@query(f"""
WITH l AS (SELECT row_id, link, {_host('link')} AS h, contains(link, '.torrent') AS is_file, contains(link, '/torrent/') AS is_detail FROM {_LINKS}), s AS (SELECT d, list_contains(g, 's') AS store FROM sources)
SELECT row_id, link, CASE WHEN coalesce(store, false) THEN is_file OR is_detail WHEN is_detail THEN true ELSE NOT is_file END AS follow, CASE WHEN coalesce(store, false) THEN 3 ELSE 2 END AS ttl FROM l LEFT JOIN s ON h = d
""")
def transition_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which links may be followed: from stores only files and details, else no file from a listing."""
    stores = table(spark, sf_dir, "sources", F.col("d").alias("h"), F.array_contains("g", "s").alias("store"))
    l = _links(spark, sf_dir).select("row_id", "link", ur.host(F.col("link")).alias("h"), F.col("link").contains(".torrent").alias("is_file"), F.col("link").contains("/torrent/").alias("is_detail"))
    store = F.coalesce("store", F.lit(False))
    follow = F.when(store, F.col("is_file") | F.col("is_detail")).when(F.col("is_detail"), F.lit(True)).otherwise(~F.col("is_file"))
    return l.join(stores, "h", "left").select("row_id", "link", follow.alias("follow"), F.when(store, 3).otherwise(2).alias("ttl"))


@query("SELECT o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)) - 1 AS ordinal, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)) % 4 AS proxy FROM orders")
def ordinal_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinals among siblings, and their assignment in turn."""
    r = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select("o_orderkey", (r - 1).cast("long").alias("ordinal"), (r % 4).cast("long").alias("proxy"))


@query("""
WITH f AS (SELECT meta_id, unnest(['category', 'genre', 'language']) AS field, unnest([category, genre, language]) AS value FROM meta), c AS (SELECT meta_id, value FROM f WHERE value IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT field) > 1)
SELECT meta_id, arg_min(value, row(len(value), field)) AS first_value, string_agg(DISTINCT value, ',' ORDER BY value) AS all_values, count(*) AS n_fields FROM f WHERE value IS NOT NULL AND NOT EXISTS (SELECT 1 FROM c WHERE c.meta_id = f.meta_id AND c.value = f.value AND f.field <> 'category') GROUP BY 1
""")
def field_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that repeat another field's value go, except category; the rest is joined in order."""
    fields = ("category", "genre", "language")
    f = table(spark, sf_dir, "meta", "meta_id", *fields).select("meta_id", F.explode(F.array(*[F.struct(F.lit(x).alias("field"), F.col(x).alias("value")) for x in fields])).alias("x")).select("meta_id", "x.*").where("value IS NOT NULL")
    n = F.size(F.collect_set("field").over(Window.partitionBy("meta_id", "value")))
    kept = f.withColumn("n", n).where("n = 1 OR field = 'category'")
    return kept.groupBy("meta_id").agg(F.min_by("value", F.struct(F.length("value"), "field")).alias("first_value"), F.array_join(F.array_sort(F.collect_set("value")), ",").alias("all_values"), F.count("*").alias("n_fields"))


@query("SELECT count(*) AS n_rows, count(DISTINCT source_id) AS n_sources, count_if(error_type IS NULL) AS n_items, count_if(error_type IS NOT NULL) AS n_errors, max(item_id) + 1 AS next_id FROM torrents_item")
def crawl_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("error_type")
    return table(spark, sf_dir, "torrents_item", "item_id", "source_id", "error_type").agg(F.count("*").alias("n_rows"), F.countDistinct("source_id").alias("n_sources"), F.count_if(e.isNull()).alias("n_items"), F.count_if(e.isNotNull()).alias("n_errors"), (F.max("item_id") + 1).alias("next_id"))


def totals(info: DataFrame) -> DataFrame:
    """info_id, total and n_trackers of every row of ``info``; null where filesizes or trackers is null.

    Sizes and trackers are those that the packed fields split into, so a comma may part
    sizes or group the thousands of one.
    """
    values = split_packed(info, {"filesizes": ("info_id", "number"), "trackers": ("info_id", "address")})
    size = F.when(F.col("fld") == "filesizes", F.regexp_replace("value", "[^0-9]", "").cast("long"))
    sums = values.groupBy(F.col("row_id").alias("info_id")).agg(F.sum(size).alias("total"), F.countDistinct(F.when(F.col("fld") == "trackers", F.col("value"))).alias("n_trackers"))
    stated = lambda field, n: F.when(F.col(field).isNotNull(), F.coalesce(F.col(n), F.lit(0))).alias(n)
    return info.select("info_id", "filesizes", "trackers").join(sums, "info_id", "left").select("info_id", stated("filesizes", "total"), stated("trackers", "n_trackers"))


@query(r"""
SELECT info_id, CASE WHEN filesizes IS NOT NULL THEN coalesce(list_sum(list_transform(
         CASE WHEN regexp_matches(filesizes, '[0-9][,.''][0-9]') AND NOT regexp_matches(filesizes, '[0-9]{4}') THEN regexp_extract_all(filesizes, '[0-9][0-9,.'']*') ELSE regexp_extract_all(filesizes, '[0-9]+') END,
         lambda v: CAST(regexp_replace(v, '[^0-9]', '', 'g') AS BIGINT)))::BIGINT, 0) END AS total,
       CASE WHEN trackers IS NOT NULL THEN len(list_distinct(list_filter(list_transform(string_split(regexp_replace(trackers, '[\s|;,"''\[\]]+([A-Za-z][A-Za-z0-9+.\-]*://)', chr(1) || '\1', 'g'), chr(1)),
         lambda v: regexp_replace(v, '^[\s|;,"''\[\]]+|[\s|;,"''\[\]]+$', '', 'g')), lambda v: v <> ''))) END AS n_trackers
FROM torrent_info
""")
def file_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of the sizes and number of distinct trackers of every file, whatever its lists are packed with."""
    return totals(table(spark, sf_dir, "torrent_info", "info_id", "filesizes", "trackers"))


# Page trees: the HTML descriptions are the pages.


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "meta", "meta_id", "url", "description", "title", "category")
    return m.where(F.col("description").rlike(r"(?i)<(?:h[1-6]|p|div|ul|table)[ >]")).select("meta_id", ur.host(F.col("url")).alias("site"), F.col("description").alias("html"))


@query()
def dom_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of all HTML pages, with paths and short paths."""
    return paths.anchored(dom.nodes(_pages(spark, sf_dir), "meta_id", "html"), "meta_id").drop("attrs")


def _induced(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    pages = _pages(spark, sf_dir)
    nodes = checkpoint(dom.nodes(pages, "meta_id", "html"))
    # The texts to be found: headings as titles, list items and table cells as fields.
    values = nodes.where(F.col("tag").isin("h2", "h3", "li", "td", "code") & (F.col("text") != "")).groupBy("meta_id", "tag").agg(F.min_by("text", "node_id").alias("value"))
    field = F.when(F.col("tag").isin("h2", "h3"), "title").when(F.col("tag") == "li", "keyword").when(F.col("tag") == "td", "category").otherwise("sample")
    known = paths.induce(nodes, "meta_id", values.select("meta_id", field.alias("field"), "value"), "field", "value")
    sites = pages.select("meta_id", "site")
    return nodes, sites, known.join(sites, "meta_id")


@query()
def path_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _induced(spark, sf_dir)[2]


@query()
def framed_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of known texts, without those that the site's home page, its page of the smallest id, has at the same place."""
    pages = _pages(spark, sf_dir)
    nodes = checkpoint(dom.nodes(pages, "meta_id", "html"))
    # One page of each site: counted before it is broadcast.
    homes = small_side(pages.groupBy("site").agg(F.min("meta_id").alias("home")))
    site_of = pages.select("meta_id", "site").join(homes, "site")
    frame = nodes.join(site_of.where("meta_id = home").select("meta_id", "site"), "meta_id").select("site", "path", "text").distinct()
    values = nodes.where(F.col("tag").isin("h2", "h3", "code") & (F.col("text") != "")).groupBy("meta_id", "tag").agg(F.min_by("text", "node_id").alias("value"))
    others = site_of.where("meta_id != home").select("meta_id", "site")
    home = others.join(frame, "site").select("meta_id", "path", "text")
    return paths.induce(nodes.join(others, "meta_id", "left_semi"), "meta_id", values.join(others, "meta_id", "left_semi").select("meta_id", F.when(F.col("tag") == "code", "sample").otherwise("title").alias("field"), "value"), "field", "value", home)


@query()
def image_path_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where pages show their first image, by short path."""
    m = table(spark, sf_dir, "meta", "meta_id", "description").where(F.lower("description").contains("<img"))
    nodes = checkpoint(dom.nodes(m, "meta_id", "description"))
    first = nodes.where("tag = 'img'").groupBy("meta_id").agg(F.min_by(F.col("attrs")["src"], "node_id").alias("src"))
    return paths.image_paths(nodes, "meta_id", first, "src")


@query()
def wrapper_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn each site's paths by vote and apply them to all its pages."""
    nodes, sites, known = _induced(spark, sf_dir)
    return paths.extract(nodes, "meta_id", sites, paths.wrapper(known, "site", "field"))


@query()
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages to numbered items, by short path."""
    m = table(spark, sf_dir, "meta", "meta_id", "description").where(F.col("description").contains("<a "))
    return paths.download_paths(dom.nodes(m, "meta_id", "description"), "meta_id", "/[0-9]+$")


@query()
def record_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of pages with the fields that follow from others filled in."""
    m = table(spark, sf_dir, "meta", "meta_id", "title", "description", "category", "genre", "quality", "season", "episode")
    record = m.withColumn("subcategory", F.col("category")).withColumn("category", tx.extract_category(F.col("category"))).withColumn("image", F.lit(None).cast("string"))
    return paths.cascade(record).drop("description")


@query()
def image_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image that stands for each page; sizes follow from the address, as files are not fetched."""
    m = table(spark, sf_dir, "meta", "meta_id", "url", "description").where(F.col("description").contains("src="))
    i = m.select(F.col("meta_id").alias("page"), ur.host(F.col("url")).alias("site"), F.explode(F.array_distinct(F.regexp_extract_all("description", F.lit('src="([^"]+)"'), F.lit(1)))).alias("src"))
    w = (F.pmod(F.crc32(F.encode("src", "UTF-8")), F.lit(300)) + 20).cast("int")
    return paths.chosen_image(i.select("page", "src", w.alias("width"), (w + 10).alias("height"), (ur.host(F.col("src")) != F.col("site")).alias("off_domain")), "page")


_PARTS = {"h": r"urn\W*btih\W*([0-9a-f]{40})", "n": r"(?:^|[^a-z0-9])dn\s*[=:]\s*([^&;|,]*)", "l": r"(?:^|[^a-z0-9])xl\s*[=:]\s*([0-9]+)"}


@query(f"""
WITH p AS (SELECT row_id, regexp_extract(lower(_id), '{_PARTS["h"]}', 1) AS h, regexp_extract(lower(_id), '{_PARTS["n"]}', 1) AS n, regexp_extract(lower(_id), '{_PARTS["l"]}', 1) AS l FROM torrent)
SELECT row_id, upper(h) AS infohash, nullif(replace(n, '+', ' '), '') AS name, TRY_CAST(l AS BIGINT) AS size, NULL::VARCHAR AS error FROM p WHERE h <> ''
""")
def magnet_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled identifiers, however they are written, put as magnet links and read."""
    low = F.lower("_id")
    h, n, l = (F.regexp_extract(low, _PARTS[k], 1) for k in "hnl")
    t = table(spark, sf_dir, "torrent", "row_id", "_id").where(h != "")
    uri = F.concat(F.lit("magnet:?xt=urn:btih:"), h, F.lit("&dn="), F.replace(n, F.lit("%"), F.lit("%25")), F.when(l != "", F.concat(F.lit("&xl="), l)).otherwise(""))
    return metainfo.decode_magnets(t.select("row_id", uri.alias("uri")), "row_id", "uri").select("row_id", "infohash", "name", "size", "error")


_FILES = "string_split(filepaths, '///')"
_INFO = f"""CASE WHEN filedir IS NULL THEN 'd6:lengthi' || strlen(filepaths) || 'e4:name' || strlen(filepaths) || ':' || filepaths || 'e'
ELSE 'd5:filesl' || array_to_string(list_transform({_FILES}, lambda p: 'd6:lengthi' || strlen(p) || 'e4:pathl' || strlen(p) || ':' || p || 'ee'), '') || 'e4:name' || strlen(filedir) || ':' || filedir || 'e' END"""


@query(f"""
SELECT info_id, upper(sha1({_INFO})) AS infohash, replace(coalesce(filedir, filepaths), chr(8203), '') AS name, strlen(filepaths) - CASE WHEN filedir IS NULL THEN 0 ELSE 3 * (len({_FILES}) - 1) END AS size, CASE WHEN filedir IS NULL THEN 1 ELSE len({_FILES}) END AS n_files,
       len(list_distinct(list_filter(string_split_regex(replace(coalesce(trackers, ''), chr(8203), ''), '[ \\r\\n]+'), lambda t: t <> ''))) AS n_trackers, regexp_replace(regexp_replace(replace(comment, chr(8203), ''), '\\r?\\n', '<br />', 'g'), '\\t', ' ', 'g') AS comment, ['h:' || info_id] AS nodes, NULL::VARCHAR AS error
FROM torrent_info WHERE filepaths IS NOT NULL
""")
def metainfo_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metainfo of one or several files, with tiers of trackers, comment and nodes, written as bencoded bytes from the table and read again."""
    i = table(spark, sf_dir, "torrent_info", "info_id", "filedir", "filepaths", "trackers", "comment").where("filepaths IS NOT NULL")
    text = lambda c: F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)
    one = lambda p: F.concat(F.lit("d6:lengthi"), F.octet_length(p).cast("string"), F.lit("e4:pathl"), text(p), F.lit("ee"))
    single = F.concat(F.lit("d6:lengthi"), F.octet_length("filepaths").cast("string"), F.lit("e4:name"), text(F.col("filepaths")), F.lit("e"))
    several = F.concat(F.lit("d5:filesl"), F.array_join(F.transform(F.split("filepaths", "///"), one), ""), F.lit("e4:name"), text(F.col("filedir")), F.lit("e"))
    tiers = F.transform(F.filter(F.split(F.coalesce("trackers", F.lit("")), r"[ \r\n]+"), lambda t: t != ""), lambda t: F.concat(F.lit("l"), text(t), F.lit("e")))
    number = F.col("info_id").cast("string")
    raw = F.concat(F.lit("d13:announce-listl"), F.array_join(tiers, ""), F.lit("e"), F.coalesce(F.concat(F.lit("7:comment"), text(F.col("comment"))), F.lit("")), F.lit("4:info"), F.when(F.col("filedir").isNull(), single).otherwise(several), F.lit("5:nodesll1:hi"), number, F.lit("eeee"))
    out = metainfo.decode_files(i.select("info_id", F.encode(raw, "UTF-8").alias("raw")), "info_id", "raw")
    return out.select("info_id", "infohash", "name", "size", F.size("files").cast("long").alias("n_files"), F.size("trackers").cast("long").alias("n_trackers"), "comment", "nodes", "error")


@query("SELECT meta_id, (meta_id % 900 + 1)::INTEGER AS width, (meta_id % 700 + 2)::INTEGER AS height FROM meta")
def image_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width and height of images that are written as PNG, GIF and JPEG from the table, the last behind long metadata, and read again."""
    hexed = lambda n, digits: F.lpad(F.hex(n), digits, "0")
    w, h = F.col("meta_id") % 900 + 1, F.col("meta_id") % 700 + 2
    small = lambda n: F.concat(F.substring(hexed(n, 4), 3, 2), F.substring(hexed(n, 4), 1, 2))
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), hexed(w, 8), hexed(h, 8))
    gif = F.concat(F.lit("474946383961"), small(w), small(h))
    # Five segments of metadata, 300 kB in all, stand before the frame.
    jpeg = F.concat(F.lit("FFD8" + ("FFE1EA60" + "00" * 59998) * 5 + "FFC0000B08"), hexed(h, 4), hexed(w, 4), F.lit("0000"))
    raw = F.when(F.col("meta_id") % 100 == 0, F.unhex(jpeg)).when(F.col("meta_id") % 2 == 0, F.unhex(png)).otherwise(F.unhex(gif))
    m = table(spark, sf_dir, "meta", "meta_id")
    return images.read_dimensions(m.select("meta_id", raw.alias("raw")), "meta_id", "raw")


@query("SELECT meta_id, coalesce(regexp_full_match(season, '[0-9]+') OR regexp_matches(season, '(?i)s[0-9]+e[0-9]+'), false) AS season_ok, coalesce(regexp_matches(infohash, '[0-9a-fA-F]{40}'), false) AS digest_ok, upper(nullif(regexp_extract(infohash, '([0-9a-fA-F]{40})', 1), '')) AS digest, len(string_split(url, '/')) > 3 AS image_ok FROM meta")
def valid_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether strings offered for a field are valid for it, and their value."""
    v = lambda f, c: tx.valid_meta(f, F.col(c), F.col("url"))
    m = table(spark, sf_dir, "meta", "meta_id", "url", "season", "infohash").select("meta_id", v("season", "season").alias("s"), v("infohash", "infohash").alias("h"), v("image", "url").alias("i"))
    return m.select("meta_id", F.col("s.valid").alias("season_ok"), F.col("h.valid").alias("digest_ok"), F.col("h.value").alias("digest"), F.col("i.valid").alias("image_ok"))


@query("SELECT row_id, url_decode(replace(regexp_extract(lower(_id), 'dn[=:] ?([^&;|,]*)', 1), '%', '%25')) AS name FROM torrent WHERE _id IS NOT NULL")
def percent_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of labelled identifiers, encoded for an address and decoded again; plus signs stay."""
    name = F.regexp_extract(F.lower("_id"), "dn[=:] ?([^&;|,]*)", 1)
    return table(spark, sf_dir, "torrent", "row_id", "_id").where("_id IS NOT NULL").select("row_id", ur.decoded(F.replace(name, F.lit("%"), F.lit("%25"))).alias("name"))


@query("SELECT DISTINCT d AS domain FROM sources WHERE contains(d, '-') AND d NOT IN ('amberquill-index.example', 'velvelsil-meadow.invalid')")
def seed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds written as a list of ranks and domains and read again: those with a token and not blacklisted."""
    at = f"{shared_folder(spark)}/seeds/{uuid.uuid4().hex}"
    table(spark, sf_dir, "sources", F.col("_id").cast("string").alias("rank"), "d").write.csv(at)
    return files.read_seeds(spark, at, "-", ("amberquill-index.example", "velvelsil-meadow.invalid"))


@query("SELECT strftime(ts, '%Y-%m-%d-%H') AS hour, count(*) AS n_lines FROM events WHERE ts IS NOT NULL GROUP BY 1")
def hourly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in each hour's file, once they are written."""
    at = f"{shared_folder(spark)}/hourly/{uuid.uuid4().hex}"
    files.write_hourly(table(spark, sf_dir, "events", "ts", F.concat_ws("\t", "event_id", "event_type").alias("line")).where("ts IS NOT NULL"), at)
    return spark.read.text(at).groupBy(F.col("hour").cast("string").alias("hour")).agg(F.count("*").alias("n_lines"))


_BITS = "array_to_string(list_transform(string_split(digest, ''), lambda c: array_to_string(list_transform([16, 8, 4, 2, 1], lambda b: CAST((strpos('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', c) - 1) // b % 2 AS VARCHAR)), '')), '')"


@query(f"""
WITH d AS (SELECT item_id, regexp_extract(origins, '7:([A-Z2-7]{{32}})', 1) AS digest FROM torrents_item), b AS (SELECT item_id, digest, {_BITS} AS bits FROM d WHERE digest <> '')
SELECT item_id, digest, array_to_string(list_transform(range(0, 40), lambda i: substr('0123456789ABCDEF', 1 + 8 * CAST(substr(bits, 4 * i + 1, 1) AS INT) + 4 * CAST(substr(bits, 4 * i + 2, 1) AS INT) + 2 * CAST(substr(bits, 4 * i + 3, 1) AS INT) + CAST(substr(bits, 4 * i + 4, 1) AS INT), 1)), '') AS hex FROM b
""")
def base32_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of items' origins in one notation."""
    t = table(spark, sf_dir, "torrents_item", "item_id", "origins").select("item_id", F.regexp_extract("origins", "7:([A-Z2-7]{32})", 1).alias("digest")).where("digest != ''")
    return t.select("item_id", "digest", ur.canonical_digest(F.col("digest")).alias("hex"))


@query()
def tracker_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "torrent_info", "info_id", "trackers").where("trackers IS NOT NULL")
    return t.select("info_id", ur.signed_crc(F.regexp_extract("trackers", "([a-z]+://[^ |;,]+)", 1)).alias("tracker_id"))


# Streams over the events.


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_visited_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind of event of each user once, however often it comes."""
    return drained(views.visited_once(_event_stream(spark, sf_dir).select("user_id", "event_type"), ["user_id", "event_type"])).drop("batch")


@query("SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, epoch_us(max(ts)) - epoch_us(min(ts)) > 1800000000 AS promoted FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1")
def stream_first_last_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = drained(views.seen(_event_stream(spark, sf_dir), "user_id"), "update")
    return states.groupBy("user_id").agg(F.max_by(F.struct("first_seen", "last_seen", "promoted"), "batch").alias("s")).select("user_id", "s.*")


@query("SELECT time_bucket(INTERVAL 60 minutes, ts) AS hour, event_type, count(*) AS n_lines FROM events WHERE ts IS NOT NULL GROUP BY 1, 2")
def stream_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each hour, those of the hours that are still open included: the last state of each."""
    states = drained(views.hourly_counts(_event_stream(spark, sf_dir), "event_type"), "update")
    last = states.groupBy("hour", "event_type").agg(F.max_by("n_lines", "batch").alias("n_lines"))
    return last.withColumn("hour", F.col("hour").cast("timestamp_ntz"))
