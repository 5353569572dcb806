"""Queries of the crawl side: link filters, frontiers, merges, jobs; each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.functions import lexicon as lx
from gleanery.functions import plugins
from gleanery.functions import text as tx
from gleanery.functions import urls as ur
from gleanery.operators import ranking
from gleanery.plans.reference import _BAD, _LINKS, _first_sql, _host, _links
from gleanery.session import table

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


_KIND = "CASE WHEN regexp_matches(url, '(?i)\\.torrent(\\?|$)') THEN 'application/x-bittorrent' WHEN regexp_matches(url, '(?i)\\.png$') THEN 'image/png' WHEN regexp_matches(url, '(?i)\\.css$') THEN 'text/css' ELSE 'text/html' END"


@query(f"""
WITH u AS (SELECT 'meta' AS tbl, meta_id AS row_id, url FROM meta UNION ALL SELECT 'torrent', row_id, 'magnet:?' || _id FROM torrent WHERE regexp_matches(lower(_id), '(^|[^a-z])xt *[=:]')), k AS (SELECT *, {_KIND} || CASE WHEN row_id % 2 = 0 THEN '; charset=utf-8' ELSE '' END AS stated FROM u)
SELECT tbl, row_id, CASE WHEN starts_with(url, 'magnet:') THEN 'magnet' WHEN lower(trim(split_part(stated, ';', 1), ' ')) IN ('application/x-bittorrent', 'application/octet-stream') THEN 'decode' WHEN lower(trim(split_part(stated, ';', 1), ' ')) IN ('text/css', 'image/gif', 'image/png', 'text/javascript') THEN 'drop' ELSE 'continue' END AS route FROM k
""")
def media_type_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route of a response by the part of its media type before a semicolon; a magnet address passes through."""
    m = table(spark, sf_dir, "meta", F.lit("meta").alias("tbl"), F.col("meta_id").alias("row_id"), "url")
    t = table(spark, sf_dir, "torrent", "row_id", "_id").where(F.lower("_id").rlike("(^|[^a-z])xt *[=:]")).select(F.lit("torrent").alias("tbl"), "row_id", F.concat(F.lit("magnet:?"), "_id").alias("url"))
    url = F.col("url")
    # No headers are kept with the pages: the address tells the type that would have come.
    kind = F.when(url.rlike(r"(?i)\.torrent(\?|$)"), "application/x-bittorrent").when(url.rlike(r"(?i)\.png$"), "image/png").when(url.rlike(r"(?i)\.css$"), "text/css").otherwise("text/html")
    stated = F.concat(kind, F.when(F.col("row_id") % 2 == 0, "; charset=utf-8").otherwise(""))
    return m.unionByName(t).select("tbl", "row_id", ur.route(url, stated).alias("route"))


@query(f"""
SELECT d.doc_id, l.pos, replace(split_part(l.link, '#', 1), 'https://', 'http://') AS link FROM documents d JOIN {_LINKS} l ON l.row_id = d.doc_id
WHERE ({_host('l.link')} = {_host('d.url')} OR NOT starts_with(l.link, 'http')) AND NOT regexp_matches(l.link, '{_BAD}') ORDER BY 1, 2
""")
def internal_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that stay on the page's site, without fragment and blacklisted words, over plain http."""
    docs = table(spark, sf_dir, "documents", F.col("doc_id").alias("row_id"), ur.host(F.col("url")).alias("site"))
    link = F.col("link")
    inside = (ur.host(link) == F.col("site")) | ~link.startswith("http")
    return _links(spark, sf_dir).join(docs, "row_id").where(inside & ~link.rlike(_BAD)).select(F.col("row_id").alias("doc_id"), "pos", F.replace(ur.without_fragment(link), F.lit("https://"), F.lit("http://")).alias("link"))


WHITELIST = ("^http://[^/]*\\\\.(?:example|test)/", "^https://")


@query(f"""
WITH s AS (SELECT d, list_contains(g, 's') AS store FROM sources), l AS (SELECT row_id, pos, link, {_host('link')} AS h, min({_host('link')}) OVER (PARTITION BY row_id) AS site FROM {_LINKS})
SELECT row_id, pos, CASE WHEN h = site OR coalesce(store, false) THEN 3 ELSE 2 - CAST(pos AS INTEGER) END AS ttl FROM l LEFT JOIN s ON h = d
WHERE (regexp_matches(link, '^http://[^/]*\\.(?:example|test)/') OR regexp_matches(link, '^https://')) AND CASE WHEN h = site OR coalesce(store, false) THEN 3 ELSE 2 - CAST(pos AS INTEGER) END > 0
""")
def whitelist_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitelisted links with their time to live: reset on site and in stores, less one elsewhere; none at 0."""
    stores = table(spark, sf_dir, "sources", F.col("d").alias("h"), F.array_contains("g", "s").alias("store"))
    link = F.col("link")
    l = _links(spark, sf_dir).withColumn("h", ur.host(link)).withColumn("site", F.min("h").over(Window.partitionBy("row_id"))).join(stores, "h", "left")
    ttl = F.when((F.col("h") == F.col("site")) | F.coalesce("store", F.lit(False)), 3).otherwise(2 - F.col("pos"))
    return l.where(link.rlike(r"^http://[^/]*\.(?:example|test)/") | link.rlike("^https://")).select("row_id", "pos", ttl.alias("ttl")).where("ttl > 0")


@query(f"""
WITH r AS (SELECT row_id, disc[1] AS url, disc[len(disc)] AS final_url FROM torrent WHERE len(disc) > 1), n AS (SELECT row_id, regexp_replace(url, '/$', '') AS url, regexp_replace(final_url, '/$', '') AS final_url FROM r)
SELECT row_id, {_host('final_url')} AS final_site FROM n WHERE url <> final_url AND {_host('url')} <> {_host('final_url')} AND {_host('final_url')} IN (SELECT d FROM sources)
""")
def redirect_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that end on another known site: from the first to the last address of each record."""
    trim = lambda c: F.regexp_replace(c, "/$", "")
    r = table(spark, sf_dir, "torrent", "row_id", "disc").where(F.size("disc") > 1).select("row_id", trim(F.get("disc", F.lit(0))).alias("url"), trim(F.element_at("disc", -1)).alias("final_url"))
    moved = r.where((F.col("url") != F.col("final_url")) & (ur.host(F.col("url")) != ur.host(F.col("final_url")))).select("row_id", ur.host(F.col("final_url")).alias("final_site"))
    return moved.join(table(spark, sf_dir, "sources", F.col("d").alias("final_site")), "final_site", "left_semi").select("row_id", "final_site")


@query(f"""
WITH p AS (SELECT row_id, list_distinct(list_filter(disc, lambda x: contains(x, '.torrent'))) AS f, list_distinct(list_filter(disc, lambda x: NOT contains(x, '.torrent'))) AS o FROM torrent WHERE disc IS NOT NULL)
SELECT row_id, len(f) = 1 AS is_detail, array_to_string(list_sort(CASE WHEN len(f) = 0 THEN o ELSE list_append(o, list_min(f)) END), ' ') AS links FROM p
""")
def single_file_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with exactly one file are detail pages; of several files the first in order is kept."""
    is_file = lambda x: x.contains(".torrent")
    files, others = F.array_distinct(F.filter("disc", is_file)), F.array_distinct(F.filter("disc", lambda x: ~is_file(x)))
    kept = F.when(F.size(files) == 0, others).otherwise(F.concat(others, F.array(F.array_min(files))))
    return table(spark, sf_dir, "torrent", "row_id", "disc").where("disc IS NOT NULL").select("row_id", (F.size(files) == 1).alias("is_detail"), F.array_join(F.array_sort(kept), " ").alias("links"))


@query("SELECT meta_id, CASE WHEN lower(trim(description, ' ')) IS NOT DISTINCT FROM lower(trim(title, ' ')) THEN NULL ELSE description END AS description FROM meta")
def description_not_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions, without those that only repeat the title."""
    same = F.lower(F.trim("description")).eqNullSafe(F.lower(F.trim("title")))
    return table(spark, sf_dir, "meta", "meta_id", "title", "description").select("meta_id", F.when(~same, F.col("description")).alias("description"))


@query(f"""
WITH l AS (SELECT row_id, {_host('link')} AS site, link, string_split(link, '/')[4] AS category, row_number() OVER (PARTITION BY row_id ORDER BY pos) AS k FROM {_LINKS} WHERE string_split(link, '/')[4] IN ('torrent', 't', 'get') AND NOT regexp_matches(link, '{_BAD}')),
     c AS (SELECT site, k, count(DISTINCT (link, category)) AS n FROM l GROUP BY 1, 2)
SELECT site, min(k) AS k FROM c WHERE n > 1 GROUP BY 1
""")
def category_link_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first position among a page's category links at which a site's pages differ."""
    l = _links(spark, sf_dir).withColumn("category", ur.segment(F.col("link"), 3)).where(F.col("category").isin("torrent", "t", "get") & ~F.col("link").rlike(_BAD))
    l = l.withColumn("k", F.row_number().over(Window.partitionBy("row_id").orderBy("pos")).cast("long"))
    c = l.groupBy(ur.host(F.col("link")).alias("site"), "k").agg(F.countDistinct("link", "category").alias("n"))
    return c.where("n > 1").groupBy("site").agg(F.min("k").alias("k"))


_IMG = r"""regexp_extract_all(description, '<img[^>]*alt="([^"]*)"', 1)"""


@query(f"""
SELECT meta_id, alt FROM (SELECT meta_id, i, {_IMG}[i] AS alt, row_number() OVER (PARTITION BY meta_id ORDER BY i) AS r FROM meta, unnest(range(1, len({_IMG}) + 1)) t(i) WHERE length({_IMG}[i]) > 0 AND contains(lower(description), lower({_IMG}[i]))) WHERE r = 1
""")
def image_by_alt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first image whose alternative text occurs in the page."""
    alts = F.regexp_extract_all("description", F.lit(r'<img[^>]*alt="([^"]*)"'), F.lit(1))
    fits = F.filter(alts, lambda a: (F.length(a) > 0) & F.lower("description").contains(F.lower(a)))
    return table(spark, sf_dir, "meta", "meta_id", "description").where("description IS NOT NULL").select("meta_id", F.try_element_at(fits, F.lit(1)).alias("alt")).where("alt IS NOT NULL")


@query("""
WITH p AS (SELECT item_id, min(infohash) AS infohash, min(title) AS title, min(size) AS size FROM meta WHERE item_id IS NOT NULL GROUP BY 1), f AS (SELECT item_id, min(infohash) AS infohash, min(filedir) AS title, min(comment) AS comment FROM torrent_info WHERE item_id IS NOT NULL GROUP BY 1)
SELECT item_id, trim(coalesce(p.infohash, f.infohash), ' ') AS infohash, trim(coalesce(p.title, f.title), ' ') AS title, trim(p.size, ' ') AS size, trim(f.comment, ' ') AS comment FROM p FULL JOIN f USING (item_id)
""")
def merge_page_over_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of page and file of an item in one record; the page's go first, values are trimmed."""
    p = table(spark, sf_dir, "meta", "item_id", "infohash", "title", "size").where("item_id IS NOT NULL").groupBy("item_id").agg(F.min("infohash").alias("h1"), F.min("title").alias("t1"), F.min("size").alias("size"))
    f = table(spark, sf_dir, "torrent_info", "item_id", "infohash", "filedir", "comment").where("item_id IS NOT NULL").groupBy("item_id").agg(F.min("infohash").alias("h2"), F.min("filedir").alias("t2"), F.min("comment").alias("comment"))
    return p.join(f, "item_id", "full").select("item_id", F.trim(F.coalesce("h1", "h2")).alias("infohash"), F.trim(F.coalesce("t1", "t2")).alias("title"), F.trim("size").alias("size"), F.trim("comment").alias("comment"))


@query(f"""
WITH v AS (SELECT {_host('link')} AS site, coalesce(string_split(link, '/')[4], '') AS path, count(*) AS votes FROM {_LINKS} WHERE regexp_matches(link, '/[0-9]+') GROUP BY 1, 2)
SELECT site, path, votes FROM (SELECT *, max(votes) OVER (PARTITION BY site) // 3 AS bar FROM v) WHERE votes > bar
""")
def link_path_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of a site's numbered links with over a third of the best one's votes."""
    link = F.col("link")
    v = _links(spark, sf_dir).where(link.rlike("/[0-9]+")).groupBy(ur.host(link).alias("site"), F.coalesce(ur.segment(link, 3), F.lit("")).alias("path")).agg(F.count("*").alias("votes"))
    return v.withColumn("bar", F.expr("max(votes) over (partition by site) div 3")).where("votes > bar").select("site", "path", "votes")


@query(f"""
SELECT row_id, link FROM (SELECT row_id, link, contains(link, '/torrent/') AS keep, row_number() OVER (PARTITION BY {_host('link')} ORDER BY md5(link), link, row_id, pos) AS r FROM {_LINKS}) WHERE r <= 10 OR keep
""")
def sampled_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten links of each site in the order of their hash, and all that must be kept."""
    keep = F.col("link").contains("/torrent/")
    l = _links(spark, sf_dir).withColumn("site", ur.host(F.col("link"))).withColumn("hash", F.md5(F.col("link").cast("binary")))
    first = ranking.top_k(l, "site", ["hash", "link", "row_id", "pos"], 10).where(~keep)
    return first.select("row_id", "link").unionByName(l.where(keep).select("row_id", "link"))


@query(f"""
WITH m AS (SELECT {_host('url')} AS site, meta_id, url, row_number() OVER (PARTITION BY {_host('url')} ORDER BY url, meta_id) AS r, count(*) OVER (PARTITION BY {_host('url')}) AS visited FROM meta),
     s AS (SELECT *, count_if(infohash_ok) OVER (PARTITION BY site) AS found FROM (SELECT m.*, meta.infohash IS NOT NULL AS infohash_ok FROM m JOIN meta USING (meta_id)))
SELECT site, meta_id, r AS place FROM s WHERE r <= 5 AND visited <= 20000 AND NOT (visited > 1000 AND found < visited // 1000)
""")
def quota_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five pages of each site, unless too many were visited for too few found."""
    m = table(spark, sf_dir, "meta", "meta_id", "url", "infohash").withColumn("site", ur.host(F.col("url")))
    counts = m.groupBy("site").agg(F.count("*").alias("visited"), F.count("infohash").alias("found"))
    good = counts.where("visited <= 20000 AND NOT (visited > 1000 AND found < visited div 1000)").select("site")
    first = ranking.top_k(m.select("site", "meta_id", "url"), "site", ["url", "meta_id"], 5)
    return first.join(good, "site", "left_semi").select("site", "meta_id", F.col("place").cast("long").alias("place"))


@query("""
WITH j AS (SELECT o_orderkey AS id, ['site', 'fresh', 'multisite'][CAST(o_orderkey % 3 AS INTEGER) + 1] AS spider, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'P' THEN 'running' ELSE 'finished' END AS state, o_custkey AS site FROM orders)
SELECT state, spider || '-' || replace('domain=' || site, '=', '_') AS name, count(*) AS n_jobs, min(id) AS first_id FROM j WHERE spider IN ('site', 'fresh') OR id = 7 GROUP BY 1, 2
""")
def job_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs of three states under derived names, those of two spiders or of one id."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_custkey")
    spider = F.get(F.array(F.lit("site"), F.lit("fresh"), F.lit("multisite")), (F.col("o_orderkey") % 3).cast("int"))
    state = F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "P", "running").otherwise("finished")
    j = o.select(F.col("o_orderkey").alias("id"), spider.alias("spider"), state.alias("state"), F.col("o_custkey").cast("string").alias("site"))
    name = F.concat("spider", F.lit("-"), F.replace(F.concat(F.lit("domain="), "site"), F.lit("="), F.lit("_")))
    return j.where(F.col("spider").isin("site", "fresh") | (F.col("id") == 7)).groupBy("state", name.alias("name")).agg(F.count("*").alias("n_jobs"), F.min("id").alias("first_id"))


#: Sites that one job may have.
JOB_SITES = 50


@query(f"""
WITH v AS (SELECT _id, bool_or(coalesce(ok, false)) AS ok FROM torrents_domain WHERE _id IS NOT NULL GROUP BY 1), r AS (SELECT _id, substr(_id, 1, 2) AS b, (row_number() OVER (PARTITION BY substr(_id, 1, 2) ORDER BY _id) - 1) // {JOB_SITES} AS part FROM v WHERE NOT ok)
SELECT 'site-' || replace(_id, '.', '_') AS job, 'http://' || _id AS start_urls FROM v WHERE ok
UNION ALL SELECT 'multisite-' || b || '-' || part, string_agg('http://' || _id, ',' ORDER BY _id) FROM r GROUP BY b, part
""")
def controller_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job for each promoted site; the others are merged into jobs of at most fifty sites, by the beginning of their name."""
    v = table(spark, sf_dir, "torrents_domain", "_id", "ok").where("_id IS NOT NULL").groupBy("_id").agg(F.max(F.coalesce("ok", F.lit(False))).alias("ok"))
    own = v.where("ok").select(F.concat(F.lit("site-"), F.replace("_id", F.lit("."), F.lit("_"))).alias("job"), F.concat(F.lit("http://"), "_id").alias("start_urls"))
    begin = F.substring("_id", 1, 2)
    # Sites, not visits: a name's beginning has few of them.
    part = F.floor((F.row_number().over(Window.partitionBy(begin).orderBy("_id")) - 1) / JOB_SITES).cast("string")
    rest = v.where("NOT ok").select(F.concat_ws("-", F.lit("multisite"), begin, part).alias("job"), F.concat(F.lit("http://"), "_id").alias("u"))
    return own.unionByName(rest.groupBy("job").agg(F.array_join(F.array_sort(F.collect_list("u")), ",").alias("start_urls")))


@query(r"""
SELECT doc_id, CASE WHEN regexp_matches(url, '(?i)\.html?$|/$|/[^./]*$') THEN substr(text, 1, 10000000) ELSE substr(text, 1, 500000) END AS body, (doc_id % 3)::INTEGER AS proxy FROM documents
""")
def capped_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies cut to a cap that depends on the extension of the address (a cap is what a proxy is for)."""
    page = F.col("url").rlike(r"(?i)\.html?$|/$|/[^./]*$")
    return table(spark, sf_dir, "documents", "doc_id", "url", "text").select("doc_id", F.substring("text", 1, F.when(page, 10_000_000).otherwise(500_000)).alias("body"), (F.col("doc_id") % 3).cast("int").alias("proxy"))


@query("SELECT visit_id, floor(date_diff('second', ingested_at, TIMESTAMP '2016-06-01') / 86400)::BIGINT AS age_days, date_diff('second', ingested_at, TIMESTAMP '2016-06-01') / 86400 < 2 OR coalesce(cko, 0) > 5 AS skip FROM torrents_domain WHERE ingested_at IS NOT NULL")
def age_and_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age of each visit in days at a fixed day, and whether its site is left alone."""
    t = table(spark, sf_dir, "torrents_domain", "visit_id", "ingested_at", "cko").where("ingested_at IS NOT NULL")
    now = F.lit("2016-06-01").cast("timestamp")
    s = F.unix_timestamp(now) - F.unix_timestamp(F.col("ingested_at").cast("timestamp"))
    return t.select("visit_id", F.floor(s / 86400).alias("age_days"), ((s / 86400 < 2) | (F.coalesce("cko", F.lit(0)) > 5)).alias("skip"))


@query(f"""
SELECT row_id, string_agg(coalesce(CAST(s._id AS VARCHAR), '0') || ':' || link, '||' ORDER BY pos) AS origins FROM {_LINKS} LEFT JOIN sources s ON {_host('link')} = s.d GROUP BY 1
""")
def origins_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovery pages written as source and address, in order."""
    s = table(spark, sf_dir, "sources", F.col("_id").alias("sid"), F.col("d").alias("h"))
    l = _links(spark, sf_dir).withColumn("h", ur.host(F.col("link"))).join(s, "h", "left")
    part = F.concat(F.coalesce(F.col("sid").cast("string"), F.lit("0")), F.lit(":"), "link")
    return l.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("pos", part.alias("p")))).alias("ps")).select("row_id", F.array_join("ps.p", "||").alias("origins"))


@query("""
WITH m AS (SELECT meta_id, list_filter(string_split_regex(lower(coalesce(title, '')), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM meta), t AS (SELECT meta_id, unnest(w) AS token FROM m)
SELECT token, count(*) AS n_rows, count(DISTINCT meta_id) AS n_pages FROM t GROUP BY 1 HAVING count(DISTINCT meta_id) > 1
""")
def title_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of titles that occur on more than one page."""
    t = table(spark, sf_dir, "meta", "meta_id", "title").select("meta_id", F.explode(F.filter(F.split(F.lower(F.coalesce("title", F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")).alias("token"))
    return t.groupBy("token").agg(F.count("*").alias("n_rows"), F.countDistinct("meta_id").alias("n_pages")).where("n_pages > 1")


@query("SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) FILTER (event_type <> 'click') AS counts FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def unset_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of each user by kind, with one key removed."""
    e = table(spark, sf_dir, "events", "user_id", "event_type").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    m = e.groupBy("user_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "n")))).alias("counts"))
    left = F.map_entries(F.map_filter("counts", lambda k, v: k != "click"))
    return m.select("user_id", F.nullif(F.array_join(F.array_sort(F.transform(left, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ","), F.lit("")).alias("counts"))


@query(r"""
SELECT info_id, regexp_full_match(infohash, '[0-9a-fA-F]{40}|[A-Za-z2-7]{32}') AS is_digest, regexp_full_match(infohash, '[A-Za-z2-7]*') AS is_base32, len(regexp_replace(infohash, '[^0-9_]', '', 'g')) > 3 AS is_ugly,
       'http://img.test/' || infohash || '.png' AS image, '//img.test/' || infohash || '.png' AS reference FROM torrent_info WHERE infohash IS NOT NULL
""")
def id_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of identifiers, and image addresses made absolute."""
    h = F.col("infohash")
    ref = F.concat(F.lit("//img.test/"), h, F.lit(".png"))
    i = table(spark, sf_dir, "torrent_info", "info_id", "infohash").where(h.isNotNull())
    return i.select("info_id", ur.is_digest(h).alias("is_digest"), ur.is_base32(h).alias("is_base32"), ur.is_ugly_id(h).alias("is_ugly"), ur.absolute_image(ref, F.lit("http://img.test")).alias("image"), ref.alias("reference"))


@query()
def unescaped_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions with entities resolved; SQL lacks the table of their names."""
    d = table(spark, sf_dir, "meta", "meta_id", "description").where("description IS NOT NULL")
    return d.select("meta_id", tx.unescaped(F.col("description")).alias("plain"))


def _next_is_description(tokens: Column) -> Column:
    """The token accepted as description: the first acceptable one, of shorter ones too right after a token that announces it.

    The announcement holds until a candidate has been looked at, so the tokens are folded
    in order.
    """
    start = F.struct(F.lit(None).cast("string").alias("best"), F.lit(False).alias("armed"))

    def step(acc: Column, t: Column) -> Column:
        long, short = F.length(t) > 60, acc["armed"] & (F.length(t) > 12)
        take = acc["best"].isNull() & (long | short)
        return F.struct(F.when(take, t).otherwise(acc["best"]).alias("best"), F.when(long | (F.length(t) > 12), F.lower(t).contains("description") | F.lower(t).contains("notes")).otherwise(acc["armed"] | F.lower(t).contains("description")).alias("armed"))

    return F.aggregate(tokens, start, step)["best"]


@query()
def announced_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "meta", "meta_id", "description").where("description IS NOT NULL")
    return d.select("meta_id", _next_is_description(F.split(tx.strip_tags(F.col("description")), "\n")).alias("found"))


@query(r"""
SELECT meta_id, CASE WHEN NOT regexp_matches(url, '^https?://') THEN url WHEN meta_id % 3 = 0 THEN coalesce(nullif(regexp_extract(url, '(?:/|=)([0-9]+)(?:[,/?&]|$)', 1), ''), url) WHEN meta_id % 3 = 1 THEN coalesce(nullif(regexp_extract(url, '([0-9a-fA-F]{40})', 1), ''), url) ELSE url END AS key FROM meta
""")
def extract_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses through the extractor that is called by name; without one they stay."""
    name = F.get(F.array(F.lit("number"), F.lit("digest"), F.lit("none")), (F.col("meta_id") % 3).cast("int"))
    return table(spark, sf_dir, "meta", "meta_id", "url").select("meta_id", plugins.extract(name, F.col("url")).alias("key"))


@query(f"SELECT {_host('url')} AS site, count(*) AS n_pages FROM meta WHERE title IS NOT NULL AND url IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def step_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through a pipeline of steps, one of which fails and is passed over."""
    steps = [lambda d: d.where("title IS NOT NULL AND url IS NOT NULL"), lambda d: d.select("no_such_column"), lambda d: d.groupBy(ur.host(F.col("url")).alias("site")).agg(F.count("*").alias("n_pages")), lambda d: d.where("n_pages > 1")]
    return plugins.pipeline(table(spark, sf_dir, "meta", "url", "title"), steps, on_error=lambda e: None)


@query("SELECT meta_id, split_part(CASE " + " ".join(f"WHEN lower(genre) IN ({', '.join(repr(w) for w in ws)}) THEN '{c}'" for c, ws in lx.CLASSES.items()) + " END, '_', 1) AS field FROM meta WHERE genre IS NOT NULL")
def field_of_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The field that a word belongs to: its class up to the underscore."""
    return table(spark, sf_dir, "meta", "meta_id", "genre").where("genre IS NOT NULL").select("meta_id", tx.field_of_class(tx.word_class(F.col("genre"))).alias("field"))


@query("SELECT doc_id, text AS plain FROM documents WHERE text IS NOT NULL")
def coerced_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of texts, in UTF-8 or Latin-1 where that holds them, read back whatever they are in."""
    d = table(spark, sf_dir, "documents", "doc_id", "text").where("text IS NOT NULL")
    latin = (F.col("doc_id") % 2 == 0) & ~F.col("text").rlike(r"[^\x00-\x7f\xa0-\xff]")
    return d.select("doc_id", tx.coerced(F.when(latin, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))).alias("plain"))
