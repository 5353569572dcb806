"""Paths on page trees: induction from known texts, anchoring, extraction, link and image choice.

All work on the rows that ``sources.dom.nodes`` makes of pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.urls import is_ugly_id

#: Paths through these elements name no field.
REJECTED = "/(?:script|style|select|noscript)|comment"
DOWNLOAD = r"\.torrent$|/download|/get/|[0-9a-fA-F]{40}"


def anchored(nodes: DataFrame, page: str) -> DataFrame:
    """Add ``short_path``: from the nearest ancestor (or the node itself) with a telling id or a class no other node has.

    An id of more than three digits and underscores tells nothing. Without an anchor the
    absolute path stays.
    """
    cls = F.col("attrs")["class"]
    uses = F.count("*").over(Window.partitionBy(page, F.col("tag"), cls))
    own = F.when(F.col("attrs")["id"].isNotNull() & (F.col("attrs")["id"] != "") & ~is_ugly_id(F.col("attrs")["id"]), F.concat(F.lit("//"), "tag", F.lit('[@id="'), F.col("attrs")["id"], F.lit('"]'))).when(
        cls.isNotNull() & (cls != "") & (uses == 1), F.concat(F.lit("//"), "tag", F.lit('[@class="'), cls, F.lit('"]'))
    )
    marked = nodes.withColumn("__own", own)
    anchors = marked.where(F.col("__own").isNotNull()).groupBy(page).agg(F.collect_list(F.struct(F.length("path").alias("n"), F.col("path").alias("p"), F.col("__own").alias("a"))).alias("__anchors"))
    # The anchors of one page are as few as its nodes with an id or a class of their own.
    near = F.array_max(F.filter("__anchors", lambda x: (F.col("path") == x["p"]) | F.col("path").startswith(F.concat(x["p"], F.lit("/")))))
    out = marked.join(anchors, page, "left").withColumn("__near", near)
    return out.withColumn("short_path", F.when(F.col("__near").isNotNull(), F.concat("__near.a", F.expr("substring(path, __near.n + 1)"))).otherwise(F.col("path"))).drop("__own", "__anchors", "__near")


def induce(nodes: DataFrame, page: str, values: DataFrame, field: str, value: str, home: DataFrame | None = None) -> DataFrame:
    """page, field, value, path: where the page shows the value of a field.

    Exact texts are taken before texts that only contain the value (in any case); of these
    the shortest, then the first node. Texts that the home page has at the same path are
    its frame and do not count; ``home`` has path and text, and page if they differ by page. Paths through scripts, and titles' headings for other
    fields, are rejected; so is a field that a page shows at more than one path. Null
    values and values that are nowhere on the page give no row.
    """
    texts = anchored(nodes, page).where(F.col("text") != "").select(page, "node_id", "path", "short_path", "text")
    if home is not None:
        by = [page, "path", "text"] if page in home.columns and "node_id" not in home.columns else ["path", "text"]
        texts = texts.join(home.select(*by).distinct(), by, "left_anti")
    offered = values.where(F.col(value).isNotNull() & (F.col(value) != "")).select(page, field, value).distinct()
    hits = offered.join(texts, page).where(F.lower("text").contains(F.lower(F.col(value))))
    exact = (F.col("text") != F.col(value)).cast("int")
    best = hits.groupBy(page, field, value).agg(F.min(F.struct(exact.alias("e"), F.length("text").alias("l"), "node_id", F.col("short_path").alias("path"))).alias("b"))
    ok = ~F.col("path").rlike(REJECTED) & ~((F.col(field) == "language") & F.col("path").contains("/a")) & ~((F.col(field) != "title") & F.col("path").rlike("/h1(?:$|\\[)|//h1"))
    found = best.select(page, field, value, F.col("b.path").alias("path")).where(ok)
    several = found.groupBy(page, field).agg(F.countDistinct("path").alias("n")).where(f"n > 1 AND {field} != 'category'")
    return found.join(several.select(page, field), [page, field], "left_anti")


def wrapper(induced: DataFrame, site: str, field: str) -> DataFrame:
    """site, field, path and votes; what the pages of a site agree on."""
    return induced.groupBy(site, field, "path").agg(F.count("*").alias("votes"))


def extract(nodes: DataFrame, page: str, site_of: DataFrame, learned: DataFrame, share: float = 0.3, segments: bool = False) -> DataFrame:
    """page, field, value, votes, trusted: what the wrapper of its site finds on each page.

    Only paths with more than one vote are tried; those above the bar (a share of the
    votes of all of them) are trusted. An image gives its source, a link under ``links``
    its address, everything else its text with that of the elements within it. What lies
    within another hit of the same field says nothing new. Empty values are left out.
    """
    tried = learned.where("votes > 1").withColumn("trusted", F.col("votes") > F.sum("votes").over(Window.partitionBy("site", "field")) * share)
    lazy = F.coalesce(F.col("attrs")["data-src"], F.col("attrs")["data-original"], F.col("attrs")["src"])
    shown = F.when(F.col("tag") == "img", lazy).when(F.col("field") == "links", F.col("attrs")["href"]).otherwise(F.col("whole_text"))
    at = anchored(nodes, page).join(site_of, page)
    hits = at.join(tried.withColumnRenamed("path", "short_path"), ["site", "short_path"]).withColumn("value", shown)
    # A hit below another one at the same page and field; both are as few as a page's hits.
    outer = hits.select(page, "field", F.col("path").alias("__outer"))
    within = hits.join(outer, [page, "field"]).where(F.col("path").startswith(F.concat("__outer", F.lit("/")))).select(page, "field", "path").distinct()
    hits = hits.join(within, [page, "field", "path"], "left_anti")
    return hits.where("value IS NOT NULL AND value != ''").select(page, "field", "value", "votes", "trusted", F.col("short_path").alias("path"))


def download_paths(nodes: DataFrame, page: str, pattern: str = DOWNLOAD) -> DataFrame:
    """Short paths of links that look like downloads; the first node where paths repeat."""
    href = F.substring_index(F.col("attrs")["href"], "?", 1)
    links = anchored(nodes, page).where((F.col("tag") == "a") & href.rlike(pattern))
    return links.groupBy(page, F.col("short_path").alias("path")).agg(F.min_by(F.col("attrs")["href"], "node_id").alias("href"))


def chosen_image(images: DataFrame, page: str) -> DataFrame:
    """page and src of the one image that stands for the page.

    ``images`` has page, src, width, height, off_domain. Images on over half of all pages
    are frame; then four size limits are tried in order (over 100 both ways, at least 100
    both ways, over 100 one way, at least 100 one way). Of those left, pairs of nearly
    equal size (within 3 both ways) go, and foreign ones where there are more than one. A
    page with exactly one left under the first limit that yields one has it.
    """
    pages = images.select(page).distinct()
    n = images.agg(F.countDistinct(page).alias("n"))
    frame = images.groupBy("src").agg(F.countDistinct(page).alias("on")).crossJoin(F.broadcast(n)).where(F.expr("on > n div 2 AND n > 1")).select("src")
    left = images.join(frame, "src", "left_anti").dropDuplicates([page, "src"])
    w, h = F.col("width"), F.col("height")
    limits = [(w > 100) & (h > 100), (w >= 100) & (h >= 100), (w > 100) | (h > 100), (w >= 100) | (h >= 100)]
    modes = left.select("*", F.explode(F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in enumerate(limits)]), lambda x: x.isNotNull())).alias("mode"))
    a, b = modes.alias("a"), modes.select(page, "mode", F.col("src").alias("s2"), F.col("width").alias("w2"), F.col("height").alias("h2")).alias("b")
    twins = a.join(b, [page, "mode"]).where((F.col("src") != F.col("s2")) & (F.abs(F.col("width") - F.col("w2")) < 3) & (F.abs(F.col("height") - F.col("h2")) < 3)).select(page, "mode", "src").distinct()
    rest = modes.join(twins, [page, "mode", "src"], "left_anti").withColumn("k", F.count("*").over(Window.partitionBy(page, "mode"))).where("k = 1 OR NOT off_domain")
    single = rest.groupBy(page, "mode").agg(F.count("*").alias("k"), F.min("src").alias("src")).where("k = 1")
    return pages.join(single.groupBy(page).agg(F.min_by("src", "mode").alias("src")), page)


def cascade(record: DataFrame) -> DataFrame:
    """Fill the gaps of extracted records: fields follow from each other in a fixed order.

    Columns used: title, description, category, subcategory, genre, quality, season,
    episode, image. Adds keywords, item_schema and tags. Present values are never replaced.
    """
    from gleanery.functions import text as tx

    season, episode = tx.season_episode(F.col("title"))
    image = F.nullif(F.regexp_extract("description", r'(?i)<img[^>]*src="([^"]+)"', 1), F.lit(""))
    keys = tx.keywords(F.col("title"))
    from gleanery.functions import lexicon as lx

    quality = F.try_element_at(F.filter(keys, lambda k: k.isin(list(lx.words("quality")))), F.lit(1))
    out = record.withColumns({"keywords": F.array_join(keys, ","), "quality": F.coalesce("quality", quality), "image": F.coalesce("image", image), "season": F.coalesce("season", season), "episode": F.coalesce("episode", episode)})
    category = F.coalesce("category", tx.category_of_subcategory(F.col("subcategory")), tx.category_of_genre(F.col("genre")), F.when(F.col("season").isNotNull(), F.lit("series")))
    out = out.withColumn("category", category)
    return out.withColumns({"item_schema": tx.schema_of(F.col("category"), F.col("genre"), F.col("quality")), "tags": tx.tags_of(F.col("category"))})


#: Classes of frames whose pictures are advertisements.
AD_CLASSES = ("ads", "promo")


def image_paths(nodes: DataFrame, page: str, images: DataFrame, src: str) -> DataFrame:
    """page, src and path: where the page shows a known image; no row if it is in a frame of advertisements.

    Nodes whose source ends in that of the image, apart from its host, are candidates; the
    one with the shortest source counts, then the first. The path is anchored at the
    nearest ancestor with a telling id or a class no other node has.
    """
    at = anchored(nodes, page)
    tail = F.regexp_replace(F.col(src), "^[A-Za-z][A-Za-z0-9+.\\-]*://[^/]*/", "")
    shown = F.coalesce(F.col("attrs")["data-src"], F.col("attrs")["data-original"], F.col("attrs")["src"])
    offered = images.where(F.col(src).isNotNull() & (F.col(src) != "")).select(page, F.col(src).alias("__src"), tail.alias("__tail")).distinct()
    hits = at.where(F.col("tag") == "img").withColumn("__shown", shown).join(offered, page).where(F.col("__shown").endswith(F.col("__tail")))
    best = hits.groupBy(page, "__src").agg(F.min(F.struct(F.length("__shown").alias("n"), "node_id", F.col("short_path").alias("path"), F.col("path").alias("full"))).alias("b"))
    # An image lies in a frame if the frame's path begins its own.
    ads = nodes.where(F.exists(F.array(*map(F.lit, AD_CLASSES)), lambda c: F.coalesce(F.col("attrs")["class"], F.lit("")).startswith(c))).select(page, F.col("path").alias("frame"))
    inside = best.join(ads, page).where(F.col("b.full").startswith(F.concat("frame", F.lit("/")))).select(page, "__src").distinct()
    return best.join(inside, [page, "__src"], "left_anti").select(page, F.col("__src").alias(src), F.col("b.path").alias("path"))
