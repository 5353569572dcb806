"""Queries of the operators on text, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.canon import map_values
from gleanery.llm.dedup import collapse
from gleanery.llm.encoding import garbled
from gleanery.llm.leak import leaked
from gleanery.llm.markup import clean, unwrapped, wrappers
from gleanery.llm.mix import counted, mix, shares
from gleanery.llm.repetition import repetition, repetitive
from gleanery.session import table


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled pieces of names, paths and titles with the text that was meant."""
    rows = table(spark, sf_dir, "torrents_item", F.lit("torrents_item").alias("tbl"), F.col("item_id").alias("row_id"), F.col("filename").alias("text"))
    rows = rows.unionByName(table(spark, sf_dir, "torrent_info", F.lit("torrent_info").alias("tbl"), F.col("info_id").alias("row_id"), F.col("filepaths").alias("text")))
    rows = rows.unionByName(table(spark, sf_dir, "meta", F.lit("meta").alias("tbl"), F.col("meta_id").alias("row_id"), F.col("title").alias("text")))
    return garbled(rows, ["tbl", "row_id"], "text")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_pieces(spark, sf_dir).select("tbl", "row_id").distinct()


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "torrent", F.lit("torrent").alias("tbl"), F.col("row_id"), F.col("_id").alias("value"))
    rows = rows.unionByName(table(spark, sf_dir, "meta", F.lit("meta").alias("tbl"), F.col("meta_id").alias("row_id"), F.col("infohash").alias("value")))
    return collapse(rows.where(F.col("value").isNotNull()), "tbl", "row_id", F.col("value"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).where("row_id > keep_id").select("tbl", "keep_id", F.col("row_id").alias("copy_id"))


def p3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each record, with its number of copies."""
    return _records(spark, sf_dir).where("row_id = keep_id").select("tbl", "keep_id", "copies")


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, sf_dir, "mix_targets", "source", "weight", "max_repeats")
    docs = counted(table(spark, sf_dir, "documents", "doc_id", "source", "text"), "doc_id", "source", "text")
    return mix(docs, "doc_id", "source", "n_tokens", targets), targets


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the mixture, with their number of copies."""
    return _mixture(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of all tokens that each source reaches."""
    mixed, targets = _mixture(spark, sf_dir)
    return shares(mixed, "source", "n_tokens", targets)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetitive(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text").select("doc_id")


def p10_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of repeated words of every document."""
    return repetition(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("category", "genre", "quality", "language")
    wide = table(spark, sf_dir, "meta", "meta_id", *fields)
    return wide.select("meta_id", F.explode(F.array(*[F.struct(F.lit(f).alias("fld"), F.col(f).alias("value")) for f in fields])).alias("x")).select("meta_id", "x.*").where(F.col("value").isNotNull())


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = table(spark, sf_dir, "canon_terms", "fld", "term_id", "name", "aliases")
    return map_values(_typed(spark, sf_dir), "fld", "value", terms, "term_id", "name", "aliases")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "canon_terms", "fld", F.col("name").alias("value")).distinct()
    wanted = _mapped(spark, sf_dir).where(F.col("term_id").isNotNull()).join(F.broadcast(names), ["fld", "value"], "left_anti")
    return _typed(spark, sf_dir).join(wanted, ["fld", "value"]).select("meta_id", "fld", "term_id")


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that stand for no entry, with the number of rows that have them."""
    lost = _mapped(spark, sf_dir).where(F.col("term_id").isNull()).select("fld", "value")
    counts = _typed(spark, sf_dir).groupBy("fld", "value").agg(F.count("*").alias("n_rows"))
    return counts.join(lost, ["fld", "value"])


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = table(spark, sf_dir, "meta", "meta_id", "url", "description").where(F.col("description").isNotNull())
    host = F.regexp_extract("url", r"^[a-z]+://(?:www\.)?([^/:?#]+)", 1)
    rows = meta.select(F.lit("meta").alias("tbl"), F.col("meta_id").alias("row_id"), host.alias("host"), F.col("description").alias("text"))
    info = table(spark, sf_dir, "torrent_info", "info_id", "comment").where(F.col("comment").isNotNull())
    # Comments come from files of no host; they share one group.
    return rows.unionByName(info.select(F.lit("torrent_info").alias("tbl"), F.col("info_id").alias("row_id"), F.lit("").alias("host"), F.col("comment").alias("text")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unwrapped(_marked(spark, sf_dir), ["tbl", "row_id"], "host", "text").where("n_marks > 0").select("tbl", "row_id")


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean text of every description and comment, as blocks and as lines."""
    return clean(_marked(spark, sf_dir), ["tbl", "row_id"], "host", "text")


def p6_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wrapper of each host."""
    found = wrappers(_marked(spark, sf_dir), ["tbl", "row_id"], "host", "text")[1]
    nodes = F.zip_with("names", "optional", lambda n, o: F.when(o, F.concat(n, F.lit("?"))).otherwise(n))
    return found.select("host", F.array_join(nodes, " ").alias("wrapper"), F.col("n").alias("n_rows"))


def p8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks with the number of words of the item in the passage."""
    return leaked(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", table(spark, sf_dir, "eval_items", "eval_id", "text"), "eval_id", "text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_passages(spark, sf_dir).select("doc_id", "eval_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_pieces, p3_found, p3_records, p4_found, p4_unmatched, p6_found, p6_clean, p6_wrappers, p8_found, p8_passages, p9_mix, p9_shares, p10_found, p10_share)}

_CANON = r"""
v AS (SELECT 'torrent' AS tbl, row_id, _id AS v FROM torrent UNION ALL SELECT 'meta', meta_id, infohash FROM meta),
s AS (SELECT tbl, row_id, regexp_matches(lower(v), '(?:^|[^\p{L}\p{N}])(?:xt|dn|xl|kt)\s*[=:]') AS labelled, regexp_replace(lower(v), '[^\p{L}\p{N}]', '', 'g') AS bare,
      string_split(regexp_replace(lower(v), '(^|[^\p{L}\p{N}])(xt|dn|xl|kt)\s*[=:]', chr(1) || '\2=', 'g'), chr(1))[2:] AS parts FROM v WHERE v IS NOT NULL),
k AS (SELECT tbl, row_id, CASE WHEN labelled THEN array_to_string(list_sort(list_transform(parts, lambda p: substr(p, 1, 3) || regexp_replace(substr(p, 4), '[^\p{L}\p{N}]', '', 'g'))), '|') WHEN regexp_full_match(bare, '[0-9a-f]{40}') THEN bare END AS k FROM s)
"""
_SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_REPEATS = rf"""
w AS (SELECT doc_id, list_filter(list_transform(string_split_regex(lower(coalesce(text, '')), '{_SPACE}'), lambda x: regexp_replace(x, '[^\p{{L}}\p{{N}}]', '', 'g')), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 5], ' ') AS gram FROM w, unnest(range(1, len(ws) - 4)) t(i)),
r AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, gram ORDER BY i) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(0, 6) t(k) GROUP BY 1)
"""

ORACLE_SQL: dict[str, str] = {
    "p3_found": f"WITH {_CANON}, m AS (SELECT tbl, row_id, min(row_id) OVER (PARTITION BY tbl, k) AS keep_id FROM k WHERE k IS NOT NULL) SELECT tbl, keep_id, row_id AS copy_id FROM m WHERE row_id > keep_id",
    "p3_records": f"WITH {_CANON} SELECT tbl, min(row_id) AS keep_id, count(*) AS copies FROM k WHERE k IS NOT NULL GROUP BY tbl, k",
    "p10_found": f"WITH {_REPEATS} SELECT doc_id FROM w JOIN c USING (doc_id) WHERE n >= 0.3 * len(ws)",
    "p10_share": f"WITH {_REPEATS} SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_repeated, coalesce(n, 0) / greatest(len(ws), 1) AS share FROM w LEFT JOIN c USING (doc_id)",
}
