"""Queries of the data-preparation operators that are not about language-model text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.packed import split_arrays, split_packed
from gleanery.operators.quantities import SOURCE_UNIT, bare_number, differing, infer_units, reconcile, settle, size_readings
from gleanery.operators.timestamps import normalise, same_second, second_classes
from gleanery.session import small_side, table


def _instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, grp, row_id, utc_second of all three columns of times."""
    # A fixed table of some twenty rows.
    zones = F.broadcast(table(spark, sf_dir, "crawlers", "crawler_id", "tz_name").dropDuplicates(["crawler_id"]))
    item = table(spark, sf_dir, "torrents_item", "item_id", "fid", "source_id").select(
        F.lit("torrents_item").alias("tbl"), F.col("source_id").cast("string").alias("grp"), F.col("item_id").alias("row_id"),
        F.regexp_replace("fid", r"^\*?[0-9]{1,3} *- *", "").alias("reading"), F.lit("UTC").alias("zone"),
    )
    info = table(spark, sf_dir, "torrent_info", "info_id", "creation_date", "infohash", "crawler_id").join(zones, "crawler_id", "left")
    site = table(spark, sf_dir, "torrents_domain", "visit_id", "ls", "_id", "crawler_id").join(zones, "crawler_id", "left")
    rows = item.unionByName(info.select(F.lit("torrent_info").alias("tbl"), F.col("infohash").alias("grp"), F.col("info_id").alias("row_id"), F.col("creation_date").alias("reading"), F.col("tz_name").alias("zone")))
    rows = rows.unionByName(site.select(F.lit("torrents_domain").alias("tbl"), F.col("_id").alias("grp"), F.col("visit_id").alias("row_id"), F.col("ls").alias("reading"), F.col("tz_name").alias("zone")))
    return normalise(rows, "reading", "zone", ["tbl", "grp", "row_id"])


def p2_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One UTC instant for each reading, null where it names none, and the version of the time-zone data."""
    return _instants(spark, sf_dir).select("tbl", "row_id", F.timestamp_seconds("utc_second").alias("instant"), "tz_version")


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one group that name one second, as a class with its size: linear where pairs are not."""
    return second_classes(_instants(spark, sf_dir), ["tbl", "grp"], "row_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_second(_instants(spark, sf_dir), ["tbl", "grp"], "row_id").select("tbl", "key_a", "key_b")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = table(spark, sf_dir, "meta", "meta_id", "item_id", "size").where(F.col("size").isNotNull())
    return meta.select("item_id", "meta_id", size_readings(F.col("size"), F.lit("B")).alias("readings"))


def _file_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id and the sum of the sizes of its files, of each file that names its item."""
    info = table(spark, sf_dir, "torrent_info", "info_id", "item_id", "filesizes").where(F.col("item_id").isNotNull() & F.col("filesizes").isNotNull())
    # The item's id stands in for the row's: only the sum is asked for.
    sizes = split_arrays(info.select("item_id", "filesizes"), {"filesizes": ("item_id", "number")})
    total = F.aggregate(F.transform("values", lambda v: F.regexp_replace(v, "[^0-9]", "").try_cast("double")), F.lit(0.0), lambda a, x: a + x)
    return sizes.select(F.col("row_id").alias("item_id"), total.alias("total")).where("total > 0")


def _identities(spark: SparkSession, sf_dir: str, pages: DataFrame) -> DataFrame:
    """item_id and a size in bytes that the item must have: its pages', where these have one reading, and its files'."""
    stated = pages.where(F.col("item_id").isNotNull() & (F.size("readings") == 1)).select("item_id", F.col("readings")[0].alias("total"))
    return stated.unionByName(_file_totals(spark, sf_dir))


def p5_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unit of each source's bare numbers, as the sizes of pages and files tell it."""
    return _units(spark, sf_dir, _identities(spark, sf_dir, _pages(spark, sf_dir)))


def _units(spark: SparkSession, sf_dir: str, identities: DataFrame) -> DataFrame:
    bare = table(spark, sf_dir, "torrents_item", "item_id", "source_id", "size").select("item_id", "source_id", bare_number(F.col("size")).alias("number")).where(F.col("number").isNotNull())
    return infer_units(bare.join(identities, "item_id"), "source_id", "number", "total")


def _items(spark: SparkSession, sf_dir: str, identities: DataFrame) -> DataFrame:
    """item_id and readings of the sizes of items, bare numbers in the unit that the identities give their source.

    Where these give no unique one, the unit that the source declares holds; where it
    declares none either, any.
    """
    declared = table(spark, sf_dir, "sources", F.col("_id").alias("source_id"), "size_unit").dropDuplicates(["source_id"])
    name = {v: k for k, v in SOURCE_UNIT.items()}
    inferred = F.when(F.col("unique"), F.element_at(F.create_map(*[F.lit(x) for f, k in name.items() for x in (float(f), k)]), F.col("factor")))
    # A row for each source; counted before it is broadcast.
    units = small_side(declared.join(_units(spark, sf_dir, identities), "source_id", "full").select("source_id", F.coalesce(inferred, "size_unit", F.lit("?")).alias("unit")))
    items = table(spark, sf_dir, "torrents_item", "item_id", "size", "source_id").where(F.col("size").isNotNull()).join(units, "source_id", "left")
    return items.select("item_id", size_readings(F.col("size"), F.coalesce("unit", F.lit("?"))).alias("readings"))


def p5_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stated size in bytes, by the reading that pages, items and files of one item agree on."""
    pages = _pages(spark, sf_dir)
    identities = _identities(spark, sf_dir, pages)
    items = _items(spark, sf_dir, identities)
    stated = items.where(F.size("readings") == 1).select("item_id", F.col("readings")[0].alias("total"))
    both = settle(pages, "meta_id", "item_id", stated, "total").select(F.lit("meta").alias("tbl"), F.col("meta_id").alias("row_id"), "bytes", "unique")
    key = F.col("item_id").alias("key")
    return both.unionByName(settle(items.select("item_id", key, "readings"), "item_id", "key", identities.select(key, "total"), "total").select(F.lit("torrents_item").alias("tbl"), F.col("item_id").alias("row_id"), "bytes", "unique"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    items = _items(spark, sf_dir, _identities(spark, sf_dir, pages))
    return differing(reconcile(pages.where(F.col("item_id").isNotNull()), items, "item_id")).select("item_id", "meta_id")


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = table(spark, sf_dir, "torrent_info", "info_id", "filepaths", "filesizes", "trackers")
    item = table(spark, sf_dir, "torrents_item", "item_id", "origins")
    a = split_packed(info, {"filepaths": ("info_id", "path"), "filesizes": ("info_id", "number"), "trackers": ("info_id", "address")})
    return a.unionByName(split_packed(item, {"origins": ("item_id", "reference")}))


def p7_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value for each row, with its position in the field."""
    return _values(spark, sf_dir).select("fld", "row_id", "pos", "value")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(spark, sf_dir).where("n_values > 1").select("fld", "row_id", F.col("pos").cast("int").alias("pos"))


QUERIES = {f.__name__: f for f in (p2_found, p2_instants, p2_classes, p5_found, p5_bytes, p5_units, p7_found, p7_values)}

ORACLE_SQL: dict[str, str] = {
    "p7_found": r"""
WITH c AS (
  SELECT 'origins' AS fld, item_id AS row_id, len(regexp_extract_all(origins, '(?:^|[\s|;,"''\[])[0-9]+:[^\s|;,"'']')) AS n FROM torrents_item
  UNION ALL SELECT 'trackers', info_id, len(regexp_extract_all(trackers, '[A-Za-z][A-Za-z0-9+.\-]*://')) FROM torrent_info
  UNION ALL SELECT 'filesizes', info_id, CASE WHEN regexp_matches(filesizes, '[0-9],[0-9]') AND NOT regexp_matches(filesizes, '[0-9]{4}') THEN len(regexp_extract_all(filesizes, '[0-9,]*[0-9]')) ELSE len(regexp_extract_all(filesizes, '[0-9]+')) END FROM torrent_info
  UNION ALL SELECT 'filepaths', info_id, len(regexp_extract_all(filepaths, '\.[A-Za-z0-9]{1,5}"?\s*(?:[|;,\r\n"\]]|///|$)')) FROM torrent_info)
SELECT fld, row_id, CAST(p AS INTEGER) AS pos FROM c, unnest(range(1, n + 1)) t(p) WHERE n > 1
""",
}
