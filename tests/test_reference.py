"""The engine's own operators on small fixtures, and every query against its SQL on a small scale."""

import hashlib
import struct

import pytest
from pyspark.sql import functions as F

from gleanery.functions import text as tx
from gleanery.functions import urls as ur
from gleanery.operators import matching, paths, state, votes
from gleanery.plans import reference
from gleanery.sources import dom, files, images, metainfo

DATA = "/root/testdata/sf0.001"


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x


@pytest.mark.parametrize("size, value", [("1.5 MB", 1572864), ("2 KiB", 2048), ("size 2.5", 2621440), ("12 of 15 MB", None), ("nan MB", None), (None, None), ("7", None)])
def test_page_size(spark, size, value):
    assert one(spark, tx.page_size(F.lit(size).cast("string"))) == value


def test_text_functions(spark):
    assert one(spark, tx.infohash(F.lit("x" + "aB" * 20))) == "AB" * 20
    assert one(spark, tx.is_category(F.lit("new film"))) and not one(spark, tx.is_category(F.lit("a new film"))) and not one(spark, tx.is_category(F.lit(None).cast("string")))
    assert one(spark, tx.is_synonym(F.lit("Movie"), F.lit("film"))) and one(spark, tx.is_synonym(F.lit(""), F.lit("x"))) and not one(spark, tx.is_synonym(F.lit("book"), F.lit("film")))
    assert one(spark, tx.is_script(F.lit("var x = function() {\n}\n")))
    assert one(spark, tx.strip_tags(F.lit("<p>a &amp;lt; b</p><script>x</p></script><br>c"))) == "a &lt; b\n\nx\n\n\nc"  # ends of paragraphs are two line ends
    assert one(spark, tx.strip_tags(F.lit('<head><title>t</title></head> <body> <a href="/x">one</a><br />two')) ) == "/x\ntwo"
    got = one(spark, tx.valid_meta("season", F.lit("S03E07"), F.lit("")))
    assert (got.valid, got.value) == (True, "03")
    assert one(spark, tx.tags_of(F.lit("Television Series"))) == "moving,episodic"


def test_unescaping(spark):
    df = spark.createDataFrame([("a &eacute; &#233; &amp;lt;",), ("plain",), (None,)], "s string")
    assert [r.x for r in df.select(tx.unescaped(F.col("s")).alias("x")).collect()] == ["a é é &lt;", "plain", None]


def test_url_functions(spark):
    u = F.lit("http://www.a.b.test:80/x/y.html?q#f")
    assert one(spark, ur.host(u)) == "a.b.test" and one(spark, ur.registered_domain(u)) == "b.test"
    assert one(spark, ur.resolve(u, F.lit("z"))) == "http://www.a.b.test:80/x/z" and one(spark, ur.resolve(u, F.lit("/z"))) == "http://www.a.b.test:80/z" and one(spark, ur.resolve(F.lit("http://a.test"), F.lit("z"))) == "http://a.test/z"
    assert one(spark, ur.host(F.lit("no address"))) == "" and one(spark, ur.decoded(F.lit("a+b%20c"))) == "a+b c"
    digest = hashlib.sha1(b"x").digest()
    import base64

    assert one(spark, ur.canonical_digest(F.lit(base64.b32encode(digest).decode()))) == digest.hex().upper()
    assert one(spark, ur.canonical_digest(F.lit("a" * 40))) == "A" * 40 and one(spark, ur.canonical_digest(F.lit("x"))) is None
    import zlib

    c = zlib.crc32(b"udp://x")
    assert one(spark, ur.signed_crc(F.lit("udp://x"))) == str(c - 2**32 if c >= 2**31 else c)


def test_ties_go_to_the_smallest_value(spark):
    df = spark.createDataFrame([("s", "b"), ("s", "a"), ("s", "a"), ("s", "b"), ("s", None)], "site string, v string")
    assert votes.mode_of(df, ["site"], "v").first().v == "a"
    assert votes.mode_of(df.limit(0), ["site"], "v").count() == 0


def test_prefix_and_suffix_hold_for_all(spark):
    urls = ["http://a.test/t/1/x.html", "http://a.test/t/22/y.html", "http://a.test/t/3/z.html", None]
    r = votes.prefix_and_suffix(spark.createDataFrame([("a", u) for u in urls], "site string, url string"), "site", "url").first()
    assert (r.prefix, r.suffix) == ("http://a.test/t/", ".html")


def test_totals_of_packed_files(spark):
    rows = [(1, "8962853848,3378274919", "udp://a:1/x,1 udp://a:1/x,1"), (2, "4,406,997,494; 690,511,773", "udp://a:1\nhttp://b/;v=2"), (3, '"250,541,845","1,816,700"', None), (4, "12 34|56", ""), (5, "276521243,,7", "udp://a:1"), (6, None, "udp://a:1"), (7, " ;; ", "udp://a:1")]
    df = spark.createDataFrame(rows, "info_id long, filesizes string, trackers string")
    got = {r.info_id: (r.total, r.n_trackers) for r in reference.totals(df).collect()}
    assert got == {1: (12341128767, 1), 2: (5097509267, 2), 3: (252358545, None), 4: (102, 0), 5: (276521250, 1), 6: (None, 1), 7: (0, 1)}
    assert reference.totals(df.limit(0)).count() == 0


def test_pages_and_files_of_other_sizes_are_not_the_same(spark):
    sizes = [(1, "1000"), (2, "1009"), (3, "1011"), (4, "1.5 KB"), (5, None), (6, "?? MB"), (7, "1.000")]
    pages = spark.createDataFrame([(9, k, "AB", "red fox", size) for k, size in sizes], "item_id long, meta_id long, infohash string, title string, size string")
    info = spark.createDataFrame([(9, 1, "ab", "Red Fox", "600|400", None), (9, 2, "ab", None, "100000,900000", None), (9, 3, None, None, None, None), (9, 4, "ab", "x", "1000", None), (9, 5, "cd", None, "1000", None), (9, 6, "ab", None, "0", None), (None, 7, "ab", None, "1000", None)], "item_id long, info_id long, infohash string, filedir string, filesizes string, trackers string")
    got = {(r.meta_id, r.info_id): r.same_item for r in reference.agreement(pages, info).collect()}
    assert len(got) == 42
    assert [k for k, _ in sizes if got[k, 4] or got[k, 5]] == []
    assert [k for k, _ in sizes if got[k, 3]] == [k for k, _ in sizes if got[k, 6]] == [1, 2, 3, 4, 5, 6, 7]
    assert [k for k, _ in sizes if got[k, 2]] == [5, 6] and [k for k, _ in sizes if got[k, 1]] == [1, 2, 5, 6, 7]


def test_template(spark):
    pages = [(1, ["size", "12", "end"]), (2, ["size", "13", "end"]), (3, ["size", "14"]), (4, ["size", "12", "end", "more"])]
    df = spark.createDataFrame([("s", k, t) for k, t in pages], "site string, page long, tokens array<string>")
    got = {r.pos: (r.n_differ, r.is_variable) for r in votes.template_positions(df, "site", "page", "tokens").collect()}
    assert got == {0: (0, False), 1: (2, True), 2: (1, False)}


def test_near_join_equals_a_full_comparison(spark):
    import random

    rnd = random.Random(3)
    a = [(k, rnd.choice([0.0, -1.0, rnd.uniform(1, 5000)])) for k in range(300)] + [(900, 99.0), (901, None)]
    b = [(k, rnd.uniform(1, 5000)) for k in range(300)] + [(900, 100.0)]
    got = {(r.i, r.j) for r in matching.near_join(spark.createDataFrame(a, "i long, x double"), spark.createDataFrame(b, "j long, y double"), "x", "y").collect()}
    assert got == {(i, j) for i, x in a for j, y in b if x and x > 0 and 0.99 <= x / y <= 1.01} and (900, 900) in got


def test_state(spark):
    now = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, t long")
    new = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 2), (None, "x", 9)], "k long, v string, t long")
    assert {(r.k, r.v) for r in state.upsert(now, new, ["k"], ["t"]).collect()} == {(1, "a"), (2, "d"), (3, "e")}
    assert state.insert_missing(now, new.where("k IS NOT NULL"), ["k"]).count() == 3
    runs = spark.createDataFrame([("s", n, ok) for n, ok in enumerate([True, False, False, True, False, False, False, True])], "g string, n long, ok boolean")
    assert [r.n for r in state.failure_cut(runs, "g", "n", "ok", 2).orderBy("n").collect()] == [0, 1, 2, 3, 4, 5]


PAGE = '<html><body><div id="nav1234"><a href="/">Home</a></div><article class="item"><h1>Blue Door</h1><ul><li>Size<li><b>12 MB</b></ul><p>A long text about the door <img src="/d.png"></p><a href="/get/1.torrent?x=1">file</a></article><script>if (a</p>) x</script></body>'


def pages_of(spark):
    rows = [(k, PAGE.replace("Blue Door", f"{w} Door").replace("12 MB", f"{k} MB")) for k, w in enumerate(("Blue", "Red", "Old"), 1)]
    return spark.createDataFrame([*rows, (9, None), (10, "")], "page long, html string")


def test_nodes_and_induction_round_trip(spark):
    nodes = dom.nodes(pages_of(spark), "page", "html").cache()
    assert nodes.select("page").distinct().count() == 3
    values = spark.createDataFrame([(1, "title", "Blue Door"), (2, "title", "red door"), (3, "title", "Old Door"), (1, "size", "1 MB"), (2, "size", "2 MB"), (3, "size", None), (1, "title2", "nowhere")], "page long, field string, value string")
    known = paths.induce(nodes, "page", values, "field", "value")
    assert {r.path for r in known.where("field = 'title'").collect()} == {'//article[@class="item"]/h1'}
    sites = nodes.select("page").distinct().withColumn("site", F.lit("s"))
    learned = paths.wrapper(known.join(sites, "page"), "site", "field")
    got = {(r.page, r.field): r.value for r in paths.extract(nodes, "page", sites, learned).collect()}
    assert got[2, "title"] == "Red Door" and got[3, "size"] == "3 MB"  # a path learned on two pages reads the third
    links = paths.download_paths(nodes, "page").collect()
    assert {r.path for r in links} == {'//article[@class="item"]/a'}
    assert not [r for r in dom.read_page(PAGE) if r[2] == "p" and "if" in r[6]]


def test_frame_of_the_home_page_does_not_count(spark):
    nodes = dom.nodes(pages_of(spark), "page", "html")
    values = spark.createDataFrame([(1, "category", "Home")], "page long, field string, value string")
    assert paths.induce(nodes, "page", values, "field", "value").count() == 1
    assert paths.induce(nodes, "page", values, "field", "value", nodes.where("page = 2")).count() == 0


def test_image_choice(spark):
    rows = [(p, "logo", 300, 300, False) for p in (1, 2, 3)] + [(1, "a", 200, 300, False), (2, "b", 200, 200, False), (2, "c", 201, 201, False), (2, "d", 100, 150, False), (3, "e", 400, 90, True)]
    got = {r.page: r.src for r in paths.chosen_image(spark.createDataFrame(rows, "page long, src string, width int, height int, off_domain boolean"), "page").collect()}
    assert got == {1: "a", 2: "d", 3: "e"}


def test_cascade(spark):
    row = spark.createDataFrame([("Door S02E05 flac 720p", '<img alt="" src="/i.png">', None, None, None, None, None, None, None)], "title string, description string, category string, subcategory string, genre string, quality string, season string, episode string, image string")
    r = paths.cascade(row).first()
    assert (r.category, r.season, r.episode, r.quality, r.image, r.item_schema, r.tags) == ("series", "02", "05", "720p", "/i.png", "video", "moving,episodic")


def test_metainfo():
    info = b"d5:filesld6:lengthi3e4:pathl1:a1:beed6:lengthi4e4:pathl1:ceee4:name1:d10:name.utf-82:\xc3\xa9e"
    raw = b"d7:comment3:x\ny13:creation datei1273057659e4:info" + info + b"5:nodesll1:hi7eeee"
    got = metainfo.metainfo(raw)
    assert got["infohash"] == hashlib.sha1(info).hexdigest().upper() and got["size"] == 7 and got["name"] == "é"
    assert [f["path"] for f in got["files"]] == ["a/b", "c"] and got["trackers"] == [] and got["comment"] == "x<br />y" and got["creation_date"] == "05-05-2010 11:07:39" and got["nodes"] == ["h:7"]
    for bad in (None, b"", b"d3:", b"de", b"5:ab"):
        assert metainfo.metainfo(bad)["error"]


def test_magnets():
    hex_ = "abcdef" * 6 + "2345"
    got = metainfo.magnet(f"magnet:?xt=urn:btih:{hex_}&amp;dn=a%20b&tr=udp%3A%2F%2Fx&tr=udp%3A%2F%2Fx&tr=http://y&xl=5")
    assert (got["infohash"], got["name"], got["trackers"], got["size"]) == (hex_.upper(), "a b", ["udp://x", "http://y"], 5)
    assert metainfo.magnet("magnet:?xt=urn:btih:" + "A" * 32)["infohash"] == "0" * 40 and metainfo.magnet(None)["error"] and metainfo.magnet("magnet:?dn=x")["error"]


def test_images():
    assert images.dimensions(b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + struct.pack(">II", 640, 480)) == (640, 480)
    jpeg = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"xx" + b"\xff\xc0" + struct.pack(">HBHH", 11, 8, 48, 64)
    assert images.dimensions(jpeg) == (64, 48) and images.dimensions(b"text") == (None, None) and images.dimensions(None) == (None, None)


def test_files(spark, tmp_path):
    (tmp_path / "seeds.csv").write_text("1,torrents.test\n2,other.test\n3,mytorrent.test\n3,mytorrent.test\n")
    assert {r.domain for r in files.read_seeds(spark, str(tmp_path / "seeds.csv"), "torrent", ("mytorrent.test",)).collect()} == {"torrents.test"}
    lines = spark.sql("SELECT timestamp'2010-05-05 11:07:39' AS ts, 'a' AS line UNION ALL SELECT timestamp'2010-05-05 12:00:00', 'b'")
    files.write_hourly(lines, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"hour=2010-05-05-11", "hour=2010-05-05-12"}
    lines = files.report_lines(spark.createDataFrame([("s", "t", "a<b"), ("s", "a", None), ("z", "t", "x")], "site string, field string, value string"), "site", "field", "value")
    files.write_report(lines, str(tmp_path / "report"))
    written = "".join(p.read_text() for p in sorted((tmp_path / "report" / "site=s").glob("*.txt"))).replace("\n", "")
    assert written == "<table><tr><td>a</td><td></td></tr><tr><td>t</td><td>a&lt;b</td></tr></table>" and (tmp_path / "report" / "site=z").is_dir()


def test_every_query_agrees_with_its_sql(spark):
    import glob
    import os

    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    plain = lambda v: None if v is None else tuple(map(plain, v)) if isinstance(v, (list, tuple)) else round(v, 6) if isinstance(v, float) else int(v) if isinstance(v, int) else str(v)
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    for name in sql:
        got = queries[name](spark, DATA)
        want = con.execute(sql[name])
        columns = [c[0] for c in want.description]
        assert sorted(got.columns) == sorted(columns), name
        a = sorted(repr(plain(tuple(r))) for r in got.select(*columns).collect())
        b = sorted(repr(plain(tuple(r))) for r in want.fetchall())
        assert a == b, name


def test_no_query_is_empty(spark):
    """A query that gives no row on either side shows nothing: all give some, here or on the next scale."""
    import __spark_entry__ as entry
    from gleanery.plans import crawl, problems, reference

    for plans in (reference, crawl, problems):
        for name in plans.QUERIES:
            assert any(not plans.QUERIES[name](spark, d).isEmpty() for d in (DATA, DATA.replace("0.001", "0.01"))), name
    assert entry.entry(spark).count() > 0


def test_found_queries_give_each_row_once(spark):
    from gleanery.plans.problems import QUERIES

    for name, columns in {"p2_found": ["tbl", "key_a", "key_b"], "p5_found": ["item_id", "meta_id"], "p7_found": ["fld", "row_id", "pos"]}.items():
        df = QUERIES[name](spark, DATA)
        assert df.columns == columns and df.count() == df.distinct().count() > 0


def rows_of(name, columns):
    import pandas as pd

    return pd.read_parquet(f"{DATA}/{name}.parquet", columns=columns)


def test_tracker_ids_equal_the_standard_checksum(spark):
    import re
    import zlib

    got = {r.info_id: r.tracker_id for r in reference.tracker_ids(spark, DATA).collect()}
    want = {}
    for r in rows_of("torrent_info", ["info_id", "trackers"]).dropna().itertuples():
        found = re.search(r"([a-z]+://[^ |;,]+)", r.trackers)
        c = zlib.crc32((found[1] if found else "").encode())
        want[r.info_id] = str(c - 2**32 if c >= 2**31 else c)
    assert got == want


def test_magnets_of_the_table(spark):
    import re

    got = {r.row_id: (r.infohash, r.error) for r in reference.magnet_decode(spark, DATA).collect()}
    for r in rows_of("torrent", ["row_id", "_id"]).dropna().itertuples():
        if r.row_id in got and got[r.row_id][1] is None:
            assert got[r.row_id][0].lower() in re.sub("[^0-9a-z]", "", r._2.lower())
    assert sum(e is None for _, e in got.values()) == len(got) > 50


def test_unescaped_equals_the_standard_library(spark):
    import html

    from gleanery.plans import crawl

    want = {r.meta_id: html.unescape(r.description) for r in rows_of("meta", ["meta_id", "description"]).dropna().itertuples()}
    assert {r.meta_id: r.plain for r in crawl.unescaped_descriptions(spark, DATA).collect()} == want


def test_packed_totals_equal_a_plain_sum(spark):
    import re

    got = {r.info_id: r.total for r in reference.file_totals(spark, DATA).collect()}
    for r in rows_of("torrent_info", ["info_id", "filesizes"]).dropna().itertuples():
        if not re.search("[0-9][,.'][0-9]", r.filesizes):
            assert got[r.info_id] == sum(map(int, re.findall("[0-9]+", r.filesizes)))


def test_top_k_and_numbers(spark):
    import random

    from gleanery.operators import ranking

    rnd = random.Random(4)
    rows = [("hot" if k % 3 else f"g{k % 7}", rnd.randrange(50), k) for k in range(3000)] + [(None, 1, 9000)]
    df = spark.createDataFrame(rows, "g string, v int, k long")
    got = {(r.g, r.k, r.place) for r in ranking.top_k(df, "g", [F.desc("v"), "k"], 5).collect()}
    want = {(g, k, n + 1) for g in {x[0] for x in rows} for n, (_, v, k) in enumerate(sorted((x for x in rows if x[0] == g), key=lambda x: (-x[1], x[2]))[:5])}
    assert got == want
    assert {(r.k, r.n) for r in ranking.numbered(df.select("k"), "k").collect()} == {(k, n + 1) for n, k in enumerate(sorted(x[2] for x in rows))}
    assert ranking.numbered(df.select("k").limit(0), "k").count() == 0 == ranking.top_k(df.limit(0), "g", ["k"], 5).count()


def test_image_paths(spark):
    page = '<div id="main"><p><img src="http://a.test/x/pic.png"></p></div><div class="ads-top"><img src="/x/other.png"></div><img data-src="/x/lazy.png" src="/blank.gif">'
    nodes = dom.nodes(spark.createDataFrame([(1, page)], "page long, html string"), "page", "html")
    images_ = spark.createDataFrame([(1, "http://b.test/x/pic.png"), (1, "http://b.test/x/other.png"), (1, "http://b.test/x/lazy.png"), (1, "http://b.test/none.png"), (1, None)], "page long, src string")
    got = {r.src: r.path for r in paths.image_paths(nodes, "page", images_, "src").collect()}
    assert got == {"http://b.test/x/pic.png": '//div[@id="main"]/p/img', "http://b.test/x/lazy.png": "/img"}


def test_text_of_an_element_holds_that_of_all_within_it():
    rows = {r[2]: r[7] for r in dom.read_page("<div>a <b>b <i>c</i></b> d<p>e</p></div>")}
    assert rows == {"div": "a b c d e", "b": "b c", "i": "c", "p": "e"}


def test_a_stream_counts_its_open_hours_too(spark, tmp_path):
    import pandas as pd

    times = pd.to_datetime([f"2010-05-05 {11 + k}:07:39" for k in range(5)]).astype("datetime64[us]")
    pd.DataFrame({"event_id": range(5), "ts": times, "event_type": "a"}).to_parquet(tmp_path / "events.parquet")
    got = reference.stream_hourly_counts(spark, str(tmp_path))
    assert got.count() == 5 and got.agg({"n_lines": "sum"}).first()[0] == 5


def test_coerced(spark):
    rows = [(1, "caf\u00e9".encode()), (2, "caf\u00e9".encode("latin-1")), (3, b"<meta charset=koi8-r> " + "\u043c\u043e\u0441\u0442".encode("koi8-r")), (4, None), (5, b""), (6, b"\xff\xfea\x00")]
    got = {r.k: r.t for r in spark.createDataFrame(rows, "k long, raw binary").select("k", tx.coerced(F.col("raw")).alias("t")).collect()}
    assert got == {1: "caf\u00e9", 2: "caf\u00e9", 3: "<meta charset=koi8-r> \u043c\u043e\u0441\u0442", 4: None, 5: "", 6: "a"}


def test_plugins(spark):
    from gleanery.functions import plugins

    df = spark.createDataFrame([("number", "http://a.test/t/12,x"), ("none", "http://a.test/1"), ("number", "magnet:?1"), (None, "http://a.test/3")], "n string, u string")
    assert [r.x for r in df.select(plugins.extract(F.col("n"), F.col("u")).alias("x")).collect()] == ["12", "http://a.test/1", "magnet:?1", "http://a.test/3"]
    seen = []
    assert plugins.pipeline(df, [lambda d: d.select("nope"), lambda d: d.limit(1)], seen.append).count() == 1 and len(seen) == 1
    with pytest.raises(Exception):
        plugins.pipeline(df, [lambda d: d.select("nope")])


def test_repeats_in_later_batches(spark, tmp_path):
    import pandas as pd

    from gleanery.session import drained
    from gleanery.streaming import views

    for n, (hours, keys) in enumerate([((1, 2, 3), "aab"), ((9, 10), "ac"), ((20, 21), "bd")]):
        times = pd.to_datetime([f"2010-05-05 {h:02d}:00:00" for h in hours]).astype("datetime64[us]")
        pd.DataFrame({"k": list(keys), "ts": times}).to_parquet(tmp_path / f"{n}.parquet")
    stream = lambda: spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    once = drained(views.visited_once(stream(), ["k"]))
    assert sorted(r.k for r in once.collect()) == ["a", "b", "c", "d"]
    # Keys that the watermark has passed count as new when they come again.
    late = drained(views.visited_once(stream(), ["k"], delay="1 hour"))
    got = [r.k for r in late.collect()]
    assert set(got) == set("abcd") and len(got) >= 4  # when the state of a key goes is up to the engine


def test_runs_of_failures_across_ranges(spark):
    import random

    rnd = random.Random(8)
    rows = [(rnd.choice(["hot", "hot", "hot", "a", "b", None]), k, rnd.random() < 0.45 if k % 211 > 40 else None if k % 2 else False) for k in range(1500)]
    want, state_ = set(), {}
    for g, k, ok in rows:
        run, stopped = state_.get(g, (0, False))
        run = 0 if ok else run + 1
        stopped = stopped or run > 25
        state_[g] = run, stopped
        if not stopped:
            want.add((g, k, run))
    df = spark.createDataFrame(rows, "g string, k long, ok boolean")
    got = [(r.g, r.k, r.failures) for r in state.failure_cut(df, "g", "k", "ok", 25).collect()]
    assert len(got) == len(set(got)) and set(got) == want and any(s for _, s in state_.values())
    assert state.failure_cut(df.limit(0), "g", "k", "ok").count() == 0
