import pytest

from gleanery.operators.packed import split_packed


def values(spark, kind, text):
    df = spark.createDataFrame([(1, text, "extra")], "id long, packed string, value string")
    rows = split_packed(df.withColumnRenamed("packed", "skel"), {"skel": ("id", kind)}).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, len(rows) + 1))
    return [r.value for r in rows]


@pytest.mark.parametrize(
    "kind, text, expected",
    [
        ("reference", "5:http://a.test/x||7:ABC", ["5:http://a.test/x", "7:ABC"]),
        ("reference", "5:http://a.test/view;sid=1/2; 7:ABC; ", ["5:http://a.test/view;sid=1/2", "7:ABC"]),
        ("reference", '["5:http://a.test/t/1,x.html", "7:ABC"]', ["5:http://a.test/t/1,x.html", "7:ABC"]),
        ("reference", "5:http://a.test/x\n7:ABC\n", ["5:http://a.test/x", "7:ABC"]),
        ("address", "udp://a:1/x,1 udp://a:1/x,1", ["udp://a:1/x,1", "udp://a:1/x,1"]),
        ("address", '"udp://a:1|x";"http://b/;v=2"', ["udp://a:1|x", "http://b/;v=2"]),
        ("path", "CD/01 a, b.mkv///02 c; live.mkv", ["CD/01 a, b.mkv", "02 c; live.mkv"]),
        ("path", "01 a; b.mkv; 02 c.srt;; 03.mkv; ", ["01 a; b.mkv", "02 c.srt", "03.mkv"]),
        ("path", '"a, x.mkv","b.mkv"', ["a, x.mkv", "b.mkv"]),
        ("path", "a.mkv\r\nb.mkv///c.mkv", ["a.mkv", "b.mkv", "c.mkv"]),
        ("path", "Border, part one.epub", ["Border, part one.epub"]),
        ("path", "a.torrent;b.torrent", ["a.torrent", "b.torrent"]),
        ("path", "a.mkv;b.torrent;c.mkv", ["a.mkv", "b.torrent", "c.mkv"]),
        ("path", "README;Makefile", ["README", "Makefile"]),
        ("path", "README|LICENSE, old|Makefile|", ["README", "LICENSE, old", "Makefile"]),
        ("path", "Border, part one", ["Border, part one"]),
        ("path", "docs/README///docs/Makefile", ["docs/README", "docs/Makefile"]),
        ("path", '"a, ""x"".mkv","b ""y"""', ['a, "x".mkv', 'b "y"']),
        ("path", '"a, ""x"".mkv", "b.mkv"', ['a, "x".mkv', "b.mkv"]),
        ("number", "123456789,12,1234", ["123456789", "12", "1234"]),
        ("number", '"1,078,906"; "474,716"', ["1,078,906", "474,716"]),
        ("number", "12 34|56", ["12", "34", "56"]),
    ],
)
def test_split(spark, kind, text, expected):
    assert values(spark, kind, text) == expected


def test_edges(spark):
    long = "///".join(f"{k:05d} name.mkv" for k in range(5000))
    df = spark.createDataFrame([(1, None), (2, ""), (3, " ;; "), (4, long), (5, "a.mkv///a.mkv"), (5, "a.mkv///a.mkv"), (None, "a.mkv///b.mkv")], "id long, p string")
    rows = split_packed(df, {"p": ("id", "path")}).collect()
    per = {}
    for r in rows:
        per.setdefault(r.row_id, []).append(r.value)
    assert len(per[4]) == 5000 and sorted(per[5]) == ["a.mkv"] * 4 and 1 not in per and 2 not in per and 3 not in per and len(per[None]) == 2
    assert split_packed(df.limit(0), {"p": ("id", "path")}).count() == 0
