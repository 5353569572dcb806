import regex
from pyspark.sql import functions as F

from gleanery.llm.dedup import Trie, collapse

H = "0123456789abcdef0123456789abcdef01234567"
ROWS = [
    (1, H), (2, H.upper()), (3, f" {H[:20]} {H[20:]};"), (4, f"<{H}>"), (5, H[:39]), (6, None), (7, ""), (8, "unknown"), (9, f"xt=urn:btih:{H}&dn=a b&xl=5"), (10, f"DN = A.B; XL = 5; XT = URN-BTIH-{H.upper()};"), (11, f"xt: urn:btih:{H} | dn: a c | xl: 5"),
    (12, f"xt=urn:btih:{H}"), (13, H), (14, f"xt={H}"), (15, "x" * 100_000), (16, H[:39] + "g"), (17, f"dn=ab&xt={H}&kt=x"), (18, f"kt=x dn=a.b xt={H}"),
]


def found(spark, rows, bucket_rows=200_000):
    df = spark.createDataFrame([("t", k, v, 0, "x") for k, v in rows], "tbl string, id long, value string, bucket int, grp string")
    return {(r.row_id, r.keep_id, r.copies) for r in collapse(df, "tbl", "id", F.col("value"), bucket_rows).collect()}


def brute(rows):
    def canon(v):
        v = (v or "").lower()
        parts = regex.findall(r"(?s)(?:^|[^\p{L}\p{N}])(xt|dn|xl|kt)\s*[=:](.*?)(?=[^\p{L}\p{N}](?:xt|dn|xl|kt)\s*[=:]|$)", v)
        bare = regex.sub(r"[^\p{L}\p{N}]", "", v)
        return tuple(sorted((k, regex.sub(r"[^\p{L}\p{N}]", "", x)) for k, x in parts)) or (bare if regex.fullmatch("[0-9a-f]{40}", bare) else None)

    groups = {}
    for k, v in rows:
        if canon(v):
            groups.setdefault(canon(v), []).append(k)
    return {(k, min(g), len(g)) for g in groups.values() for k in g}


def test_formatting_does_not_matter(spark):
    got = found(spark, ROWS)
    assert got == brute(ROWS)
    assert {k for k, keep, _ in got if keep == 1} == {1, 2, 3, 4, 13} and {k for k, keep, _ in got if keep == 9} == {9, 10}
    assert {k for k, keep, _ in got if keep == 17} == {17, 18} and (12, 12, 1) in got and (14, 14, 1) in got


def test_any_bucket_size_gives_the_same(spark):
    many = ROWS + [(100 + k, H) for k in range(60)] + [(200 + k, f"dn=name {k % 7}&xt=urn:btih:{H}&xl={k % 3}") for k in range(60)] + [(300 + k, f"{k:040x}") for k in range(60)]
    want = brute(many)
    for size in (5, 17, 1000):
        assert found(spark, many, size) == want


def test_empty_and_repeated_rows(spark):
    assert found(spark, []) == set()
    assert found(spark, [(1, H), (1, H)]) == {(1, 1, 2)}


def test_trie():
    trie = Trie()
    ends = [trie.insert(k, n) for n, k in ((5, b"abcdefgh"), (3, b"abcdefgh"), (1, b"abcdefghi"), (7, b""), (2, b"abcdefgh" * 3))]
    assert ends == [0, 0, 1, 2, 3] and trie.keep == [3, 1, 7, 2] and trie.count == [2, 1, 1, 1]


def test_many_oversized_buckets_are_joined_by_shuffle(spark, monkeypatch):
    from gleanery.llm import dedup

    monkeypatch.setattr(dedup, "small_side", dedup.checkpoint)
    many = [(k, f"{k % 40:02x}" + "0" * 30 + f"{k % 160:08x}") for k in range(900)] + [(2000 + k, H) for k in range(60)]
    assert found(spark, many, 7) == brute(many)


def test_no_letter_is_left_out(spark):
    newer = "\u0870\u08c9\u2c5f\ua7d1\U00016ac0\U0001d2c0\U0001df00\U0002ebf0\U00031350\U00031351"  # Unicode 14 to 15.1
    rows = [(k, f"dn=a{c}&xl=5") for k, c in enumerate(["", *newer])]
    copies = [(100 + k, f"XL: 5; DN: A {c}") for k, c in enumerate(["", *newer])]
    greek = [(200, "dn=ΟΔΟΣ ΝΕΑ"), (201, "DN=ΟΔΟΣ.ΝΕΑ"), (202, "dn: ΟΔΟΣΝΕΑ"), (203, "dn=οδοσ-νεα")]
    want = {(k, k % 100, 2) for k, _ in rows + copies} | {(k, 200, 4) for k, _ in greek}
    assert found(spark, rows + copies + greek) == want
