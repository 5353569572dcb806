import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.operators import quantities as q


@pytest.mark.parametrize(
    "text, value",
    [
        ("697.5 MB", 697.5 * 1024**2), ("697,5 Mo", 697.5 * 1024**2), ("1 GB 2 MB", 1026 * 1024**2), ("1 MB + 1 KB", 1025 * 1024), ("4 x 2 KB", 8192), ("4 × 2.5 KB", 10240), ("2 * 2 KB", 4096), ("8 Mbit", 1024**2), ("8 Mb", 8 * 1024**2),
        ("1.5 million bytes", 1.5e6), ("2.5e+03 B", 2500), ("814 191 005 octets", 814191005), ("721'231'396 B", 721231396), ("1.234.567 bytes", 1234567), ("1.234 bytes", 1234), ("20 MB (20,971,520 bytes)", 20 * 1024**2), ("~3 gigaoctets", 3 * 1024**3),
        ("Size: 3 KiB", 3072), ("Tamaño: 3 KB / 12 ficheros", 3072), ("3\xa0KB", 3072), ("12", 12), ("1 GB / 3 parts", 1024**3),
    ],
)
def test_notations(text, value):
    assert q.parse_size(text)[0] == pytest.approx(value)


@pytest.mark.parametrize("text", [None, "", "unknown", "n/a", "see below", "-", "?? MB", "0", "0 B", "x" * 50_000, "9" * 50_000])
def test_no_quantity(text):
    assert q.parse_size(text) == []


def test_ambiguous_notation_has_two_readings():
    assert q.parse_size("1.234 MB") == [1.234 * 1024**2, 1234 * 1024**2]


@given(st.integers(1, 10**12))
def test_grouping_does_not_change_a_number(n):
    for sep in (",", ".", " ", "'"):
        assert q.parse_size(f"{n:,} bytes".replace(",", sep)) == [float(n)]


def test_reconcile(spark):
    left = spark.createDataFrame([(1, "1.234 MB", "a"), (2, "10 MB", "a"), (3, None, "a"), (None, "1 MB", "a"), (5, "3 KB", "a"), (5, "3 KB", "a")], "k long, size string, unique string")
    right = spark.createDataFrame([(1, "1234", "MiB", "z"), (2, "9", "MiB", "z"), (3, "1", "B", "z"), (5, "3", "KiB", None), (6, "", None, "z")], "k long, size string, unit string, unique string")
    a = left.select("k", "size", "unique", q.size_readings(F.col("size"), F.lit("B")).alias("readings"))
    b = right.select("k", "size", "unique", q.size_readings(F.col("size"), F.coalesce("unit", F.lit("?"))).alias("readings"))
    out = q.reconcile(a, b, "k")
    assert len(out.columns) == len(set(out.columns))
    rows = {r.k: r for r in out.collect()}
    assert out.count() == 4 and set(rows) == {1, 2, 5}
    assert rows[1].bytes_left == 1234 * 1024**2 and rows[1].unique
    assert [r.k for r in q.differing(out).collect()] == [2]
    assert q.reconcile(a.limit(0), b, "k").count() == 0


def test_unknown_unit_is_flagged_when_two_fit(spark):
    a = spark.createDataFrame([(1, [1024.0, 1024.5])], "k long, readings array<double>")
    assert not q.reconcile(a, a, "k").first().unique


def test_a_choice_that_fits_nothing_is_not_unique(spark):
    a = spark.createDataFrame([(1, [1.5, 3.0]), (2, [100.0]), (3, [7.0])], "k long, readings array<double>")
    b = spark.createDataFrame([(1, [10.0, 20.0]), (2, [50.0, 400.0]), (3, [7.0, 70.0])], "k long, readings array<double>")
    assert {r.k: r.unique for r in q.reconcile(a, b, "k").collect()} == {1: False, 2: False, 3: True}


def test_units_of_sources_follow_from_their_rows_together(spark):
    # Source 1 counts KiB but for a row about something else, 2 has too few rows, 3 fits two units, 4 none.
    rows = [(1, float(n), n * 1024.0) for n in range(5, 12)] + [(1, 50.0, 7e9), (2, 3.0, 3.0), (2, 4.0, 4.0), (None, 3.0, 3.0), (1, 0.0, 5.0), (1, None, 5.0)]
    rows += [(3, 8.0, 8.0)] * 5 + [(3, 8.0, 4096.0)] * 4 + [(4, float(n), n * 30.0) for n in range(9)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "src long, number double, total double, n string")
    got = {r.src: (r.factor, r.n, r.unique) for r in q.infer_units(df, "src", "number", "total").collect()}
    assert got[1] == (1024.0, 8, True) and got[2] == (1.0, 2, False) and not got[3][2] and not got[4][2] and set(got) == {1, 2, 3, 4}
    assert q.infer_units(df.limit(0), "src", "number", "total").count() == 0


def test_settle(spark):
    mb = 1024.0**2
    rows = [(1, 10, q.parse_size("1.234 MB")), (2, 20, q.parse_size("1.234 MB")), (3, 30, q.parse_size("1.234 MB")), (4, 40, [5.0]), (5, 50, []), (6, 60, [100.0, 100.5]), (7, None, [1.0, 2.0]), (8, 80, [3.0, 4.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, k long, readings array<double>, v string")
    # Two partners outvote one.
    other = spark.createDataFrame([(10, 1234 * mb), (20, 1.234 * mb), (20, 1.234 * mb), (20, 1234 * mb), (60, 100.0), (80, 900.0), (None, 1.0)], "k long, total double")
    got = {r.id: (r.bytes, r.unique) for r in q.settle(df, "id", "k", other, "total").collect()}
    assert got == {1: (1234 * mb, True), 2: (1.234 * mb, True), 3: (1.234 * mb, False), 4: (5.0, True), 6: (100.0, False), 7: (1.0, False), 8: (3.0, False)}
    assert q.settle(df.limit(0), "id", "k", other, "total").count() == 0


def test_a_text_keeps_to_one_notation_however_many_terms_it_has():
    terms = " + ".join(f"{k}.234 MB" for k in range(1, 9))
    assert q.parse_size(terms) == [pytest.approx(sum(k + 0.234 for k in range(1, 9)) * 1024**2), sum(k * 1000 + 234 for k in range(1, 9)) * 1024**2]
    assert q.parse_size(f"{2**85} bytes") == [2.0**85]


def test_bare_numbers(spark):
    rows = [("12", 12.0), (" 1.5 ", 1.5), ("1.234", None), ("1.2345", 1.2345), ("12 MB", None), ("", None), (None, None), ("9" * 40, None)]
    df = spark.createDataFrame(rows, "t string, want double")
    assert all(r.got == r.want for r in df.select("want", q.bare_number(F.col("t")).alias("got")).collect())
