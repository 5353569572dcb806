from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.llm import canon

TERMS = [("category", 1, "Feature Film", ["película", "motion picture"]), ("category", 2, "Comic Strip", ["bande dessinée"]), ("quality", 3, "Variable Bitrate Audio", ["vbr"]), ("quality", 4, "Constant Bitrate Audio", ["cbr", None]), ("language", 5, "Korean", ["한국어", "coreano"]), ("language", 6, "Greek", None)]


def mapped(spark, pairs):
    df = spark.createDataFrame([(f, v, "x", 1) for f, v in pairs], "fld string, value string, unit string, word int")
    terms = spark.createDataFrame([(*t, "x") for t in TERMS], "fld string, term_id long, name string, aliases array<string>, value string")
    return {(r.fld, r.value): r.term_id for r in canon.map_values(df, "fld", "value", terms, "term_id", "name", "aliases").collect()}


def test_typed_values(spark):
    cases = {
        ("category", "feature film"): 1, ("category", "[Featre  Fiml]"): 1, ("category", "PELICULA!"): 1, ("category", "c0mic_strip"): 2, ("category", "B a n d e dessinee"): 2, ("category", "Film Feature"): 1, ("category", "FeatureFilm -"): 1,
        ("category", "hot this week"): None, ("category", ""): None, ("category", "???"): None, ("quality", "VBR"): 3, ("quality", "bbr"): None, ("quality", "v4riable bitrate audio"): 3, ("quality", "Korean"): None,
        ("language", "한국어 "): 5, ("language", "한국어"): 5, ("language", "grek"): 6, ("genre", "Greek"): None, ("language", "x" * 20_000): None,
    }
    assert mapped(spark, [*cases, *cases, ("language", None), (None, "Greek")]).items() >= cases.items()


def test_empty_tables(spark):
    assert mapped(spark, []) == {}
    none = spark.createDataFrame([], "fld string, term_id long, name string, aliases array<string>")
    df = spark.createDataFrame([("language", "Greek")], "fld string, value string")
    assert canon.map_values(df, "fld", "value", none, "term_id", "name", "aliases").first().term_id is None


def test_a_long_reference_list_is_joined_by_shuffle(spark, monkeypatch):
    values = [("category", v) for v in ("featre fiml", "COMIC strip", "bande desinee", "peliculas", "x")] + [("quality", "bbr"), ("quality", "variabel bitrate audio"), ("language", "grek"), ("language", "corea no")]
    want = mapped(spark, values)
    monkeypatch.setattr(canon, "INDEX_WORDS", 1)
    assert mapped(spark, values) == want and want["category", "featre fiml"] == 1 and want["language", "corea no"] == 5


def test_soft_tf_idf_ranks_before_the_distance_of_whole_strings(spark):
    terms = spark.createDataFrame([("f", 1, "Ten Bit", None), ("f", 2, "Bit Tin", None)], "fld string, term_id long, name string, aliases array<string>")
    df = spark.createDataFrame([("f", "bit ten"), ("f", "bit tin"), ("f", "ten bit")], "fld string, value string")
    got = {r.value: (r.term_id, r.distance) for r in canon.map_values(df, "fld", "value", terms, "term_id", "name", "aliases").collect()}
    # "bitten" is one edit from "bittin" and three from "tenbit", yet its words are those of "Ten Bit".
    assert got == {"bit ten": (1, None), "bit tin": (2, 0), "ten bit": (1, 0)}


@settings(max_examples=200, deadline=None)
@given(st.text("abc1", min_size=1, max_size=14), st.text("abc1", max_size=14))
def test_segment_keys_lose_nothing(word, unit):
    if canon.edits(unit, word, canon.allowed(word)) <= canon.allowed(word):
        assert set(canon.segment_keys(word)) & set(canon.probe_keys(unit))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=12), min_size=1, max_size=8), st.text("abc", max_size=14))
def test_segment_index_loses_nothing(words, unit):
    want = {(w, canon.edits(unit, w, canon.allowed(w))) for w in words if canon.edits(unit, w, canon.allowed(w)) <= canon.allowed(w)}
    assert set(canon.Segments(words).near(unit)) == want
