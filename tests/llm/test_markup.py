import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.llm import markup

MARKED = ["a <b>c</b>", "x<br/>y", "&amp; z", "&#233;", "&lt;p&gt;", "# Head\ntext", "Head\n====\nx", "**bold**", "a ~~b~~ c", "`code`", "[a](http://b.test)", "* one\n* two", "> said", "|a|b|\n|---|---|\n", "== Head ==\nx", "''it''", "[[a|b]]", "{{cite|a}}", "\\textbf{a}", "$r = \\frac{u}{d}$", "{\\it a} b", "\\begin{itemize}\n\\item a\n\\end{itemize}", "[b]a[/b]", "[url=http://a]x[/url]", "<!-- c -->", "```\nx\n```", "1. a\n2. b"]
PLAIN = ["a < b and b > 9", "costs 9$ or 8$ in all", "$4 at first, then $5.", "Use [A] or (B), see [74].", "C:\\new\\texts on disk", "x_1 and x_2", "5*4 and 3 * 4 * 5", "R&D, 5 & 6", "C# and #9", "-> a -> b", "if (x < 58 && y > 2) it", "Rated *** of 74?", "By {unknown}", "~12 pages, 80%", "keep blunt_market_filter.txt", "2 == 2", ">= 9 MB & < 9 GB", "a ^ b ~ c", "#65 on the list", "", " ", "3. only one number"]


@pytest.mark.parametrize("text", MARKED)
def test_marks(text):
    assert markup.marks(text)


@pytest.mark.parametrize("text", PLAIN)
def test_signs_that_mark_nothing(text):
    assert not markup.marks(text)
    assert " ".join(t for _, t in markup.to_blocks(text)) == " ".join(text.split())


@pytest.mark.parametrize(
    "text, blocks",
    [
        ("<h2>A</h2><p>b <i>c</i></p><ul><li>d<li>e</ul><pre><code>x = 1</code></pre>", [("heading", "A"), ("paragraph", "b c"), ("list_item", "d"), ("list_item", "e"), ("code", "x = 1")]),
        ("&lt;b&gt;x&lt;/b&gt; &amp;amp; y", [("paragraph", "x & y")]),
        ("# A\n\n- b\n\n```\ncode\n```\n\n> q [l](http://x)", [("heading", "A"), ("list_item", "b"), ("code", "code"), ("quote", "q l")]),
        ("\\section{A}\nb\\footnote{c}\n\\begin{equation}x^2\\end{equation}", [("heading", "A"), ("paragraph", "b c"), ("formula", "x^2")]),
        ("[size=4]A[/size]\n[list][*]b[*]c[/list] [img]http://x[/img]", [("heading", "A"), ("list_item", "b"), ("list_item", "c")]),
        ("<script>bad()</script>a<!-- c -->b", [("paragraph", "ab")]),
    ],
)
def test_blocks(text, blocks):
    assert markup.to_blocks(text) == blocks


def test_nothing_of_very_long_texts_is_lost():
    assert markup.to_blocks("<p>" + "word " * 100_000 + "</p>")[0][1].count("word") == 100_000


tokens = st.lists(st.sampled_from(["<p>", "#", "<b>", "</b>", "<li>"]), min_size=1, max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(tokens, min_size=1, max_size=6))
def test_a_wrapper_reads_every_stream_it_was_made_of(streams):
    folded = [markup.fold(s) for s in streams]
    whole = markup.Wrapper()
    for f in folded:
        whole = whole.merge(markup.Wrapper([(t, False) for t in f], 1))
    assert whole.rows == len(streams) and all(whole.reads(f) for f in folded)


def test_unwrapped(spark):
    rows = [(1, "h", "<p>a</p>"), (2, "h", "<p>b</p><b>c</b>"), (3, "h", "plain"), (4, None, "**x**"), (5, "h", None), (6, "h", ""), (7, "h", "a < b"), (1, "h", "<p>a</p>"), (8, "g", "x&nbsp;y")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, site string, text string, tokens string")
    got = markup.unwrapped(df, ["id"], "site", "text")
    assert sorted((r.id, r.n_marks > 0, r.fits) for r in got.collect()) == [(1, True, True), (1, True, True), (2, True, True), (3, False, True), (4, True, True), (6, False, True), (7, False, True), (8, True, True)]
    assert markup.unwrapped(df.limit(0), ["id"], "site", "text").count() == 0
    clean = {r.id: r.text for r in markup.clean(df, ["id"], "site", "text").collect()}
    assert clean[2] == "b\nc" and clean[6] == "" and 5 not in clean


def test_the_wrapper_decides_what_only_looks_like_a_mark(spark):
    """The answer for the texts of one host hangs on the others: without them, and their wrapper, it is another."""
    odd = [(1, "see [spoil]this[/spoil]"), (2, "[note] left open"), (3, "5. one line"), (4, "Use [A] or [note]"), (5, "<ref2>x</ref2> y")]
    helping = [(11, "[note]a[/note]"), (12, "5. one\n6. two\n7. three"), (13, "[A] once"), (14, "[list][*]a[*]b[/list]"), (15, "<b>x</b> [i]y[/i]")]
    rows = [(k, "alone", t) for k, t in odd] + [(k, "helped", t) for k, t in odd + helping]
    df = spark.createDataFrame(rows, "id long, site string, text string")
    found = {(r.site, r.id): (r.n_marks > 0, r.fits) for r in markup.unwrapped(df.select("id", "site", "text", F.col("site").alias("s")), ["id", "s"], "site", "text").select("id", F.col("s").alias("site"), "n_marks", "fits").collect()}
    assert all(fits for _, fits in found.values())
    got = {site: {k for (s, k), (f, _) in found.items() if s == site and f} for site in ("alone", "helped")}
    assert got["alone"] == {1, 5}  # a pair of one text is evidence of its own
    assert got["helped"] == {1, 2, 3, 4, 5, 11, 12, 14, 15}
    texts = {(r.s, r.id): r.text for r in markup.clean(df.withColumn("s", F.col("site")), ["id", "s"], "site", "text").collect()}
    assert texts["alone", 2] == "[note] left open" and texts["helped", 2] == "left open"
    assert texts["alone", 3] == "5. one line" and texts["helped", 3] == "one line"
    assert texts["helped", 4] == "Use [A] or" and texts["helped", 13] == "[A] once" and texts["helped", 14] == "a\nb" and texts["alone", 5] == "x y"


def test_a_link_may_be_called_like_a_tag():
    assert [k for k, _ in markup.marks("against the [list](http://a.test/1) that")] == ["link"]
    assert markup.to_blocks("the [list](/1) and [b](c)[/b]") == [("paragraph", "the list and (c)")]


def test_bounds_are_gone():
    assert markup.marks("{{" + "x" * 2000 + "}}") and markup.marks("[[" + "y" * 2000 + "]]")
    deep = "<p>"
    for _ in range(9):
        deep = deep.replace("&", "&amp;").replace("<", "&lt;")
    assert markup.opened(deep) == "<p>"
    group = [f"<{k}>" for k in "abcdefghijklmnopqrstuvwxyz"] * 2
    assert markup.fold(group * 30) == [f"({' '.join(group[:26])})+"]


@settings(max_examples=150, deadline=None)
@given(st.lists(tokens, min_size=1, max_size=6))
def test_places_of_a_stream_are_its_tokens(streams):
    folded = [markup.fold(s) for s in streams]
    whole = markup.Wrapper()
    for f in folded:
        whole = whole.merge(markup.Wrapper([(t, False) for t in f], 1))
    for s, f in zip(streams, folded):
        assert whole.reads(f) and [t for d in whole.decide(f) for t in d] == [True] * sum(len(markup.inner(t)) for t in f)
    for s in streams:
        assert sorted(p for _, ps in markup.fold_places(s) for q in ps for p in q) == list(range(len(s)))
