import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.llm import mix

TARGETS = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 4), ("none", 0.0, 3), ("missing", 0.5, 2)]


def test_allocate():
    total, plan = mix.allocate({"a": 1000, "b": 100, "c": 10}, [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 4)])
    assert total == pytest.approx(200) and plan == {"a": pytest.approx(100), "b": pytest.approx(60), "c": pytest.approx(40)}
    assert mix.allocate({}, [("a", 1.0, 1)]) == (0.0, {})


def test_shares(spark):
    docs = [(k, "abc"[min(2, k % 11 // 4)], 50 + k % 90) for k in range(3000)] + [(9000, None, 5), (9001, "a", 0), (9002, "other", 7), (9003, "a", None)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, source string, n long, bin int")
    targets = spark.createDataFrame(TARGETS, "source string, weight double, max_repeats int")
    got = mix.mix(df, "doc_id", "source", "n", targets)
    again = mix.mix(df.repartition(7), "doc_id", "source", "n", targets)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))
    caps = {s: m for s, _, m in TARGETS}
    assert all(0 < r.copies <= caps[r.source] for r in got.collect())
    reached = {r.source: r.share for r in mix.shares(got, "source", "n", targets).collect()}
    assert reached["a"] == pytest.approx(0.5, abs=0.005) and reached["b"] == pytest.approx(0.3, abs=0.005) and reached["c"] == pytest.approx(0.2, abs=0.005) and reached["missing"] == 0
    assert mix.mix(df.limit(0), "doc_id", "source", "n", targets).count() == 0
    assert mix.mix(df, "doc_id", "source", "n", targets.limit(0)).count() == 0


def test_tokens(spark):
    import os

    if not os.path.exists(mix.VOCABULARY):
        pytest.skip("no vocabulary here")
    df = spark.createDataFrame([(1, "Hello world"), (2, ""), (3, None), (4, "a" * 50_000), (5, "<|endoftext|>")], "k long, text string")
    got = {r.k: r.n_tokens for r in mix.count_tokens(df, ["k"], "text").collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 100 and got[5] > 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.floats(0.1, 1000), st.floats(1, 1000)), min_size=1, max_size=8), st.floats(0.01, 0.99), st.integers(1, 4))
def test_level_supplies_what_is_needed(bins, part, cap):
    need = part * cap * sum(t for _, t in bins)
    factor = mix.level(bins, need, cap)
    assert sum(min(cap, factor * o) * t for o, t in bins) == pytest.approx(need)


def test_odds_follow_size_and_decide_the_draw(spark):
    docs = [(k, "a", 10 if k % 2 else 90) for k in range(4000)] + [(9000 + k, "b", 50) for k in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2)], "source string, weight double, max_repeats int")
    got = mix.mix(df, "doc_id", "source", "n", targets)
    share = {(r.source, r.n): r.k for r in got.groupBy("source", "n").agg({"copies": "sum"}).withColumnRenamed("sum(copies)", "k").collect()}
    # 60,000 tokens of a are wanted: a document of 90 words is nine times as likely to be used as one of 10.
    assert share["a", 90] == pytest.approx(658, rel=0.05) and share["a", 10] == pytest.approx(73, rel=0.35) and share["b", 50] == 1200
    reached = {r.source: r.share for r in mix.shares(got, "source", "n", targets).collect()}
    assert reached["a"] == pytest.approx(0.5, abs=0.001) and reached["b"] == pytest.approx(0.5, abs=0.001)
    # Equal odds use both alike.
    even = {r.n: r["count"] for r in mix.mix(df, "doc_id", "source", "n", targets, odds=F.lit(1.0)).where("source = 'a'").groupBy("n").count().collect()}
    assert even[90] == pytest.approx(600, rel=0.1) and even[10] == pytest.approx(600, rel=0.1)


def test_certain_copies_come_first_and_caps_hold(spark):
    df = spark.createDataFrame([(1, "a", 900), (2, "a", 100), (3, "a", 100), (10, "b", 1650)], "doc_id long, source string, n long")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 1)], "source string, weight double, max_repeats int")
    got = {r.doc_id: r.copies for r in mix.mix(df, "doc_id", "source", "n", targets).collect()}
    # 1,650 tokens of a: the long one nearly twice, the short ones a fifth of a time each.
    assert got[10] == 1 and got[1] in (1, 2) and all(c <= 2 for c in got.values())
