import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.llm import repetition as rp
from gleanery.llm.repetition import repeated_words, repetition, words_of


def brute(words, run):
    hit = set()
    for i in range(len(words)):
        for j in range(i):
            n = 0
            while i + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            if n >= run:
                hit |= set(range(i, i + n))
    return len(hit)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=40), st.integers(2, 6))
def test_equals_brute_force(words, run):
    assert repeated_words(words, run) == brute(words, run)


def test_words():
    assert words_of("It's  12.5 -- Über! ②") == ["its", "125", "über", "②"]


def test_edges(spark):
    phrase = "one two three four five six "
    rows = [(1, None, "x"), (2, "", "x"), (3, " -- ", "x"), (4, phrase * 2, "x"), (5, phrase.upper() + "-" + phrase, "x"), (6, "a b c", "x"), (7, "word " * 200_000, "x"), (4, phrase * 2, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, share string")
    got = {r.doc_id: (r.n_words, r.n_repeated) for r in repetition(df, "doc_id", "text").collect()}
    assert got == {1: (0, 0), 2: (0, 0), 3: (0, 0), 4: (12, 6), 5: (12, 6), 6: (3, 0), 7: (200_000, 199_999)}
    assert repetition(df.limit(0), "doc_id", "text").count() == 0


def share_had(items, n):
    grams = [tuple(items[k : k + n]) for k in range(len(items) - n + 1)]
    return 1 - len(set(grams)) / len(grams) if grams else 0.0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "bc", "dé"]), max_size=30), max_size=5), st.sampled_from([7, 2_000_000]))
def test_features_equal_brute_force(docs, chunk):
    before, rp.CHUNK = rp.CHUNK, chunk
    got = rp.features(docs)
    rp.CHUNK = before
    want = [[share_had(d, n) for n in rp.WORD_GRAMS] + [share_had(" ".join(d), n) for n in rp.CHAR_GRAMS] for d in docs]
    assert got.shape == (len(docs), 10) and np.allclose(got, np.array(want).reshape(len(docs), 10))


def planted(n, seed):
    """Documents of which every fourth repeats phrases of itself, to any share."""
    rng, out = np.random.default_rng(seed), []
    for k in range(n):
        words = [f"w{x}" for x in rng.integers(0, 400, 60 + k % 50)]
        if k % 4 == 0:
            for _ in range(int(rng.integers(1, 6))):
                a = int(rng.integers(0, len(words) - 14))
                words += words[a : a + int(rng.integers(5, 14))]
        out.append((k, " ".join(words)))
    return out


def test_classifier_on_held_out_rows():
    train, test = ([rp.words_of(t) for _, t in planted(3000, s)] for s in (1, 2))
    label = lambda docs: np.array([float(repeated_words(d) >= rp.SHARE * len(d)) for d in docs])
    p, y = rp.Classifier.fit(rp.features(train), label(train)).probability(rp.features(test)), label(test)
    assert y.sum() > 50 and p[y == 1].min() >= rp.THRESHOLD
    assert abs(p.mean() - y.mean()) < 0.01 and ((p >= 0.5) == (y == 1)).mean() > 0.98
    # Without any row of a class the ends that hold by definition still make a model.
    for x in (np.zeros((0, 10)), np.zeros((50, 10))):
        p = rp.Classifier.fit(x, np.zeros(len(x))).probability(np.array([[0.0] * 10, [1.0] * 10]))
        assert p[1] > rp.THRESHOLD and p[0] < p[1]


def test_repetitive_equals_the_exact_count(spark):
    rows = [(k, t, "x") for k, t in planted(1500, 3)] + [(9001, None, "x"), (9002, "", "x"), (9003, "word " * 5000, "x"), (0, planted(1, 3)[0][1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, share string")
    want = sorted((r.doc_id, r.n_words, r.n_repeated) for r in repetition(df, "doc_id", "text").where("share >= 0.3").collect())
    assert sorted((r.doc_id, r.n_words, r.n_repeated) for r in rp.repetitive(df, "doc_id", "text").collect()) == want and len(want) > 20
    assert rp.repetitive(df.limit(0), "doc_id", "text").count() == 0
    assert rp.repetitive(df, "doc_id", "text", threshold=1.1).count() == 0  # the classifier decides what is counted
    x, y = rp.labelled_sample(df, "doc_id", "text", rows=100)
    assert 0 < len(x) == len(y) <= 100
