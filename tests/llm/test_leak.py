import random

from gleanery.llm import leak
from gleanery.llm.leak import leaked, passage

WORDS = [f"w{k}" for k in range(3000)]
RND = random.Random(7)
INSTRUCTION = "read the passage and choose the best answer".split()
ITEMS = {k: (INSTRUCTION if k < 4 else []) + RND.sample(WORDS, 50) for k in range(8)}


def noise(n):
    return RND.choices(WORDS, k=n)


def docs():
    out, want = [], set()

    def add(words, *items):
        out.append((len(out), " ".join(words)))
        want.update((len(out) - 1, k) for k in items)

    add(noise(30) + ITEMS[5] + noise(30), 5)
    add(noise(10) + ITEMS[5][10:30] + noise(10), 5)
    add(noise(10) + ITEMS[5][10:22] + noise(10))  # a short quote
    changed = list(ITEMS[6])
    for at in (4, 14, 24, 34, 44):
        changed[at] = "other"
    add(changed, 6)
    dropped = [w for k, w in enumerate(ITEMS[7]) if k % 12 != 5]
    add(noise(5) + dropped, 7)
    add(["**" + w.upper() + "**," for w in ITEMS[4]], 4)
    add(noise(40) + INSTRUCTION + noise(40))  # the instruction alone
    scattered = [x for w in ITEMS[4] for x in (w, *noise(2))]
    add(scattered)
    add(ITEMS[4][::-1])  # another order
    add(ITEMS[0] + noise(3) + ITEMS[1], 0, 1)
    add(noise(60_000) + ITEMS[2], 2)
    out.extend([(len(out), None), (len(out) + 1, ""), (len(out) + 2, "<b> "), (len(out) + 3, "two words")])
    return out, want


def test_planted_cases(spark):
    rows, want = docs()
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, h string, item int")
    items = spark.createDataFrame([(k, " ".join(w), "x") for k, w in ITEMS.items()] + [(90, None, "x"), (91, "", "x")], "eval_id long, text string, doc string")
    got = {(r.doc_id, r.eval_id) for r in leaked(df, "doc_id", "text", items, "eval_id", "text").collect()}
    brute = {(k, e) for k, t in rows if t and not t.startswith("<") for e, w in ITEMS.items() if passage(w, t.lower().replace("*", "").replace(",", "").split(), frozenset(range(8)) if e < 4 else frozenset())}
    assert got == want == brute
    assert leaked(df.limit(0), "doc_id", "text", items, "eval_id", "text").count() == 0
    assert leaked(df, "doc_id", "text", items.limit(0), "eval_id", "text").count() == 0


def test_passage():
    item = [str(k) for k in range(30)]
    assert passage(item, item) == 30
    assert passage(item, item[:10]) == 10 and passage(item, item[:9]) == 0
    assert passage(item, item[5:10] + ["x"] + item[11:20]) == 15
    assert passage(item, []) == 0


def found(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    its = spark.createDataFrame(items, "eval_id long, text string")
    return {(r.doc_id, r.eval_id): r.matched for r in leaked(df, "doc_id", "text", its, "eval_id", "text").collect()}


def test_short_items_and_short_documents(spark):
    items = [(1, "alpha beta gamma delta"), (2, " ".join(f"q{k}" for k in range(12))), (3, "Zyx"), (4, "one two three"), (5, " ".join(f"r{k}" for k in range(40)))]
    docs = [
        (1, "so alpha, Beta <b>gamma</b> delta it is"), (2, "alpha beta gamma"), (3, "x q3 q4 q5 q6 y"), (4, "q3 q4 q5"), (5, "zyx"), (6, "one two three"), (7, "one two"), (8, "a <b and r0 r1 r2 r3 r4 r5 r6 r7 r8 r9 r10 r11 r12 r13 c> d"),
        (9, " ".join(f"r{k}" for k in range(14))),
    ]
    assert found(spark, docs, items) == {(1, 1): 4, (3, 2): 4, (5, 3): 1, (6, 4): 3, (8, 5): 14, (9, 5): 14}


def test_markup_of_any_length_goes(spark):
    item = [f"r{k}" for k in range(30)]
    href = '<a href="http://x.test/' + "y" * 5000 + '">'
    docs = [(1, " ".join(item[:7]) + href + " ".join(item[7:12]) + "](http://" + "z" * 3000 + ") [url=" + "v" * 500 + "]" + " ".join(item[12:]))]
    assert found(spark, docs, [(1, " ".join(item))]) == {(1, 1): 30}


def test_an_instruction_elsewhere_in_the_window_hides_no_passage(spark):
    ask = "now read this text with care and pick the one best answer".split()
    own = [f"v{k}" for k in range(72)]
    part = own[20:50]
    part[9], part[19] = "other", "words"
    items = [(k, " ".join(ask + RND.sample(WORDS, 60))) for k in range(2, 6)] + [(1, " ".join(ask + own))]
    docs = [(1, " ".join(noise(20) + part + noise(4) + ask + noise(20)))]
    assert set(found(spark, docs, items)) == {(1, 1)}


def test_beyond_the_filter_the_join_gives_the_same(spark, monkeypatch):
    rows, want = docs()
    monkeypatch.setattr(leak, "FILTER_SHINGLES", 3)
    assert set(found(spark, rows, [(k, " ".join(w)) for k, w in ITEMS.items()])) == want


def test_number_of_whole_shingles_is_a_bound():
    for n in range(1, 200):
        size, least = leak.shingle_size(n), leak.shortest(n)
        assert 1 <= size <= least <= n
        for words in range(least, n + 1):
            wrong = words // 10
            # The worst case: wrong words evenly spread, each breaking as many shingles as it can.
            bad = {(k + 1) * words // (wrong + 1) for k in range(wrong)}
            whole = sum(not any(i <= b < i + size for b in bad) for i in range(words - size + 1))
            assert whole >= leak.kept_whole(n)
