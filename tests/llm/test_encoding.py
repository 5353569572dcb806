import math
import random

import pytest

from gleanery.llm import encoding

CLEAN = ["corazón invisible", "última estación", "Frühling Brücke", "Grüße König", "Последний поезд", "тихая гавань", "静かな森", "海辺の手紙", "작은 정원", "Café naïve", "rivière château", "МОСТ ВЕТЕР", "coração limão"]
PAIRS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp1251"), ("utf-8", "cp437"), ("utf-8", "mac_roman"), ("cp1252", "cp1251"), ("cp1251", "cp1252"), ("koi8_r", "cp1251"), ("euc_jp", "latin-1"), ("euc_kr", "latin-1")]


@pytest.fixture(scope="module")
def rows():
    out, bad = [], {}
    rnd = random.Random(5)
    for k in range(3000):
        text = rnd.choice(CLEAN)
        if k % 25 == 0:
            for written, read in rnd.sample(PAIRS, len(PAIRS)):
                try:
                    garbled = text.encode(written).decode(read)
                except UnicodeError:
                    continue
                if garbled != text and not any(encoding.kind_of(c) for c in garbled):
                    bad[k] = text
                    text = garbled
                    break
        out.append((k, text))
    return out, bad


def test_planted_damage_is_found_and_undone(spark, rows):
    data, bad = rows
    extra = [(9001, None), (9002, ""), (9003, "plain ascii"), (9004, "½ of №7 – “quoted” √2 ≈ 1.41 ░▒▓"), (9005, "Ã, Â e Á: letras"), (9006, "lost caf�"), (9007, "Ma&ccedil;&atilde; caf&Atilde;&copy;"), (9008, "é" * 3000)]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in data + extra + data[:1]], "id long, text string, piece string, n int")
    got = {}
    for r in encoding.garbled(df.select("id", "text"), ["id"], "text").collect():
        got.setdefault(r.id, {})[r.piece] = r.meant
    assert set(bad) <= set(got) | {k for k in bad if len(bad[k]) < 5}
    assert not set(got) - set(bad) - {9006, 9007}
    assert got[9006] and got[9007] == {"cafÃ©": "café"}
    whole = sum(all(m in bad[k] for m in got[k].values()) for k in bad)
    assert whole >= 0.95 * len(bad)


def test_what_lies_around_lost_bytes_is_restored(spark, rows):
    shown = lambda text, read, written="utf-8": text.encode(written).decode(read, "replace")
    cases = {
        9001: (shown("Последний", "cp1251").replace("Р»", "�"), "Пос�едний"), 9002: (shown("海辺の手紙", "cp932"), "海辺の手紙"), 9003: (shown("ТИХАЯ", "cp1251"), "ТИХАЯ"),
        9004: (shown("тихая", "cp1251").replace("С‚", "�"), "�ихая"), 9005: ("caf�", "caf�"), 9006: ("�", "�"), 9007: ("señor�", "señor�"),
        9008: (shown("静かな森", "cp1252", "shift_jis"), "�Ãかな�X"),
    }
    assert all(encoding.LOST in text for text, _ in cases.values())
    df = spark.createDataFrame([*rows[0], *((k, text) for k, (text, _) in cases.items())], "id long, text string")
    got = {r.id: (r.piece, r.meant, r.lost) for r in encoding.garbled(df, ["id"], "text").where("id > 9000").collect()}
    assert got == {k: (text, meant, encoding.LOST in meant) for k, (text, meant) in cases.items()}


def test_bytes_that_an_encoding_cannot_show():
    assert encoding.gapped_utf8("Р�", "cp1251") == [("�", ["И"])]
    assert encoding.gapped_utf8("逋ｽ縺�迪ｫ", "cp932")[::2] == [("白", []), ("猫", [])] and "い" in encoding.gapped_utf8("逋ｽ縺�迪ｫ", "cp932")[1][1]
    assert encoding.gapped_utf8("闆�", "gbk")[0][0] == "�"
    assert encoding.gapped_utf8("caf�", "cp1252")[-1] == ("�", []) and encoding.gapped_utf8("señor�", "cp1252") is None


def test_every_pair_teaches_the_model_however_many_there_are(spark):
    rnd = random.Random(3)
    letters = [chr(c) for c in range(0x20000, 0x2A000)]
    many = [("".join(rnd.choices(letters, k=2000)), 2) for _ in range(550)]
    assert len({pair for t, _ in many for pair in zip(t, t[1:])}) > 1_000_000
    model = encoding.Model(encoding.learn(spark.createDataFrame([*many, ("café", 1)], "piece string, n long")))
    total = 1 + 5 + 2 * 550 * 2001
    assert math.isclose(model.score("f", "é"), math.log((1 + encoding._SMOOTH) / total))  # the rarest of all count too
    assert math.isclose(model.score("é", "f"), math.log(encoding._SMOOTH / total))


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert encoding.garbled(df, ["id"], "text").count() == 0


def test_words_that_another_alphabet_could_spell_teach_the_model():
    assert encoding.mixed("\u0414gg") and not encoding.mixed("caf\u00e9") and not encoding.mixed("\u0414\u0430")
    assert not encoding.suspicious("\u00f0\u00f6gg")  # its bytes in another code page are valid UTF-8
    assert encoding.suspicious("caf\u00c3\u00a9")


@pytest.mark.parametrize("written, read", [(w, r) for w in encoding.CYRILLIC for r in encoding.CYRILLIC if w != r])
def test_inverse_is_exact(written, read):
    text = "поезд".encode(written)
    shown = "".join(next(c for c, b in encoding.byte_of(read).items() if b == x) for x in text)
    inverse = encoding.single_inverse(written, read)
    assert "".join(inverse.get(c, c) for c in shown) == "поезд"
