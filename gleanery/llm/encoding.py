"""Text read in a wrong character encoding: a hidden Markov model over characters.

The model has a clean state and one state for each pair of encodings (the one a text was
written in, the one it was read in), and one for lost bytes, which alone emits U+FFFD. A pair's state emits what its inverse transform
makes of the next one to four characters, scored by letter pairs counted over the whole
corpus; the clean state emits the characters as they are. Viterbi labels the characters,
and each labelled span gets its state's inverse transform. The letter pairs are counted
over all rows; pieces whose bytes happen to be valid UTF-8 in another encoding are left
out of the count, and so are, in a second round, those that the first one labelled, so
that frequent damage does not pass for language.

Only pieces with a non-ASCII character, between ASCII separators, are looked at, and each
distinct piece once.
"""

from __future__ import annotations

import html
import math
import mmap
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, product

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import checkpoint, give_file, small_side, spread

# Encodings that single-byte text is written in and read in, by script.
LATIN = ("cp1252", "cp1250", "iso8859_2", "cp437", "cp850", "cp852", "mac_roman", "mac_latin2", "cp1254", "iso8859_15")
CYRILLIC = ("cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic")
GREEK = ("cp1253", "iso8859_7", "cp737", "mac_greek")
#: Multi-byte encodings a text is written in, and those that UTF-8 is read in.
MULTI = ("shift_jis", "euc_jp", "gbk", "big5", "euc_kr", "cp949")
WIDE = ("gbk", "cp932", "big5", "cp949")
READ_UTF8 = ("cp1252", "cp1251", "cp1250", "iso8859_2", "cp437", "cp850", "cp852", "cp866", "koi8_r", "mac_roman", "mac_cyrillic", "cp1253", "iso8859_7", "cp1254", "cp737")

#: Costs in nats: entering a pair's state by how common it is, leaving it, a broken unit.
ENTER_UTF8, ENTER_SINGLE, ENTER_MULTI, LEAVE, BROKEN = 3.0, 7.0, 5.0, 1.5, 11.0
#: By so much a labelled reading must beat the clean one: if what it means is a word that
#: occurs 20 times or four times as often as the piece, or just more often, and if it is unknown.
FREQUENT, COMMON, KNOWN, SURE = -8.0, -4.0, 1.0, 9.0
LOST = "�"
#: So many combinations of letters for lost bytes are looked up among the known words; a piece with more keeps U+FFFD.
GUESSES = 4096
#: So many scores a task keeps at hand; it looks up the others again.
SCORES = 200_000
# A letter of a large script that was never seen is one of thousands.
_SMOOTH, _CONTROL, _RARE = 0.05, 25.0, 9.0

_PIECE = regex.compile(r"[^\x00-\x3f_|]*[^\x00-\x7f][^\x00-\x3f_|]*")
_ENTITY = regex.compile(r"&(?:[A-Za-z][A-Za-z0-9]{1,31}|#[0-9]{1,7}|#x[0-9A-Fa-f]{1,6});")


def pieces(text: str) -> list[str]:
    """Parts of a text that hold a non-ASCII character, HTML entities resolved, letters composed.

    >>> pieces("Caf&eacute;_rouge") == ["Caf" + chr(233)]
    True
    """
    if "&" in text and _ENTITY.search(text):
        text = html.unescape(text)
    return list(dict.fromkeys(_PIECE.findall(unicodedata.normalize("NFC", text))))


@lru_cache(maxsize=None)
def byte_of(encoding: str) -> dict[str, int]:
    """Byte of every character that a single-byte encoding shows for bytes from 0x80.

    Bytes without a character are shown as C1 controls, as Latin-1 shows them.
    """
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    if encoding == "cp1252":
        for b in range(128, 160):
            out.setdefault(chr(b), b)
    return out


@lru_cache(maxsize=None)
def single_inverse(written: str, read: str) -> dict[str, str]:
    """Character shown to letter meant, for two single-byte encodings; some mean themselves."""
    out = {}
    for c, b in byte_of(read).items():
        try:
            meant = bytes([b]).decode(written)
        except UnicodeDecodeError:
            continue
        if meant.isalpha():
            out[c] = meant
    return out


def utf8_unit(piece: str, at: int, read: dict[str, int]) -> tuple[int, str] | None:
    """Length and character of the UTF-8 sequence that starts at ``at``, if there is one."""
    lead = read.get(piece[at])
    if lead is None or not 0xC2 <= lead <= 0xF4:
        return None
    n = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
    tail = [read.get(c, 0) for c in piece[at + 1 : at + n]]
    if len(tail) < n - 1 or any(not 0x80 <= b <= 0xBF for b in tail):
        return None
    try:
        return n, bytes([lead, *tail]).decode("utf-8")
    except UnicodeDecodeError:
        return None


def whole_utf8(piece: str, name: str) -> str | None:
    """What a piece was if all its non-ASCII characters are UTF-8 read in ``name``."""
    read, out, at = byte_of(name), [], 0
    while at < len(piece):
        if piece[at] < "\x80":
            out.append(piece[at])
            at += 1
        elif u := utf8_unit(piece, at, read):
            out.append(u[1])
            at += u[0]
        else:
            return None
    return "".join(out)


def wide_utf8(piece: str, read: str) -> str | None:
    """What UTF-8 text shown in a double-byte encoding was, with a lost end cut; None if it was none."""
    try:
        raw = piece.encode(read)
    except UnicodeEncodeError:
        return None
    try:
        meant = raw.decode("utf-8")
    except UnicodeDecodeError as e:
        if len(raw) - e.start > 2 or e.start < 4:
            return None
        meant = raw[: e.start].decode("utf-8") + LOST
    return meant if meant != piece and any(c > "\x7f" for c in meant) else None


def raw_bytes(piece: str, read: str) -> list[int | None] | None:
    """Bytes that ``read`` shows as this piece, None for each U+FFFD; no list if it cannot show it."""
    if read not in WIDE:
        table = byte_of(read)
        out = [None if c == LOST else ord(c) if c < "\x80" else table.get(c, -1) for c in piece]
        return None if -1 in out else out
    out = []
    for part in regex.split(f"({LOST})", piece):
        try:
            out += [None] if part == LOST else part.encode(read)
        except UnicodeEncodeError:
            return None
    return out


def shows_lost(byte: int, after: int | None, read: str) -> bool:
    """Whether ``read`` shows U+FFFD for a byte before another (-1: the end; None: unknown)."""
    raw = bytes([byte]) if read not in WIDE or after is None or after < 0 else bytes([byte, after])
    shown = raw.decode(read, "replace")
    return shown[0] == LOST or after is None and read in WIDE and 0x80 < byte < 0xFF


def gapped_utf8(piece: str, read: str) -> list[tuple[str, list[str]]] | None:
    """Characters of UTF-8 that was read in ``read`` and lost bytes to U+FFFD; None if it was none.

    Each comes with the characters it may be: none if its bytes are there, U+FFFD standing
    for one that lost some, and then those that lack one byte ``read`` cannot show there.
    """
    raw = raw_bytes(piece, read)
    if raw is None:
        return None
    out, at = [], 0
    follows = lambda k: k < len(raw) and (raw[k] is None or 0x80 <= raw[k] <= 0xBF)
    while at < len(raw):
        lead, end = raw[at], at + 1
        if lead is not None and lead < 0x80:
            out.append((chr(lead), []))
            at += 1
            continue
        if lead is not None and 0x80 <= lead <= 0xBF and at and raw[at - 1] is None:  # U+FFFD took the next lead byte too
            while end - at < 3 and follows(end) and raw[end] is not None:
                end += 1
            out[-1:] = [(LOST, []), (LOST, [])]
            at = end
            continue
        if lead is not None and not 0xC2 <= lead <= 0xF4:
            return None
        most = 4 if lead is None else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        # After a lost lead byte, what another one lost belongs to the next character.
        while end - at < most and follows(end) and (lead is not None or raw[end] is not None):
            end += 1
        unit = raw[at:end]
        if None not in unit:
            try:
                out.append((bytes(unit).decode("utf-8"), []))
            except UnicodeDecodeError:
                return None
        else:
            options = []
            if unit.count(None) == 1:
                k = unit.index(None)
                after = unit[k + 1] if k + 1 < len(unit) else raw[end] if end < len(raw) else -1
                for x in range(0x80, 0xF5):
                    try:
                        c = bytes([*unit[:k], x, *unit[k + 1 :]]).decode("utf-8")
                    except UnicodeDecodeError:
                        continue
                    if len(c) == 1 and c.isalpha() and shows_lost(x, after, read):
                        options.append(c)
            out.append((LOST, options))
        at = end
    return out


@lru_cache(maxsize=None)
def kind_of(c: str) -> str:
    """The large script of a character whose letters are too many to be counted in pairs."""
    o = ord(c)
    if 0x4E00 <= o <= 0x9FFF or 0x3400 <= o <= 0x4DBF:
        return "H"
    if 0xAC00 <= o <= 0xD7A3:
        return "K"
    if 0x3040 <= o <= 0x30FF:
        return "J"
    return "b" if c in "^$" else ""


def pair_keys(a: str, b: str) -> list[tuple[str, str]]:
    """What is counted of two neighbours: the pair, or in large scripts the letter and the pair of scripts."""
    ka, kb = kind_of(a), kind_of(b)
    if (not ka or ka == "b") and (not kb or kb == "b"):
        return [("p", a + b)]
    scripts = ("s", (ka or "x") + (kb or "x"))
    return [scripts, ("u", b)] if kb not in ("", "b") else [scripts]


def mixed(text: str) -> bool:
    """Whether a word has letters of two alphabets, as a chance reading has and a word has not."""
    latin = any(c.isalpha() and c < "\u0250" for c in text)
    return latin + any("\u0370" <= c <= "\u03ff" for c in text) + any("\u0400" <= c <= "\u052f" for c in text) > 1


#: First bytes of UTF-8 next to each other, as damage leaves them that lost the bytes between.
_LEADS = regex.compile(r"[ÂÃÄÅÐÑÎÏ]{2}|([åæèéêëìíîï])(?!\1)[åæèéêëìíîï]")


def suspicious(piece: str) -> bool:
    """Whether a piece must not teach the model what clean text looks like."""
    if any(c == LOST or "\x80" <= c < "\xa0" for c in piece) or _LEADS.search(piece):
        return True
    texts = [whole_utf8(piece, name) for name in READ_UTF8] + [wide_utf8(piece, name) for name in WIDE]
    return any(t and not mixed(t) for t in texts)


def table_key(kind: str, text: str) -> int:
    """Key in the table of counts: a pair ("p"), a pair of scripts ("s"), a letter of a large script ("u"), the total of one of these ("n") or of a letter ("l").

    >>> table_key("p", "ab") < table_key("p", "b" + chr(233)) < table_key("s", "HH")
    True
    """
    return "-psunl".index(kind) << 42 | ord(text[0]) << 21 | ord(text[1:] or "\0")


class Model:
    """Letter-pair scores of clean text, and the states of all pairs of encodings."""

    def __init__(self, name: str):
        # Keys in order, each before its count; mapped, so that tasks share what they look up.
        with open(SparkFiles.get(name), "rb") as f:
            at = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
        self.keys, self.values = at.cast("q")[::2], at.cast("d")[1::2]
        self.total = {k: self.count("n", k) + 1.0 for k in "psu"}
        self.known: dict[tuple[str, str], float] = {}
        self.letters: dict[str, float] = {}
        every = LATIN + CYRILLIC + GREEK
        self.pairs = [(w, r) for w in every for r in every if w != r]

    def count(self, kind: str, text: str) -> float:
        """How often the corpus has a pair or a letter."""
        key = table_key(kind, text)
        at = bisect_left(self.keys, key)
        return self.values[at] if at < len(self.keys) and self.keys[at] == key else 0.0

    def letter(self, c: str) -> float:
        """How often the corpus has a letter, in whatever pair."""
        if c not in self.letters:
            self.letters[c] = self.count("l", c)
        return self.letters[c]

    def score(self, a: str, b: str) -> float:
        """Log frequency of two neighbours in clean text."""
        got = self.known.get((a, b))
        if got is None:
            got = 0.0
            for t, k in pair_keys(a, b):
                n = self.count(t, k)
                got += math.log((n + _SMOOTH) / self.total[t]) - (_RARE if t == "u" and not n else 0.0)
            if "\x80" <= b < "\xa0":
                got -= _CONTROL
            if len(self.known) >= SCORES:
                self.known.clear()
            self.known[a, b] = got
        return got

    def text_score(self, before: str, text: str) -> float:
        s = 0.0
        for c in text:
            s += -BROKEN if c == LOST else -BROKEN / 2 if before == LOST else self.score(before, c)
            before = c
        return s

    def states(self, piece: str) -> list[tuple[str, float, dict[int, tuple[int, str]]]]:
        """States that can emit some of ``piece``: name, cost of entering, units by their start."""
        high = [i for i, c in enumerate(piece) if c > "\x7f"]
        lost = {i: (1, LOST) for i in high if piece[i] == LOST}  # lost in any state
        return [(name, cost, lost | units) for name, cost, units in (*self._utf8(piece, high), *self._multi(piece, high), *self._single(piece, high))]

    def _utf8(self, piece: str, high: list[int]):
        for name in READ_UTF8:
            read, units, whole, until, filled = byte_of(name), {}, 0, 0, {}
            for i in high:
                if i < until:
                    continue
                b = read.get(piece[i], 0)
                if u := utf8_unit(piece, i, read):
                    units[i] = u
                    whole += 1
                    until = i + u[0]
                elif 0xE0 <= b <= 0xEF and i + 1 < len(piece) and 0x80 <= (c := read.get(piece[i + 1], 0)) <= 0xBF:
                    filled[i] = 2, self._filled(piece[i - 1 : i], [chr((b & 15) << 12 | x << 6 | y) for k in range(32) for x, y in ((k, c & 63), (c & 63, k))], piece[i + 2 : i + 3])
                    until = i + 2
                elif 0xC2 <= b <= 0xDF and name in ("cp1252", "cp1251"):
                    filled[i] = 1, self._filled(piece[i - 1 : i], [chr((b & 31) << 6 | k) for k in range(32)], piece[i + 1 : i + 2])
                elif 0xC2 <= b <= 0xEF or 0x80 <= b <= 0xBF:
                    units[i] = (1, LOST)
            units |= {i: (k, options[0]) for i, (k, options) in filled.items()}
            if whole and 2 * whole >= len(units) or name == "cp1252" and (whole or filled):
                for i, (k, options) in list(filled.items())[:1] if len(filled) == 1 else []:
                    for c in options[1:]:
                        yield f"utf_8>{name}", ENTER_UTF8 + (name not in READ_UTF8[:2]), units | {i: (k, c)}
                yield f"utf_8>{name}", ENTER_UTF8 + (name not in READ_UTF8[:2]), units
        for name in ("cp1252", "cp1251", "cp1250", "mac_roman"):  # read wrongly several times over
            text, path, deep = whole_utf8(piece, name), f"utf_8>{name}", 0
            while text and (once := whole_utf8(text, "cp1252")) and once != text:  # each time it gets shorter
                text, path, deep = once, f"{path}>cp1252", deep + 1
                if any(c > "\x7f" for c in text):
                    yield path, ENTER_UTF8 + deep, {0: (len(piece), text)}
        for name in WIDE:
            if meant := wide_utf8(piece, name):
                yield f"utf_8>{name}", ENTER_UTF8 + 1, {0: (len(piece), meant)}

    def restored(self, piece: str) -> list[tuple[float, str, str, list[tuple[int, int]]]]:
        """Labellings, as those of ``label``, of a piece that holds U+FFFD: those that are sure.

        What lies around the lost bytes is restored. A character that lost one byte is put
        back if only one letter fits, or only one that the corpus has; U+FFFD stays for any
        other. Where several letters fit, their combinations come as well, with a gain of
        KNOWN - SURE: they are only right if they mean a known word.
        """
        clean = self.text_score("^", piece) + self.score(piece[-1], "$")
        tried, guessed = self.label(piece), []
        for name in (*READ_UTF8, *WIDE):
            chars = gapped_utf8(piece, name)
            if not chars or all(c <= "\x7f" or c == LOST and not options for c, options in chars):
                continue
            fits = [[c] if c != LOST else options if len(options) == 1 else [o for o in options if self.letter(o)] or [LOST] for c, options in chars]
            meant = unicodedata.normalize("NFC", "".join(f[0] if len(f) == 1 else LOST for f in fits))
            if any(c > "\x7f" and c != LOST for c in meant):
                gain = self.text_score("^", meant) + (-BROKEN / 2 if meant[-1] == LOST else self.score(meant[-1], "$")) - ENTER_UTF8 - (name not in READ_UTF8[:2]) - clean
                tried.append((gain, f"utf_8>{name}", meant, [(0, len(piece))]))
            if 1 < math.prod(map(len, fits)) <= GUESSES and [LOST] not in fits:
                guessed += [(KNOWN - SURE, f"utf_8>{name}", unicodedata.normalize("NFC", "".join(g)), [(0, len(piece))]) for g in product(*fits)]
        best: dict[str, tuple] = {}
        for x in sorted(tried, key=lambda x: (-x[0], x[1])):
            if x[0] >= SURE:
                best.setdefault(x[2], x)
        for x in guessed:
            best.setdefault(x[2], x)
        return list(best.values())

    def _filled(self, before: str, options: list[str], after: str) -> list[str]:
        """The characters, likeliest first, of a sequence that lost one byte without a sign (0x80 to 0x9F)."""
        around = lambda c: (self.score(before, c) if before and before < "\x80" else 0.0) + (self.score(c, after) if after and after < "\x80" else 0.0)
        seen = [c for c in options if self.letter(c)]
        return sorted(seen, key=lambda c: (-around(c), -self.letter(c), c)) or [LOST]

    def _multi(self, piece: str, high: list[int]):
        for written in MULTI:
            for name in ("cp1252", "cp1251"):
                read, units = byte_of(name), {}
                for i in high:
                    if i + 1 == len(piece) or (lead := read.get(piece[i])) is None:
                        continue
                    k = 3 if written == "euc_jp" and lead == 0x8F else 2
                    tail = [ord(c) if c < "\x80" else read.get(c, 0) for c in piece[i + 1 : i + k]]
                    try:
                        c = bytes([lead, *tail]).decode(written)
                    except UnicodeDecodeError:
                        continue
                    if len(c) == 1 and c > "\x7f" and c.isalpha():
                        units[i] = (k, c)
                if units:
                    yield f"{written}>{name}", ENTER_MULTI, units

    def _single(self, piece: str, high: list[int]):
        seen = set()
        for written, read in self.pairs:
            inverse = single_inverse(written, read)
            units = {i: (1, inverse[piece[i]]) for i in high if piece[i] in inverse}
            mark = tuple(units.items())
            if any(meant != piece[i] for i, (_, meant) in mark) and mark not in seen:  # pairs that mean the same here are one state
                seen.add(mark)
                yield f"{written}>{read}", ENTER_SINGLE, units

    def label(self, piece: str) -> list[tuple[float, str, str, list[tuple[int, int]]]]:
        """Viterbi for each state: the best labellings as gain over all clean, state, text meant and spans.

        A piece between separators was damaged in one way, so each path visits the clean
        state and one pair's. Best first; one labelling for each meaning: the best, and all
        that may still be taken if they mean a frequent word.
        """
        n = len(piece)
        clean = self.text_score("^", piece) + self.score(piece[-1], "$")
        best: dict[str, tuple] = {}
        for name, cost, units in self.states(piece):
            # The labelling that leaves no character of the piece in the clean state, if there is one.
            whole, i = "", 0
            while i < n and (piece[i] <= "\x7f" or i in units):
                k, meant = units.get(i, (1, piece[i]))
                whole, i = whole + meant, i + k
            if i == n and LOST not in whole:
                whole = unicodedata.normalize("NFC", whole)
                gain = self.text_score("^", whole) + self.score(whole[-1], "$") - cost - clean
                if any(c > "\x7f" for c in whole) and gain > best.get(whole, (-math.inf,))[0]:
                    best[whole] = (gain, name, whole, [(0, n)])
            # A cell holds score, last character meant, text meant and spans.
            cells: list[list] = [[None, None] for _ in range(n + 1)]
            cells[0][0] = (0.0, "^", "", ())
            for i, c in enumerate(piece):
                for state in (0, 1):
                    if cells[i][state] is None:
                        continue
                    s, last, text, spans = cells[i][state]
                    stay = s + (-BROKEN / 2 if last == LOST else self.score(last, c))
                    if state == 0 or c <= "\x7f":  # ASCII belongs to either state
                        _put(cells[i + 1], state, (stay, c, text + c, spans))
                    else:
                        _put(cells[i + 1], 0, (stay - LEAVE, c, text + c, spans))
                    if i in units:
                        k, meant = units[i]
                        step = s + self.text_score(last, meant) - (0.0 if state else cost) - (BROKEN * (k - 1) if meant == LOST else 0.0)
                        grown = spans[:-1] + ((spans[-1][0], i + k),) if state and spans and spans[-1][1] == i else spans + ((i, i + k),)
                        _put(cells[i + k], 1, (step, meant[-1], text + meant, grown))
            for cell in cells[n]:
                if cell is not None and cell[3]:
                    gain = cell[0] + (-BROKEN / 2 if cell[1] == LOST else self.score(cell[1], "$")) - clean
                    meant = unicodedata.normalize("NFC", cell[2])
                    if any(c > "\x7f" and c != LOST for c in meant) and gain > best.get(meant, (-math.inf,))[0]:
                        best[meant] = (gain, name, meant, list(cell[3]))
        first, *others = sorted(best.values(), key=lambda x: (-x[0], x[1])) or [None]
        return [first, *(x for x in others if x[0] >= FREQUENT)] if first else []


def _put(cell: list, state: int, new: tuple) -> None:
    if cell[state] is None or new[0] > cell[state][0]:
        cell[state] = new


def learn(counted: DataFrame) -> str:
    """Letter pairs of all pieces (columns piece and n), summed over the whole corpus, as the file of a ``Model``.

    Every pair counts, however many there are: the table passes through the driver in parts,
    and tasks look up in the file what they need. Letters of large scripts are counted one by
    one and not in pairs.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sums: Counter = Counter()
            for piece, n in zip(pdf.piece, pdf.n):
                if not suspicious(piece):
                    for a, b in zip("^" + piece, piece + "$"):
                        for key in pair_keys(a, b):
                            sums[key] += n
            for (t, k), v in list(sums.items()):
                sums["n", t] += v
                if t != "s" and k[-1] > "\x9f":
                    sums["l", k[-1]] += v
            yield pd.DataFrame([(table_key(t, k), float(v)) for (t, k), v in sums.items()], columns=["k", "v"])

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"part": [np.rec.fromarrays([pdf.k, pdf.v], dtype="i8, f8").tobytes()]})

    rows = counted.mapInPandas(count, "k long, v double").groupBy("k").agg(F.sum("v").alias("v"))
    parts = checkpoint(rows.orderBy("k").mapInPandas(pack, "part binary")).toLocalIterator()
    return give_file(counted.sparkSession, chain([bytes(16)], (r.part for r in parts)))  # a file that is empty cannot be mapped


def garbled(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Each garbled piece of each row: keys, piece, meant, state and lost.

    ``lost`` says that part of the piece cannot be restored (meant then shows U+FFFD).
    Null, empty and plain ASCII texts give no row. A row with several garbled pieces gives
    several rows, a piece that repeats in a row one.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[keys].assign(piece=[pieces(t) for t in pdf["__text"]]).explode("piece").dropna(subset=["piece"])

    odd = F.col(text).rlike(r"[^\x00-\x7f]") | F.col(text).rlike(_ENTITY.pattern)
    cut_up = checkpoint(df.select(*keys, F.col(text).alias("__text")).where(odd).mapInPandas(cut, ddl + ", piece string"))
    counted = checkpoint(spread(cut_up.groupBy("piece").agg(F.count("*").alias("n")), "piece"))
    first = _judged(counted, learn(counted))
    # Second round: what the first one labelled no longer teaches the model.
    final = _judged(counted, learn(first.where("not found")))
    found = small_side(final.where("found").select("piece", "meant", "state", "lost"))
    return cut_up.join(found, "piece").select(*keys, "piece", "meant", "state", "lost")


def _judged(counted: DataFrame, counts: str) -> DataFrame:
    """Label each distinct piece and decide whether it is garbled."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(counts)
        for pdf in batches:
            out = []
            for piece, n in zip(pdf.piece, pdf.n):
                if LOST in piece:  # garbled in any case
                    tried = sorted([*((SURE + gain, *rest) for gain, *rest in model.restored(piece)), (SURE, "lost", piece, [])], key=lambda x: -x[0])
                else:
                    tried = model.label(piece)
                out += [(piece, n, meant, state, gain, k) for k, (gain, state, meant, _) in enumerate(tried)] or [(piece, n, piece, "clean", -math.inf, 0)]
            yield pd.DataFrame(out, columns=["piece", "n", "meant", "state", "gain", "place"])

    rows = checkpoint(counted.mapInPandas(judge, "piece string, n long, meant string, state string, gain double, place int"))
    words = rows.where((F.col("place") == 0) & (F.col("gain") < SURE)).groupBy(F.lower("piece").alias("word")).agg(F.sum("n").alias("times"))
    own, meant = words.select(F.col("word").alias("w1"), F.col("times").alias("own")), words.select(F.col("word").alias("w2"), F.col("times").alias("known"))
    rows = rows.join(own, F.lower("piece") == F.col("w1"), "left").join(meant, F.lower("meant") == F.col("w2"), "left")
    known, own_n = F.coalesce("known", F.lit(0)), F.coalesce("own", F.lit(0))
    enough = (F.col("gain") >= COMMON) & (known >= 4 * own_n) | (F.col("gain") >= FREQUENT) & (known >= 20 * own_n)
    usual = (F.col("gain") >= KNOWN) & (known > own_n) | enough & (known > 0) & (F.length("piece") > 2)
    # A labelling that means a known word goes before one that only scores higher.
    order = F.struct(usual.alias("usual"), "gain", -F.col("place"))
    top = rows.groupBy("piece", "n").agg(F.max(order).alias("o"), F.max_by(F.struct("meant", "state"), order).alias("b"))
    return top.select("piece", "n", "b.meant", "b.state", F.col("b.meant").contains(LOST).alias("lost"), ((F.col("o.gain") >= SURE) | F.col("o.usual")).alias("found"))
