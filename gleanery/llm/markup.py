"""Markup residue: token streams, wrappers inferred from the streams of a host, clean text.

A text is read into a stream of tokens and stretches of text. The streams of one host are
folded into a union-free regular expression, the host's wrapper: repeats next to each
other become repeated groups, streams are aligned on their common tokens, a token or group
that only some of them have becomes optional, and text becomes slots.

The wrapper decides which tokens are marks. Some are complete in themselves (an HTML
element of the standard, an entity, a link, a LaTeX command with its argument): their node
is a mark in any wrapper. Others only look like marks: bulletin-board tags of whatever name
("[b]", "[A]"), elements of unknown name, numbers that begin a line. Their node is a mark
if the wrapper supports it, by the node that closes what it opens, or by a repeated group
that it begins; else it is part of a slot. Each text is read through the wrapper of its
host, and what lands on a mark counts for ``unwrapped`` and goes out in ``clean``; what
lands in a slot stays.
"""

from __future__ import annotations

import html
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import checkpoint, small_side, spread

# Names of HTML elements, bulletin-board tags, and LaTeX commands that take no brace.
HTML = "a abbr acronym address area article aside audio b base big blockquote body br button caption center cite code col colgroup dd del details dfn dir div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark menu meta nav noscript object ol optgroup option p param picture pre q ref s samp script section select small source span strike strong style sub summary sup table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr nowiki"
BOARD = "b i u s url img quote code list size color colour font center left right align spoiler hr br table tr td th youtube video email sub sup indent pre noparse highlight * li ul ol h1 h2 h3 attach hide"
BARE_COMMANDS = "item hline centering maketitle it bf em tt sc rm sl small large Large huge noindent newline newpage par LaTeX TeX ldots dots cdot cdots times div pm leq geq neq approx infty alpha beta gamma delta epsilon theta lambda mu pi sigma phi omega sum prod int partial nabla rightarrow leftarrow to quad qquad left right"

#: Skeleton of a text without any mark.
SLOT = "#"
#: Streams of a host are folded in this many parts, by hash, before the parts are.
PARTS = 8
#: Streams that a task reads through one wrapper.
STREAMS = 2000


def _names(words: str) -> str:
    return "|".join(regex.escape(w) for w in sorted(words.split(), key=len, reverse=True))


_MARKS = [
    ("comment", r"<!--.*?(?:-->|\Z)|<!DOCTYPE[^>]*>|<\?xml[^>]*>"),
    ("script", r"<(?P<sc>script|style)\b[^>]*>.*?(?:</(?P=sc)\s*>|\Z)"),
    ("tag", rf"</?(?P<tag>{_names(HTML)})(?:\s+[^<>]*|\s*/)?>|</?(?:{_names(HTML)})\s+[a-z\-]+\s*=\s*[\"'][^<>]*"),
    ("entity", r"&(?P<ent>[A-Za-z][A-Za-z0-9]{1,31}|\#[0-9]{1,7}|\#x[0-9a-f]{1,6});"),
    ("fence", r"^[ ]{0,3}(?P<f>```+|~~~+)[^\n`]*\n.*?(?:^[ ]{0,3}(?P=f)\s*$|\Z)"),
    ("math", r"\$\$[^$]+\$\$|\\\[.*?\\\]|\\\(.*?\\\)|\$(?![\s\d])(?:[^$\n]*(?:\\[a-zA-Z]|[\^_=+<>])[^$\n]*|[A-Za-z])(?<!\s)\$(?!\d)|\\begin\{(?P<me>equation|align|displaymath|math|eqnarray|gather|multline)\*?\}.*?(?:\\end\{(?P=me)\*?\}|\Z)"),
    ("verbatim", r"\\begin\{(?P<ve>verbatim|lstlisting|minted)\}.*?(?:\\end\{(?P=ve)\}|\Z)|\\verb(?P<vd>[|!+]).*?(?P=vd)"),
    ("env", r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\])?"),
    ("command", rf"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?(?=\{{)|\{{\\(?:{_names(BARE_COMMANDS)})\b|\\(?:{_names(BARE_COMMANDS)})(?![A-Za-z\\])|\\[%&_$\#{{}}](?=\s|\w)|\\\\(?=\s*\n)"),
    ("board", rf"\[/?(?P<bb>{_names(BOARD)})(?:=[^\[\]\n]*)?\](?!\((?:[a-z]+:|www\.|[/\#.]))|\[/?(?P<bb>[A-Za-z][A-Za-z0-9]*)(?:=[^\[\]\n]*)?\](?![(\[])"),
    ("template", r"\{\{[^{}\n]*\}\}|^\{\|.*?^\|\}"),
    ("wikilink", r"\[\[[^\[\]\n]+\]\]|\[(?:https?|ftp)://[^\s\]]+(?:\s[^\]\n]*)?\]"),
    ("quotes", r"'''''(?=\S).+?'''''|'''(?=\S).+?'''|''(?=\S).+?(?<=\S)''(?!')"),
    ("wikihead", r"^[ ]{0,3}(?P<wh>={2,6})[ ]*[^=\s\n][^=\n]*?[ ]*(?P=wh)[ ]*$"),
    ("image", r"!\[[^\]\n]*\]\([^()\n]*\)"),
    ("link", r"\[[^\]\[\n]+\]\((?:[^()\s]|\([^()\s]*\))+(?:\s+\"[^\"\n]*\")?\)|\[[^\]\[\n]+\]\[[^\]\[\n]*\]|<(?:https?://|mailto:)[^<>\s]+>"),
    ("setext", r"(?<=[^\s])\n[ ]{0,3}(?:={3,}|-{3,})[ ]*$"),
    ("head", r"^[ ]{0,3}\#{1,6}[ ]+(?=\S)"),
    ("rule", r"^[ ]{0,3}(?:[-*_][ ]*){3,}$|^-{4,}[ ]*$"),
    ("table", r"^[ ]*\|?[ ]*:?-{2,}:?[ ]*(?:\|[ ]*:?-{2,}:?[ ]*)+\|?[ ]*$"),
    ("row", r"^[ ]*\|[^\n|]*\|[^\n]*\|?[ ]*$"),
    ("quote", r"^[ ]{0,3}>+[ ]+(?=\S)"),
    ("bullet", r"^[ ]{0,6}[*+\-][ ]+(?=\S)|^\#[ ]+(?=\S)|^[*\#:;]{2,}[ ]+(?=\S)"),
    ("number", r"^[ ]{0,3}[0-9]{1,3}[.)][ ]+(?=\S)"),
    ("code", r"(?<![`\\])(?P<bt>`{1,2})(?!`)[^`\n]+?(?<!`)(?P=bt)(?!`)"),
    ("strong", r"(?<![*\\\w])\*{2,3}(?=[^\s*])[^\n]*?(?<=[^\s*])\*{2,3}(?![*\w])|(?<![_\\\w])__(?=[^\s_])[^\n]*?(?<=[^\s_])__(?![_\w])"),
    ("strike", r"(?<!~)~~(?=[^\s~])[^\n]*?(?<=[^\s~])~~(?!~)"),
    ("emphasis", r"(?<![*\\\w])\*(?=[^\s*])[^*\n]*?(?<=[^\s*])\*(?![*\w])|(?<![_\\\w/])_(?=[^\s_])[^_\n]*?(?<=[^\s_])_(?![_\w])"),
    ("element", r"</?(?P<el>[A-Za-z][A-Za-z0-9_\-]*)(?:\s+[A-Za-z_\-]+\s*=[^<>]*|\s*/)?>"),
]
#: No mark begins with a letter, or with a space or digit within a line.
_BEGIN = r"(?=[<&`~$\\\[{'=!\n\-*_#>|:;+]|(?:(?<=\n)|\A)[ 0-9])"
_LEXER = regex.compile(_BEGIN + "(?:" + "|".join(f"(?P<k_{k}>{p})" for k, p in _MARKS) + ")", regex.M | regex.S | regex.I)
_WORTH = r"[<&\[\]*_#=\\`~|$'{]|\n *[-+>] |^ *[-+>] |\n *[-0-9]|^ {0,3}[0-9]{1,3}[.)] "


def _well_formed(kind: str, m: regex.Match) -> bool:
    """Whether a match is a token at all: an entity has a name, "<a b and c>" is no element."""
    if kind == "entity":
        return m["ent"][0] == "#" or f"{m['ent']};" in html.entities.html5 or f"{m['ent'].lower()};" in html.entities.html5
    if kind == "tag" and m["tag"] and len(m["tag"]) == 1 and m[0].startswith("<") and " " in m[0] and "=" not in m[0]:
        return False
    return True


def signs(text: str) -> list[tuple[str, regex.Match]]:
    """All that is or looks like a mark in a text, in order, as kind and match."""
    out, at = [], 0
    while m := _LEXER.search(text, at):
        kind = m.lastgroup if m.lastgroup and m.lastgroup.startswith("k_") else next(g for g, v in m.groupdict().items() if g.startswith("k_") and v is not None)
        if _well_formed(kind[2:], m):
            out.append((kind[2:], m))
            at = m.end() if m.end() > m.start() else m.end() + 1
        else:
            at = m.start() + 1
    return out


def _token(kind: str, m: regex.Match) -> str:
    if kind in ("tag", "element"):
        return "<" + ("/" if m[0].startswith("</") else "") + (m["tag"] or m["el"] or "tag").lower() + ">"
    if kind == "board":
        name = m["bb"] if len(m["bb"]) == 1 else m["bb"].lower()  # "[B]" may be a remark where "[b]" is none
        return "[" + ("/" if m[0].startswith("[/") else "") + name + "]"
    if kind == "entity":
        return SLOT  # part of the text
    if kind in ("env", "command"):
        return regex.sub(r"\[[^\]]*\]|\s", "", m[0])
    return f"{{{kind}}}"


def marks(text: str) -> list[tuple[str, regex.Match]]:
    """The marks of a text that is its own only witness, as if its host had one page."""
    return [x for x, k in zip(signs(text), Wrapper.of([text]).kept(text)) if k]


_COMPLETE = frozenset(HTML.split()) | {"tag"}
#: Boards' tags that close nothing and are closed by none.
_ALONE = ("[hr]", "[br]")


def looks_only(token: str) -> bool:
    """Whether a token only looks like a mark, so that the wrapper has to support it."""
    return token[0] == "[" and token not in _ALONE or token == "{number}" or token[0] == "<" and token.strip("</>") not in _COMPLETE


def opened(text: str) -> str:
    """The text with markup that was escaped, however often, put back.

    >>> opened("&amp;lt;b&amp;gt;"), opened("a &lt; b")
    ('<b>', 'a &lt; b')
    """
    while _ESCAPED.search(text) and (once := html.unescape(text)) != text:
        text = once
    return text


def stream(text: str | None) -> tuple[list[str], int]:
    """Folded tokens of a text, with text as slots, and the number of its marks that need no support.

    >>> stream("<p>One <b>two</b> [A]</p>")
    (['<p>', '#', '<b>', '#', '</b>', '[A]', '</p>'], 4)
    """
    if not text or text.isspace():
        return [], 0
    plain = opened(text)
    tokens, places = _read(plain)
    sure = sum(t == SLOT or not looks_only(t) for t in (tokens[k] for k in places)) + (plain != text)
    return fold(tokens), sure


def _read(text: str) -> tuple[list[str], list[int]]:
    """Unfolded tokens of an opened text, and for each of its ``signs`` the place of its token."""
    tokens, places, at = [], [], 0
    for kind, m in signs(text):
        if text[at : m.start()].strip() and tokens[-1:] != [SLOT]:
            tokens.append(SLOT)
        t = _token(kind, m)
        if not (t == SLOT and tokens[-1:] == [SLOT]):
            tokens.append(t)
        places.append(len(tokens) - 1)
        at = m.end()
    if text[at:].strip() and tokens[-1:] != [SLOT]:
        tokens.append(SLOT)
    return tokens, places


@lru_cache(maxsize=50_000)
def inner(name: str) -> list[str]:
    """The plain tokens of a folded one.

    >>> inner("((<td> # </td>)+ </tr>)+")
    ['<td>', '#', '</td>', '</tr>']
    """
    return name.replace(")+", "").replace("(", "").split(" ")


def _runs(codes: np.ndarray, size: int) -> bool:
    """Whether any run of ``size`` codes is followed by itself."""
    same = np.flatnonzero(codes[size:] != codes[:-size])
    edges = np.concatenate(([-1], same, [len(codes) - size]))
    return bool((np.diff(edges) > size).any())


@lru_cache(maxsize=50_000)
def _folded(tokens: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(name for name, _ in fold_places(tokens))


def fold(tokens: Sequence[str]) -> list[str]:
    """Repeats next to each other as one repeated group, shortest groups first.

    >>> fold(["<ul>", "<li>", "#", "<li>", "#", "</ul>"])
    ['<ul>', '(<li> #)+', '</ul>']
    """
    return list(_folded(tuple(tokens)))


def fold_places(tokens: Sequence[str]) -> list[tuple[str, list[list[int]]]]:
    """As ``fold``, and for each plain token of a folded one the places it had in ``tokens``.

    >>> fold_places(["<li>", "#", "<li>", "#", "</ul>"])
    [('(<li> #)+', [[0, 2], [1, 3]]), ('</ul>', [[4]])]
    """
    names, places = list(tokens), [[[k]] for k in range(len(tokens))]
    size = 1
    while size <= len(names) // 2 and len(set(names)) < len(names):
        if len(names) > 100:  # long streams: look for any repeat of this size at once
            numbers: dict[str, int] = {}
            if not _runs(np.array([numbers.setdefault(t, len(numbers)) for t in names]), size):
                size += 1
                continue
        i, changed = 0, False
        while i + 2 * size <= len(names):
            group = names[i : i + size]
            n = 1
            while names[i + n * size : i + (n + 1) * size] == group:
                n += 1
            if n > 1:
                one = group[0] if size == 1 and group[0].endswith(")+") else f"({' '.join(group)})+"
                copies = [[p for ps in places[i + k * size : i + (k + 1) * size] for p in ps] for k in range(n)]
                names[i : i + n * size] = [one]
                places[i : i + n * size] = [[sum(ps, []) for ps in zip(*copies)]]
                changed = True
            i += 1
        size = 1 if changed and size > 1 else size + 1
    return list(zip(names, places))


#: Kinds of blocks that clean text consists of.
BLOCKS = ("heading", "paragraph", "list_item", "code", "formula", "quote", "table_row")
_ESCAPED = regex.compile(r"&(?:amp;)*(?:lt|\#60|\#x3c);/?[a-z!]", regex.I)
_BLOCK_TAGS = {**{f"h{k}": "heading" for k in range(1, 7)}, "title": "heading", "li": "list_item", "dt": "list_item", "dd": "list_item", "pre": "code", "blockquote": "quote", "tr": "table_row"}
_BREAK_TAGS = set("p div ul ol dl table tbody thead hr section article header footer center form body html".split())
_BLOCK_BOARD = {"size": "heading", "h1": "heading", "h2": "heading", "h3": "heading", "*": "list_item", "li": "list_item", "code": "code", "quote": "quote", "tr": "table_row"}


class _Blocks:
    """Collects text into blocks of a kind."""

    def __init__(self) -> None:
        self.done: list[tuple[str, str]] = []
        self.kind, self.text = "paragraph", ""

    def start(self, kind: str = "paragraph") -> None:
        lines = [self.text.strip("\n")] if self.kind == "code" else [" ".join(x.split()) for x in self.text.split("\n")]
        for line in lines:
            if line.strip(" |"):
                self.done.append((self.kind, line.strip(" |") if self.kind == "table_row" else line))
        self.kind, self.text = kind, ""

    def whole(self, kind: str, text: str) -> None:
        self.start(kind)
        self.text = text
        self.start()


def _inner(text: str) -> str:
    """Inline text without the marks inside it."""
    return " ".join(t for _, t in to_blocks(text))


def to_blocks(text: str | None, kept: Sequence[bool] | None = None) -> list[tuple[str, str]]:
    """Clean text as blocks (kind, text) in order; see BLOCKS.

    ``kept`` says of each of ``signs(opened(text))`` whether it is a mark; without it the
    text is its own only witness, as if its host had one page.

    Headings, list items, code, formulas, quotes and table rows keep their kind; links
    and emphasis keep their words; comments, scripts, images and templates go. Null and
    blank texts have no blocks.

    >>> to_blocks("== Bridge ==\\n* [[a|one]]\\n* two **big**")
    [('heading', 'Bridge'), ('list_item', 'one'), ('list_item', 'two big')]
    """
    if not text:
        return []
    text = opened(text)
    found = signs(text)
    if kept is None and any(looks_only(_token(*x)) for x in found):
        kept = Wrapper.of([text]).kept(text)
    if kept is not None:
        found = [x for x, k in zip(found, kept) if k]
    out, at, braces = _Blocks(), 0, 0
    for kind, m in [*found, ("end", None)]:
        plain = text[at : m.start() if m else len(text)]
        while braces and "}" in plain:  # the brace that a command opened
            plain = plain.replace("}", "\n" if out.kind == "heading" else "", 1)
            braces -= 1
        first, *others = plain.split("\n") if out.kind in ("heading", "list_item", "quote", "table_row") else [plain]
        out.text += first
        if others and first + out.text:
            if (out.text + first).strip():
                out.start()
            out.text += "\n".join(others)
        if m is None:
            break
        s, at = m[0], m.end()
        if kind in ("tag", "element", "board"):
            name = m["bb"] if kind == "board" else m["tag"] or m["el"] or ""
            name, closing = name.lower(), s[1:2] == "/"
            block = (_BLOCK_BOARD if kind == "board" else _BLOCK_TAGS).get(name)
            if kind == "board" and name in ("img", "youtube", "video", "attach") and not closing:
                end = regex.search(rf"\[/{name}\]", text[at:], regex.I)
                at += end.start() if end else 0
                continue
            if block:
                if not (name == "li" and closing and out.kind != "list_item"):
                    out.start("paragraph" if closing else block)
            elif name == "br":
                out.text += "\n"
                if out.kind != "code":
                    out.start("paragraph" if out.kind == "heading" else out.kind)
            elif name in ("td", "th") and closing:
                out.text += " | "
            elif name in _BREAK_TAGS or kind == "board" and name == "list":
                out.start()
        elif kind == "entity":
            out.text += html.unescape(s).replace("\xa0", " ")
        elif kind in ("fence", "verbatim"):
            body = s.strip("`~ \n").split("\n", 1) if kind == "fence" else [s, regex.sub(r"\\(?:begin|end)\{\w+\}|\\verb.", "", s)]
            out.whole("code", body[-1].strip("|!+\n"))
        elif kind == "math":
            body = regex.sub(r"^(?:\$\$?|\\[\[(]|\\begin\{\w+\*?\})|(?:\$\$?|\\[\])]|\\end\{\w+\*?\})$", "", s).strip()
            alone = not plain.rpartition("\n")[2].strip() and text[at : at + 1] in ("", "\n")
            if alone or s.startswith(("$$", "\\[", "\\begin")):
                out.whole("formula", body)
            else:
                out.text += body
        elif kind == "command":
            name = s.strip("{\\").split("[")[0].rstrip("*")
            braces += s.startswith("{") or text[at : at + 1] == "{"
            at += text[at : at + 1] == "{"
            if name in ("section", "subsection", "subsubsection", "chapter", "title", "part"):
                out.start("heading")
            elif name == "item":
                out.start("list_item")
            elif name == "footnote":
                out.text += " "
            elif len(name) == 1 and not name.isalpha():
                out.text += name
        elif kind == "env":
            out.start("quote" if s.startswith("\\begin{quot") else "paragraph")
        elif kind == "template":
            words = s[2:-2].split("|")
            out.text += words[1] if len(words) == 2 and "=" not in words[1] and not s.startswith("{|") else ""
        elif kind == "wikilink":
            words = s.strip("[]").split("|") if s.startswith("[[") else s[1:-1].split(None, 1)
            out.text += "" if regex.match(r"(?i)(?:file|image|category):", words[0]) else words[-1]
        elif kind in ("wikihead", "head", "setext"):
            if kind == "wikihead":
                out.whole("heading", _inner(s.strip().strip("=")))
            elif kind == "head":
                out.start("heading")
            else:
                *before, last = out.text.split("\n")
                out.text = "\n".join(before)
                out.whole("heading", last)
        elif kind in ("quotes", "strong", "emphasis", "strike", "code"):
            mark = {"quotes": "'", "strong": "*_", "emphasis": "*_", "strike": "~", "code": "`"}[kind]
            out.text += s.strip(mark) if kind == "code" else _inner(s.strip(mark))
        elif kind == "link":
            out.text += _inner(regex.match(r"\[([^\]]+)\]|<([^>]+)>", s)[1] or s.strip("<>"))
        elif kind in ("bullet", "number", "quote"):
            out.start("quote" if kind == "quote" else "list_item")
        elif kind == "row":
            out.whole("table_row", " | ".join(_inner(c) for c in s.strip().strip("|").split("|")))
        elif kind in ("rule", "table"):
            out.start()
    out.start()
    return out.done


class Wrapper:
    """A union-free expression: folded tokens in order, each required or optional."""

    def __init__(self, nodes: list[tuple[str, bool]] | None = None, rows: int = 0):
        self.nodes, self.rows = nodes or [], rows
        self._groups = [inner(t) if t.endswith(")+") else None for t, _ in self.nodes]
        self._held: frozenset[str] | None = None
        self._found: tuple | None = None

    @classmethod
    def of(cls, texts: Sequence[str]) -> Wrapper:
        """The wrapper of a few texts."""
        whole = cls()
        for t in texts:
            whole = whole.merge(cls([(name, False) for name in stream(t)[0]], 1))
        return whole

    def merge(self, other: Wrapper) -> Wrapper:
        """Align two expressions on their common tokens; what one of them lacks becomes optional.

        What one of them has once and the other as a repeated group is that group.
        """
        if not self.rows or not other.rows:
            return self if self.rows else other
        left, right = self._absorbed(other._groups), other._absorbed(self._groups)
        mine, yours = [t for t, _ in left], [t for t, _ in right]
        out: list[tuple[str, bool]] = []
        for op, a, b, c, d in SequenceMatcher(None, mine, yours, autojunk=False).get_opcodes():
            if op == "equal":
                out += [(mine[k], left[k][1] or right[c + k - a][1]) for k in range(a, b)]
            else:
                out += [(t, True) for t in mine[a:b]] + [(t, True) for t in yours[c:d]]
        return Wrapper(self.settled(out), self.rows + other.rows)

    def _absorbed(self, groups: list[list[str] | None]) -> list[tuple[str, bool]]:
        """The nodes, with what the other side repeats as that group."""
        nodes = list(self.nodes)
        for group in sorted({tuple(g) for g in groups if g}):
            name, i = f"({' '.join(group)})+", 0
            while i + len(group) <= len(nodes):
                part = nodes[i : i + len(group)]
                if tuple(t for t, _ in part) == group and not any(o for _, o in part):
                    nodes[i : i + len(group)] = [(name, False)]
                i += 1
        return nodes

    @staticmethod
    def settled(nodes: list[tuple[str, bool]]) -> list[tuple[str, bool]]:
        """Optional tokens that stand next to their like are one."""
        out: list[tuple[str, bool]] = []
        for token, optional in nodes:
            if out and out[-1][0] == token and (optional or out[-1][1]):
                out[-1] = (token, out[-1][1] and optional)
            else:
                out.append((token, optional))
        return out

    def reads(self, tokens: Sequence[str]) -> bool:
        """Whether the expression accepts a folded stream."""
        # reach[i] holds the nodes that may come next once i tokens are read.
        n, reach = len(tokens), [set() for _ in range(len(tokens) + 1)]
        reach[0].add(0)
        starts, until = self._index()
        for i in range(n):
            open_ = sorted(reach[i])
            for k, size in starts.get(tokens[i], ()) if open_ else ():
                # The latest start is the one from which the fewest nodes have to be passed over.
                at = bisect_right(open_, k) - 1
                if at >= 0 and until[open_[at]] >= k and (not size or list(tokens[i : i + size]) == self._groups[k]):
                    reach[i + (size or 1)].add(k + 1)
        return any(until[s] == len(self.nodes) for s in reach[n])

    def _index(self) -> tuple[dict[str, list[tuple[int, int]]], list[int]]:
        """Nodes by the token they begin with (and the length of the group, 0 if it is folded), and for each node the next required one."""
        if self._found is None:
            starts: dict[str, list[tuple[int, int]]] = {}
            until = [len(self.nodes)] * (len(self.nodes) + 1)
            for k in range(len(self.nodes) - 1, -1, -1):
                until[k] = until[k + 1] if self.nodes[k][1] else k
            for k, (name, _) in enumerate(self.nodes):
                starts.setdefault(name, []).append((k, 0))
                if self._groups[k]:
                    starts.setdefault(self._groups[k][0], []).append((k, len(self._groups[k])))
            self._found = starts, until
        return self._found

    def held(self) -> frozenset[str]:
        """The tokens that only look like marks and are marks in this expression.

        A tag is if the expression holds one that opens before one that closes it; a number
        that begins a line if it holds a repeated group with it; an entry of a list in such
        a group, or if it holds a list that opens and closes.
        """
        if self._held is None:
            first, last = {}, {}
            flat = [(t, (k, q), g is not None) for k, ((name, _), g) in enumerate(zip(self.nodes, self._groups)) for q, t in enumerate(inner(name)) if looks_only(t)]
            for t, at, _ in flat:
                if t[1] == "/":
                    last[t[0] + t[2:]] = at
                else:
                    first.setdefault(t, at)
            pairs = {t for t in first if t in last and first[t] < last[t]}
            heads = {t for t, _, repeated in flat if t in _HEADS and (repeated or t != _HEADS[0] and pairs & _LISTS)}
            self._held = frozenset(pairs | {t[0] + "/" + t[1:] for t in pairs} | heads)
        return self._held

    def decide(self, tokens: Sequence[str]) -> list[list[bool]]:
        """Of each plain token of a folded stream, whether it is a mark.

        A one-letter tag of the bulletin-board kind needs its partner in the same stream,
        since a letter in brackets is a common remark. A stream the wrapper does not read
        has only the marks that are complete.
        """
        own = {t for name in tokens for t in inner(name)}
        held = self.held() if any(map(looks_only, own)) and self.reads(tokens) else frozenset()
        # An opening and a closing tag differ by the slash.
        lone = {t for t in held & own if t[0] == "[" and t not in _HEADS and len(t.strip("[/]")) == 1 and (t.replace("[/", "[") if t[1] == "/" else t.replace("[", "[/")) not in own}
        return [[not looks_only(t) or t in held and t not in lone for t in inner(name)] for name in tokens]

    def kept(self, text: str) -> list[bool]:
        """Of each of ``signs(text)``, whether it is a mark of the wrapper."""
        tokens, places = _read(text)
        folded = fold_places(tokens)
        return spell(places, folded, self.decide([name for name, _ in folded]))


#: Tokens that begin a line or an entry and close nothing, and those that open a list.
_HEADS = ("{number}", "[*]", "[li]")
_LISTS = {"[list]", "[ul]", "[ol]"}


def spell(places: list[int], folded: list[tuple[str, list[list[int]]]], decided: list[list[bool]]) -> list[bool]:
    """What was decided for folded tokens, for each sign of the text."""
    of = {p: d for (_, where), ds in zip(folded, decided) for ps, d in zip(where, ds) for p in ps}
    return [of[p] for p in places]


def infer(streams: DataFrame, parts: int = PARTS) -> DataFrame:
    """host, names, optional and n (rows) of each host's wrapper, from distinct folded streams (host, tokens, n).

    A host's streams are folded in two steps, over ``parts`` parts by hash and over the
    parts' results, whatever their number, so that no task holds all streams of a host.
    """

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = Wrapper()
        for tokens, n in sorted(zip(map(tuple, pdf.tokens), pdf.n), key=lambda x: (-x[1], x[0])):
            if whole.rows and whole.reads(tokens):
                whole.rows += int(n)
            else:
                whole = whole.merge(Wrapper([(t, False) for t in tokens], int(n)))
        return pd.DataFrame({"host": pdf.host.iloc[:1], "names": [[t for t, _ in whole.nodes]], "optional": [[o for _, o in whole.nodes]], "n": [whole.rows]})

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = Wrapper()
        for names, optional, n in sorted(zip(map(tuple, pdf.names), map(tuple, pdf.optional), pdf.n), key=lambda x: (-x[2], x[0])):
            whole = whole.merge(Wrapper(list(zip(names, map(bool, optional))), int(n)))
        return pd.DataFrame({"host": pdf.host.iloc[:1], "names": [[t for t, _ in whole.nodes]], "optional": [[o for _, o in whole.nodes]], "n": [whole.rows]})

    kept = "host string, names array<string>, optional array<boolean>, n long"
    salted = streams.withColumn("salt", F.pmod(F.xxhash64("tokens"), F.lit(parts)))
    folded = spread(salted, "host", "salt").groupBy("host", "salt").applyInPandas(part, kept)
    return spread(folded, "host").groupBy("host").applyInPandas(join, kept)


def read_streams(df: DataFrame, keys: list[str], host: str, text: str) -> DataFrame:
    """keys, host, tokens and n_sure (marks that need no support) of every text; texts without any sign never leave the JVM.

    Null and blank texts have no tokens.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema) + ", host string, tokens array<string>, n_sure int"
    rows = df.select(*keys, F.coalesce(F.col(host), F.lit("")).alias("host"), F.col(text).alias("__text"))
    odd = F.coalesce(F.col("__text").rlike(_WORTH), F.lit(False))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            both = [stream(t) for t in pdf.pop("__text")]
            yield pdf.assign(tokens=[t for t, _ in both], n_sure=[n for _, n in both])

    plain = F.when(F.trim("__text") == "", F.array().cast("array<string>")).otherwise(F.array(F.lit(SLOT)))
    return rows.where(odd).mapInPandas(read, ddl).unionByName(rows.where(~odd & F.col("__text").isNotNull()).select(*keys, "host", plain.alias("tokens"), F.lit(0).alias("n_sure")))


def wrappers(df: DataFrame, keys: list[str], host: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The streams of all texts, and the wrapper of each host."""
    rows = checkpoint(read_streams(df, keys, host, text))
    distinct = rows.groupBy("host", "tokens").agg(F.count("*").alias("n"))
    return rows, infer(distinct)


#: A text that may hold a token which only looks like a mark.
_NEEDY = rf"(?im)\[/?[*A-Za-z][^\[\]\n]*\]|^ {{0,3}}[0-9]{{1,3}}[.)] |</?(?!(?:{_names(HTML)})[\s/>])[A-Za-z]|&(?:amp;)*(?:lt|#60|#x3c);"


def _decisions(rows: DataFrame, found: DataFrame) -> DataFrame:
    """host, tokens, decided, held and fits of each distinct stream that holds a token which only looks like a mark.

    ``decided`` says of each plain token whether it is a mark, ``held`` how many of those
    that only look like one are.
    """
    needy = F.exists("tokens", lambda t: t.rlike(r"\[|\{number\}|</?(?!(?:" + _names(HTML) + r")>)"))
    streams = checkpoint(rows.where(needy).select("host", "tokens").distinct())
    # A wrapper is long beside a stream: it meets the streams of its host part by part. One row for each host.
    ways = small_side(streams.groupBy("host").agg(F.ceil(F.count("*") / STREAMS).cast("int").alias("ways")))
    streams = streams.join(ways, "host").select("host", "tokens", F.pmod(F.hash("tokens"), "ways").alias("salt"))
    copies = found.join(ways, "host").select("host", "names", "optional", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("salt"))

    def check(pdf: pd.DataFrame, wrapper: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(pdf) and len(wrapper):
            w = Wrapper(list(zip(wrapper.names.iat[0], map(bool, wrapper.optional.iat[0]))), 1)
            for h, tokens in zip(pdf.host, map(list, pdf.tokens)):
                decided = w.decide(tokens)
                held = sum(d and looks_only(t) for name, ds in zip(tokens, decided) for t, d in zip(inner(name), ds))
                out.append((h, tokens, decided, held, w.reads(tokens)))
        return pd.DataFrame(out, columns=["host", "tokens", "decided", "held", "fits"])

    both = streams.groupBy("host", "salt").cogroup(copies.groupBy("host", "salt"))
    return both.applyInPandas(check, "host string, tokens array<string>, decided array<array<boolean>>, held int, fits boolean")


def _key(tokens: str) -> Column:
    """A short key of a stream, alike for no two that differ."""
    return F.unhex(F.md5(F.array_join(tokens, " "))).alias("key")


def unwrapped(df: DataFrame, keys: list[str], host: str, text: str) -> DataFrame:
    """keys, n_marks and fits (whether the wrapper of the host reads the text) of every text.

    ``n_marks`` counts the tokens that are marks in the wrapper of the text's host: those
    that are in any wrapper, and, once for each place in the folded stream, those that this
    one supports. Null texts give no row; blank and plain ones have no marks.
    """
    rows, found = wrappers(df, keys, host, text)
    # What needs no second look at the rows, none supported and all read, stays out.
    decided = _decisions(rows, found).where("held > 0 OR NOT fits").select("host", _key("tokens"), "held", "fits")
    seen = rows.withColumn("key", _key("tokens")).join(small_side(decided), ["host", "key"], "left")
    # A stream without such a token is read by the wrapper that it went into.
    return seen.select(*keys, (F.col("n_sure") + F.coalesce("held", F.lit(0))).alias("n_marks"), F.coalesce("fits", F.lit(True)).alias("fits"))


def clean(df: DataFrame, keys: list[str], host: str, text: str) -> DataFrame:
    """keys, blocks (array of kind and text) and text (the blocks, one to a line) of every row that has a text.

    Texts are read through the wrapper of their host; tokens that are no marks of it stay
    in the text as they are. Only texts with a token that needs support wait for the
    wrapper, since any wrapper reads the others alike.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)
    rows, found = wrappers(df, keys, host, text)
    # Kinds of streams, not rows; counted before they are broadcast.
    decided = small_side(_decisions(rows, found).select(F.col("host").alias("__host"), _key("tokens").alias("__key"), F.col("decided").alias("__decided")))
    texts = df.select(*keys, F.coalesce(F.col(host), F.lit("")).alias("__host"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    needy = F.col("__text").rlike(_NEEDY)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(__tokens=[stream(t)[0] for t in pdf["__text"]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            blocks = []
            for t, d in zip(pdf.pop("__text"), pdf.pop("__decided")):
                plain = opened(t)
                if d is None:
                    blocks.append(to_blocks(plain, [True] * len(plain)))
                else:
                    tokens, places = _read(plain)
                    blocks.append(to_blocks(plain, spell(places, fold_places(tokens), [list(x) for x in d])))
            yield pdf.assign(blocks=[[{"kind": k, "text": t} for k, t in b] for b in blocks], text=["\n".join(t for _, t in b) for b in blocks])

    asked = texts.where(needy).mapInPandas(read, ddl + ", __host string, __text string, __tokens array<string>")
    asked = asked.withColumn("__key", _key("__tokens")).join(decided, ["__host", "__key"], "left").select(*keys, "__text", "__decided")
    both = asked.unionByName(texts.where(~needy).select(*keys, "__text", F.lit(None).cast("array<array<boolean>>").alias("__decided")))
    return both.mapInPandas(run, ddl + ", blocks array<struct<kind: string, text: string>>, text string")
