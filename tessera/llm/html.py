"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks (text between block-level tags; inline tags do not cut). A block becomes a
vector: hashed names, classes and ids along its tag path, hashed words, and its length, links and punctuation.
A bidirectional LSTM in numpy reads the page's blocks in order, both ways, and labels every block as
main text or not from the whole page. It is trained here, on pages drawn from a generator of layouts
(menus, headers, notices, adverts, sidebars, forms, shares, reader comments, footers around and inside
articles), from fixed seeds, once in a driver process; the weights (about 90 kB) are broadcast.

Scripts, styles, templates, comments of markup and the head never become blocks. Character references are
decoded; white space in a block becomes one space; main blocks are joined by one space in page order.
Pages are cut in time linear in their length, and read in a bounded number of blocks at a time.
Edge cases: null or empty html, and pages without a main block, give an empty text; unclosed elements,
comments and scripts are closed by the end of the page, which drops a tag it cuts off; ids may be null or repeat, and equal rows get equal
texts; pages of any length are read whole; an empty table gives none; input columns text and n_chars give way to the new ones.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .text import chunks, text_bytes, word_hashes, words

PATH_DIMS, WORD_DIMS, SHAPE_DIMS, HIDDEN = 160, 24, 8, 20
DIMS = PATH_DIMS + WORD_DIMS + SHAPE_DIMS
TRAIN_PAGES, EPOCHS, BATCH, RATE, DEPTH, CELLS = 2600, 8, 28, 0.01, 10, 1 << 13

#: What may follow "<"; a plain start or end tag has no "<" or ">" in its quotes, so its match never runs past the next of them.
_TOKEN = re.compile(
    r"<(?:(?P<comment>!--)|(?P<cdata>!\[CDATA\[)|(?P<other>[!?])|(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?:(?P<attrs>(?:[^<>\"']|\"[^\"<>]*+\"|'[^'<>]*+')*+)(?P<close>>))?)",
    re.I,
)
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "noscript", "template", "title", "svg", "iframe", "textarea", "select", "object")}
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+|[0-9]+")
# Element kinds of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "rp", "rt", "ruby",
    "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "label", "button", "input",
}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul"}
SCOPE = {"article", "aside", "body", "div", "footer", "form", "header", "html", "main", "nav", "section", "table", "td", "th", "ul", "ol", "dl", "blockquote"}


class Block:
    __slots__ = ("path", "text", "linked", "tag")

    def __init__(self, path, text, linked, tag):
        self.path, self.text, self.linked, self.tag = path, text, linked, tag


def _names(tag: str, attrs: str) -> tuple[int, ...]:
    """Path features of an element: its name and the words of its class, id and role."""
    out = [tag]
    if attrs and len(attrs) > 4:
        for m in _ATTR.finditer(attrs):
            out += [f".{w}" for w in _PART.findall((m[2] or m[3] or m[4] or "").lower())[:8]]
    return tuple(crc32(x.encode()) % PATH_DIMS for x in out)


class _Ends:
    """Where tags end whose quotes hold "<" or ">": at the first ">" outside quotes, or at the first at all if a quote stays open.

    Every quote and every ">" of the page is looked at once, whatever the number of tags.
    """

    def __init__(self, page: str):
        self.page = page
        self.at = [m.start() for m in re.finditer("[>\"']", page)]
        self.end: list[int] = [-1] * (len(self.at) + 1)
        after = {'"': -1, "'": -1}
        for i in range(len(self.at) - 1, -1, -1):
            mark = page[self.at[i]]
            if mark == ">":
                self.end[i] = self.at[i]
            else:
                self.end[i] = self.end[after[mark] + 1] if after[mark] >= 0 else -1
                after[mark] = i

    def find(self, start: int) -> int:
        end = self.end[bisect_left(self.at, start)]
        return end if end >= 0 else self.page.find(">", start)


def tokens(page: str):
    """(text, None, "", False) of text, and (tag, attributes, is an end) of tags, in order and in time linear in the page.

    A "<" that starts no markup is text. Markup that the page's end cuts off is dropped, as browsers do.
    """
    at, ends, said = 0, None, 0
    while (m := _TOKEN.search(page, at)) is not None:
        start, at = m.start(), m.end()
        if start > said:
            yield page[said:start], None, "", False
        if (tag := m["tag"]) is None:
            stop = "-->" if m["comment"] else "]]>" if m["cdata"] else ">"
            end = page.find(stop, at)
            if m["cdata"]:
                yield html.escape(page[at : end if end >= 0 else len(page)]), None, "", False
            at = said = end + len(stop) if end >= 0 else len(page)
            continue
        attrs = m["attrs"]
        if attrs is None:
            ends = ends or _Ends(page)
            if (close := ends.find(at)) < 0:
                return
            attrs, at = page[at:close], close + 1
        tag = tag.lower()
        if not m["end"] and tag in _RAW:
            closing = _RAW[tag].search(page, at)
            at = closing.end() if closing else len(page)
        said = at
        yield "", tag, attrs, bool(m["end"])
    if said < len(page):
        yield page[said:], None, "", False


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, ...]]] = []
    open_at: dict[str, list[int]] = {}  # places in the stack by tag
    solid: list[int] = []  # places of tags that are not inline
    held: list[str] = []
    state = {"linked": 0}
    known: dict[tuple[str, str], tuple[int, ...]] = {}

    def cut():
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                block = stack[solid[-1]][0] if solid else "body"
                out.append(Block([n for _, n in stack[-DEPTH:]], text, min(1.0, state["linked"] / max(1, len(text))), block))
        state["linked"] = 0

    def pop(tag: str, within: set | None = None):
        if not (places := open_at.get(tag)):
            return
        at = places[-1]
        if within is not None and any(open_at.get(t) and open_at[t][-1] > at for t in within):
            return
        while len(stack) > at:
            t, _ = stack.pop()
            open_at[t].pop()
            if solid and solid[-1] == len(stack):
                solid.pop()

    for text, tag, attrs, is_end in tokens(page or ""):
        if tag is None:
            if not open_at.get("head"):
                held.append(text)
                if open_at.get("a"):
                    state["linked"] += len(text)
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in _RAW and not is_end:
            if tag in ("textarea", "select", "iframe", "object"):
                cut()
            continue
        if tag not in INLINE:
            cut()
        if is_end:
            pop(tag, None if tag in SCOPE or tag in INLINE else SCOPE)
            continue
        if tag in VOID:
            continue
        if tag == "body":
            pop("head")
        if tag in ENDS_P:
            pop("p", SCOPE)
        for other in CLOSES.get(tag, ()):
            pop(other, {"ul", "ol", "dl", "table", "select", *SCOPE} - {other})
        key = (tag, attrs)
        if (names := known.get(key)) is None:
            names = known[key] = _names(tag, attrs)
        open_at.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            solid.append(len(stack))
        stack.append((tag, names))
    cut()
    return out


def features(pages: list[list[Block]], place: np.ndarray | None = None) -> np.ndarray:
    """Vectors of all blocks of the pages, in order; place: where in its page each block stands, 0 to 1, if the pages are parts."""
    every = [b for p in pages for b in p]
    x = np.zeros((len(every), DIMS), np.float32)
    if not every:
        return x
    rows, cols, weight = [], [], []
    for n, b in enumerate(every):
        for depth, names in enumerate(reversed(b.path)):
            w = 1.0 if depth < 2 else 0.8
            for c in names:
                rows.append(n)
                cols.append(c)
                weight.append(w)
    np.maximum.at(x, (np.array(rows, np.int64), np.array(cols, np.int64)), np.array(weight, np.float32))
    data, offsets = text_bytes(pa.array([b.text for b in every], pa.string()))
    starts, ends, owner = words(data, offsets)
    h = (word_hashes(data, starts, ends, lower=True) % np.uint64(WORD_DIMS)).astype(np.int64)
    bag = np.bincount(owner * WORD_DIMS + h, minlength=len(every) * WORD_DIMS).reshape(-1, WORD_DIMS)
    count = np.maximum(1, bag.sum(1))
    x[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = np.sqrt(bag / count[:, None])
    n_chars = np.diff(offsets)
    marks = np.zeros(len(every))
    hit = np.flatnonzero((data == 46) | (data == 44) | (data == 59))
    np.add.at(marks, np.searchsorted(offsets, hit, "right") - 1, 1)
    if place is None:
        place = np.concatenate([np.arange(len(p)) / max(1, len(p) - 1) for p in pages if p])
    s = PATH_DIMS + WORD_DIMS
    x[:, s] = np.log1p(count) / 5
    x[:, s + 1] = [b.linked for b in every]
    x[:, s + 2] = np.minimum(1, marks / count)
    x[:, s + 3] = place
    x[:, s + 4] = [b.tag in ("p", "blockquote", "pre") for b in every]
    x[:, s + 5] = [b.tag in ("h1", "h2", "h3", "h4", "h5", "h6") for b in every]
    x[:, s + 6] = [b.tag in ("li", "td", "th", "dd", "dt") for b in every]
    x[:, s + 7] = np.minimum(1, n_chars / 400)
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * z)


class BiLSTM:
    """Two LSTMs over a page's blocks and a logistic output on their joined states."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        f = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        self.w = {}
        for d in "ab":
            self.w[f"x{d}"], self.w[f"h{d}"] = f(DIMS, 4 * HIDDEN), f(HIDDEN, 4 * HIDDEN)
            self.w[f"b{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)
        self.w["o"], self.w["ox"], self.w["ob"] = f(2 * HIDDEN, 1)[:, 0], np.zeros(DIMS, np.float32), np.zeros(1, np.float32)

    def _pass(self, x: np.ndarray, mask: np.ndarray, d: str):
        steps, n, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        pre = x @ self.w[f"x{d}"] + self.w[f"b{d}"]
        out, tape = np.zeros((steps, n, HIDDEN), np.float32), [None] * steps
        for t in range(steps) if d == "a" else range(steps - 1, -1, -1):
            z = pre[t] + h @ self.w[f"h{d}"]
            g = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o, u = g[:, :HIDDEN], g[:, HIDDEN : 2 * HIDDEN], g[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * u
            tc = np.tanh(new)
            tape[t] = (i, f, o, u, c, tc, h, m)
            c, h = m * new, m * o * tc
            out[t] = h
        return out, tape

    def forward(self, x: np.ndarray, mask: np.ndarray):
        a, ta = self._pass(x, mask, "a")
        b, tb = self._pass(x, mask, "b")
        both = np.concatenate([a, b], 2)
        return _sigmoid(both @ self.w["o"] + x @ self.w["ox"] + self.w["ob"][0]), both, ta, tb

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, both, ta, tb = self.forward(x, mask)
        e = ((p - y) * mask / max(1.0, float(mask.sum()))).astype(np.float32)
        g = {"o": np.einsum("tnh,tn->h", both, e), "ox": np.einsum("tnd,tn->d", x, e), "ob": np.array([e.sum()], np.float32)}
        for d, tape, w in (("a", ta, self.w["o"][:HIDDEN]), ("b", tb, self.w["o"][HIDDEN:])):
            steps, n, _ = x.shape
            dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            dz = np.zeros((steps, n, 4 * HIDDEN), np.float32)
            gh = np.zeros_like(self.w[f"h{d}"])
            for t in range(steps - 1, -1, -1) if d == "a" else range(steps):
                i, f, o, u, c, tc, h, m = tape[t]
                dh = (dh + e[t][:, None] * w) * m
                dn = (dc * m) + dh * o * (1 - tc * tc)
                dz[t] = np.concatenate([dn * u * i * (1 - i), dn * c * f * (1 - f), dh * tc * o * (1 - o), dn * i * (1 - u * u)], 1)
                gh += h.T @ dz[t]
                dh, dc = dz[t] @ self.w[f"h{d}"].T, dn * f
            g[f"x{d}"] = np.einsum("tnd,tnk->dk", x, dz, optimize=True)
            g[f"h{d}"], g[f"b{d}"] = gh, dz.sum((0, 1))
        return g

    def read(self, pre: np.ndarray, mask: np.ndarray, d: str, state: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, tuple]:
        """What one direction adds to the output at each step, and its last state; keeps nothing else."""
        (h, c), steps = state, len(pre)
        out, w = np.zeros(pre.shape[:2], np.float32), self.w["o"][:HIDDEN] if d == "a" else self.w["o"][HIDDEN:]
        for t in range(steps) if d == "a" else range(steps - 1, -1, -1):
            z = pre[t] + h @ self.w[f"h{d}"]
            g = _sigmoid(z[:, : 3 * HIDDEN])
            m = mask[t][:, None]
            c = m * (g[:, HIDDEN : 2 * HIDDEN] * c + g[:, :HIDDEN] * np.tanh(z[:, 3 * HIDDEN :]))
            h = m * g[:, 2 * HIDDEN :] * np.tanh(c)
            out[t] = h @ w
        return out, (h, c)

    def _start(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)

    def _side_by_side(self, group: list[list[Block]]) -> list[np.ndarray]:
        x = features(group)
        first = np.concatenate([[0], np.cumsum([len(p) for p in group])]).astype(int)
        padded, mask = pad([x[i:j] for i, j in zip(first[:-1], first[1:], strict=True)])
        z = padded @ self.w["ox"] + self.w["ob"][0]
        for d in "ab":
            z = z + self.read(padded @ self.w[f"x{d}"] + self.w[f"b{d}"], mask, d, self._start(len(group)))[0]
        p = _sigmoid(z)
        return [p[: len(page), k] for k, page in enumerate(group)]

    def _in_parts(self, page: list[Block]) -> np.ndarray:
        """One long page, a bounded number of blocks at a time in each direction."""
        z = np.zeros(len(page), np.float32)
        place = np.arange(len(page)) / max(1, len(page) - 1)
        starts = list(range(0, len(page), CELLS))
        for d in "ab":
            state = self._start(1)
            for i in starts if d == "a" else reversed(starts):
                x = features([page[i : i + CELLS]], place[i : i + CELLS])
                out, state = self.read((x @ self.w[f"x{d}"] + self.w[f"b{d}"])[:, None], np.ones((len(x), 1), np.float32), d, state)
                z[i : i + CELLS] += out[:, 0]
                if d == "a":
                    z[i : i + CELLS] += x @ self.w["ox"] + self.w["ob"][0]
        return _sigmoid(z)

    def predict(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Probability of main text for every block; pages of like length are read side by side, ``CELLS`` blocks at most, padding included."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < 64 and len(pages[order[end]]) * (end + 1 - at) <= CELLS:
                end += 1
            group = [pages[i] for i in order[at:end]]
            found = self._side_by_side(group) if len(group[0]) <= CELLS else [self._in_parts(group[0])]
            for i, p in zip(order[at:end], found, strict=True):
                out[i] = p
            at = end
        return out


def pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(r) for r in rows)
    x, mask = np.zeros((steps, len(rows), rows[0].shape[1]), np.float32), np.zeros((steps, len(rows)), np.float32)
    for k, r in enumerate(rows):
        x[: len(r), k], mask[: len(r), k] = r, 1
    return x, mask


# Words for the classes and texts of generated boilerplate.
KINDS = {
    "nav": ("nav", "menu navbar navigation topnav breadcrumb breadcrumbs tabs links", "Home About Contact News Products Blog Login Menu Search"),
    "header": ("header", "header masthead branding topbar logo site title banner hero", "Welcome Site Daily Today Sign in"),
    "notice": ("div", "cookie cookies consent notice gdpr alert popup modal overlay privacy banner message", "We use cookies Accept all privacy settings By continuing you agree"),
    "ad": ("div", "ad ads advert advertisement sponsored promo adslot adsense sponsor promoted commercial", "Buy now Sponsored offer Shop sale Advertisement"),
    "sidebar": ("aside", "sidebar side widget related recommended trending popular rail more recent tags", "Related Most read Trending Popular posts More stories"),
    "form": ("form", "form newsletter subscribe signup search login contact", "Subscribe Email Name Submit Your address Sign up"),
    "share": ("div", "share social sharing follow buttons toolbar meta byline author", "Share Tweet Like Follow us Print"),
    "comments": ("section", "comments comment responses discussion replies reply thread disqus feedback reader", "Reply says Comments Leave a comment likes"),
    "footer": ("footer", "footer copyright bottom legal colophon foot credits", "© &copy; All rights reserved Terms Privacy &middot; Imprint"),
}
CONTENT = "content post entry story article body main text page prose section container wrapper inner column center"


def sample_page(rng: np.random.Generator) -> str:
    """A page of a random layout; main blocks are wrapped in the private marks \\x01 and \\x02."""
    parts = ["er", "on", "ti", "la", "que", "st", "en", "ou", "ver", "ich", "do", "ra", "é", "ung", "ción", "an", "th", "ß", "ñ", "me"]
    pick = lambda s: s[int(rng.integers(0, len(s)))]

    def word():
        return "".join(pick(parts) for _ in range(int(rng.integers(1, 5))))

    def sentence(n):
        t = [word() + ("," if rng.random() < 0.1 else "") for _ in range(max(1, n))]
        return " ".join(t).capitalize() + pick([".", ".", ".", "!", "?", ""])

    style = rng.random()  # some pages repeat words, some are lists, shouted or full of marks

    def prose(long=False):
        if style < 0.06:
            return " ".join([word()] * int(rng.integers(2, 60)))
        if style < 0.12:
            return " | ".join(word() for _ in range(int(rng.integers(2, 40))))
        if style < 0.18:
            return " ".join(word().upper() + "!!" for _ in range(int(rng.integers(2, 40))))
        if style < 0.24:
            return " ".join(word() + pick(["%%%", "&amp;&amp;", "***", "$$$"]) for _ in range(int(rng.integers(2, 40))))
        return " ".join(sentence(int(rng.integers(1, 18))) for _ in range(int(rng.integers(1, 7 if long else 3))))

    def main(t):
        if rng.random() < 0.15:
            t += f" {pick(['<b>', '<em>', '<a href=x>', '<span>'])}{word()}{pick(['</b>', '</em>', '</a>', ''])}"
        return f"\x01{t}\x02"

    def classes(kind):
        words = KINDS[kind][1].split()
        c = pick(words) + ("-" + pick(words) if rng.random() < 0.3 else "") + (f" {pick(['box', 'wrap', 'inner', 'row', 'col-4', 'x1'])}" if rng.random() < 0.3 else "")
        return f' {"id" if rng.random() < 0.2 else "class"}="{c}"'

    def junk(kind):
        tag = KINDS[kind][0]
        plain = rng.random() < 0.45
        if plain and kind not in ("form",) and rng.random() < 0.7:
            head, tag = f"<div{classes(kind)}>", "div"
        else:
            head = f"<{tag}{classes(kind) if tag == 'div' or rng.random() < 0.5 else ''}>"
        say = lambda: (pick(KINDS[kind][2].split(" ")) + " " if rng.random() < 0.4 else "") + sentence(int(rng.integers(1, 9)))
        n = int(rng.integers(1, 7))
        if kind in ("nav", "sidebar") or kind == "footer" and rng.random() < 0.5:
            body = "<ul>" + "".join(f'<li><a href="/{i}">{word()}</a></li>' for i in range(n)) + "</ul>"
            if kind == "sidebar" and rng.random() < 0.5:
                body = f"<h3>{say()}</h3>" + "".join(f"<p>{say()}</p>" for _ in range(n))
        elif kind == "comments":
            body = f"<h3>{say()}</h3>" + "".join(f'<div class="{pick(["comment", "reply", "response"])}"><p>{prose()}</p></div>' if rng.random() < 0.7 else f"<p>{prose()}</p>" for _ in range(n))
        elif kind == "form":
            body = f"<label>{say()}</label><input name=x><p>{say()}</p><button>{word()}</button>"
        elif rng.random() < 0.5:
            body = say() if rng.random() < 0.6 else prose()
        else:
            body = f"<p>{say()}</p>" + (f'<p><a href="/x">{word()}</a></p>' if rng.random() < 0.5 else "")
        return f"{head}{body}</{tag}>"

    story = [f"<h1>{main(sentence(int(rng.integers(3, 10))))}</h1>"] if rng.random() < 0.85 else []
    for _ in range(int(rng.integers(1, 16))):
        r = rng.random()
        if r < 0.66:
            story.append(f"<p>{main(prose(True))}</p>")
        elif r < 0.74:
            story.append(f"<p><b>{main(sentence(int(rng.integers(1, 12))))}<br>")
        elif r < 0.81:
            story.append(f"<{(h := pick(['h2', 'h3']))}>{main(sentence(4))}</{h}>")
        elif r < 0.86:
            story.append("<ul>" + "".join(f"<li>{main(sentence(6))}</li>" for _ in range(int(rng.integers(1, 5)))) + "</ul>")
        elif r < 0.90:
            story.append(f"<blockquote><p>{main(prose())}</p></blockquote>")
        elif r < 0.93:
            story.append("<table><tr>" + "".join(f"<td>{main(word())}</td>" for _ in range(3)) + "</tr></table>")
        elif r < 0.95:
            story.append(f"<div>{main(prose(True))}</div>")
        else:
            story.append(junk(pick(["ad", "share", "form", "sidebar", "notice", "ad"])))
    inner = "".join(story)
    tail = junk("comments") if rng.random() < 0.35 else ""
    if tail and rng.random() < 0.4:
        inner, tail = inner + tail, ""
    kind = rng.random()
    if kind < 0.45:
        body = f"<article>{inner}</article>"
    elif kind < 0.65:
        body = f"<main>{inner}</main>" if rng.random() < 0.5 else f"<main><article>{inner}</article></main>"
    elif kind < 0.92:
        c = CONTENT.split()
        body = f'<div class="{pick(c)}">{inner}</div>' if rng.random() < 0.6 else f'<div id="{pick(c)}"><div class="{pick(c)}-{pick(c)}">{inner}</div></div>'
    else:
        body = inner
    if rng.random() < 0.3:
        body = f'<div class="{pick(CONTENT.split())}">{body}{junk("sidebar") if rng.random() < 0.5 else ""}</div>'
    top = [junk(k) for k in ("notice", "header", "nav", "ad") if rng.random() < (0.75 if k == "nav" else 0.4)]
    low = [junk(k) for k in ("share", "sidebar", "form", "ad", "footer") if rng.random() < (0.75 if k == "footer" else 0.3)]
    if rng.random() < 0.15:
        low.insert(0, f"</div><div{classes('comments')}>" + "".join(f"<p>{prose()}</p>" for _ in range(3)) + "</div>")
    return f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{sentence(5)}</title><style>p{{}}</style></head><body>{''.join(top)}{body}{tail}{''.join(low)}</body></html>"


def labelled(page: str) -> tuple[list[Block], np.ndarray]:
    found = blocks(page)
    y = np.array(["\x01" in b.text or "\x02" in b.text for b in found], np.float32)
    for b in found:
        b.text = b.text.replace("\x01", "").replace("\x02", "") or "-"
    return found, y


_TRAINED: dict = {}


def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = 11) -> BiLSTM:
    """The labeller, trained once in a process."""
    key = (pages, epochs, seed)
    if key in _TRAINED:
        return _TRAINED[key]
    rng = np.random.default_rng(seed)
    data = [labelled(sample_page(rng)) for _ in range(pages)]
    data = sorted((d for d in data if d[0]), key=lambda d: len(d[0]))
    xs = [features([b]) for b, _ in data]
    for x in xs:  # half of the pages without their words: the path must carry the rest
        if rng.random() < 0.5:
            x[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = 0
    model = BiLSTM()
    mean, var, step = {k: np.zeros_like(v) for k, v in model.w.items()}, {k: np.zeros_like(v) for k, v in model.w.items()}, 0
    starts = np.arange(0, len(data), BATCH)
    for epoch in range(epochs):
        rate = RATE * (1 if epoch < epochs - 3 else 0.3)
        for a in rng.permutation(starts).tolist():
            x, mask = pad(xs[a : a + BATCH])
            y, _ = pad([d[1][:, None] for d in data[a : a + BATCH]])
            step += 1
            for k, g in model.gradients(x, mask, y[:, :, 0]).items():
                g = np.clip(g, -1, 1)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                var[k] = 0.995 * var[k] + 0.005 * g * g
                model.w[k] = (model.w[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(var[k] / (1 - 0.995**step)) + 1e-8)).astype(np.float32)
    _TRAINED[key] = model
    return model


def main_texts(pages: list[str | None], model: BiLSTM) -> list[str]:
    cut = [blocks(p) for p in pages]
    return [" ".join(b.text for b, p in zip(page, probability, strict=True) if p >= 0.5) for page, probability in zip(cut, model.predict(cut), strict=True)]


def extract(pages: DataFrame, model: BiLSTM | None = None, html_col: str = "html") -> DataFrame:
    """pages without html_col, with text and n_chars (code points). Narrow: no shuffle."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train())
    keep = [c for c in pages.columns if c != html_col and c not in ("text", "n_chars")]
    source = pages.select(*keep, F.col(html_col).cast("string").alias(html_col))

    def run(batches):
        for batch in chunks(batches, html_col, 1 << 20):
            texts = main_texts(batch.column(html_col).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)
    return source.mapInArrow(run, f"{kinds}, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
