"""Secret scan: fixed token patterns, and literals that flow to sensitively named targets.

Assignment-aware lexing: every ``name = expr``, ``name: expr``, ``name := expr`` and ``"name": expr`` of
source or configuration syntax, and every XML element or attribute pair that names a value, is parsed into a target and the
alternatives of its expression (terms joined by ``+``; the operands of ``or``, ``||`` and ``??``; each argument of a call, whose own name is no
literal). Terms are strings, with prefixes and triple quotes, bare literals, and names. A name stands for its last assignment before,
else for the first one after; so a literal kept in a plain constant is judged by every target it flows to. A
literal is reported when the weight of some such target times the score of the joined value reaches ``threshold``.

Edge cases: a null text is read as empty and yields no span; null or repeated doc_ids are kept, one row
each; an empty table yields no rows; texts of any length are read whole, in time linear in it. Positions are code points, the end
exclusive. Spans of one kind never overlap; a literal that overlaps a pattern's span is reported beside it, and ``redact`` merges them.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .text import chunks

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 0.5

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_OPERATOR = re.compile(r":=|=>|=|:")
_TARGET = re.compile(r"""([A-Za-z_$][A-Za-z0-9_.$-]{0,127})["'\]]{0,2}[ \t]*\Z""")
_STRING = re.compile(r'[rRbBuUfF]{0,2}(?:"""(.*?)"""|' + r"'{3}(.*?)'{3}" + r'|"((?:[^"\\\n]|\\.)*)"|' + r"'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)", re.S)
_BARE = re.compile(r"[A-Za-z0-9_$][A-Za-z0-9+/_.~$-]*={0,2}")
_CALL = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$]*\(")
_AFTER = re.compile(r"(?:[ \t]*\.[A-Za-z_]\w*\(\))*")
_JOIN = re.compile(r"[ \t]*(?:(\+)|\|\||\?\?|\bor\b)\s*")
_WORD = re.compile(r"(?:new|await|return|not)[ \t]+")
_BLANK = re.compile(r"[ \t]*")
_OTHER = re.compile(r"[^\"'`()A-Za-z0-9_$,+:=\n]+")
_NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$]*\Z")
_NAME_AT = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$]*")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_TAG = re.compile(r"<([A-Za-z][A-Za-z0-9:._-]*)([^<>]*)>([^<>]*)(</)?")
_ATTRIBUTE = re.compile(r"""([A-Za-z][A-Za-z0-9:._-]*)\s*=\s*(?:"([^"]*)"|'([^']*)')""")

#: Fixed weights of the parts of a target's name; pairs are looked up joined.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "authkey": 1.0,
    "signingkey": 1.0, "encryptionkey": 1.0, "auth": 0.7, "bearer": 0.8, "jwt": 0.8, "cookie": 0.6, "session": 0.6,
}
_PLACEHOLDERS = {"true", "false", "null", "none", "undefined", "example", "changeme", "placeholder", "redacted"}


def name_weight(name: str) -> float:
    """The sensitivity of a target, from the parts of its name and pairs of neighbouring parts."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    pairs = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((SENSITIVE.get(p, 0.0) for p in parts + pairs), default=0.0)


def measure(value: str) -> tuple[int, bool, int, dict[str, int]]:
    """What scoring needs of a literal and joining adds up: length, white space, character classes, counts of characters."""
    counts = Counter(value)
    if len(counts) > 256:  # more kinds tell no more
        few = Counter()
        for c, n in counts.items():
            few[chr(ord(c) % 256)] += n
        counts = few
    kinds = sum(1 << k for k, hit in enumerate((str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())) if any(map(hit, counts)))
    return len(value), any(c.isspace() for c in counts), kinds, counts


def joined(parts: list[tuple[int, bool, int, dict[str, int]]]) -> tuple[int, bool, int, dict[str, int]]:
    if len(parts) == 1:
        return parts[0]
    counts: Counter = Counter()
    kinds = 0
    for _, _, k, c in parts:
        kinds |= k
        for x, n in c.items():  # a name added to itself over and over doubles without end
            counts[x] = min(counts[x] + n, 1 << 40)
    return min(sum(p[0] for p in parts), 1 << 40), any(p[1] for p in parts), kinds, counts


def score_of(n: int, blank: bool, kinds: int, counts: dict[str, int]) -> float:
    """0 to 1: entropy, length and mixed character classes of a measured value."""
    if n < 8 or blank or len(counts) < 4:
        return 0.0
    total = sum(counts.values())
    entropy = -sum(c / total * math.log2(c / total) for c in counts.values())
    return min(1.0, entropy / 3.5) * min(1.0, 0.4 + 0.3 * kinds.bit_count()) * min(1.0, 0.5 + n / 32)


def literal_score(value: str) -> float:
    """The score of one literal."""
    return 0.0 if value.lower() in _PLACEHOLDERS else score_of(*measure(value))


def expression(text: str, at: int, parsed: dict[int, tuple[int, int]]) -> tuple[list[list[tuple]], int]:
    """The alternatives of the expression at a place, each a list of terms, and its end.

    A term is ("string" | "bare", value, start, end), or ("inner", n) for the assignment n inside a call's arguments; parsed has those that
    begin further on, by the place of their operator, with their ends.
    """
    found: list[list[tuple]] = []
    now: list[tuple] = []
    depth, glued = 0, True

    def close():
        nonlocal now
        if now:
            found.append(now)
            now = []

    def add(term):
        nonlocal glued
        if not glued:
            close()
        now.append(term)
        glued = False

    while at < len(text):
        if depth == 0 and (word := _WORD.match(text, at)):
            at = word.end()
        if s := _STRING.match(text, at):
            g = s.lastindex
            add(("string", s[g], s.start(g), s.end(g)))
            at = _AFTER.match(text, s.end()).end()
        elif call := _CALL.match(text, at):
            depth, at, glued = depth + 1, call.end(), False
            continue
        elif s := _BARE.match(text, at):
            end = s.end()
            if depth:  # in a call's arguments a name may be that of an assignment
                name = _NAME_AT.match(text, at)
                end = name.end() if name else end
                sign = _BLANK.match(text, end).end()
                if sign in parsed:
                    n, at = parsed[sign]
                    add(("inner", n))
                    continue
            add(("bare", text[at:end], at, end))
            at = end
        elif depth == 0:
            break
        elif text[at] in "()":
            depth += 1 if text[at] == "(" else -1
            at += 1
            if depth:
                glued = False
                continue
            close()
            glued = False
        elif text[at] == "\n":
            if text.startswith("\n\n", at):  # no call runs past a blank line
                break
            at += 1
            continue
        elif skip := _OTHER.match(text, at):
            at = skip.end()
            continue
        else:
            glued = text[at] == "+" and bool(now)
            at += 1
            continue
        if link := _JOIN.match(text, at):
            at, glued = link.end(), bool(link[1])
        elif depth == 0:
            break
    close()
    return found, at


def assignments(text: str) -> list[tuple[int, str, list[list[tuple]]]]:
    """(place, target, alternatives) of all assignments; read from the last to the first, so that none is parsed twice."""
    out: list[tuple[int, str, list[list[tuple]]]] = []
    parsed: dict[int, tuple[int, int]] = {}
    for m in reversed(list(_OPERATOR.finditer(text))):
        if m.start() and text[m.start() - 1] in "=:!<>+-*/%|&^" or text[m.end() : m.end() + 1] in ("=", ":"):
            continue
        if m.group() == ":" and text.startswith("//", m.end()):
            continue
        target = _TARGET.search(text, max(0, m.start() - 136), m.start())
        if not target:
            continue
        found, end = expression(text, _BLANK.match(text, m.end()).end(), parsed)
        if found:
            parsed[m.start()] = len(out), end
            out.append((m.start(), target[1], found))
    for m in _TAG.finditer(text):
        pairs = {a[1].lower(): a for a in _ATTRIBUTE.finditer(text, m.start(2), m.end(2))}
        named = next((pairs[k] for k in ("name", "key", "id", "property") if k in pairs), None)
        value = next((pairs[k] for k in ("value", "content", "val") if k in pairs), None)
        if named and value:
            g = value.lastindex
            out.append((m.start(), named[named.lastindex], [[("string", value[g], value.start(g), value.end(g))]]))
        if m[4] and (inner := m[3].strip()):
            start = m.start(3) + m[3].index(inner)
            out.append((m.start(), named[named.lastindex] if named else m[1], [[("string", inner, start, start + len(inner))]]))
    return out


def lexed_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive target, constants propagated."""
    if "=" not in text and ":" not in text and "</" not in text:
        return []
    found = assignments(text)
    weight = [name_weight(target) for _, target, _ in found]
    if not any(weight):
        return []
    nodes = [(n, terms) for n, (_, _, alternatives) in enumerate(found) for terms in alternatives]
    of: list[list[int]] = [[] for _ in found]
    for k, (n, _) in enumerate(nodes):
        of[n].append(k)
    places: dict[str, list[tuple[int, int]]] = {}
    for n, (place, target, _) in sorted(enumerate(found), key=lambda x: x[1][0]):
        places.setdefault(target, []).append((place, n))

    def named(name: str, n: int) -> int | None:
        """The assignment that a name in assignment n stands for."""
        known = places[name]
        at = bisect_left(known, (found[n][0], -1))
        before = at - 1 if at else next((k for k in range(at, len(known)) if known[k][1] != n), None)
        return None if before is None else known[before][1]

    uses: list[list[int | None]] = []  # by node and term: the assignment it stands for
    for n, terms in nodes:
        uses.append([t[1] if t[0] == "inner" else named(t[1], n) if t[0] == "bare" and t[1] in places and _NAME.match(t[1]) else None for t in terms])
    # nodes after all they use; a use that closes a circle is left out
    state, order, edges = [0] * len(nodes), [], [[] for _ in nodes]
    for first in range(len(nodes)):
        stack = [(first, iter([(u, k) for u in dict.fromkeys(uses[first]) if u is not None for k in of[u]]))] if not state[first] else []
        state[first] = state[first] or 1
        while stack:
            k, rest = stack[-1]
            for u, j in rest:
                if state[j] == 1:
                    continue
                edges[k].append((u, j))
                if state[j] == 0:
                    state[j] = 1
                    stack.append((j, iter([(w, x) for w in dict.fromkeys(uses[j]) if w is not None for x in of[w]])))
                    break
            else:
                state[k] = 2
                order.append(k)
                stack.pop()
    sizes: list = [None] * len(nodes)
    for k in order:
        longest: dict[int, tuple] = {}
        for u, j in edges[k]:
            if u not in longest or sizes[j][0] > longest[u][0]:
                longest[u] = sizes[j]
        parts = []
        for t, u in zip(nodes[k][1], uses[k], strict=True):
            if u is None:
                parts.append(measure(t[1]) if len(nodes[k][1]) > 1 or t[1].lower() not in _PLACEHOLDERS else (0, True, 0, {}))
            elif u in longest:
                parts.append(longest[u])
        sizes[k] = joined(parts) if parts else (0, True, 0, {})
    best = [weight[n] * score_of(*sizes[k]) if weight[n] else 0.0 for k, (n, _) in enumerate(nodes)]
    for k in reversed(order):
        for _, j in edges[k]:
            best[j] = max(best[j], best[k])
    hit = {(t[2], t[3]) for k, (_, terms) in enumerate(nodes) if best[k] >= threshold for t, u in zip(terms, uses[k], strict=True) if u is None and t[1]}
    out: list[tuple[int, int]] = []
    for span in sorted(hit, key=lambda s: (s[0], -s[1])):
        if not out or span[0] >= out[-1][1]:
            out.append(span)
    return out


def spans(text: str | None, threshold: float = THRESHOLD) -> list[tuple[int, int, int]]:
    """All spans of a text as (start, kind's rank, end), sorted."""
    if not text:
        return []
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found + [(s, 3, e) for s, e in lexed_spans(text, threshold)])


def render(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def redact(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for s, k, e in found:
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], f"[{KINDS[k]}]"]
        at = e
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its id, counts by kind, the digest of the pattern spans and all spans. Narrow: no shuffle."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in chunks(batches):
            rows = [spans(t, threshold) for t in batch.column("text").to_pylist()]
            base = [[x for x in r if x[1] < 3] for r in rows]
            counts = [[sum(x[1] == k for x in r) for r in rows] for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(render(b).encode()).hexdigest() for b in base], pa.string()),
                    pa.array([render(r) for r in rows], pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_literal long, base_sha256 string, spans string")


def redacted(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with every secret in text_col replaced by its kind in brackets; other columns and nulls stay."""

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: redact(t, spans(t, threshold)) if t else t)

    return docs.withColumn(text_col, clean(F.col(text_col).cast("string")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
