"""Secret scan by assignment-aware lexing (operator 8).

Two layers find spans in every whole text.

* Base patterns: keyword assignments, access ids and long hexadecimal runs.
* The lexer reads source and configuration syntax (``name = "literal"``,
  ``"name": "literal"``, ``name: literal``, ``export NAME=literal``,
  ``--name literal``, ``<name>literal</name>``, ``name: Type = literal``, triple
  quotes, block scalars and literals on the next line) into name-literal pairs,
  carries constants from name to name (``a = "..."; password = a``, and joins
  with ``+``), and scores each literal by the sensitivity of the name it
  reaches and by its own make-up. Literals that score at least ``THRESHOLD``
  are reported where they are written. A literal with white space counts by its
  best word that holds letters and digits; other words are prose. Private keys in
  PEM form are reported whole, whatever their name.

A quote that nothing closes in its line is a plain mark, and so are the same quotes behind it
that the line escapes; a single quote behind a letter or digit is an apostrophe unless a
string prefix (``b'...'``) stands before it. The time is linear in the text: what one failed
reading has told about the rest of a line or of a run is kept. Constants are joined up to
``MAX_JOINED`` characters, so that names joined with themselves cannot grow without end.

A lexed span that lies inside a base span adds nothing and is left out; base
spans always stay.

Defined results: a NULL or empty text has no spans; a NULL doc_id stays NULL; repeated rows give
repeated result rows; an empty table gives an empty result; further columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstar.llm.common import prepare

KINDS = ("assign", "access", "hex", "lexed")
THRESHOLD = 0.6
MIN_LITERAL = 6
MAX_JOINED = 1 << 16
REDACTED = "[REDACTED]"

_ASCII_FOLD = re.IGNORECASE | re.ASCII
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _ASCII_FOLD)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of 24 and more among all maximal runs

#: Sensitive parts of names, by weight.
_STRONG = re.compile(r"passw(?:or)?d|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential", _ASCII_FOLD)
_WEAK = re.compile(r"pwd|auth|bearer|signing[_-]?key|encryption[_-]?key|connection[_-]?string", _ASCII_FOLD)
#: Every sensitive name holds one of these (lower case), so a text without any of them has no finding.
_HINTS = ("passw", "passphrase", "secret", "token", "key", "credential", "pwd", "auth", "bearer", "connection")
_PLACEHOLDER = re.compile(
    r"(?:x+|\*+|\.+|-+|_+|0+|change_?me|example.*|your[_-].*|placeholder|redacted|dummy|sample|none|null|nil|undefined|"
    r"true|false|todo|test|string|str|int|password|secret|token)",
    _ASCII_FOLD,
)

_LEX = re.compile(
    r"""(?P<tag><(?P<tagname>[A-Za-z_][\w.-]*)>(?P<tagbody>[^<>\n]*)</(?P=tagname)>)"""
    r"""|(?P<flag>--?(?P<flagname>[A-Za-z][\w-]*)(?:=|[ ]+)(?P<flagbody>[^\s"'=-][^\s"']*))"""
    r"""|(?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
    r"""|(?P<name>[A-Za-z_$][\w$]*(?:[.-][A-Za-z_$][\w$]*)*)"""
    r"""|(?P<op>:=|=>|[=!<>]=|[=:+])"""
    r"""|(?P<number>\d[\w.]*)"""
    r"""|(?P<line>\n)"""
    r"""|(?P<end>[;,{}()\[\]])"""
    r"""|(?P<space>[^\S\n]+)"""
    r"""|(?P<other>.)"""
)
_LONG = re.compile(r"""[^\S\n]*[A-Za-z]{0,2}(?P<quote>\"{3}|'{3}|`)(?P<body>[\s\S]*?)(?P=quote)""")
_BLOCK = re.compile(r"[^\S\n]*[|>][-+\d]{0,2}[^\S\n]*(?:#[^\n]*)?\n")
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----(?:(?!-----)[\s\S])*-----END [A-Z0-9 ]*PRIVATE KEY-----")
_BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>]+")


_MARK = re.compile("(?P<other>.)")
_PREFIXES = frozenset(("b", "r", "u", "f", "br", "rb", "fr", "rf"))
#: Words after which a name may be followed by its type alone: ``const name string = literal``.
_DECLARES = frozenset(("const", "var"))

_LETTER, _DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, ordered by start then kind."""
    low = text.lower()
    spans: list[tuple[int, int, int]] = []
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def name_weight(name: str) -> float:
    """How sensitive a target name is: 0, 0.35 or 0.6."""
    return 0.6 if _STRONG.search(name) else 0.35 if _WEAK.search(name) else 0.0


def literal_score(value: str) -> float:
    """How much a literal looks like a secret, 0 to 0.4: entropy and mixed classes."""
    if len(value) < MIN_LITERAL or _PLACEHOLDER.fullmatch(value) or "${" in value or "{{" in value:
        return -1.0
    if any(c.isspace() for c in value):
        return max((literal_score(w) for w in value.split() if _LETTER.search(w) and _DIGIT.search(w)), default=-1.0)
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    mixed = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(0.25, entropy / 14) + min(0.15, 0.05 * mixed)


def lexed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of literals that reach a sensitive name."""
    low = text.lower()
    if not any(h in low for h in _HINTS):
        return []
    constants: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}
    found: set[tuple[int, int]] = {m.span() for m in _PEM.finditer(text)}

    def judge(name: str, value: str, spans: tuple[tuple[int, int], ...]) -> None:
        weight = name_weight(name)
        if weight and weight + literal_score(value) >= THRESHOLD:
            found.update(spans)

    tokens, runs = _tokens(text), _Runs(text)
    closers = _closers(tokens)
    i, n = 0, len(tokens)
    while i < n:
        kind, m = tokens[i]
        if kind == "tag":
            judge(m["tagname"], m["tagbody"], (m.span("tagbody"),))
        elif kind == "flag":
            judge(m["flagname"], m["flagbody"], (m.span("flagbody"),))
        elif kind in ("name", "text"):
            j = i + 1
            while j < n and tokens[j][0] == "end" and tokens[j][1][0] == "]":  # config["name"] = ...
                j += 1
            if j + 1 < n and tokens[j][1][0] in ("?", "!") and tokens[j + 1][1][0] == ":":  # name?: Type
                j += 1
            if j + 1 < n and i and tokens[i - 1][1][0] in _DECLARES and tokens[j][0] == "name" and tokens[j + 1][1][0] == "=":
                j += 1  # const name Type = value
            if j < n and tokens[j][0] == "op" and tokens[j][1][0] in ("=", ":", ":=", "=>"):
                name = m[0].strip("\"'`")
                if tokens[j][1][0] == ":" and (equals := _after_type(tokens, j + 1, closers)):
                    value, spans, _ = _value(text, tokens, equals, constants, runs)
                    if value is not None:
                        constants[name] = (value, spans)
                        judge(name, value, spans)
                        i += 1  # what stands for the type may be a name of its own: if x: name = value
                        continue
                value, spans, j = _value(text, tokens, j, constants, runs)
                if value is not None:
                    constants[name] = (value, spans)
                    judge(name, value, spans)
                    i = j
                    continue
        i += 1
    return sorted((a, 3, b) for a, b in found)


def _tokens(text: str) -> list[tuple[str, re.Match]]:
    """(kind, match) of all tokens but white space."""
    out: list[tuple[str, re.Match]] = []
    at, size, plain = 0, len(text), {'"': 0, "'": 0}  # up to where a quote is known to open nothing
    while at < size:
        sign = text[at]
        if sign not in plain:
            m = _LEX.match(text, at)
        elif at < plain[sign] or (sign == "'" and _apostrophe(text, at, out)):
            m = _MARK.match(text, at)
        else:
            m = _LEX.match(text, at)
            if m.lastgroup == "other":
                # read to the end of its line in vain: every later one of this line is escaped,
                # and would be read over the same characters
                end = text.find("\n", at)
                plain[sign] = size if end < 0 else end
        at = m.end()
        kind = m.lastgroup
        if kind in ("tagbody", "tagname", "flagbody", "flagname"):
            kind = "tag" if m["tag"] else "flag"
        if kind != "space":
            out.append((kind, m))
    return out


def _apostrophe(text: str, at: int, before: list[tuple[str, re.Match]]) -> bool:
    if not at or not text[at - 1].isalnum():
        return False
    kind, m = before[-1]
    return not (kind == "name" and m[0].lower() in _PREFIXES)


class _Runs:
    """Where the run of bare characters around a place ends; the last run is remembered."""

    def __init__(self, text: str):
        self.text, self.start, self.stop = text, 0, 0

    def end(self, at: int) -> int:
        if not self.start <= at < self.stop:
            m = _BARE.match(self.text, at)
            self.start, self.stop = at, m.end() if m else at
        return self.stop if at < self.stop else at


def _closers(tokens) -> dict[int, int]:
    """Token number of each opening bracket -> that of its closing one."""
    out, stack = {}, []
    for i, (kind, m) in enumerate(tokens):
        if kind == "end" and m[0] in "([{":
            stack.append(i)
        elif kind == "end" and m[0] in ")]}" and stack:
            out[stack.pop()] = i
    return out


def _after_type(tokens, at: int, closers: dict[int, int]) -> int | None:
    """The ``=`` behind a type expression that starts at ``at``, if there is one in the line."""
    j, angles = at, 0
    while j < len(tokens):
        kind, m = tokens[j]
        sign = m[0]
        if kind == "op":
            if sign == "=" or (sign == ">=" and angles):
                if j == at:
                    return None
                # without a blank before it, as in base64 or a=b, only a quoted value makes an assignment
                spaced = tokens[j - 1][1].end() < m.start()
                quoted = j + 1 < len(tokens) and (tokens[j + 1][0] == "text" or tokens[j + 1][1][0] in ("\"", "'", "`"))
                return j if spaced or quoted else None
            if sign not in ("=>", "+"):  # function types, sums of bounds
                return None
        elif kind == "end":
            if sign in "([{":
                if j not in closers:
                    return None
                j = closers[j]
            elif sign != "," or not angles:
                return None
        elif kind == "line" or kind == "flag":
            return None
        elif sign == "<":
            angles += 1
        elif sign == ">":
            angles = max(0, angles - 1)
        j += 1
    return None


def _across_lines(text: str, op: re.Match) -> tuple[int, int] | None:
    """Span of a triple-quoted, many-line or block literal right after an operator."""
    m = _LONG.match(text, op.end())
    if m and (len(m["quote"]) == 3 or "\n" in m["body"]):
        return m.span("body")
    block = _BLOCK.match(text, op.end()) if op[0] == ":" else None
    if not block:
        return None
    line = text[text.rfind("\n", 0, op.start()) + 1 : op.start()]
    indent = len(line) - len(line.lstrip(" \t"))
    at = end = block.end()
    while at < len(text):
        stop = text.find("\n", at)
        stop = len(text) if stop < 0 else stop
        row = text[at:stop]
        if row.strip():
            if len(row) - len(row.lstrip(" \t")) <= indent:
                break
            end = stop
        at = stop + 1
    return (block.end(), end) if end > block.end() else None


def _value(text: str, tokens, at: int, constants, runs: _Runs):
    """The constant after the operator at ``at``: (value or None, its spans, next token)."""
    value, j = "", at + 1
    spans: dict[tuple[int, int], None] = {}  # in order, each once
    opened_by = tokens[at][1][0]
    if long := _across_lines(text, tokens[at][1]):
        body = text[long[0] : long[1]]
        start = long[0] + len(body) - len(body.lstrip())
        return body.strip(), ((start, start + len(body.strip())),), at + 1  # the lines inside are read as well
    while j < len(tokens) and (tokens[j][0] == "line" or tokens[j][1][0] == "("):
        j += 1
    if j > at + 1 and (j == len(tokens) or tokens[j][0] != "text" or (j + 1 < len(tokens) and tokens[j + 1][0] == "op" and tokens[j + 1][1][0] != "+")):
        j = at + 1  # only a literal may stand on the next line
    while j < len(tokens):
        kind, m = tokens[j]
        if kind == "text":
            value += m[0][1:-1]
            spans[m.start() + 1, m.end() - 1] = None
        elif kind == "name" and m[0].lower() in _PREFIXES and j + 1 < len(tokens) and tokens[j + 1][0] == "text" and tokens[j + 1][1].start() == m.end():
            j += 1  # b"literal"
            continue
        elif kind == "name" and m[0] in constants and runs.end(m.start()) <= m.end():
            known, where = constants[m[0]]
            if len(value) + len(known) > MAX_JOINED:
                return None, (), j
            value += known
            spans |= dict.fromkeys(where)
        elif not spans and kind in ("name", "number", "other", "flag") and (stop := runs.end(m.start())) > m.start():
            follows = j + 1 < len(tokens) and tokens[j + 1][0] == "op" and tokens[j + 1][1][0] in ("=", ":")
            padded = follows and tokens[j + 1][1][0] == "=" and tokens[j + 1][1].start() < stop  # abc=, part of the literal
            if follows and opened_by == ":" and not padded:  # name: Type = value
                return None, (), j
            while j < len(tokens) and tokens[j][1].start() < stop:
                j += 1
            return text[m.start() : stop], ((m.start(), stop),), j
        else:
            return None, (), j
        j += 1
        if j < len(tokens) and tokens[j][0] == "op" and tokens[j][1][0] == "+":
            j += 1
        else:
            break
    return (value, tuple(spans), j) if spans else (None, (), j)


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each (start, kind, end) by start then kind."""
    if not text:
        return [], []
    base = base_spans(text)
    starts, reach = [b[0] for b in base], list(accumulate((b[2] for b in base), max))
    # inside a base span: of those that start no later, one reaches as far
    more = [s for s in lexed_spans(text) if not (k := bisect_right(starts, s[0])) or reach[k - 1] < s[2]]
    return base, sorted(base + more)


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str | None) -> str | None:
    """The text with every span, overlapping ones as one, put out of sight."""
    spans = scan(text)[1]
    if not spans:
        return text
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], REDACTED]
        at = max(at, b)
    return "".join(out) + text[at:]


_RESULT = "doc_id long, n_assign long, n_access long, n_hex long, n_lexed long, base_sha256 string, spans string"


def _scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0), batch.column(1)):
            base, spans = scan(text.as_py())
            per_kind = Counter(k for _, k, _ in spans)
            digest = hashlib.sha256(render(base).encode()).hexdigest()
            rows.append((doc.as_py(), *[per_kind[k] for k in range(4)], digest, render(spans)))
        names = [c.split()[0] for c in _RESULT.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        cols = list(zip(*rows)) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)


def scan_documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts by kind, digest of the base spans, and all spans."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(_scan_rows, _RESULT)


def redact_documents(docs: DataFrame) -> DataFrame:
    """The same rows and columns with secrets put out of sight and ``n_chars``,
    where there is one, brought into line; other columns pass unchanged."""
    prepare(docs.sparkSession)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        for batch in batches:
            before = batch.column(at)
            after = [redact(t.as_py()) for t in before]
            cols = list(batch.columns)
            cols[at] = pa.array(after, before.type)
            if "n_chars" in columns:
                k = columns.index("n_chars")
                old = cols[k].to_pylist()
                new = [n if a == b.as_py() else len(a) for n, a, b in zip(old, after, before)]
                cols[k] = pa.array(new, cols[k].type)
            yield pa.RecordBatch.from_arrays(cols, names=columns)

    return docs.mapInArrow(run, docs.schema)
