"""Secret scans: fixed patterns, and literals that reach a sensitive name.

*Patterns.*  ``assign``, ``access`` and ``hex``, leftmost and non-overlapping within each kind;
a match that is too short is dropped after it has taken its characters.

*Lexing.*  Texts that name something sensitive are read as source or configuration: names
(plain, dotted, quoted or in a subscript, with or without a type), ``=``, ``:``, ``:=`` or ``=>``,
and a value of string literals, bare words and names joined by ``+``.  Strings may have a prefix
or triple quotes; in parentheses, strings side by side are one value.  Literals are stored under their names, names in a value stand
for what was stored, and a value that reaches a sensitive name is scored by the name and by its
own length, mixture and entropy.  Its literals, wherever they stand, become spans of kind
``literal`` unless a pattern has them already.

Defined results: a null text counts as empty; every input row gives one result row; nulls and
repeated rows stay; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from hashlib import sha256
from math import log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, IntegerType, StringType, StructField, StructType,
)

from shelfcast.llm.arrow import map_lists

#: Fixed patterns: in ASCII, and the first in either case.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")  # a run of 16 or more is a whole run: nothing else can match
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18

#: Kinds in their order at one start.
KINDS = ("assign", "access", "hex", "literal")

#: Parts of names that make a value sensitive, with their weight.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "api_key": 1.0, "accesskey": 1.0, "access_key": 1.0, "privatekey": 1.0,
    "private_key": 1.0, "credential": 0.9, "authkey": 0.9, "auth_key": 0.9, "signature": 0.6,
}
HINTS = ("passw", "pwd", "passphrase", "secret", "token", "key", "credential", "signature")
#: Parts of values that are no secrets; the longest has ``EDGE`` + 1 characters.
PLACEHOLDER = re.compile(r"example|changeme|placeholder|your[_-]|dummy|\$\{|\{\{", re.I)
EDGE = 10

# Names and types are taken whole and tried at their beginning only: a long run of letters is
# read once, however many names could begin in it.
NAME = r"[A-Za-z_][A-Za-z0-9_]*+(?:[.-][A-Za-z0-9_]++)*+"
BEGIN = r"(?<![A-Za-z0-9_])(?<![A-Za-z0-9_][.-])"
#: Triple-quoted or plain.
STRING = (
    r'''"""(?:[^\\]|\\[\s\S])*?"""|\'{3}(?:[^\\]|\\[\s\S])*?\'{3}'''
    r'''|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*\''''
)
PREFIX = r"(?:[bBfFrRuU]{1,2}(?=[\"']))?"
TERM = re.compile(rf"""[ \t]*(?:{PREFIX}({STRING})|([A-Za-z0-9+/_.=-]+))""")
#: Parentheses before a string or a name; the terms inside, and what joins them.
OPEN = re.compile(r"""[ \t]*\((?:\s|\()*(?=[A-Za-z_"'])""")
INNER = re.compile(rf"""\s*(?:{PREFIX}({STRING})|({NAME}))""")
JOINED = re.compile(rf"""\s*\+(?=\s*["'A-Za-z_])|\s*(?={PREFIX}["'])""")
#: A type behind a name, where a value follows.
TYPE = r"[&*]{0,2}(?:'[a-z]++[ \t]++)?(?:\[\])?[A-Za-z_][\w.]*+(?:[\[<][^\]>=\n]{0,80}[\]>]{1,4})?"
TYPED = rf"{TYPE}(?:[ \t]*\|[ \t]*{TYPE}){{0,4}}\??(?=[ \t]*=(?![=>]))"
#: A name with its operator; the name may be quoted, the last subscript, or declared with a type.
TARGET = re.compile(
    rf"""\b(?:var|const)[ \t]++({NAME})[ \t]++{TYPED}[ \t]*+="""
    rf"""|{BEGIN}({NAME})["']?(?:[ \t]*+\]|[ \t]*+\[[0-9]*+\])?"""
    rf"""(?:[ \t]*+\??:[ \t]*+({TYPED})[ \t]*+=|[ \t]*+(?::=|=>|=(?!=)|:(?![:/])))"""
)
PLUS = re.compile(r"[ \t]*\+(?=[ \t]*[\"'A-Za-z_])")

#: Least score of a reported literal, and the fewest characters it has.
LEAST_SCORE, LEAST_LENGTH = 0.6, 8

SPAN = StructType(
    [StructField("kind", StringType()), StructField("start", IntegerType()),
     StructField("end", IntegerType())]
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three patterns."""
    low, spans = text.lower(), []
    if any(k in low for k in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_VALUE:
                spans.append(("assign", *m.span()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LENGTH:
                spans.append(("access", *m.span()))
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return spans


def name_weight(name: str) -> float:
    """How sensitive a target name is."""
    low = name.lower().replace("-", "_")
    return max((w for part, w in SENSITIVE.items() if part in low), default=0.0)


class Value:
    """What a name stands for: its characters counted, its ends, and where its literals are.

    A value made of others points to them, so that doubling it again and again costs a step each.
    """

    __slots__ = ("counts", "size", "head", "tail", "refused", "parts", "taken")

    def __init__(self):
        self.counts: Counter = Counter()
        self.size, self.head, self.tail = 0, "", ""
        self.refused, self.parts, self.taken = False, [], False

    def append(self, counts, size: int, head: str, tail: str, refused: bool, part) -> None:
        self.refused |= refused or PLACEHOLDER.search(self.tail + head) is not None
        for character, number in counts.items():
            self.counts[character] += number
        if self.size < EDGE:
            self.head = (self.head + head)[:EDGE]
        self.tail = (self.tail + tail)[-EDGE:] if size < EDGE else tail
        self.size += size
        self.parts.append(part)

    def literal(self, content: str, start: int, end: int) -> None:
        refused = PLACEHOLDER.search(content) is not None
        ends = content[:EDGE], content[-EDGE:]
        self.append(Counter(content), len(content), *ends, refused, (start, end))

    def value(self, other: Value) -> None:
        self.append(other.counts, other.size, other.head, other.tail, other.refused, other)

    def places(self) -> list[tuple[int, int]]:
        """Places of all literals in it that have not been taken yet."""
        out, open_ = [], [self]
        while open_:
            value = open_.pop()
            if not value.taken:
                value.taken = True
                out += [p for p in value.parts if isinstance(p, tuple) and p[1] > p[0]]
                open_ += [p for p in value.parts if isinstance(p, Value)]
        return out


def strength(value: Value) -> float:
    """From 0 to 1: how much a literal looks like a generated or chosen secret."""
    counts = value.counts
    if value.size < LEAST_LENGTH or value.refused or any(c.isspace() for c in counts):
        return 0.0
    if set(counts) <= set("xX") or (value.head[0] == "<" and value.tail[-1] == ">"):
        return 0.0
    kinds = {"a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "." for c in counts}
    if len(kinds) < 2:
        return 0.0
    entropy = -sum(n / value.size * log2(n / value.size) for n in counts.values())
    return min(1.0, entropy / 3.0)


def assignments(text: str):
    """``(name, terms)`` in text order; a term is ``("literal" | "name" | "known", value, start, end)``.

    A ``known`` name counts only if something is stored under it.
    """
    at = 0
    while target := TARGET.search(text, at):
        at, terms = target.end(), []
        inner = OPEN.match(text, at)
        at = inner.end() if inner else at
        while term := (INNER if inner else TERM).match(text, at):
            kind = 1 if term[1] is not None else 2
            start, end = term.span(kind)
            if kind == 1:
                quotes = 3 if term[1][:3] in ('"""', "'''") and len(term[1]) >= 6 else 1
                start, end = start + quotes, end - quotes
                if quotes == 3:  # without the line ends about the content
                    content = text[start:end]
                    start += len(content) - len(content.lstrip())
                    end = max(start, end - len(content) + len(content.rstrip()))
                terms.append(("literal", text[start:end], start, end))
            elif inner:
                terms.append(("known", term[2], start, end))
            else:
                is_name = re.fullmatch(NAME, term[2]) is not None
                terms.append(("name" if is_name else "literal", term[2], start, end))
            at = term.end()
            plus = (JOINED if inner else PLUS).match(text, at)
            if not plus:
                break
            at = plus.end()
        if terms:
            yield target[1] or target[2], terms
            if target[3] and name_weight(target[3]):  # "a: password = value" is no type
                yield target[3], terms
        if len(terms) == 1 and terms[0][0] in ("name", "known"):
            at = terms[0][2]  # "a = b = value": the name may be a target itself


def literal_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of literals whose value reaches a sensitive name."""
    low = text.lower()
    if not any(h in low for h in HINTS):
        return []
    stored: dict[str, Value] = {}
    found: set[tuple[int, int]] = set()
    for name, terms in assignments(text):
        value = Value()
        for kind, content, start, end in terms:
            if kind != "literal" and content in stored:
                value.value(stored[content])
            elif kind == "literal" or (kind == "name" and any(c.isdigit() for c in content)):
                # with a digit, an unknown bare word is a literal of a configuration file
                value.literal(content, start, end)
        stored[name] = value
        if name_weight(name) * strength(value) >= LEAST_SCORE:
            found.update(value.places())
    return [("literal", *p) for p in sorted(found)]


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans in order of start, then kind; ends are exclusive, in code points."""
    if not text:
        return []
    base = base_spans(text)
    starts, ends = [], []  # what the patterns cover, joined
    for start, end in sorted(s[1:] for s in base):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    more = []
    for span in literal_spans(text):
        k = bisect_right(starts, span[1]) - 1
        if k < 0 or ends[k] < span[2]:
            more.append(span)
    return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _spans_start():
    def work(texts: list) -> dict[str, list]:
        out: dict[str, list] = {"spans": [], "base_sha256": []}
        for text in texts:
            spans = scan(text)
            out["spans"].append([dict(zip(SPAN.names, s)) for s in spans])
            base = listed(s for s in spans if s[0] != "literal")
            out["base_sha256"].append(sha256(base.encode()).hexdigest())
        return out

    return work


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` (array of ``kind, start, end``) and the digest of the pattern spans."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fields = [StructField("spans", ArrayType(SPAN)), StructField("base_sha256", StringType())]
    return map_lists(source, _spans_start, StructType(fields), carry=1)


def redact_text(text: str | None, mark: str) -> str | None:
    """The text with every span, overlapping ones joined, replaced by ``mark``."""
    if not text:
        return text
    pieces, at = [], 0
    for _, start, end in scan(text):
        if start >= at:
            pieces += [text[at:start], mark]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def redact(
    docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
    mark: str = "[secret]",
) -> DataFrame:
    """``docs`` with secrets replaced; all rows and columns stay.

    Where ``length_col`` is a column it follows the new text.
    """

    def start():
        def work(texts: list) -> dict[str, list]:
            return {"clean": [redact_text(t, mark) for t in texts]}

        return work

    # the rest of the row passes the task unread
    rest = [F.col(c) for c in docs.columns if c != text_col] or [F.lit(None).alias("none")]
    rows = docs.select(F.struct(*rest).alias("row"), F.col(text_col).alias("text"))
    done = map_lists(rows, start, StructType([StructField("clean", StringType())]), carry=1)
    columns = []
    for name, kind in docs.dtypes:
        if name == text_col:
            columns.append(F.col("clean").alias(name))
        elif name == length_col:
            columns.append(F.char_length("clean").cast(kind).alias(name))
        else:
            columns.append(F.col("row")[name].alias(name))
    return done.select(*columns)
