"""Licence scans: identifier tags and notice phrases by Aho-Corasick, expressions by shunting-yard.

A text is lower-cased in A-Z and cut into words of digits, letters and characters beyond ASCII.
One automaton over the words finds three things at once: the base phrases, further notice
phrases, and identifier tags such as ``SPDX-License-Identifier``. What follows a tag on its line is
read as an expression of identifiers with ``AND``, ``OR``, ``WITH``, ``+`` and parentheses, up to
the first token that cannot continue it. A shunting-yard parser turns it into postfix order, and
its value is computed from there: the reader of ``a OR b`` may choose the lighter licence, that of
``a AND b`` bears the heavier one, and a linking exception after ``WITH`` lightens a copyleft. ``WITH`` takes a licence, not a group, on its
left; after a group it counts for the whole group.

The score says how far the licences found restrict reuse: 0 without any, 0.25 for permissive ones,
0.5 for weak and 0.75 for strong copyleft, 1 for those that forbid commercial use or changes or
reserve all rights, 0.6 for unknown identifiers. Several findings hold together, so the heaviest
counts; a base phrase counts like a notice, but inside an expression only the expression does.

Null and empty texts have no words, no places and score 0; repeated rows give equal rows; a null id
is kept. Whole texts are read, one at a time. Parentheses left open are closed at the end and a
dangling operator is ignored; both mark the expression as malformed, none raises. A tag with no
identifier after it finds nothing. Columns of the input other than id and text are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

# The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Further phrases of licence notices, in words, and the licence each one names.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "gnu gpl": "gpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "bsl",
    "licensed under the apache license": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "free and unencumbered software released into the public domain": "unlicense",
    "dedicated to the public domain": "public-domain",
    "cc0": "cc0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
    "creative commons attribution noncommercial noderivatives": "cc-by-nc-nd",
    "all rights reserved": "proprietary",
}

# Tags in words; a strict tag is followed by any identifier, another one only by known licences.
TAGS = {"spdx license identifier": True, "license expression": True, "license": False, "licence": False}

PERMISSIVE, WEAK, UNKNOWN, STRONG, CLOSED = 0.25, 0.5, 0.6, 0.75, 1.0
RESTRICTION = {
    **dict.fromkeys(("mit", "apache", "bsd", "isc", "zlib", "bsl", "unlicense", "cc0", "cc-by", "public-domain", "wtfpl", "python", "psf", "postgresql", "ncsa", "x11"), PERMISSIVE),
    **dict.fromkeys(("lgpl", "mpl", "epl", "cddl", "eupl"), WEAK),
    **dict.fromkeys(("gpl", "agpl", "gfdl", "cc-by-sa", "osl"), STRONG),
    **dict.fromkeys(("cc-by-nc", "cc-by-nd", "cc-by-nc-sa", "cc-by-nc-nd", "proprietary"), CLOSED),
}
NO_LICENCE = ("none", "noassertion")
LINKING = re.compile("classpath|linking|library|runtime|gcc|llvm|autoconf|bison|font|openjdk")

UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AFTER_TAG = re.compile(r"[\"']?[ \t]*[:=][ \t]*[\[\"']*")
TOKEN = re.compile(r"[ \t]*(?:([()/])|([A-Za-z0-9][A-Za-z0-9.+:_-]*))")
FAMILY = re.compile(r"0?([a-z]+?0?(?:-[a-z]+)*)(?:-?v?[0-9].*|-only|-or-later)?\+?$")
PRECEDENCE = {"OR": 1, "AND": 2, "WITH": 3}
SYMBOLS = {"/": "OR"}


def lowered(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(UPPER)


def family(identifier: str) -> str:
    """The licence an identifier names, without version: ``GPL-2.0-or-later`` is ``gpl``."""
    name = lowered(identifier)
    if name in RESTRICTION or name.startswith("licenseref-"):
        return name
    found = FAMILY.match(name)
    return found[1] if found else name


def known(identifier: str) -> bool:
    return family(identifier) in RESTRICTION


@dataclass
class Expression:
    """A licence expression: its text, its value and its licences."""

    text: str
    value: float
    licences: list[str] = field(default_factory=list)
    malformed: bool = False


def tokens_after(text: str, at: int, strict: bool) -> tuple[list[str], bool, int]:
    """(tokens, malformed, end): the longest run from ``at`` that an expression may begin with."""
    tokens: list[str] = []
    depth, operand, end = 0, True, at  # operand: what must come next
    while found := TOKEN.match(text, at):
        token = found[1] or found[2].rstrip(".:")
        operator = SYMBOLS.get(token, token.upper())
        if operand and token == "(":
            depth += 1
        elif operand and found[2] and operator not in PRECEDENCE:
            sure = known(token) or (tokens and tokens[-1] == "WITH") or (strict and (not tokens or tokens[-1] == "(" or re.search("[0-9-]", token)))
            if not sure:
                break
            operand = False
        elif not operand and operator in PRECEDENCE:
            token, operand = operator, True
        elif not operand and token == ")" and depth:
            depth -= 1
        else:
            break
        tokens.append(token)
        end = found.end()
        if found[2] and len(token) < len(found[2]):  # the full stop of a sentence ends it
            break
        at = end
    dangling = 0
    while tokens and (tokens[-1] in PRECEDENCE or tokens[-1] == "("):
        dangling += 1
        depth -= tokens.pop() == "("
    return tokens + [")"] * depth, bool(depth or dangling), end


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands as they come, operators once nothing that binds tighter is open."""
    out: list[str] = []
    waiting: list[str] = []
    for token in tokens:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif token in PRECEDENCE:
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
        else:
            out.append(token)
    return out + waiting[::-1]


def evaluate(tokens: list[str], malformed: bool = False) -> Expression | None:
    """The value of balanced tokens; None if they name no licence."""
    stack: list[tuple[float, str]] = []  # value, and the identifier of a plain operand
    licences: list[str] = []
    order = postfix(tokens)
    for token, following in zip(order, [*order[1:], ""]):
        if token not in PRECEDENCE:
            name = family(token)
            if following != "WITH" and name not in NO_LICENCE:
                licences.append(name)
            stack.append((0.0 if name in NO_LICENCE else RESTRICTION.get(name, UNKNOWN), token))
            continue
        (right, after), (left, _) = stack.pop(), stack.pop()
        if token == "WITH":
            value = min(left, WEAK) if LINKING.search(lowered(after)) else left
        else:
            value = min(left, right) if token == "OR" else max(left, right)
        stack.append((value, ""))
    if not stack or not licences:
        return None
    text = "".join(f" {t} " if t in PRECEDENCE else t for t in tokens)
    return Expression(text, stack[0][0], sorted(set(licences)), malformed)


class Scanner:
    """The automaton of phrases and tags. Every entry is words between single spaces."""

    def __init__(self, base: Mapping[str, str], notices: Mapping[str, str], tags: Mapping[str, bool]) -> None:
        import ahocorasick

        entries: dict[str, list[tuple[str, object]]] = {}
        for kind, phrases in (("base", base), ("notice", notices), ("tag", tags)):
            for phrase, value in phrases.items():
                entries.setdefault(f" {phrase} ", []).append((kind, value))
        self.automaton = ahocorasick.Automaton()
        for phrase, values in entries.items():
            self.automaton.add_word(phrase, (len(phrase), values))
        if entries:
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[str, str, int, float, bool]]]:
        """(number of words, findings): kind, label or expression, first word, restriction, malformed."""
        low = lowered(text)
        words = WORD.findall(low)
        if not words or not len(self.automaton):
            return len(words), []
        joined = f" {' '.join(words)} "
        findings, tagged, at, word = [], [], 0, 0
        for start, length, values in sorted(((end - length + 1, length, values) for end, (length, values) in self.automaton.iter(joined)), key=lambda h: h[:2]):
            word += joined.count(" ", at, start)
            at = start
            for kind, value in values:
                if kind == "tag":
                    last = word + joined.count(" ", start, start + length) - 2
                    tagged.append((word, last, value))
                else:
                    findings.append((kind, value, word, RESTRICTION.get(value, UNKNOWN), False))
        if tagged:
            starts = [m.start() for m in WORD.finditer(low)]
            found, spans = self.expressions(text, starts, [len(w) for w in words], tagged)
            # what stands inside an expression is weighed by the expression
            first = [a for a, _ in spans]
            inside = [(at := bisect_right(first, f[2])) > 0 and f[2] < spans[at - 1][1] for f in findings]
            findings = [(*f[:3], 0.0, f[4]) if within else f for f, within in zip(findings, inside)] + found
        return len(words), findings

    @staticmethod
    def expressions(text: str, starts: list[int], sizes: list[int], tagged: list[tuple[int, int, bool]]):
        """Findings after the tags (first word, last word, strict), and the spans of words read.

        One finding per expression and one per licence in it.
        """
        findings: list[tuple[str, str, int, float, bool]] = []
        spans: list[tuple[int, int]] = []
        read: set[int] = set()
        for word, last, strict in sorted(tagged, key=lambda t: (t[1], not t[2])):
            after = AFTER_TAG.match(text, starts[last] + sizes[last])
            if not after or after.end() in read:  # the same place after a shorter tag
                continue
            read.add(after.end())
            tokens, malformed, end = tokens_after(text, after.end(), strict)
            found = evaluate(tokens, malformed)
            if found:
                spans.append((last + 1, bisect_left(starts, end)))
                findings.append(("expression", found.text, word, found.value, malformed))
                findings += [("identifier", name, word, 0.0, malformed) for name in found.licences]
        return findings, spans


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.ArrayType(T.StringType())),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "findings",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("kind", T.StringType()),
                        T.StructField("value", T.StringType()),
                        T.StructField("word", T.LongType()),
                        T.StructField("restriction", T.DoubleType()),
                        T.StructField("malformed", T.BooleanType()),
                    ]
                )
            ),
        ),
    ]
)


def summary(scanned: tuple[int, list[tuple[str, str, int, float, bool]]]) -> tuple:
    """The fields of ``FOUND`` for one text."""
    n_words, findings = scanned
    base = [f for f in findings if f[0] == "base"]
    places = [f[2] for f in base]
    return (
        n_words,
        len(base),
        min(places, default=None),
        max(places, default=None),
        sorted({f[1] for f in base}),
        sorted({f[1] for f in findings if f[0] != "expression"}),
        max((f[3] for f in findings), default=0.0),
        [dict(zip(("kind", "value", "word", "restriction", "malformed"), f)) for f in sorted(findings, key=lambda f: (f[2], f[0], f[1]))],
    )


def scan_licenses(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    base: Mapping[str, str] = BASE_PHRASES,
    notices: Mapping[str, str] = NOTICES,
    tags: Mapping[str, bool] = TAGS,
) -> DataFrame:
    """One row per document: id and the fields of ``FOUND``.

    ``base`` and ``notices`` map phrases, as words between single spaces, to labels; ``tags`` map
    tags to whether any identifier may follow. ``findings`` has every place by its first word: base
    phrases, notices, identifiers and whole expressions with their restriction.
    """
    rows = documents.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["id"], *FOUND.fields])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        scanner = Scanner(base, notices, tags)
        kinds = to_arrow_schema(FOUND)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [summary(scanner.scan(t.as_py() or "")) for t in part.column(1)]
                columns = [pa.array([f[i] for f in found], kinds.field(i).type) for i in range(len(kinds))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=schema.fieldNames())

    return rows.mapInArrow(scanned, schema)
