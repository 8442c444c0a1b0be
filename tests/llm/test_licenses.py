import random
import re

import pytest

from claimwright.llm import licenses
from claimwright.llm.licenses import BASE_PHRASES, NOTICES, TAGS, Scanner, evaluate, family, summary, tokens_after

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_of(text):
    """Words and places by comparing slices."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = [(i, label) for phrase, label in BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), sorted({label for _, label in places})


def texts():
    rnd = random.Random(11)
    pieces = ["GNU", "General", "Public", "License", "Apache", "MIT", "CC", "BY", "cc-by", "x", "é", "\n", "Lizenz", "0", "gnu general public license", "MIT License", "K"]
    made = ["".join(rnd.choice(pieces) + rnd.choice([" ", ", ", "-", "\n", "."]) for _ in range(rnd.randint(1, 40))) for _ in range(300)]
    return [*made, "", None, "\x00\x7f", "cc by " * 30_000, "Áñ" * 50_000, "SPDX-License-Identifier: " + "(" * 20_000 + "MIT", "SPDX-License-Identifier: MIT" + " OR MIT" * 20_000]


def test_base_places_equal_slices(spark):
    rows = [(i % 300, t, "x", 1) for i, t in enumerate(texts())] + [(None, "MIT license", "x", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, labels string, id int")
    got = licenses.scan_licenses(frame).collect()
    fields = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted([(r["id"] is None, r["id"] or 0, str([r[f] for f in fields])) for r in got]) == sorted([(i is None, i or 0, str(list(base_of(t)))) for i, t, *_ in rows])
    assert all(set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1 for r in got)
    assert licenses.scan_licenses(frame.limit(0)).count() == 0


def scan(text):
    return summary(Scanner(BASE_PHRASES, NOTICES, TAGS).scan(text))


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        ("Licensed under CC BY-NC 4.0.", ["cc-by", "cc-by-nc"], 1.0),
        ("# SPDX-License-Identifier: GPL-2.0-only OR MIT", ["gpl", "mit"], 0.25),
        ("# SPDX-License-Identifier: GPL-2.0-only AND MIT", ["gpl", "mit"], 0.75),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", ["gpl"], 0.5),
        ("SPDX-License-Identifier: MIT OR GPL-2.0-only AND CC-BY-NC-4.0", ["cc-by", "cc-by-nc", "gpl", "mit"], 0.25),
        ("SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND LGPL-2.1+ */", ["gpl", "lgpl", "mit"], 0.5),
        ('"license": "MIT/Apache-2.0"', ["apache", "mit"], 0.25),
        ("license: see the file", [], 0.0),
        ("SPDX-License-Identifier: NONE", [], 0.0),
        ("SPDX-License-Identifier: LicenseRef-Own", ["licenseref-own"], 0.6),
        ("All rights\nreserved", ["proprietary"], 1.0),
        ("a licence to print", [], 0.0),
    ],
)
def test_labels_and_score(text, labels, score):
    found = scan(text)
    assert found[5] == labels and found[6] == score


def test_malformed_expressions():
    for text, shown in (("((MIT OR", "((MIT))"), ("MIT AND", "MIT"), (") MIT", None), ("", None), ("OR MIT", None), ("(", None)):
        tokens, malformed, _ = tokens_after(text, 0, True)
        found = evaluate(tokens, malformed)
        assert (found.text if found else None) == shown and (not found or found.malformed)


def descent(tokens):
    """Value by recursive descent; an operand before WITH must be a licence or a group."""
    at = 0

    def operand():
        nonlocal at
        token = tokens[at]
        at += 1
        if token == "(":
            value = either()
            at += 1
        else:
            value = licenses.RESTRICTION.get(family(token), licenses.UNKNOWN)
        while at < len(tokens) and tokens[at] == "WITH":
            exception = tokens[at + 1]
            at += 2
            value = min(value, licenses.WEAK) if "Classpath" in exception else value
        return value

    def both():
        nonlocal at
        value = operand()
        while at < len(tokens) and tokens[at] == "AND":
            at += 1
            value = max(value, operand())
        return value

    def either():
        nonlocal at
        value = both()
        while at < len(tokens) and tokens[at] == "OR":
            at += 1
            value = min(value, both())
        return value

    return either()


def test_shunting_yard_equals_recursive_descent():
    rnd = random.Random(5)

    def made(depth):
        if depth == 0 or rnd.random() < 0.3:
            name = [rnd.choice(["MIT", "GPL-3.0-only", "LGPL-2.1+", "CC-BY-NC-4.0", "Own-1"])]
            return name + ["WITH", rnd.choice(["Classpath-exception-2.0", "Other-1"])] if rnd.random() < 0.2 else name
        inner = [*made(depth - 1), rnd.choice(["AND", "OR"]), *made(depth - 1)]
        return ["(", *inner, ")"] if rnd.random() < 0.5 else inner

    for _ in range(500):
        tokens = made(5)
        text = " ".join(tokens).replace("( ", "(").replace(" )", ")")
        read, malformed, _ = tokens_after(text, 0, True)
        assert read == tokens and not malformed
        found = evaluate(read)
        assert found.value == descent(tokens) and found.text == text
