import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from claimwright.llm import pii, quality  # noqa: E402
from claimwright.llm.columns import running_starts  # noqa: E402


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(1)
    parts = ["a b c d e ", "a b c d e f ", "x\n", "\t", "# | <", "same line here\n", "\r\n", "ü é", "one two three. ", "\x0b", " "]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))) for i in range(300)]
    return rows + [(900, None), (901, ""), (901, ""), (902, "long word. " * 30_000), (903, "w" * 200_000)]


def test_statistics(spark, texts):
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = quality.judge(frame).select("doc_id", "text", "judged.n_words", "judged.word_chars", "judged.n_symbols", "judged.n_dup_lines", "judged.n_repeat_words").collect()
    assert len(got) == len(texts)
    for row in got:
        assert tuple(row)[2:] == brute.statistics(row["text"])


def test_lines_and_verdict(spark):
    prose = "The committee met on Tuesday and discussed the plan for the new bridge over the river."
    rows = [
        (0, prose),
        (1, prose + "\nHome | About | Contact | Login"),
        (2, "\n".join(["Home | About | News", "Sign in to read more", "Click here", prose[:20]])),
        (3, "THIS!! IS!! ALL!! SHOUTED!! AND!! NOTHING!! ELSE!! IN!! THE!! WHOLE!! TEXT!!"),
        (4, "word### with%%% symbols*** on$$$ every&&& single### word%%% of### the*** document$$$"),
        (5, "too short"),
        (6, None),
    ]
    frame = spark.createDataFrame([(i, t, "x", i) for i, t in rows], "doc_id long, text string, judged string, kept long")
    kept = {r["doc_id"]: r for r in quality.clean_documents(frame).collect()}
    assert set(kept) == {0, 1} and kept[1]["text"] == prose and kept[1]["judged"] == "x" and kept[1]["kept"] == 1
    assert quality.clean_documents(frame.limit(0)).columns == frame.columns


def test_words_of_lines_and_shares_of_stock_phrases(spark):
    """Tabs separate words too, and a stock phrase condemns a line only if it is a large part of it."""
    tabbed = "\n".join("\t".join(f"cell{i}x{j}" for j in range(11)) for i in range(6))
    paragraph = "Those who want to hear of the next meeting may subscribe at the desk in the hall, where the minutes of all earlier meetings are kept for readers."
    rows = [(0, tabbed), (1, paragraph), (2, paragraph + "\nLicensed under CC BY-NC 4.0.\nSubscribe to our newsletter!")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in quality.clean_documents(frame).collect()}
    assert kept == {0: tabbed, 1: paragraph, 2: paragraph}


def test_verdict_against_brute_force(spark):
    rnd = random.Random(3)
    pieces = ["the meeting is held", "Home", "|", "›", "click here", "all rights reserved", "###", "!!", "??", "what a day.", "read more", "$", "a plain line of words that ends well.", "cookie", "\t", "licensed under"]
    rows = [(i, "\n".join(" ".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(1, 8)))) for i in range(800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["base_failed"], r["text"], r["kept"]) for r in quality.judge(frame.select("doc_id", "text")).select("doc_id", "judged.base_failed", "judged.text", "judged.kept").collect()}
    want = {i: brute.cleaned(t) for i, t in rows}
    assert got == want and 50 < sum(w[2] for w in want.values()) < 750  # both verdicts occur


def test_documents_are_judged_once(spark):
    frame = spark.createDataFrame([(0, "x")], "doc_id long, text string")
    plan = quality.clean_documents(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lorem ipsum") == quality.judge(frame)._jdf.queryExecution().optimizedPlan().toString().count("lorem ipsum") > 0


def test_running_starts(spark):
    rows = [([],), ([5],), (list(range(1, 50)),)]
    got = spark.createDataFrame(rows, "a array<long>").select("a", running_starts(F.col("a")).alias("s")).collect()
    for a, s in got:
        assert s == [sum(a[:i]) for i in range(len(a))]


def test_base_spans(spark):
    rnd = random.Random(2)
    parts = ["a", "b.c", "@", "x@y.z", "_", "+", "1", "22", "333", ".", "-", " ", "4111 1111 1111 1111", "10.0.0.1", "+1 (456) 555-2186", "ü", "\n", "a@b.c_d@e.f.g", "0001.002.3.4.5", "(", "😀"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))) for i in range(600)]
    rows += [(900, None), (901, ""), (902, "1 2" * 5000 + "a@b." * 9000), (903, "+1" + " " * 20_000 + "x"), (None, "p@q.r"), (None, "p@q.r")]
    found = pii.find_identifiers(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((str(r["doc_id"]), r["b"]) for r in found.select("doc_id", pii.spans_text(F.col("base")).alias("b")).collect())
    assert got == sorted((str(i), brute.spans(t)) for i, t in rows)


def test_bootstrap_and_redaction(spark):
    rows = [(k, f"please dial phone: +1 (456) 555-{1000 + 37 * k} now", "x") for k in range(12)]
    rows += [(50, "please dial phone: (456) 555-9911 now", "x"), (51, "it was 5551234567 items", "x"), (52, "nothing", "x"), (52, "nothing", "x"), (53, None, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = {r["doc_id"]: r["added"] for r in pii.find_identifiers(spark, frame).collect()}
    assert [tuple(s) for s in found[50]] == [("phone", 19, 33)] and not found[51] and not found[52]
    texts = {r["doc_id"]: r["text"] for r in pii.redact(spark, frame).collect()}
    assert texts[0] == texts[50] == "please dial phone: [PHONE] now" and texts[51] == "it was 5551234567 items" and texts[53] is None
    assert pii.redact(spark, frame).count() == len(rows) and pii.redact(spark, frame).columns == frame.columns
    clashing = frame.selectExpr("*", "1 as `__id`", "2 as `__hash`", "'y' as `__spans`", "3 as of", "4 as hashed", "5 as base")
    again = pii.redact(spark, clashing)
    assert again.columns == clashing.columns and {r["doc_id"]: r["text"] for r in again.collect()} == texts
    assert pii.find_identifiers(spark, frame.limit(0)).count() == 0


def test_hidden_seeds_come_back(spark):
    """A third of the numbers lose the plus that makes them seeds; their contexts bring them back, and no others."""
    rnd = random.Random(4)
    contexts = ["my mobile is", "reach us under", "hotline number:"]
    rows, hidden = [], {}
    for i in range(90):
        number = f"({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"
        text = f"well then {contexts[i % 3]} {'' if i // 3 % 3 == 0 else '+1 '}{number} as said"
        if i // 3 % 3 == 0:
            hidden[i] = ("phone", text.index(number), text.index(number) + len(number))
        rows.append((i, text))
    rows += [(1000 + i, f"the parts list shows {rnd.randint(10**7, 10**8)} in row {i}") for i in range(40)]
    found = pii.find_identifiers(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = {r["doc_id"]: [tuple(s) for s in r["added"]] for r in found if r["added"]}
    assert added == {i: [span] for i, span in hidden.items()}


def test_spelled_at_signs(spark):
    rows = [(k, f"please write mail: user{k}@example.com now") for k in range(12)]
    rows += [(50, "please write mail: john(at)example.com now"), (51, "please write mail: jane[at]example.org now"), (52, "please write mail: (at)x now"), (53, "seen sam(at)home only"), (54, "w" * 200_000 + "(at)")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["added"]] for r in pii.find_identifiers(spark, frame).collect()}
    assert found[50] == [("email", 19, 38)] and found[51] == [("email", 19, 38)]
    assert not found[52] and not found[53] and not found[54]
    texts = {r["doc_id"]: r["text"] for r in pii.redact(spark, frame).collect()}
    assert texts[50] == texts[51] == texts[0] == "please write mail: [EMAIL] now"
