import random
from collections import Counter

import corpus_pipeline
from claimwright.llm import language, minhash, toxicity

WORDS = {
    "en": "the and of with house there which whole might thought water",
    "de": "der und nicht mit schule werden über größe straße zwischen",
    "fr": "les des avec pour être château français où voilà chez",
    "es": "los las con para niño corazón español mañana según aquí",
}


def said(rnd, code, n):
    return " ".join(rnd.choice(WORDS[code].split()) for _ in range(n))


def test_language(spark):
    rnd = random.Random(7)
    labelled = spark.createDataFrame([(said(rnd, c, 12), c) for c in WORDS for _ in range(40)] + [(None, "en"), ("the house", None)], "text string, lang string")
    model = language.fit_languages(spark, labelled)
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    rows = [(c, said(rnd, c, 30), "x") for c in WORDS for _ in range(10)] + [("und", None, "x"), ("und", "", "x"), ("und", "12 ²³ !?", "x"), ("en", "the house " * 50_000, "x")]
    got = language.predict_languages(spark.createDataFrame(rows, "want string, text string, lang_pred string"), model).collect()
    assert len(got) == len(rows) and all(r["want"] == r["lang_pred"] and 0 <= r["lang_score"] <= 1 for r in got)
    empty = language.fit_languages(spark, labelled.limit(0))
    assert {r["lang_pred"] for r in language.predict_languages(labelled, empty).collect()} == {"und"}


def test_copies_and_wordless_languages_teach_nothing(spark):
    """Many copies of one text are one text; a language without letters is absent."""
    rows = [("the house and water", "en")] * 4000 + [(f"der garten und schule nicht über {w}", "de") for w in WORDS["de"].split() * 3] + [("123 !", "sv"), ("", "sv"), ("456", "no")]
    model = language.fit_languages(spark, spark.createDataFrame(rows, "text string, lang string"))
    assert model.families == {"germanic": ["de", "en"]}
    asked = spark.createDataFrame([("the house and water",), ("der garten und schule",)], "text string")
    assert [r["lang_pred"] for r in language.predict_languages(asked, model).collect()] == ["en", "de"]
    alone = language.fit_languages(spark, spark.createDataFrame([("12", "en"), ("34", "de"), ("ja nein", "de")], "text string, lang string"))
    assert alone.families == {"germanic": ["de"]} and not alone.pair_machines


def test_folding():
    assert toxicity.folded("1D1OT, idіot! stüpid w0rth1ess") == " idiot idiot stupid worthiess "
    assert toxicity.folded("") == "  " and toxicity.folded("!!") == "  "


def test_exceptions_cover_hits():
    lexicon = toxicity.Lexicon({" trash ": 3.0, " idio": 2.0}, [" trash can "])
    assert lexicon.hits(toxicity.folded("Trash can, idiotic trash")).keys() == {10, 18}
    assert toxicity.Lexicon({}, []).hits(" any ") == {}


def test_toxicity(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        text, toxic = said(rnd, rnd.choice(list(WORDS)), 30), int(i % 5 == 0)
        rows.append((i, text + rnd.choice([" you idiot", " m0ron", " such scum"]) if toxic else text, toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(spark, frame)
    assert {" idiot ", " moron ", " scum "} <= set(model.terms)
    fresh = [(0, said(rnd, "en", 60) + " Idi0t"), (1, said(rnd, "de", 60)), (2, None), (3, ""), (4, said(rnd, "fr", 20) + " sсum"), (4, said(rnd, "es", 20))]
    scored = toxicity.measure(spark.createDataFrame([(i, t, 9.0) for i, t in fresh], "doc_id long, text string, score double"), model).collect()
    flags = Counter((r["doc_id"], r["score"] >= 0.3) for r in scored)
    assert flags == Counter([(0, True), (1, False), (2, False), (3, False), (4, True), (4, False)])
    odd = spark.createDataFrame([(1000 + i, "you idiot table", label) for i, label in enumerate([2, -1, 7, None])], frame.schema)
    assert toxicity.fit_toxicity(spark, frame.unionByName(odd)) == model
    assert toxicity.with_labels(frame.select("doc_id", "text"), odd.unionByName(frame.limit(3)).select("doc_id", "toxic")).count() == 3
    none = toxicity.fit_toxicity(spark, frame.limit(0))
    assert all(r["score"] == 0 for r in toxicity.measure(frame, none).collect())


def test_toxicity_counts_copies_once_and_shared_passages_all(spark):
    """Texts that share the passage with their least shingle all count; copies of one text count once."""
    rnd = random.Random(10)
    passage = min((said(rnd, "en", 12) for _ in range(300)), key=lambda p: minhash.shingle_set(p.encode())[0])
    least, texts = minhash.shingle_set(passage.encode())[0], []
    while len(texts) < 12:
        text = f"{passage} {said(rnd, 'de', 12)} you idiot"
        if minhash.shingle_set(text.encode())[0] == least:
            texts.append(text)
    copied = f"{said(rnd, 'fr', 12)} duplicated"
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(100 + i, copied.upper() if i % 2 else copied, 1) for i in range(12)]
    rows += [(200 + i, said(rnd, rnd.choice(list(WORDS)), 30), 0) for i in range(100)]
    model = toxicity.fit_toxicity(spark, spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert " idiot " in model.terms and " dupiicated " not in model.terms


def test_pipeline(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(i, said(rnd, c, 40) + ".", c, "s", 0) for i, c in enumerate(list(WORDS) * 15)]
    rows += [(100, rows[0][1].upper(), "en", "s", 0), (101, "too short", "en", "s", 0), (102, None, None, None, None), (103, "1 2 3 4 5 6 7 8 9 10 11 12.", "en", "s", 0)]
    rows += [(104, said(rnd, "en", 30) + ". write to me@example.com.", None, "s", 0)]
    frame = spark.createDataFrame([(*r, {"k": 1}) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, more map<string,int>")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = frame, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs
    names = list(seen)
    ids = {n: sorted(r["doc_id"] for r in seen[n].select("doc_id").distinct().collect()) for n in names}
    assert ids["quality rules"] == [*range(60), 100, 103, 104] and ids["language ID"] == [*range(60), 100, 104]
    assert ids["MinHash near-dedup"] == ids["PII"] == ids["packing"] == [*range(60), 104]
    assert all(seen[n].columns == frame.columns for n in names[:-1])
    last = seen["PII"].where("doc_id = 104").first()
    assert last["text"].endswith("write to [EMAIL].") and last["n_chars"] == len(last["text"]) and last["lang"] == "en"
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == 61
    nothing = frame.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, str(tmp_path)).count() == 0
