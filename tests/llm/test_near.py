import random
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from claimwright.llm import components, embeddings, minhash  # noqa: E402


def test_components(spark):
    rnd = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in components.components(spark, spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = brute.grouped({x for p in pairs for x in p}, pairs)
    assert {i: got.get(i, i) for i in want} == want


def near_texts():
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, passage = [], " ".join(rnd.choice(vocabulary) for _ in range(60))
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(30, 120))]
        for _ in range(rnd.randint(1, 9)):
            copy = list(base)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append(" ".join(copy).upper() if rnd.random() < 0.3 else " ".join(copy))
    rows += [passage + " " + " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(10, 60))) for _ in range(25)]
    rows += ["a b c", "A  b\tc", "a b", "", None, None, "word " * 20_000, "word " * 20_000]
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_near_duplicates(spark, monkeypatch):
    rows = near_texts()
    want = brute.near_duplicates(rows)
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    for block, partners in ((1024, 4), (4, 1)):
        monkeypatch.setattr(minhash, "BLOCK", block)
        monkeypatch.setattr(minhash, "PARTNERS", partners)
        got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(spark, frame).collect()}
        assert got == want


def test_dropping(spark):
    text = "one two three four five six seven"
    frame = spark.createDataFrame([(5, text, 1), (3, text.upper(), 2), (3, text.upper(), 2), (9, None, 3), (None, text, 4)], "doc_id long, text string, id int")
    kept = minhash.drop_near_duplicates(spark, frame)
    assert kept.columns == frame.columns and sorted((r["id"] for r in kept.collect())) == [2, 3, 4]
    assert minhash.near_duplicates(spark, frame.limit(0)).count() == 0
    clashing = frame.withColumnsRenamed({"id": "gone"}).selectExpr("*", "1 as `__id`", "2 as kept", "3 as component")
    again = minhash.drop_near_duplicates(spark, clashing)
    assert again.columns == clashing.columns and sorted(r["gone"] for r in again.collect()) == [2, 3, 4]


def test_limits_of_batches_are_put_back(spark):
    names = [f"spark.sql.execution.arrow.{n}" for n in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(n) for n in names]
    long = spark.range(300, numPartitions=1).selectExpr("repeat('x', 10000) as text")

    def largest(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([max(b.nbytes for b in batches)])], names=["n"])

    with components.arrow_batches(spark, 1000, 100_000):
        assert [spark.conf.get(n).rstrip("b") for n in names] == ["1000", "100000"]
        assert long.mapInArrow(largest, "n long").first()["n"] < 200_000
    assert [spark.conf.get(n) for n in names] == before
    assert long.mapInArrow(largest, "n long").first()["n"] > 2_000_000


def vector_links(rows, least=0.95):
    sound = {i: v for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = list(sound)
    unit = np.array([np.array(sound[i]) / np.linalg.norm(sound[i]) for i in ids])
    near = unit @ unit.T >= least
    pairs = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near)) if a < b]
    component = brute.grouped([i for i, _ in rows], pairs)
    counts = {i: 0 for i, _ in rows}
    for a, b in pairs:
        counts[a] += 1
        counts[b] += 1
    return {i: (counts[i], component[i]) for i, _ in rows}


def test_near_vectors(spark, monkeypatch):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((20, 8))
    rows = [(i, [float(x) for x in (base[rng.integers(20)] + rng.standard_normal(8) * rng.choice([0, 0.05, 0.3])) * rng.choice([1, 100])]) for i in range(400)]
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] + [1.0] * 7), (2003, [None] + [1.0] * 7), (2004, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = vector_links(rows)
    for part in (16384, 30):
        monkeypatch.setattr(embeddings, "PART", part)
        got = {r["id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(spark, frame).collect()}
        assert got == want
    assert embeddings.near_vectors(spark, frame.limit(0)).count() == 0


def test_vectors_of_other_lengths_and_null_ids(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [1.0, 0.0]), (3, [1.0, 0.01]), (None, [1.0, 0.0])]
    got = {r["id"]: tuple(r)[1:] for r in embeddings.near_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert got == {0: (1, 0, True), 1: (1, 0, False), 2: (1, 2, True), 3: (1, 2, False), None: (0, None, True)}
