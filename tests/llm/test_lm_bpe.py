import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from claimwright.llm import bpe, lm, ngram_trie  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, universe in ((1, 10), (1000, 2**63), (5000, 6000), (3000, 2**40), (2, 2)):
        values = np.unique(rng.integers(0, universe, n, dtype=np.uint64))
        sequence = ngram_trie.EliasFano(values)
        assert (sequence.at(np.arange(len(values))) == values).all()
        keys = np.concatenate([values, rng.integers(0, universe, 500, dtype=np.uint64)])
        assert (sequence.next_from(keys) == np.searchsorted(values, keys)).all()
        assert ((sequence.find(keys) >= 0) == np.isin(keys, values)).all()
    assert (ngram_trie.EliasFano(np.zeros(0, np.uint64)).find(np.array([3], np.uint64)) == -1).all()


def test_scores(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice("the of and Cat cat dog ran sat é 日本".split()) for _ in range(rnd.randint(0, 40)))) for i in range(150)]
    rows += [(None, None), (900, ""), (901, "unheard words only"), (902, "the cat " * 20_000)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, chunk int")
    want = {i: w for (i, _), w in zip(rows, brute.lm_scores(rows))}
    for chunk, shard in ((4_000_000, 16_000_000), (20_000, 60_000)):
        monkeypatch.setattr(lm, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(lm, "SHARD_BYTES", shard)
        got = lm.score_texts(frame).collect()
        assert len(got) == len(rows)
        for r in got:
            exact = want[r["doc_id"]]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == exact[:3]
            assert r["base_score"] == pytest.approx(exact[3], rel=1e-9)
            assert r["score"] == pytest.approx(exact[4], abs=0.02 * r["n_tokens"] + 1e-9)  # half a step of a code
    assert lm.score_texts(frame.limit(0)).count() == 0


def test_round_trip(spark, monkeypatch):
    rnd = random.Random(6)
    parts = ["a", "the ", " ", "  \n", "\t", "12", "'s", "é", "日本", " ", "\x1c", "!", "?!", "—", "word"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.choice([0, 5, 100, 600])))) for i in range(120)]
    rows += [(900, None), (901, ""), (902, "x" * 3000), (903, "ab " * 900 + "y" * 700 + " end " * 50)] + [(904, "ab " * 900)] * 2 + [(None, "q r " * 500)]
    coder = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    want = Counter((i, np.array(coder.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows)
    frame = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, part int")
    monkeypatch.setattr(bpe, "CHUNK", 400)
    monkeypatch.setattr(bpe, "OVERLAP", 60)
    coded = bpe.decode_ids(bpe.encode_texts(frame, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    got = coded.collect()
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in got) == want
    assert all(4 * r["n_tokens"] == len(r["ids"]) for r in got)
    assert bpe.encode_texts(frame.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
