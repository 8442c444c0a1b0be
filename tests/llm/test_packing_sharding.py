import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from claimwright.llm import packing, sharding  # noqa: E402

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(100, 5, 40, 16), packing.Limits(100, 5, 40, 16, cut=False)])
def test_limits_hold(limits):
    rng = np.random.default_rng(0)
    placed, sizes = [], {}
    packer = packing.Packer(limits, lambda *piece: placed.append(piece))
    for i in range(400):
        tokens = int(rng.integers(1, 90))
        loss = int(rng.integers(0, min(tokens, 40) + 1))
        sizes[i] = (tokens, loss)
        packer.add(i, tokens, loss)
    packer.finish()
    of, within = defaultdict(list), defaultdict(list)
    for document, start, length, sequence, offset in placed:
        of[document].append((start, length))
        within[sequence].append((offset, length, document, start))
    for document, (tokens, _) in sizes.items():
        at = 0
        for start, length in sorted(of[document]):
            assert start == at and length > 0
            at += length
        assert at == tokens and (limits.cut or len(of[document]) == 1)
    for pieces in within.values():
        at = loss = 0
        for offset, length, document, start in sorted(pieces):
            assert offset == at
            at += length
            loss += max(0, start + length - max(start, sizes[document][0] - sizes[document][1]))
        assert at <= limits.tokens and len(pieces) <= limits.segments and loss <= limits.loss


@pytest.mark.parametrize("longest", [1, 5, 40])
def test_short_documents_leave_little_padding(longest):
    rng = np.random.default_rng(longest)
    lengths, placed = rng.integers(1, longest + 1, 20_000).tolist(), defaultdict(int)
    packer = packing.Packer(packing.Limits(), lambda document, start, length, sequence, offset: placed.__setitem__(sequence, placed[sequence] + length))
    for i, n in enumerate(lengths):
        packer.add(i, n, n)
    packer.finish()
    assert sum(placed.values()) == sum(lengths)
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in placed.values())
    assert padding < 0.02 * sum(lengths)


def test_pieces_hold_the_ids(spark):
    whole = Tokenizer.from_file(VOCABULARY)
    rows = [(0, "Hello WORLD, it's 12345 a_b don't!?—"), (1, None), (2, ""), (3, "ß ²³ <|endoftext|> é 日本 Iİ \x1c x 'S ok"), (4, "ÀÉ ÿ × ÷ we'LL"), (5, "many words here. " * 9000), (6, "same"), (None, "same")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string").repartition(2)
    got = packing.pack_documents(frame, VOCABULARY).collect()
    of, within = defaultdict(list), defaultdict(list)
    for r in got:
        of[r["doc_id"]].append(r)
        within[r["sequence_id"]].append(r)
    for i, text in rows:
        want = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        pieces = sorted(of[i], key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in pieces) == want.tobytes() and {r["doc_tokens"] for r in pieces} == {len(want)}
    for pieces in within.values():
        length = sum(r["length"] for r in pieces)
        assert length <= 4096 and length & (length - 1) == 0
    assert packing.pack_documents(frame.limit(0), VOCABULARY).count() == 0


def test_loss_column_binds(spark):
    rows = [(i, "some prompt and an answer " * 4, n) for i, n in enumerate([0, 5, 10, 20, None, 1000, -1] * 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, answer int").coalesce(1)
    limits = packing.Limits(tokens=256, segments=512, loss=24, pool=16)
    of, borne = defaultdict(int), defaultdict(int)
    for r in packing.pack_documents(frame, VOCABULARY, limits=limits, loss="answer").collect():
        n, total = rows[r["doc_id"]][2], r["doc_tokens"]
        first = total - (total if n is None else min(max(n, 0), total))
        borne[r["sequence_id"]] += max(0, r["start"] + r["length"] - max(r["start"], first))
        of[r["doc_id"]] += r["length"]
    assert len(of) == len(rows) and len(set(of.values())) == 1 and max(borne.values()) == 24


def test_differencing():
    places, sums = sharding.differenced([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]])
    assert sorted(sums) == [14, 16]
    for k in range(2):
        assert sum(size for size, place in zip([8, 7, 6, 5, 4], places) if place[0] == k) == sums[k]


@pytest.mark.parametrize("shards", [2, 3, 8])
def test_differencing_against_brute_force(shards):
    rng = np.random.default_rng(shards)
    sizes = [int(x) for x in rng.integers(1, 2**40, 300)]
    places, sums = sharding.differenced([[n, *[0] * (shards - 1)] for n in sizes])
    assert sorted(sums) == brute.differenced(sizes, shards)
    held = [0] * shards
    for n, place in zip(sizes, places):
        held[place[0]] += n
    assert held == sums


def test_repeated_rows_are_numbered_apart(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 16)
    monkeypatch.setattr(sharding, "SLOTS", 100)
    rows = [(1, "hot")] * 400 + [(None, None)] * 33 + [(i, f"text {i}") for i in range(200)]
    got = sharding.shard_documents(spark, spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == sorted((i or 0, len(t or "") + 1) for i, t in rows)
    for shard in (0, 1):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))


def test_shards(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, "é" * int(rng.integers(1, 400))) for i in range(500)] + [(900, None), (901, None), (902, "x" * 3000), (None, "same"), (903, "same"), (903, "same")]
    frame = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, shard int")
    for bucket, slots in ((10_000, 50_000), (100, 40)):
        monkeypatch.setattr(sharding, "BUCKET", bucket)
        monkeypatch.setattr(sharding, "SLOTS", slots)
        got = sharding.shard_documents(spark, frame, 4).collect()
        assert len(got) == len(rows)
        held, shards_of = defaultdict(list), defaultdict(set)
        for r in got:
            held[r["shard"]].append(r)
            shards_of[r["text_crc32"], r["size"]].add(r["shard"])
        assert all(len(s) == 1 for s in shards_of.values()) and set(held) == {0, 1, 2, 3}
        for members in held.values():
            assert sorted(r["slot"] for r in members) == list(range(len(members)))
        sums = [sum(r["size"] for r in members) for members in held.values()]
        assert max(sums) - min(sums) <= 0.02 * sum(sums)
    assert sharding.shard_documents(spark, frame.limit(0), 4).count() == 0


def test_words_are_those_of_the_vocabularys_order_of_alternatives():
    import re

    from claimwright.llm import packing

    as_given = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
    for text in ("it's we'll 'tis 12'd x''s !'re a'b é'm", "''d'", "don't 'S 'vex 3're", "", "ll'ms\t'\n's's"):
        assert packing.PLAIN_WORDS.findall(text) == as_given.findall(text)
