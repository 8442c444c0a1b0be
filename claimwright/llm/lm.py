"""Scores of texts under an n-gram model, through Elias-Fano tries that Spark builds in shards.

1. Documents are dealt into chunks of a few megabytes by a hash of id and text. A chunk finds its
   distinct words and word pairs, counts those of training documents, and asks the shard of each
   context word about it and its successors.
2. A shard merges the counts of all chunks into a trie (``ngram_trie``), and answers every chunk:
   token counts and one-byte smoothed probabilities, by context-relative successor search.
3. Back at its documents, a chunk adds up the logarithms. No counts, vocabulary or trie pass the
   driver, a frequent pair is one entry per chunk, and the number of chunks and shards follows the
   input. Their size stays, but for the shard of a very common word, which holds all its successors.

The model interpolates: p(w | v) = max(c(v, w) - D, 0) / c(v) + D * n(v) / c(v) * p(w), with n(v)
different successors and p(w) = (c(w) + 1) / (N + V + 1); an unseen context leaves p(w). Words are
64-bit fingerprints, successors 32-bit ones within their context.

Null and empty texts are their end token. A null id counts as the empty text when documents are
divided. Repeated rows count and score each on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from .columns import held_out
from .ngram_trie import LEVELS, Trie

CHUNK_BYTES = 4_000_000
SHARD_BYTES = 16_000_000
DISCOUNT = 0.75
END, START = np.uint64(xxhash.xxh64_intdigest(b" ")), np.uint64(xxhash.xxh64_intdigest(b"  "))  # no word has a space

ASKED = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("shard", T.LongType()), T.StructField("blob", T.BinaryType())])


def packed(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays)] + [a.nbytes for a in arrays], np.int64)
    return zstandard.compress(head.tobytes() + b"".join(a.tobytes() for a in arrays), 1)


def unpacked(blob: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(kinds) + 1)[1:]
    ends = 8 * (len(kinds) + 1) + np.cumsum(sizes)
    return [np.frombuffer(raw[e - n : e], k) for k, e, n in zip(kinds, ends, sizes)]


class Chunk:
    """The tokens of a chunk: distinct words and pairs, and where they occur."""

    def __init__(self, texts: list[bytes | None], shards: int) -> None:
        pieces, lengths = [], []
        for text in texts:
            words = (text or b"").lower().split()
            pieces.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
            pieces.append(np.array([END], np.uint64))
            lengths.append(len(words) + 1)
        tokens = np.concatenate(pieces)
        self.lengths = np.array(lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.words, self.word = np.unique(np.concatenate([tokens, [START]]), return_inverse=True)
        start, self.word = self.word[-1], self.word[:-1]
        self.before = np.concatenate([[start], self.word[:-1]])
        self.before[self.starts] = start
        pairs, self.pair = np.unique(self.before * len(self.words) + self.word, return_inverse=True)
        self.context, self.successor = np.divmod(pairs, len(self.words))
        mixed = (self.words ^ (self.words >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        self.shard = ((mixed >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
        self.order = np.argsort(self.shard, kind="stable")  # words by shard, rising within it
        self.bounds = np.searchsorted(self.shard[self.order], np.arange(shards + 1))
        self.successors_of = np.bincount(self.context, minlength=len(self.words))
        self.first_pair = np.cumsum(self.successors_of) - self.successors_of

    def members(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of a shard, and the pairs that start with them, in the order of the exchange."""
        words = self.order[self.bounds[shard] : self.bounds[shard + 1]]
        lengths = self.successors_of[words]
        pairs = np.repeat(self.first_pair[words] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        return words, pairs


def _ask(shards: int):
    def ask(key, table):
        chunk = Chunk(table["text"].to_pylist(), shards)
        trained = np.repeat(~table["held_out"].to_numpy(), chunk.lengths).astype(np.float64)
        tokens = np.bincount(chunk.word, trained, len(chunk.words)).astype(np.uint32)
        counts = np.bincount(chunk.pair, trained, len(chunk.context)).astype(np.uint32)
        blobs = []
        for shard in range(shards):
            words, pairs = chunk.members(shard)
            successors = (chunk.words[chunk.successor[pairs]] >> np.uint64(32)).astype(np.uint32)
            blobs.append(packed(chunk.words[words], tokens[words], chunk.successors_of[words].astype(np.uint32), successors, counts[pairs]))
        return pa.table([pa.array([key[0].as_py()] * shards, pa.int64()), pa.array(range(shards), pa.int64()), pa.array(blobs, pa.binary())], names=ASKED.names)

    return ask


def _answer(key, table):
    asked = [unpacked(b.as_py(), np.uint64, np.uint32, np.uint32, np.uint32, np.uint32) for b in table["blob"]]
    contexts, place = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
    tokens = np.bincount(place, np.concatenate([a[1] for a in asked]), len(contexts))
    owner = np.repeat(place, np.concatenate([a[2] for a in asked]))
    keys = (owner.astype(np.uint64) << np.uint64(32)) | np.concatenate([a[3] for a in asked])
    counts = np.concatenate([a[4] for a in asked])
    keys, counts = keys[counts > 0], counts[counts > 0]
    keys, place = np.unique(keys, return_inverse=True)
    counts = np.bincount(place, counts, len(keys))
    trie = Trie(contexts, tokens, keys, counts, DISCOUNT)
    totals = np.array([tokens.sum(), (tokens > 0).sum()], np.int64)
    answers = [packed(totals, *trie.query(a[0], a[2], a[3])) for a in asked]
    return pa.table([table["chunk"], table["shard"], pa.array(answers, pa.binary())], names=ASKED.names)


def _score(shards: int, names: list[str]):
    def score(key, documents, answers):
        chunk = Chunk(documents["text"].to_pylist(), shards)
        tokens, rest = np.zeros(len(chunk.words), np.int64), np.zeros(len(chunk.words))
        seen = np.zeros(len(chunk.context))
        total = kinds = 0
        for shard, blob in zip(answers["shard"].to_pylist(), answers["blob"].to_pylist()):
            sums, counted, rests, codes = unpacked(blob, np.int64, np.int64, np.uint8, np.uint8)
            words, pairs = chunk.members(shard)
            tokens[words], rest[words], seen[pairs] = counted, LEVELS[rests], LEVELS[codes]
            total, kinds = total + int(sums[0]), kinds + int(sums[1])
        single = (tokens + 1) / (total + kinds + 1)
        rest[rest == 0] = 1.0  # an unseen context leaves the single word
        joint = seen + rest[chunk.context] * single[chunk.successor]
        count = tokens[chunk.word]
        sums = [np.add.reduceat(x, chunk.starts) for x in ((count > 0).astype(np.int64), np.log10(single)[chunk.word], np.log10(joint)[chunk.pair])]
        columns = [documents["doc_id"], documents["held_out"], pa.array(chunk.lengths), pa.array(sums[0]), pa.array([total] * len(chunk.lengths), pa.int64()), pa.array(sums[1]), pa.array(sums[2])]
        return pa.table(columns, names=names)

    return score


def score_texts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int = 7, part: int = 2) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    The model learns from the rows whose id's crc32 modulo ``parts`` is not ``part``.
    """
    rows = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 2)).first()[0] or 1
    chunks, shards = -(-size // CHUNK_BYTES), -(-size // SHARD_BYTES)
    rows = rows.withColumns({"held_out": held_out(F.col("doc_id"), parts, part), "chunk": F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks).cast("long"))})
    schema = T.StructType(
        [T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType())]
        + [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
        + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score")]
    )
    asked = rows.groupBy("chunk").applyInArrow(_ask(shards), ASKED)
    answers = asked.groupBy("shard").applyInArrow(_answer, ASKED)
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(shards, schema.names), schema)
