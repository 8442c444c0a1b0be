"""Packing of tokenised documents into sequences by vector bin packing.

A sequence has three limits: tokens, segments (pieces of documents) and loss-bearing tokens. A
task fills one sequence after another from a pool of its documents. The next piece is the one
whose demand, as a share of the limits, has the largest dot product with what is left of the
sequence, among those that fit whole. If none fits and cutting is allowed, the piece with the
largest dot product is cut to fill the sequence, and its rest stays in the pool. A sequence that
can take no further piece, since documents are so short that its segments run out, and what is
left at the end of a task, are cut into sequences whose lengths are powers of two, which need no
padding.

Packing needs no shuffle: sequences hold documents of one input partition, and their ids are
made of the partition and a running number, so a task that is run again gives the same ids.

A null or empty text is its end token alone. Ids and other columns are not read; repeated rows
are packed each on its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

# What the vocabulary's own pattern splits, for texts of these letters only.
PLAIN = re.compile(r"[\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
# letters come first, since most words begin with one and no other alternative does
PLAIN_WORDS = re.compile(r"[a-zß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
WORD_END = "</w>"


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 2048
    loss: int = 4096
    pool: int = 512  # documents a task chooses from; up to ``segments`` while they do not fill a sequence
    cut: bool = True  # whether a document may be cut to fill a sequence


class WordEncoder:
    """Ids of texts under a BPE with word ends; each distinct word is encoded once while cached.

    Texts outside plain Latin letters go to the tokenizer as they are.
    """

    CACHED_WORDS = 400_000

    def __init__(self, vocabulary: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(vocabulary)
        self.words = Tokenizer.from_file(vocabulary)
        self.words.normalizer = None
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.whole.get_vocab_size()
        self.ends = np.array([(self.whole.id_to_token(i) or "").endswith(WORD_END) for i in range(size)])
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.starts, self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, words: list[str]) -> None:
        lines = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.words.encode_batch_fast(lines, add_special_tokens=False)])
        after = np.flatnonzero(self.ends[ids]) + 1
        lengths = np.diff(after, prepend=0)
        self.places.update(zip(words, range(len(self.places), len(self.places) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.flat) + after - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        found = [PLAIN_WORDS.findall(t.lower()) if p else [] for t, p in zip(texts, plain)]
        words = list(chain.from_iterable(found))
        if len(self.places) > self.CACHED_WORDS:
            self._forget()
        new = list(set(words).difference(self.places))
        if new:
            self._learn(new)
        place = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        lengths = self.lengths[place]
        ends = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.starts[place] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.cumsum([0] + [len(f) for f in found])]
        return [
            ids[bounds[i] : bounds[i + 1]] if p else np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32)
            for i, (t, p) in enumerate(zip(texts, plain))
        ]


class Packer:
    """Fills sequences from a pool; ``place`` gets (document, start, length, sequence, offset)."""

    def __init__(self, limits: Limits, place: Callable[[int, int, int, int, int], None]) -> None:
        self.limits, self.place, self.sequence = limits, place, 0
        self.documents: list[int] = []
        self.start, self.left, self.loss = (np.zeros(0, np.int64) for _ in range(3))
        self.free: list[int] = []
        self._grow(limits.pool)

    def _grow(self, slots: int) -> None:
        more = slots - len(self.documents)
        self.free += range(len(self.documents), slots)[::-1]
        self.documents += [0] * more
        self.start, self.left, self.loss = (np.concatenate([x, np.zeros(more, np.int64)]) for x in (self.start, self.left, self.loss))

    def add(self, document: int, tokens: int, loss: int) -> None:
        """``loss``: how many of the last tokens bear loss."""
        while not self.free:
            if len(self.documents) < self.limits.segments and self.left.sum() < self.limits.tokens:
                self._grow(min(2 * len(self.documents), self.limits.segments))
            else:
                self._fill(self._room())
        slot = self.free.pop()
        self.documents[slot], self.start[slot], self.left[slot], self.loss[slot] = document, 0, tokens, loss

    def finish(self) -> None:
        while len(self.free) < len(self.documents):
            self._fill(self._room())

    def _room(self) -> int:
        """A whole sequence, or the largest power of two that the pool still fills."""
        left = int(self.left.sum())
        return self.limits.tokens if left >= self.limits.tokens or not self.limits.cut else 1 << (left.bit_length() - 1)

    def _take(self, slot: int, tokens: int, offset: int) -> int:
        """Places the next tokens of a slot; returns how many of them bear loss."""
        borne = max(0, int(self.loss[slot]) - int(self.left[slot] - tokens))
        self.place(self.documents[slot], int(self.start[slot]), tokens, self.sequence, offset)
        self.start[slot] += tokens
        self.left[slot] -= tokens
        self.loss[slot] -= borne
        if not self.left[slot]:
            self.free.append(slot)
        return borne

    def _fill(self, room: int) -> None:
        """Fills one sequence; tokens without loss come first in a document."""
        limits = self.limits
        tokens, segments, loss, offset = room, limits.segments, limits.loss, 0
        used = np.zeros(len(self.documents), bool)  # a document has at most one piece in a sequence
        while tokens and segments:
            gain = self.left * (tokens / limits.tokens**2) + segments / limits.segments**2 + self.loss * (loss / limits.loss**2)
            open_ = (self.left > 0) & ~used
            whole = open_ & (self.left <= tokens) & (self.loss <= loss)
            if whole.any():
                slot = int(np.where(whole, gain, -1.0).argmax())
                taken = int(self.left[slot])
            elif open_.any() and (limits.cut or not offset):
                slot = int(np.where(open_, gain, -1.0).argmax())
                quiet = int(self.left[slot] - self.loss[slot])
                taken = min(int(self.left[slot]), tokens, quiet + loss)
                if not taken:
                    break
            else:
                break
            used[slot] = True
            loss -= self._take(slot, taken, offset)
            tokens, segments, offset = tokens - taken, segments - 1, offset + taken
        self.sequence += 1


PIECES = [("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType())]


def _packed(vocabulary: str, end_id: int, limits: Limits, names: list[str]):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = WordEncoder(vocabulary)
        base = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}  # document: its id, its token ids, tokens not yet placed
        pieces: list[tuple] = []

        def place(document: int, start: int, length: int, sequence: int, offset: int) -> None:
            entry = held[document]
            ids = entry[1]
            pieces.append((entry[0], start, length, ids[start : start + length].tobytes(), len(ids), base + sequence, offset))
            entry[2] -= length
            if not entry[2]:
                del held[document]

        packer, seen = Packer(limits, place), 0

        def flushed() -> Iterator[pa.RecordBatch]:
            if pieces:
                columns = [pa.array([p[i] for p in pieces], kind) for i, kind in enumerate(kinds)]
                pieces.clear()
                yield pa.RecordBatch.from_arrays(columns, names=names)

        kinds = None
        for batch in batches:
            kinds = [batch.column(0).type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            at = 0
            while at < batch.num_rows:
                ids, texts, losses, size = [], [], [], 0
                while at < batch.num_rows and size < 2_000_000:
                    text = batch.column(1)[at].as_py() or ""
                    ids.append(batch.column(0)[at].as_py())
                    texts.append(text)
                    losses.append(batch.column(2)[at].as_py() if batch.num_columns > 2 else None)
                    size, at = size + len(text), at + 1
                for doc_id, tokens, loss in zip(ids, encoder.encode(texts), losses):
                    tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                    held[seen] = [doc_id, tokens, len(tokens)]
                    packer.add(seen, len(tokens), len(tokens) if loss is None else min(max(loss, 0), len(tokens)))
                    seen += 1
                yield from flushed()
        packer.finish()
        yield from flushed()

    return pack


def pack_documents(documents: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, limits: Limits = Limits(), loss: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    The column ``loss`` says how many of a document's last tokens, its end token among them, bear
    loss; without it, or where it is null, all do. ``vocabulary`` is a tokenizer file on every executor.
    """
    borne = [F.col(f"`{loss}`").cast("long").alias("loss")] if loss else []
    rows = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), *borne)
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)] + [T.StructField(n, t) for n, t in PIECES])
    return rows.mapInArrow(_packed(vocabulary, end_id, limits, schema.names), schema)
