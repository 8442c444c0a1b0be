"""Byte-level BPE over whole texts by overlapping chunks, and its inverse.

A text of more than ``chunk`` characters is cut into chunks that overlap. Each chunk is
pre-tokenised on its own, in parallel; where a chunk and the next one have a pre-token boundary
in common within their overlap, they have resynchronised, since a match depends only on what
follows it. The texts are stitched there and the pieces between the stitches are encoded in
parallel. A text with an overlap without a common boundary (one very long run) is encoded as one
piece. Shorter texts are one piece from the start. Decoding concatenates the bytes of the ids.

Null and empty texts have no ids. Repeated rows give equal rows, as often as they came; a null
id is a value of its own.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

# White space as Unicode defines it, as the ranks' own pattern reads ``\s``.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

CHUNK = 32_768  # characters
OVERLAP = 1_024


def encoding(ranks: str, pattern: str):
    import tiktoken

    with open(ranks, "rb") as lines:
        pairs = [line.split() for line in lines]
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def boundaries(text: str, pattern: str, last: bool) -> np.ndarray:
    """Starts of the pre-tokens of a chunk; the last two may change with what follows, unless it ends the text."""
    import regex

    spaces = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]")
    starts = [m.start() for m in regex.finditer(spaces, text)]
    return np.array(starts if last else starts[:-2], np.int64)


def _chunk_boundaries(pattern: str):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for text, last in zip(batch["text"].to_pylist(), batch["last"].to_pylist()):
                at = boundaries(text, pattern, last)
                heads.append(at[at < OVERLAP])
                # white space before a stitch would lose sight of what follows it
                tails.append([i - CHUNK for i in at[at >= CHUNK].tolist() if not text[i - 1].isspace()])
            columns = [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "heads", "tails"])

    return find


def _encoded(ranks: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [np.array(coder.encode_ordinary(t.as_py() or ""), "<u4").tobytes() for t in part["text"]]
                kept = [part.column(i) for i, n in enumerate(part.schema.names) if n != "text"]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.binary())], names=[*[n for n in part.schema.names if n != "text"], "ids"])

    return encode


def _with_ids(rows: DataFrame, ranks: str, pattern: str) -> DataFrame:
    schema = T.StructType([f for f in rows.schema.fields if f.name != "text"] + [T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(_encoded(ranks, pattern), schema)


def stitched(chunks: Column) -> Column:
    """Start and end of each chunk's piece, relative to the chunk, from the sorted chunks of a text.

    Null where some overlap has no boundary in common.
    """
    count = F.size(chunks)
    meets = F.transform(
        F.slice(chunks, 1, count - 1),
        lambda c, i: F.array_min(F.array_intersect(c["tails"], F.get(chunks, i + 1)["heads"])),
    )

    def pieces(stitch: Column) -> Column:
        def piece(c: Column, i: Column) -> Column:
            start = F.when(i > 0, F.get(stitch, i - 1)).otherwise(F.lit(0))
            return F.struct(c["part"].alias("part"), start.alias("start"), F.when(i < count - 1, F.get(stitch, i) + CHUNK).alias("end"))

        return F.when(~F.exists(stitch, lambda x: x.isNull()), F.transform(chunks, piece))

    return F.element_at(F.transform(F.array(meets), pieces), 1)


def encode_texts(documents: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens and ids as little-endian unsigned 32-bit integers.

    ``ranks`` is a rank file on every executor.
    """
    rows = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    short = _with_ids(rows.where(F.length("text") <= CHUNK), ranks, pattern)

    # equal rows are handled once and repeated at the end; a digest stands for the text in the shuffles
    key = ["doc_id", "digest"]
    long = rows.where(F.length("text") > CHUNK).withColumn("digest", F.sha2("text", 256))
    texts = long.groupBy(*key).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    size = F.length("text")
    parts = texts.withColumn("part", F.explode(F.sequence(F.lit(0), F.ceil(size / CHUNK).cast("int") - 1)))
    chunks = parts.select(
        *key, "copies", "part", ((F.col("part") + 1) * CHUNK >= size).alias("last"), F.substring("text", F.col("part") * CHUNK + 1, F.lit(CHUNK + OVERLAP)).alias("text")
    ).repartition(*key, "part")
    found = chunks.mapInArrow(_chunk_boundaries(pattern), T.StructType([*chunks.schema.fields, *[T.StructField(n, T.ArrayType(T.LongType())) for n in ("heads", "tails")]]))
    ordered = found.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("part", "heads", "tails"))).alias("chunks"))
    plan = ordered.select(F.col("doc_id").alias("id"), F.col("digest").alias("of"), stitched(F.col("chunks")).alias("pieces"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of"))
    spans = plan.where("pieces is not null").select("id", "of", F.explode("pieces").alias("piece"))
    cut = F.substring("text", (F.col("piece.start") + 1).cast("int"), F.coalesce(F.col("piece.end") - F.col("piece.start"), F.lit(CHUNK + OVERLAP)).cast("int"))
    pieces = chunks.join(spans, same & (F.col("part") == F.col("piece.part"))).select(*key, "copies", "part", cut.alias("text"))
    unbroken = texts.join(plan.where("pieces is null"), same, "left_semi").select(*key, "copies", F.lit(0).alias("part"), "text")
    encoded = _with_ids(pieces.repartition(*key, "part").unionByName(unbroken), ranks, pattern)
    joined = encoded.groupBy(*key, "copies").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("pieces"))
    ids = F.aggregate("pieces", F.lit(b"").cast("binary"), lambda all_, p: F.concat(all_, p["ids"]))
    whole = joined.select("doc_id", "copies", ids.alias("ids")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    both = short.unionByName(whole.select("doc_id", "ids"))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def _decoded(ranks: str, pattern: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raw = [coder.decode_bytes(np.frombuffer(x.as_py(), "<u4").tolist()) for x in part["ids"]]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=[*part.schema.names, "decoded"])

    return decode


def decode_ids(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Adds ``decoded``: the bytes of ``ids``."""
    return encoded.mapInArrow(_decoded(ranks, pattern), T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))
