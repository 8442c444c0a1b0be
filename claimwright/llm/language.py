"""Hierarchical language identification by linear support vector machines.

Every whole text becomes a vector of hashed frequencies of its letter sequences of one to three
letters. A first machine, or one per family against the rest, predicts the family; within a
family, one machine per pair of languages votes, and margins break ties. The machines are fitted
by MLlib on about ``per_language`` distinct labelled texts per language, chosen by a hash; the
prediction runs where the documents are.

Families are fixed for the languages listed here; any other label is a family of its own. Null
texts and texts without a letter are ``und`` with score 0, as is everything if there is nothing
to learn from. Ids and other columns are never inputs; repeated rows get equal predictions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .components import written

UNKNOWN = "und"
PER_LANGUAGE = 1500
BUCKETS = 4096

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he"),
    "indo-aryan": ("hi", "ur", "bn", "mr"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


class LetterVectors:
    """Hashed frequencies of letter sequences; other characters separate and count as one space."""

    def __init__(self) -> None:
        self.letter = np.array([chr(i).isalpha() for i in range(0x10000)] + [True])

    def vector(self, text: str) -> np.ndarray | None:
        if not any(c.isalpha() for c in text):
            return None
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        codes = np.where(self.letter[np.minimum(codes, 0x10000)], codes, np.uint32(32))
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
        total = np.zeros(BUCKETS)
        key = np.zeros(len(codes), np.uint32)
        for n in range(1, min(3, len(codes)) + 1):
            key = key[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :]
            place = ((key + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(20)
            total += np.bincount(place, minlength=BUCKETS)
        total = np.sqrt(total / total.sum())
        return total / np.sqrt((total * total).sum())


@dataclass
class LanguageModel:
    families: dict[str, list[str]]
    family_machines: dict[str, tuple[np.ndarray, float]] = field(default_factory=dict)
    pair_machines: dict[tuple[str, str], tuple[np.ndarray, float]] = field(default_factory=dict)

    def predict(self, vector: np.ndarray) -> tuple[str, float]:
        names = sorted(self.families)
        if not names:
            return UNKNOWN, 0.0
        if len(names) == 1:
            family, sure = names[0], 1.0
        else:
            margins = {f: float(vector @ w + b) for f, (w, b) in self.family_machines.items()}
            if len(names) == 2:
                margins[names[1]] = -margins[names[0]]
            family = max(names, key=lambda f: margins[f])
            sure = _sigmoid(margins[family])
        languages = self.families[family]
        votes, sums = dict.fromkeys(languages, 0), dict.fromkeys(languages, 0.0)
        for pair in combinations(languages, 2):
            w, b = self.pair_machines[pair]
            margin = float(vector @ w + b)
            votes[pair[0] if margin >= 0 else pair[1]] += 1
            sums[pair[0]] += margin
            sums[pair[1]] -= margin
        best = max(languages, key=lambda code: (votes[code], sums[code]))
        if len(languages) > 1:
            sure *= _sigmoid(sums[best] / (len(languages) - 1))
        return best, sure


def _sigmoid(margin: float) -> float:
    return float(1 / (1 + np.exp(-3 * np.clip(margin, -20, 20))))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = LetterVectors()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found = [letters.vector(t.as_py() or "") for t in part["text"]]
            yield pa.RecordBatch.from_arrays([part["lang"], pa.array(found, pa.list_(pa.float64()))], names=["lang", "vector"])


def _grouped(codes: Iterable[str]) -> dict[str, list[str]]:
    """Languages by family."""
    families: dict[str, list[str]] = {}
    for code in sorted(codes):
        families.setdefault(FAMILY_OF.get(code, code), []).append(code)
    return families


def fit_languages(spark: SparkSession, labelled: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """A model from columns text and lang; rows without either are left out.

    Texts without a letter and repeats of a text in its language teach nothing and do not count. So
    a language is known if one of its texts has a letter, and about ``per_language`` distinct texts,
    or all if there are fewer, stand for it.
    """
    rows = labelled.where("text is not null and lang is not null").select("lang", "text").where(F.col("text").rlike("\\p{L}")).withColumn("hash", F.xxhash64("text"))
    distinct = rows.select("lang", "hash").distinct()
    counts = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return LanguageModel(_grouped(counts))
    shares = {code: int(min(1.0, per_language / n) * 1_000_000) for code, n in counts.items()}
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
    chosen = rows.where(F.pmod(F.xxhash64("hash"), F.lit(1_000_000)) < F.element_at(share, F.col("lang"))).dropDuplicates(["lang", "hash"]).select("lang", "text")
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("vector", T.ArrayType(T.DoubleType()))])
    sample = written(spark, chosen.mapInArrow(_vectors, schema).where("vector is not null"), "letters")
    families = _grouped([r["lang"] for r in sample.select("lang").distinct().collect()])
    model = LanguageModel(families)
    if sum(map(len, families.values())) < 2:
        return model
    sample = sample.select("lang", array_to_vector("vector").alias("features")).persist()
    machine = LinearSVC(maxIter=30, regParam=1e-4, standardization=False, aggregationDepth=2)

    def fitted(frame: DataFrame, positive: list[str]) -> tuple[np.ndarray, float]:
        with_label = frame.withColumn("label", F.col("lang").isin(positive).cast("double"))
        found = machine.fit(with_label)
        return found.coefficients.toArray(), float(found.intercept)

    names = sorted(families)
    for family in names[:1] if len(names) == 2 else names if len(names) > 2 else []:
        model.family_machines[family] = fitted(sample, families[family])
    for codes in families.values():
        for pair in combinations(codes, 2):
            model.pair_machines[pair] = fitted(sample.where(F.col("lang").isin(*pair)), [pair[0]])
    sample.unpersist()
    return model


def predict_languages(documents: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The documents with ``lang_pred`` and ``lang_score``; input columns of these names are replaced."""
    kept = [c for c in documents.columns if c not in ("lang_pred", "lang_score")]
    rows = documents.select(*[F.col(f"`{c}`") for c in kept])
    place = kept.index(text)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = LetterVectors()
        for batch in batches:
            languages, scores = [], []
            for value in batch.column(place):
                vector = letters.vector(value.as_py() or "")
                language, score = (UNKNOWN, 0.0) if vector is None else model.predict(vector)
                languages.append(language)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "lang_score"])

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])
    return rows.mapInArrow(predict, schema)
