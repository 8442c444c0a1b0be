"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

* Folding removes disguises: accents, look-alike letters of other scripts, digits and signs that
  stand for letters, case, and everything between words.
* The lexicon holds words and word beginnings that labelled toxic documents use far more often
  than others. It is learnt over all labelled documents; copies, recognised by a digest of their
  whole shingle set, count once. Weights are smoothed log odds; only the model itself, at most
  ``max_terms`` terms and ``max_exceptions`` phrases, is gathered.
* Exception phrases are a lexicon word with one neighbour that labelled documents use harmlessly;
  further phrases may be given. A hit inside one does not count.
* One automaton finds all terms and phrases. The weights found are set against the length of the
  text, and a logistic regression over the labelled documents turns both into a score.

Null and empty texts have no hits and get the score of no hits. Ids and labels are not inputs of
a score; repeated rows score alike. Without labels of both kinds the lexicon is empty and the
score is the share of toxic labels, 0 if there are none.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .components import written
from .minhash import shingle_set, sieved

# Characters that stand for a letter. Letters and digits that share a look fold to
# one of them, in texts and lexicon alike.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "и": "u", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ł": "i", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e", "l": "i",
}
MARKS = {c: None for c in range(0x300, 0x370)} | {0xAD: None, 0x200B: None, 0x200C: None, 0x200D: None, 0x2060: None, 0xFEFF: None}
FOLDS = str.maketrans(LOOKALIKES) | MARKS
INNER_MARK = re.compile(r"(?<=\w)[!|](?=\w)")
BETWEEN = re.compile(r"[\W_]+")
BEGINNINGS = (4, 5, 6)


@dataclass(frozen=True)
class Learning:
    max_terms: int = 2000
    max_exceptions: int = 500
    least_share: float = 0.01  # of the toxic groups that use a term
    least_groups: int = 3
    least_odds: float = 20.0
    exception_groups: int = 5
    exception_share: float = 0.2  # at most, toxic groups among those with the phrase


def folded(text: str) -> str:
    """Words in folded letters, separated and surrounded by single spaces."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    text = text.lower()
    if "!" in text or "|" in text:
        text = INNER_MARK.sub("i", text)
    return f" {BETWEEN.sub(' ', text.translate(FOLDS)).strip()} "


class Lexicon:
    """``terms``: folded, with a leading space, and a closing one unless they are beginnings."""

    def __init__(self, terms: dict[str, float], exceptions: list[str]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term, weight in terms.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        if terms or exceptions:
            self.automaton.make_automaton()

    def hits(self, text: str) -> dict[int, float]:
        """Start of each hit word and its largest weight, without those inside an exception phrase."""
        found: dict[int, float] = {}
        covered: list[tuple[int, int]] = []
        if self.automaton.kind == 0 or not len(self.automaton):
            return found
        for end, (length, weight) in self.automaton.iter(text):
            start = end - length + 1
            if weight is None:
                covered.append((start, end))
            else:
                found[start] = max(found.get(start, 0.0), weight)
        if covered and found:
            inside = np.zeros(len(text) + 1, np.int64)
            for start, end in covered:
                inside[start] += 1
                inside[end] -= 1
            inside = np.cumsum(inside)
            found = {start: weight for start, weight in found.items() if not inside[start]}
        return found

    def measures(self, text: str) -> list[float]:
        """Weight found, and weight per word; both on logarithmic scales."""
        weight = sum(self.hits(text).values())
        return [float(np.log1p(weight)), float(np.log1p(100 * weight / max(1, text.count(" ") - 1)))]


@dataclass
class ToxicityModel:
    terms: dict[str, float]
    exceptions: list[str]
    coefficients: tuple[float, ...]
    intercept: float

    def score(self, measures: list[float]) -> float:
        margin = self.intercept + sum(c * x for c, x in zip(self.coefficients, measures))
        with np.errstate(over="ignore"):
            return float(1 / (1 + np.exp(-margin)))


def terms_of(text: str) -> set[str]:
    words = set(text.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in BEGINNINGS if len(w) > n}


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for text in batch["text"]:
            shingles = shingle_set((text.as_py() or "").encode())
            digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], pa.array(digests, pa.binary())], names=["doc_id", "toxic", "class"])


def _counted(extract):
    """Per task, how many documents of each kind have each term that ``extract`` finds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                counts = (Counter(), Counter())
                for text, toxic in zip(part["text"].to_pylist(), part["toxic"].to_pylist()):
                    counts[toxic].update(extract(folded(text or "")))
                terms = list(counts[0].keys() | counts[1].keys())
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *[pa.array([c[t] for t in terms], pa.int64()) for c in counts]], names=["term", "clean", "toxic"])

    return count


TERM_COUNTS = T.StructType([T.StructField("term", T.StringType()), T.StructField("clean", T.LongType()), T.StructField("toxic", T.LongType())])


def _phrases(terms: dict[str, float]):
    lexicon: list[Lexicon] = []

    def extract(text: str) -> set[str]:
        if not lexicon:
            lexicon.append(Lexicon(terms, []))
        found = set()
        for start in lexicon[0].hits(text):
            end = text.find(" ", start + 1)
            after = text.find(" ", end + 1)
            before = text.rfind(" ", 0, start)
            if after > 0:
                found.add(text[start : after + 1])
            if before >= 0:
                found.add(text[before : end + 1])
        return found

    return extract


def with_labels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents (doc_id, text) with their label from ``labels`` (doc_id, toxic); the larger label of an id counts.

    The labels pass a bitmap of fixed size, so the texts of other documents are not shuffled.
    """
    one = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = sieved(documents.select(F.col("doc_id").alias("id"), "text"), one.select(F.col("doc_id").alias("id")))
    return texts.join(one.hint("merge"), F.col("id") == F.col("doc_id")).select("doc_id", "text", "toxic")


def fit_toxicity(spark: SparkSession, labelled: DataFrame, learning: Learning = Learning(), exceptions: tuple[str, ...] = ()) -> ToxicityModel:
    """A model from columns doc_id, text and toxic. ``exceptions`` are further harmless phrases.

    Labels are 0 and 1; rows with any other value are not labelled.
    """
    rows = labelled.where("toxic in (0, 1)").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    rows = written(spark, rows, "labelled")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("toxic", T.IntegerType()), T.StructField("class", T.BinaryType())])
    classes = rows.mapInArrow(_classes, schema).where("class is not null")
    chosen = written(spark, classes.groupBy("toxic", "class").agg(F.min("doc_id").alias("id")).select("id", F.col("toxic").alias("kind")), "groups")
    sizes = {r["kind"]: r["n"] for r in chosen.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    terms: dict[str, float] = {}
    if clean and toxic:
        groups = rows.join(chosen.hint("merge"), (F.col("doc_id") == F.col("id")) & (F.col("toxic") == F.col("kind")), "left_semi")
        least = max(learning.least_groups, int(learning.least_share * toxic))
        odds = F.log(F.col("toxic") / toxic) - F.log((F.col("clean") + 0.5) / clean)
        counts = groups.select("text", "toxic").mapInArrow(_counted(terms_of), TERM_COUNTS).groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        best = counts.where(F.col("toxic") >= least).withColumn("odds", odds).where(F.col("odds") >= float(np.log(learning.least_odds)))
        terms = {r["term"]: r["odds"] for r in best.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "term").limit(learning.max_terms).collect()}
        phrases = groups.select("text", "toxic").mapInArrow(_counted(_phrases(terms)), TERM_COUNTS).groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
        harmless = phrases.where((F.col("clean") >= learning.exception_groups) & (share <= learning.exception_share))
        learnt = [r["term"] for r in harmless.orderBy(F.desc("clean"), "term").limit(learning.max_exceptions).collect()]
    else:
        learnt = []
    model = ToxicityModel(terms, learnt + [folded(p) for p in exceptions], (0.0, 0.0), float("-inf"))
    if not toxic:
        return model
    if not clean:
        model.intercept = float("inf")
        return model
    measured = measure(rows.select("toxic", "text"), model, "text").select(F.col("toxic").cast("double").alias("label"), array_to_vector("measures").alias("features"))
    fitted = LogisticRegression(maxIter=50, regParam=1e-3).fit(measured.persist())
    measured.unpersist()
    model.coefficients, model.intercept = tuple(float(x) for x in fitted.coefficients), float(fitted.intercept)
    return model


def measure(documents: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The documents without their text, with ``measures`` and ``score``."""
    kept = [c for c in documents.columns if c not in (text, "measures", "score")]
    rows = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("__text"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms, model.exceptions)
        for batch in batches:
            found = [lexicon.measures(folded(t.as_py() or "")) for t in batch["__text"]]
            scores = [model.score(m) for m in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.float64())), pa.array(scores, pa.float64())], names=[*kept, "measures", "score"])

    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("measures", T.ArrayType(T.DoubleType())), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(measured, schema)
