"""Bootstrapped contextual extraction of personal identifiers, in DataFrame functions only.

1. Every whole text is scanned once. Strict patterns give the seeds (mail and IP addresses,
   card and phone numbers); a looser pattern gives other identifier-shaped candidates. Each
   comes with its position and with the words before it.
2. The words before a seed or candidate are its lexical patterns. Patterns and instances form a
   bipartite graph with one edge per pattern and distinct value. Round by round, a pattern's
   confidence is the share of its values that are trusted for a kind, and a value's trust is the
   chance that at least one of its patterns is right. Values of no known kind whose shape suits
   the kind are what the method looks for, so they count against a pattern by ``doubt`` only.
3. A candidate whose shape suits a kind and whose trust for it passes ``min_trust``, carried by a
   pattern with enough different trusted values, is a found identifier of that kind.

Seeds are always kept. Positions are code points. Null and empty texts have no spans; equal rows
get equal spans; a null id is a value of its own. The graph holds only identifiers and the words
before them, is aggregated before each shuffle, and no join carries a text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimwright.session import scratch_path

from .columns import free_name, let, matches, whole

KINDS = ("email", "ip", "card", "phone")

# What each kind looks like. The guards in front only keep a long run of characters
# from being tried at each of its positions; they leave the matches as they are.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = "0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Identifier-shaped: an at sign (or its spelling, before which the local part stops) between others,
# or seven digits and more.
CANDIDATE = r"(?<![^\s@])(?:[^\s@]++@|(?:(?![\(\[]at[\)\]])[^\s@])++[\(\[]at[\)\]])[^\s@]++|[+(]*+[0-9](?:[\x20().:/-]{0,2}[0-9]){6,}+"


@dataclass(frozen=True)
class Bootstrap:
    rounds: int = 3
    min_trust: float = 0.8
    min_support: float = 3.0  # trusted different values of an accepted pattern
    doubt: float = 0.25  # weight against a pattern of its unknown values that suit the kind
    decay: float = 0.95  # of trust handed on by a pattern
    context: int = 80  # characters before an identifier that are looked at for its words


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(value: Column) -> Column:
    """The check digit rule on a text of digits: double every second digit from the right."""

    def total(d: Column) -> Column:
        def part(i: Column) -> Column:
            n = F.substring(d, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return n - F.when(n > 9, 9).otherwise(0)

        return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(d)), part), F.lit(0), lambda a, b: a + b) % 10 == 0

    return let(value, total)


def seeds(text: Column) -> dict[str, Column]:
    """Per kind, the strict matches that pass their check; failing ones are not tried again."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def found(pattern: str, possible: Column, valid) -> Column:
        return F.when(possible, F.filter(matches(text, pattern), lambda m: valid(m["value"]))).otherwise(none)

    def digits_between(value: Column, low: int, high: int) -> Column:
        return F.length(digits_of(value)).between(low, high)

    return {
        "email": found(EMAIL, F.contains(text, F.lit("@")), lambda v: F.lit(True)),
        "ip": found(IP, text.rlike(r"[0-9]\.[0-9]"), lambda v: v.rlike(f"^{IP_PART}(\\.{IP_PART}){{3}}$")),
        "card": found(CARD, text.rlike("[0-9](?:[\\x20-]?[0-9]){12}"), lambda v: F.when(digits_between(v, 13, 19), passes_luhn(digits_of(v))).otherwise(False)),
        "phone": found(PHONE, F.contains(text, F.lit("+")), lambda v: digits_between(v, 9, 15)),
    }


def suits(value: Column, kind: str) -> Column:
    """Whether a candidate's shape allows the kind."""
    digits = F.length(digits_of(value))
    mail = value.rlike(r"@|[\(\[]at[\)\]]")
    return {
        "email": mail,
        "ip": ~mail & value.rlike(r"^[0-9]+([.:][0-9]+){3,}$"),
        "card": ~mail & digits.between(12, 19) & ~F.contains(value, F.lit(".")),
        "phone": ~mail & digits.between(7, 15),
    }[kind]


def scanned(documents: DataFrame, doc_id: str, text: str, options: Bootstrap) -> DataFrame:
    """One row per document: id, hash of the text, ``base`` spans and all occurrences with the words before them."""
    value = whole(F.col(f"`{text}`"))
    kinds = seeds(F.col("text"))

    def labelled(spans: Column, kind: Column) -> Column:
        return F.transform(spans, lambda m: F.struct(kind.alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))

    base = F.concat(*[labelled(F.col(k), F.lit(k)) for k in KINDS])
    loose = F.when(F.contains(F.col("text"), F.lit("@")) | F.col("text").rlike(r"[0-9]|[\(\[]at[\)\]]"), matches(F.col("text"), CANDIDATE))
    other = F.filter(
        F.coalesce(loose, F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")),
        lambda m: ~F.exists(F.col("base"), lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])),
    )
    places = F.concat(F.col("base"), labelled(other, F.lit(None).cast("string")))

    def before(m: Column) -> Column:
        start = F.greatest(m["start"] - options.context, F.lit(0))
        return F.lower(F.substring(F.col("text"), (start + 1).cast("int"), (m["start"] - start).cast("int")))

    def occurrence(m: Column) -> Column:
        left = before(m)
        two = F.regexp_extract(left, r"(\S+)\s+(\S+)\s*$", 0)
        one = F.regexp_extract(left, r"(\S+)\s*$", 0)
        patterns = F.array_distinct(F.filter(F.array(F.trim(two), F.trim(one)), lambda p: p != ""))
        return F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), patterns.alias("patterns"))

    rows = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), value.alias("text"))
    rows = rows.select("doc_id", "text", *[kinds[k].alias(k) for k in KINDS])
    rows = rows.select("doc_id", "text", base.alias("base"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.transform("base", lambda b: b.dropFields("value")).alias("base"), F.transform(places, occurrence).alias("places"))


def trusted_values(places: DataFrame, options: Bootstrap) -> DataFrame:
    """Candidate values that the pattern-instance graph trusts: (value, kind)."""
    edges = (
        places.select("value", "kind", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "value")
        .agg(*[F.max((F.col("kind") == k).cast("double")).alias(f"seed_{k}") for k in KINDS])
        .select("pattern", "value", *[F.coalesce(F.col(f"seed_{k}"), F.lit(0.0)).alias(f"trust_{k}") for k in KINDS])
    )
    seed = reduce(Column.__or__, [F.col(f"trust_{k}") > 0 for k in KINDS])
    fits = [(~seed & suits(F.col("value"), k)).cast("double").alias(f"fits_{k}") for k in KINDS]
    edges = edges.select("*", *[F.col(f"trust_{k}").alias(f"seed_{k}") for k in KINDS], *fits)
    trust = edges

    def confidence(k: str) -> Column:
        unknown = F.greatest(F.col(f"fits_{k}") - F.col(f"support_{k}") + F.col(f"seeds_{k}"), F.lit(0.0))
        others = F.col("values") - F.col(f"fits_{k}") - F.col(f"seeds_{k}")
        return F.col(f"support_{k}") / (F.col(f"support_{k}") + others + options.doubt * unknown)
    for last in [False] * (options.rounds - 1) + [True]:
        sums = [F.sum(f"{was}_{k}").alias(f"{name}_{k}") for was, name in (("trust", "support"), ("seed", "seeds"), ("fits", "fits")) for k in KINDS]
        patterns = trust.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"), *sums)
        confident = patterns.select(
            "pattern",
            *[F.when(F.col(f"support_{k}") >= options.min_support, confidence(k)).otherwise(0.0).alias(f"sure_{k}") for k in KINDS],
        ).where(reduce(Column.__or__, [F.col(f"sure_{k}") >= options.min_trust for k in KINDS]))
        unseen = edges.where(~seed).select("pattern", "value")
        # the chance that none of a value's patterns is right, as a sum of logarithms
        scores = (
            unseen.join(confident, "pattern")
            .groupBy("value")
            .agg(*[(1 - F.exp(F.sum(F.log1p(-options.decay * F.col(f"sure_{k}"))))).alias(f"t_{k}") for k in KINDS])
            .select("value", *[F.when(suits(F.col("value"), k), F.col(f"t_{k}")).otherwise(0.0).alias(f"t_{k}") for k in KINDS])
        )
        if last:
            best = F.greatest(*[F.struct(F.col(f"t_{k}").alias("trust"), F.lit(-i).alias("order"), F.lit(k).alias("kind")) for i, k in enumerate(KINDS)])
            return scores.select("value", best.alias("best")).where(F.col("best.trust") >= options.min_trust * options.decay).select("value", F.col("best.kind").alias("kind"))
        known = [f"{name}_{k}" for name in ("seed", "fits") for k in KINDS]
        trust = edges.join(scores, "value", "left").select("pattern", "value", *known, *[F.greatest(F.col(f"trust_{k}"), F.coalesce(F.col(f"t_{k}"), F.lit(0.0))).alias(f"trust_{k}") for k in KINDS])
    raise ValueError("at least one round is needed")


def find_identifiers(spark: SparkSession, documents: DataFrame, doc_id: str = "doc_id", text: str = "text", options: Bootstrap = Bootstrap()) -> DataFrame:
    """One row per document: doc_id, text_hash, ``base`` and ``added`` spans (kind, start, end).

    Base spans are in the order of kinds, then by start; added ones are by kind and start.
    """
    path = scratch_path(spark, "identifiers")
    scanned(documents, doc_id, text, options).write.parquet(path)
    rows = spark.read.parquet(path)
    places = rows.select("doc_id", "text_hash", F.explode("places").alias("p")).select("doc_id", "text_hash", "p.*")
    found = places.where(F.col("kind").isNull()).drop("kind").join(trusted_values(places, options), "value")
    added = found.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).agg(F.array_sort(F.collect_set(F.struct("kind", "start", "end"))).alias("added"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    nothing = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return rows.join(added, same, "left").select("doc_id", "text_hash", "base", F.coalesce("added", nothing).alias("added"))


def spans_text(spans: Column) -> Column:
    """kind:start:end joined by commas, by kind as listed, then by start and end."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    keyed = F.transform(spans, lambda s: F.struct(F.element_at(order, s["kind"]).alias("o"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.sort_array(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(spark: SparkSession, documents: DataFrame, doc_id: str = "doc_id", text: str = "text", options: Bootstrap = Bootstrap()) -> DataFrame:
    """The documents with every found span replaced by its kind in brackets; same rows and columns.

    Overlapping spans become one, named by the first. Null texts stay null.
    """
    found = find_identifiers(spark, documents, doc_id, text, options).select("doc_id", "text_hash", F.concat("base", "added").alias("spans")).where(F.size("spans") > 0).distinct()
    of, hashed, spans = (free_name(documents.columns, name) for name in ("of", "hashed", "spans"))
    found = found.toDF(of, hashed, spans)
    value = whole(F.col(f"`{text}`"))
    merged = F.aggregate(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))),
        F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>"),
        lambda done, s: let(
            F.get(done, F.size(done) - 1),
            lambda last: F.when(
                F.coalesce(s["start"] < last["end"], F.lit(False)),
                F.array_append(F.slice(done, 1, F.size(done) - 1), F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))),
            ).otherwise(F.array_append(done, s)),
        ),
    )

    def rebuilt(spans: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            previous = F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))
            return F.concat(F.substring(value, (previous + 1).cast("int"), (s["start"] - previous).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]"))

        rest = F.substring(value, (F.element_at(spans, -1)["end"] + 1).cast("int"), F.length(value))
        return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

    joined = documents.join(found, F.col(f"`{doc_id}`").eqNullSafe(F.col(of)) & (F.xxhash64(value) == F.col(hashed)), "left")
    new = F.when(F.col(spans).isNull(), F.col(f"`{text}`")).otherwise(let(merged, rebuilt))
    return joined.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in documents.columns])
