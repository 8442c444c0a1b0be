"""Line-first cleaning: judge every line, remove the failing ones, reject what loses too much.

Only DataFrame functions run here. A line fails by one of three rules:

* punctuation: symbols or doubled marks come with a large share of its words, or it is a
  fragment of few words without a closing mark;
* navigation: separators between short items, as in menus and link lists;
* boilerplate: stock phrases of page furniture or of a licence are a large share of it.

A document is rejected if its statistics over the whole text fail (too few words, or too many
words in repeated windows), or if the failing lines hold more than ``max_lost`` of its
characters. Null and empty texts have no words and are rejected. Repeated rows are judged each
on its own. Columns other than the text pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .columns import SPACE_CLASS, SPACES, let, whole, words_of

# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›·•¦"
STOCK_PHRASES = (
    "all rights reserved", "terms of (use|service)", "privacy policy", "cookie", "enable javascript", "click here",
    "sign (in|up)", "log ?in", "subscribe", "read more", "share (this|on)", "skip to content", "lorem ipsum",
    "licensed under", "is licensed under", "released under the",
)


@dataclass(frozen=True)
class Rules:
    """Thresholds; shares are per word of the line unless said otherwise."""

    symbols: float = 0.5
    doubled_marks: float = 0.3
    separators: float = 0.2
    fragment_words: int = 4
    stock: float = 0.15  # of the line's characters, in stock phrases
    max_lost: float = 0.5  # of the characters of the lines
    min_words: int = 10
    max_repeated: int = 20  # per cent of the words
    window: int = 5


def characters_in(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def line_fails(line: Column, rules: Rules) -> Column:
    """Whether a line fails one of the three rules. Lines without a word never fail."""

    def judged(parts: Column) -> Column:
        trimmed, words = parts["trimmed"], parts["words"]
        doubled = (F.length(trimmed) - F.length(F.replace(F.replace(trimmed, F.lit("!!"), F.lit("")), F.lit("??"), F.lit("")))) / 2
        punctuation = (
            (characters_in(trimmed, SYMBOLS) >= rules.symbols * words)
            | (doubled >= rules.doubled_marks * words)
            | ((words < rules.fragment_words) & ~trimmed.rlike("[.!?:;…\"'”»)]$"))
        )
        bars = characters_in(trimmed, SEPARATORS)
        navigation = (bars >= 2) & (bars >= rules.separators * words)
        phrases = "(?i)\\b(" + "|".join(STOCK_PHRASES) + ")\\b"
        stock = F.length(trimmed) - F.length(F.regexp_replace(trimmed, phrases, ""))
        boilerplate = F.when(trimmed.rlike(phrases), stock >= rules.stock * F.length(trimmed)).otherwise(False)
        return (trimmed != "") & (punctuation | navigation | boilerplate)

    trimmed = F.trim(line, F.lit(SPACES))
    return let(F.struct(trimmed.alias("trimmed"), F.size(F.split(trimmed, SPACE_CLASS)).alias("words")), judged)


def clean_lines(text: Column, rules: Rules = Rules()) -> Column:
    """Struct of the text without failing lines, and the counts of characters before and removed."""
    judged = F.transform(F.split(whole(text), "\n", -1), lambda line: F.struct(line.alias("line"), line_fails(line, rules).alias("fails")))

    def total(lines: Column) -> Column:
        return F.aggregate(lines, F.lit(0).cast("long"), lambda n, x: n + F.length(x["line"]))

    def result(lines: Column) -> Column:
        return let(
            F.filter(lines, lambda x: ~x["fails"]),
            lambda good: F.struct(
                F.array_join(F.transform(good, lambda x: x["line"]), "\n").alias("text"),
                total(lines).alias("characters"),
                (total(lines) - total(good)).alias("lost"),
            ),
        )

    return let(judged, result)


def repeated_words(words: Column, window: int = 5) -> Column:
    """How many words lie in a window that occurs at least twice.

    Hashes of the windows tell texts without any repeat, which most are. Where two are equal,
    the windows themselves are sorted with their positions, equal neighbours give the starts of
    repeated windows, and the words they cover are counted: n log n for the longest text.
    """

    def starts_of(w: Column) -> Column:
        return F.sequence(F.lit(0), F.size(w) - window)

    def hashes(w: Column) -> Column:
        return F.transform(starts_of(w), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

    def exact(w: Column) -> Column:
        grams = F.transform(starts_of(w), lambda i: F.struct(F.array_join(F.slice(w, i + 1, window), " ").alias("gram"), i.alias("at")))

        def covered(s: Column) -> Column:
            twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["gram"].eqNullSafe(x["gram"])) | (F.get(s, i + 1)["gram"].eqNullSafe(x["gram"])))
            return let(
                F.sort_array(F.transform(twice, lambda x: x["at"])),
                lambda at: F.aggregate(
                    F.transform(at, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - p, F.lit(window)))),
                    F.lit(0).cast("long"),
                    lambda n, x: n + x,
                ),
            )

        return let(F.sort_array(grams), covered)

    def counted(w: Column) -> Column:
        repeats = let(hashes(w), lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(F.size(w) <= window, F.lit(0).cast("long")).when(repeats, exact(w)).otherwise(F.lit(0).cast("long"))

    return let(words, counted)


def text_statistics(text: Column, rules: Rules = Rules()) -> Column:
    """Counts over the whole text: words, their characters, symbols, repeated lines and windows."""
    value = whole(text)

    def lines(all_lines: Column) -> Column:
        return let(
            F.filter(all_lines, lambda line: F.translate(line, SPACES, "") != ""),
            lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        )

    def statistics(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(value, SPACES, "")).cast("long").alias("word_chars"),
            characters_in(value, SYMBOLS).cast("long").alias("n_symbols"),
            lines(F.split(value, "\n", -1)).alias("n_dup_lines"),
            repeated_words(words, rules.window).alias("n_repeat_words"),
        )

    return let(words_of(text), statistics)


def judge(documents: DataFrame, text: str = "text", rules: Rules = Rules(), name: str = "judged") -> DataFrame:
    """Adds a struct: statistics, ``base_failed``, the cleaned text and ``kept``.

    An input column of that name is replaced.
    """
    column = F.col(f"`{text}`")

    def verdict(parts: Column) -> Column:
        s, c = parts["s"], parts["c"]
        failed = (s["n_words"] < rules.min_words) | (100 * s["n_repeat_words"] > rules.max_repeated * s["n_words"])
        lost = c["lost"] > rules.max_lost * c["characters"]
        return F.struct(
            *[s[name].alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            failed.alias("base_failed"),
            c["text"].alias("text"),
            (~failed & ~lost).alias("kept"),
        )

    both = F.struct(text_statistics(column, rules).alias("s"), clean_lines(column, rules).alias("c"))
    return documents.withColumn(name, let(both, verdict))


def clean_documents(documents: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their failing lines removed; same columns."""
    names = documents.columns
    judged = judge(documents.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]), f"c{names.index(text)}", rules, "judged")
    # an array that is empty for rejected rows: a filter on the verdict would compute it twice, and
    # so would the one that Spark adds below a plain explode
    kept = judged.withColumn("passed", let(F.col("judged"), lambda j: F.when(j["kept"], F.array(j["text"])).otherwise(F.array().cast("array<string>"))))
    rows = kept.select(*[c for c in kept.columns if c not in ("judged", "passed")], F.explode_outer("passed").alias("cleaned"))
    return rows.where("cleaned is not null").select(*[F.col("cleaned" if c == text else f"c{i}").alias(c) for i, c in enumerate(names)])
