"""Column helpers that the operators of this folder share. All of them stay on the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# What separates words, as characters and as a character class of patterns.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: Column) -> Column:
    """The text; null is empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space and tab to carriage return, in order."""
    return F.filter(F.split(whole(text), SPACE_CLASS), lambda w: w != "")


def free_name(taken: list[str], name: str) -> str:
    """The name, lengthened until none of ``taken`` is like it."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts == part


def running_starts(lengths: Column) -> Column:
    """Exclusive running sums of an array of lengths: where each piece starts.

    Blocks of about the square root of the size keep the copying of grown arrays at n^1.5.
    """

    def within(block: Column) -> Column:
        empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts"))
        return F.aggregate(block, empty, lambda s, n: F.struct((s["at"] + n).alias("at"), F.array_append(s["starts"], s["at"]).alias("starts")))

    def joined(blocks: Column) -> Column:
        return let(
            within(F.transform(blocks, lambda b: b["at"]))["starts"],
            lambda bases: F.flatten(F.transform(blocks, lambda b, i: F.transform(b["starts"], lambda x: x + F.get(bases, i)))),
        )

    def blocks_of(a: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(a))).cast("int")
        return let(
            F.struct(a.alias("a"), width.alias("width")),
            lambda s: F.transform(F.sequence(F.lit(0), ((F.size(s["a"]) - 1) / s["width"]).cast("int")), lambda b: within(F.slice(s["a"], b * s["width"] + 1, s["width"]))),
        )

    return let(lengths, lambda a: F.when(F.size(a) == 0, F.array().cast("array<bigint>")).otherwise(let(blocks_of(a), joined)))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as structs (start, end, value); positions count code points.

    The gaps that the same pattern leaves when it splits the text give the positions. The
    pattern must not match the empty text.
    """

    def placed(parts: Column) -> Column:
        found, gaps = parts["found"], parts["gaps"]
        lengths = F.transform(found, lambda v, i: (F.length(F.get(gaps, i)) + F.when(i > 0, F.length(F.get(found, i - 1))).otherwise(0)).cast("long"))
        # running_starts is exclusive: the start of a match is the sum up to and with its own gap
        return let(
            F.struct(running_starts(lengths).alias("before"), lengths.alias("lengths")),
            lambda s: F.transform(
                found,
                lambda v, i: F.struct(
                    (F.get(s["before"], i) + F.get(s["lengths"], i)).alias("start"),
                    (F.get(s["before"], i) + F.get(s["lengths"], i) + F.length(v)).alias("end"),
                    v.alias("value"),
                ),
            ),
        )

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return let(both, placed)
