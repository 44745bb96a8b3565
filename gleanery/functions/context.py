"""The lines around a reference, and what can be read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.grading import matching_terms
from gleanery.functions.markup import AMOUNT
from gleanery.functions.scalars import col, let, trim_text, utf16_length

# Technology terms looked for near a reference.
CONTEXT_TERMS = ("typescript", "javascript", "react", "nodejs", "python", "rust", "go", "java")


def context_lines(lines: Column, needle: Column, before: int = 5, after: int = 5) -> Column:
    """Lines around the first one holding the needle; NULL when no line does.

    ``after`` counts from the hit itself, so 5 and 5 give at most ten lines.
    """
    hits = F.transform(lines, lambda line: F.contains(line, needle))

    def around(hit: Column) -> Column:
        start = F.greatest(F.lit(1), hit - before)
        return F.when(hit > 0, F.slice(lines, start, hit + after - start))

    return let(F.array_position(hits, F.lit(True)).cast("int"), around)


def text_lines(text: Column | str) -> Column:
    return F.split(col(text), "\n")


def context_title(lines: Column) -> Column:
    """First line that looks like a heading, bold text or a link, between 10 and 100 characters."""
    marked = lambda l: F.startswith(l, F.lit("#")) | F.startswith(l, F.lit("[")) | F.startswith(l, F.lit("**"))
    # No text has fewer UTF-16 units than characters.
    fits = lambda l: marked(l) & (F.length(l) < 100) & (utf16_length(l) > 10) & (utf16_length(l) < 100)
    line = F.get(F.filter(lines, fits), F.lit(0))
    bare = F.regexp_replace(line, r"^[#\*\[]+\s*", "")
    return trim_text(F.regexp_replace(bare, r"\][^\n\r\x{2028}\x{2029}]*\z", ""))


def amount_cents(text: Column, legacy_commas: bool = False) -> Column:
    """First dollar amount in cents. ``legacy_commas`` drops only the first comma before reading the number."""
    amount = F.when(F.contains(text, F.lit("$")), F.nullif(F.regexp_extract(text, AMOUNT, 1), F.lit("")))
    if legacy_commas:
        once = F.regexp_replace(amount, r"^([^,]*),", "$1")
        number = F.regexp_extract(once, r"^\d+(\.\d+)?", 0)
    else:
        number = F.replace(amount, F.lit(","), F.lit(""))
    return F.round(number.try_cast("double") * 100).cast("bigint")


def joined_lines(lines: Column) -> Column:
    return F.array_join(lines, " ")


def context_cents(lines: Column, legacy_commas: bool = False) -> Column:
    return amount_cents(joined_lines(lines), legacy_commas)


def context_tech(lines: Column, terms: Sequence[str] = CONTEXT_TERMS) -> Column:
    return matching_terms(joined_lines(lines), terms)


def context_description(lines: Column, length: int = 200) -> Column:
    return F.substring(joined_lines(lines), 1, length)


def line_of(text: Column, needle: Column) -> Column:
    """Number, from 1, of the first line that holds the needle; NULL when no line does, as when it spans lines."""
    before = F.substr(text, F.lit(1), F.instr(text, needle) - 1)
    number = F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1
    return F.when(~F.contains(needle, F.lit("\n")) & (F.instr(text, needle) > 0), number)


def lines_around(lines: Column, hit: Column, before: int = 5, after: int = 5) -> Column:
    """Lines around the one of a number; ``after`` counts from it, so 5 and 5 give at most ten lines."""
    start = F.greatest(F.lit(1), hit - before)
    return F.slice(lines, start, hit + after - start)
