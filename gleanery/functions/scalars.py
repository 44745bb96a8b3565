"""Defaults, money, text length and key helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space a JavaScript trim removes, as one class that Java and RE2 both read.
WHITESPACE = r"[\s\x{0B}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
WHITESPACE_CHARS = (
    " \t\n\x0b\f\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
# What a JavaScript dot matches.
NOT_NEWLINE = r"[^\n\r\x{2028}\x{2029}]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or(c: Column | str, default: Column | str) -> Column:
    """``c || default`` for strings: NULL and '' both take the default (a str default is a literal)."""
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(col(c), F.lit("")), fallback)


def number_or(c: Column | str, default: Column | int | float) -> Column:
    """``c || default`` for numbers: NULL and 0 both take the default."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(col(c), F.lit(0)), fallback)


def flag_or_false(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(False))


def cents_to_usd(cents: Column | str) -> Column:
    return col(cents) / F.lit(100.0)


def usd_to_cents(usd: Column | str) -> Column:
    return F.round(col(usd) * 100).cast("bigint")


def money_sum(usd: Column | str) -> Column:
    """Sum of dollar amounts through integer cents, so the result does not depend on row order."""
    return F.coalesce(F.sum(usd_to_cents(usd)), F.lit(0)) / F.lit(100.0)


def format_reward(cents: Column | str) -> Column:
    """Whole dollars from cents, halves away from zero."""
    return F.concat(F.lit("$"), F.round(cents_to_usd(cents)).cast("bigint").cast("string"))


def number_text(x: Column | str) -> Column:
    """Shortest plain decimal of a double: 150.0 -> '150', 1250.5 -> '1250.5'."""
    return F.regexp_replace(col(x).cast("decimal(30,10)").cast("string"), r"\.?0+$", "")


def format_usd(usd: Column | str) -> Column:
    return F.concat(F.lit("$"), number_text(usd))


def trim_text(x: Column | str) -> Column:
    return F.btrim(col(x), F.lit(WHITESPACE_CHARS))


def utf16_length(x: Column | str) -> Column:
    """String length in UTF-16 units."""
    return (F.octet_length(F.encode(col(x), "UTF-16BE")) / 2).cast("bigint")


def iso_millis(ts: Column | str) -> Column:
    """ISO-8601 text with milliseconds and a Z, for a timestamp read in a UTC session."""
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def elapsed_ms(start: Column | str, end: Column | str) -> Column:
    micros = lambda c: F.unix_micros(col(c).cast("timestamp"))
    return F.floor((micros(end) - micros(start)) / 1000).cast("bigint")


def capitalise(x: Column | str) -> Column:
    """Upper-case the first letter and keep the rest."""
    return F.concat(F.upper(F.substring(col(x), 1, 1)), F.substr(col(x), F.lit(2)))


def item_key(handle: Column | str, number: Column | str) -> Column:
    return F.concat(col(handle), F.lit("#"), col(number).cast("string"))


def issue_hash(owner: Column | str, repo: Column | str, number: Column | str) -> Column:
    return F.concat(col(owner), F.lit("/"), item_key(repo, number))


def fill_url(template: str, handle: Column | str) -> Column:
    """``template`` with ``{handle}`` replaced by the handle column."""
    head, tail = template.split("{handle}")
    return F.concat(F.lit(head), col(handle), F.lit(tail))


def url_or_template(url: Column | str, handle: Column | str, template: str) -> Column:
    return text_or(url, fill_url(template, handle))


def url_host(url: Column | str) -> Column:
    return F.nullif(F.regexp_extract(col(url), r"^https?://([^/]+)", 1), F.lit(""))


def url_handle(url: Column | str) -> Column:
    """First path segment of a URL: the handle in a listing address."""
    return F.nullif(F.regexp_extract(col(url), r"^https?://[^/]+/([^/?#]+)", 1), F.lit(""))


def split_handles(text: Column | str) -> Column:
    """Comma list to array: trimmed, empty parts dropped."""
    return F.filter(F.transform(F.split(col(text), ","), trim_text), lambda h: h != "")


def combine_text(*parts: Column | str) -> Column:
    return F.concat_ws("\n\n", *[col(p) for p in parts])
