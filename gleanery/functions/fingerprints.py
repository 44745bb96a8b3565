"""Page signatures for change checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.scalars import col, utf16_length

# What the signature counts, and the item-card marker.
SIGNATURE_PATTERNS = (r"(?i)bounty", r"\$\d+", r"(?i)open")
CARD_MARKER = r'data-testid="bounty-card"'
DOLLAR_DIGITS = r"\$\d+"


def fingerprint(
    html: Column | str,
    patterns: Sequence[str] = SIGNATURE_PATTERNS,
    ignore: Sequence[str] = (),
    mode: str = "counts",
) -> Column:
    """First 16 hex digits of a SHA-256.

    ``counts`` hashes pattern counts and the text length, so different pages may share a value;
    ``content`` hashes the text itself. ``ignore`` patterns are removed first in both modes.
    """
    text = col(html)
    for pattern in ignore:
        text = F.regexp_replace(text, pattern, "")
    if mode == "content":
        basis = text
    elif mode == "counts":
        counts = [F.regexp_count(text, F.lit(p)).cast("string") for p in patterns]
        basis = F.concat(F.concat_ws("-", *counts), utf16_length(text).cast("string"))
    else:
        raise ValueError(f"unknown fingerprint mode: {mode}")
    return F.substring(F.sha2(basis, 256), 1, 16)


def estimate_items(html: Column | str, marker: str = CARD_MARKER, fallback: str = DOLLAR_DIGITS) -> Column:
    """Card markers on the page, or dollar amounts when there are none. A rough estimate."""
    cards = F.regexp_count(col(html), F.lit(marker))
    return F.coalesce(F.nullif(cards, F.lit(0)), F.regexp_count(col(html), F.lit(fallback))).cast("bigint")
