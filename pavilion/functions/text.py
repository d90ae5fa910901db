"""Text cleaning."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def is_blank(c: Column) -> Column:
    """True for null, empty and spaces-only values; never null itself."""
    return c.isNull() | (F.trim(c) == "")


def fill_blank(c: Column, placeholder: str = "BLANK") -> Column:
    """Replace blank values by a placeholder, leave the others untouched."""
    return F.when(F.trim(c) != "", c).otherwise(F.lit(placeholder))


def standardise(c: Column, keep: Iterable[str] = ()) -> Column:
    """Title-case a value, with runs of spaces collapsed and the ends trimmed.

    Title-casing also rewrites acronyms ("XI" becomes "Xi"); spellings listed in
    ``keep`` are restored exactly.
    """
    low = F.trim(F.lower(c))
    # Most values hold no run of spaces; a substring test is far cheaper than the regex.
    single = F.when(low.contains("  "), F.regexp_replace(low, "  +", " ")).otherwise(low)
    tidy = F.initcap(single)
    kept = list(keep)
    if not kept:
        return tidy
    return map_spellings(tidy, kept)


def map_spellings(c: Column, spellings: list[str]) -> Column:
    """Give a value the exact spelling listed for it, compared without case."""
    result = c
    for spelling in spellings:
        result = F.when(F.lower(c) == spelling.lower(), F.lit(spelling)).otherwise(result)
    return result


# Fixed value: what a normalised name leaves out, here in runs to save replacements.
_NOT_ALPHANUMERIC = "[^a-zA-Z0-9]+"


def normalise_name(c: Column) -> Column:
    """Strip everything but ASCII letters and digits, then lower-case."""
    return F.lower(F.regexp_replace(c, _NOT_ALPHANUMERIC, ""))
