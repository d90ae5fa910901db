"""Labels derived from values."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def map_codes(c: Column, names: Mapping[str, str]) -> Column:
    """Replace known codes by names; unknown codes and null pass through as text.

    One constant map, for lists of a few dozen codes: a CASE branch per code makes the
    generated method of a wide table too long to be compiled. For a longer list join a
    table of codes instead (``operators.lookup.lookup_codes``).
    """
    code = c.cast("string")
    if not names:
        return code
    pairs = F.create_map(*[F.lit(text) for pair in names.items() for text in pair])
    return F.coalesce(F.try_element_at(pairs, code), code)


def band(c: Column, floors: Sequence[tuple[float, str]], below: str) -> Column:
    """Label a number by the highest floor it reaches; ``below`` for the rest and for null."""
    chain = None
    for floor, label in sorted(floors, key=lambda f: f[0], reverse=True):
        reaches = c >= F.lit(floor)
        chain = F.when(reaches, label) if chain is None else chain.when(reaches, label)
    return F.lit(below) if chain is None else chain.otherwise(F.lit(below))


def contains_label(c: Column, part: str, found: str, missing: str) -> Column:
    """One label when ``part`` occurs in the text, another when not or when null."""
    return F.when(c.contains(part), F.lit(found)).otherwise(F.lit(missing))


def high_impact(total: Column, wicket: Column, above: int = 6, wicket_value: int = 0) -> Column:
    """True when the total is over the bound or the wicket flag has the given value.

    ``wicket_value=0`` marks balls without a wicket, as the published result does;
    ``1`` marks the wickets. A null on both sides gives false.
    """
    return F.when((total > above) | (wicket == wicket_value), F.lit(True)).otherwise(F.lit(False))
