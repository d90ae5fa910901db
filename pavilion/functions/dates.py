"""Date parsing and date arithmetic."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# The accepted shapes, tried in order, each with its date pattern.
# A slash means month first, a dash means day first with two digits.
DEFAULT_DATE_FORMATS: tuple[tuple[str, str], ...] = (
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{2}-\d{2}-\d{4}$", "dd-MM-yyyy"),
)


def parse_date(c: Column, formats: Iterable[tuple[str, str]] = DEFAULT_DATE_FORMATS) -> Column:
    """Parse with the first format whose shape fits.

    A value of another shape, or of the right shape but no such day, gives null
    (``try_to_date``: a strict parse would end the job under ANSI mode).
    """
    chain = None
    for shape, pattern in formats:
        fits, day = c.rlike(shape), F.try_to_date(c, pattern)
        chain = F.when(fits, day) if chain is None else chain.when(fits, day)
    return F.lit(None).cast("date") if chain is None else chain


def date_parts(c: Column) -> dict[str, Column]:
    """Year, month and day of month."""
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}


def year_after_days_back(as_of: Column, days: Column) -> Column:
    """The year of the day that lies ``days`` days before ``as_of``."""
    return F.year(F.date_sub(as_of, days))
