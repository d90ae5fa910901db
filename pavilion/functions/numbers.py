"""Integer and flag cleaning."""
from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, IntegerType, StringType


def whole_number(c: Column) -> Column:
    """The int that a text stands for, spaces around it aside; null for any other text.

    ``2.0`` and ``1e3`` are whole numbers too; ``2.5``, ``2.0000000001``, ``1e-10`` and what no int can hold are not. A number
    with an exponent may have up to 27 digits before it: so many a decimal holds without rounding, unless it is too small, which
    shows as a zero that is not written as one.
    """
    text = F.trim(c)
    # Most texts are plain. The rest goes through a lambda, whose body stays out of the generated code, which would be too long over many
    # columns. A failed cast costs far more than the tests that spare it.
    rest = F.transform(F.array(text), _whole_decimal)[0]
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int")).when(text.rlike("[.eE]"), rest)


def _whole_decimal(text: Column) -> Column:
    point = F.regexp_replace(F.regexp_extract(text, "^([+-]?[0-9]*)[.]0*$", 1), "^[+-]?$", "0")
    number = text.try_cast("decimal(38,27)")
    exact = text.rlike("^[+-]?([0-9][.]?){1,27}[eE]|^[+-]?[.][0-9]{1,27}[eE]") & (number == F.floor(number))
    exact = exact & ((number != 0) | text.rlike("^[+-]?[0.]+[eE]"))
    return F.when(text.rlike("^[+-]?([0-9]+[.]0*|[.]0+)$"), point.try_cast("int")).when(
        text.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)[eE][+-]?[0-9]+$") & exact, number.try_cast("int")
    )


def whole_or_zero(c: Column, dtype: DataType) -> Column:
    """An int, with null, blank and unreadable values as 0.

    ``dtype`` is the type of ``c``: an int column needs no parsing, so it stays a
    plain ``coalesce`` that the optimizer can see through.
    """
    if isinstance(dtype, IntegerType):
        return F.coalesce(c, F.lit(0))
    if isinstance(dtype, StringType):
        return F.coalesce(whole_number(c), F.lit(0))
    return F.coalesce(c.try_cast("int"), F.lit(0))


def is_true(c: Column) -> Column:
    """True for ``true`` and ``1`` in any type or case, false for all else, null included."""
    return F.coalesce(F.lower(c.cast("string")).isin("true", "1"), F.lit(False))
