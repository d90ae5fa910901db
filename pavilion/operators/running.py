"""Running totals."""
from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DecimalType, IntegralType, MapType, StructType, TimestampNTZType, TimestampType, VariantType,
)

_AT, _STEP, _CARRIED, _HERE, _ABOVE = "__at", "__step", "__carried", "__here", "__above"


_PER_RANGE = 16  # sampled values for each range


def running_total(
    df: DataFrame, by: Sequence[str], order: str, value: str, name: str, block: int = 65_536, ranges: int = 1_024
) -> DataFrame:
    """Sum of ``value`` up to and including each ``order`` value of a group.

    Rows that share an order value share the total, as with the default frame of an
    ordered window. One row comes out per group and order value; a null order value comes first, NaN last.

    Rows are first summed per order value, which shrinks a large group before any
    shuffle. What then happens depends on the type of ``order``:

    * Whole numbers, dates, timestamps, booleans and decimals of up to 18 digits have a position, a long. Where positions span no more
      than ``block``, one window per group does the rest. Where they span more, they are cut into blocks of
      ``block`` consecutive positions, blocks into blocks of blocks, and so on until the top level has no more than
      ``block``: a long needs four levels at most. So no window holds more than ``block`` + 1 rows, however many rows or values a
      group has and however sparse they are. The span is read by a job of its own over the order column.
    * Other types with an order (doubles, strings, longer decimals, binary) are cut at values from a sample into up to ``ranges``
      ranges. A window holds one group's values of one range: about one in ``ranges`` of all pairs of group and value, and
      no more than twice that but by a rare chance, even if all belong to one group. The sample, of ``16 * ranges``
      pairs with the smallest hash, is read by a job of its own, and is the same if that runs again.

    Each level's window starts from one extra row that carries the total of all that is earlier, found one level up.
    """
    steps = (
        df.select(*by, F.col(order).alias(_AT), F.col(value).alias(_STEP))
        .groupBy(*by, _AT).agg(F.sum(_STEP).alias(_STEP))
    )
    kind = df.schema[order].dataType
    place = _position(kind)
    blocks = _blocks_of_positions(df, order, place, block) if place else _blocks_of_ranges(steps, kind, by, ranges)
    carries = None
    for level in range(len(blocks), -1, -1):
        top = level == len(blocks)
        here = F.col(_AT) if level == 0 else blocks[level - 1]
        above = F.lit(0).cast("long") if top else blocks[level]
        rows = steps.select(*by, above.alias(_ABOVE), here.alias(_HERE), _STEP)
        if level:
            rows = rows.groupBy(*by, _ABOVE, _HERE).agg(F.sum(_STEP).alias(_STEP))
        lines = rows.withColumn(_CARRIED, F.lit(False))
        if not top:
            # What precedes a block goes before its first row.
            first = carries.select(*by, F.col(_HERE).alias(_ABOVE), F.lit(None).cast(rows.schema[_HERE].dataType).alias(_HERE), _STEP, F.lit(True).alias(_CARRIED))
            lines = lines.unionByName(first)
        within = Window.partitionBy(*by, *([] if top else [_ABOVE])).orderBy(F.desc(_CARRIED), _HERE)
        if level == 0:
            totals = lines.withColumn(name, F.sum(_STEP).over(within)).filter(~F.col(_CARRIED))
            return totals.select(*by, F.col(_HERE).alias(order), name)
        earlier = F.sum(_STEP).over(within.rowsBetween(Window.unboundedPreceding, -1))
        carries = lines.withColumn(_STEP, earlier).filter(~F.col(_CARRIED) & F.col(_STEP).isNotNull())


def _position(kind: DataType) -> Callable[[str], Column] | None:
    """What turns the order values of a column into longs in the same order, or None where a long has no room for them."""
    if isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
        raise TypeError(f"running_total orders by a plain value, not {kind.simpleString()}")
    if isinstance(kind, DateType):
        return lambda name: F.unix_date(_named(name)).cast("long")
    if isinstance(kind, (IntegralType, BooleanType)):
        return lambda name: _named(name).cast("long")
    if isinstance(kind, TimestampType):
        return lambda name: F.unix_micros(_named(name))
    if isinstance(kind, TimestampNTZType):
        # Counted by the clock itself, so that no time zone folds two hours into one.
        return lambda name: F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', {_quoted(name)})")
    if isinstance(kind, DecimalType) and kind.precision <= 18:
        return lambda name: (_named(name) * F.lit(10**kind.scale).cast(f"decimal({kind.scale + 1},0)")).cast("long")
    return None


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _named(name: str) -> Column:
    return F.col(_quoted(name))


def _blocks_of_positions(df: DataFrame, order: str, place: Callable[[str], Column], block: int) -> list[Column]:
    """The number of an order value's block at each level, from blocks of ``block`` positions on."""
    radix = max(2, block)
    lowest, highest = df.select(place(order).alias("p")).agg(F.min("p"), F.max("p")).first()
    blocks, size, at = [], radix, place(_AT)
    while lowest is not None and highest // (size // radix) - lowest // (size // radix) >= radix:
        if size < 1 << 63:
            # Rounds down, and is exact for every long: dividing by / would go through a double.
            number = F.call_function("div", at, F.lit(size)) - F.when(F.try_mod(at, F.lit(size)) < 0, 1).otherwise(0)
        else:
            number = F.when(at < 0, -1).otherwise(0).cast("long")
        blocks.append(number)
        size *= radix
    return blocks


def _blocks_of_ranges(steps: DataFrame, kind: DataType, by: Sequence[str], ranges: int) -> list[Column]:
    """How many cuts, taken from a sample, an order value has reached; no level at all if the sample is the whole."""
    most = _PER_RANGE * ranges
    pairs = steps.select(*by, _AT).filter(F.col(_AT).isNotNull())
    sample = pairs.orderBy(F.xxhash64(*by, _AT), _AT).limit(most).select(_AT)
    values = [row[0] for row in sample.orderBy(_AT).collect()]
    cuts = list(dict.fromkeys(values[_PER_RANGE::_PER_RANGE])) if len(values) == most else []
    if not cuts:
        return []
    width = math.isqrt(len(cuts)) + 1
    lists = [F.array(*[F.lit(v).cast(kind) for v in cuts[i : i + width]]) for i in range(0, len(cuts), width)]

    def reached(some: Column) -> Column:
        return F.size(F.filter(some, lambda cut: cut <= F.col(_AT)))

    # First the lists whose first cut is reached, then the cuts of the last of these: two short searches instead of a long one.
    list_number = reached(F.array(*[some[0] for some in lists]))
    within = reached(F.element_at(F.array(*lists), F.greatest(list_number, F.lit(1))))
    return [(F.greatest(list_number - 1, F.lit(0)) * width + within).cast("long")]
