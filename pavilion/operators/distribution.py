"""Histogram and density of one numeric column.

Both read the column twice, once for its bounds and once for the result. Only one row per bin
or grid point leaves a task. Bounds, bins and curves are those of the finite values; NaN and infinities are counted apart.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

_CELLS = 1 << 20  # kernels that a task works out at a time


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts over equal-width bins from the lowest to the highest value.

    Returns ``bin`` (1 to ``bins``), ``lo``, ``hi`` and ``count``, empty bins
    included. Nulls are left out; the highest value belongs to the last bin. When all
    values are equal the bins cover half a unit to either side. Bins span the finite values. Of the
    others there is one more row for each kind that occurs: bin 0 for minus infinity, ``bins`` + 1 for infinity and ``bins`` + 2 for NaN,
    whose ``lo`` and ``hi`` are that value. Without a finite value the bins have no bounds and count 0.
    """
    x = _values(df, column)
    finite = F.when(_finite("x"), F.col("x"))
    edges = _bounds(x, F.min(finite), F.max(finite)).select(
        F.when(F.col("hi") > F.col("lo"), F.col("lo")).otherwise(F.col("lo") - 0.5).alias("lo"),
        F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("hi") + 0.5).alias("hi"),
    )
    edge = edges.select(F.struct("lo", "hi")).scalar()
    lo, hi = edge["lo"], edge["hi"]
    place = F.least(F.floor((F.col("x") - lo) * bins / (hi - lo)) + 1, F.lit(bins)).cast("int")
    other = {0: float("-inf"), bins + 1: float("inf"), bins + 2: float("nan")}
    for number, value in other.items():
        place = F.when(F.col("x") == value, number).otherwise(place)
    counted = x.select(place.alias("bin")).groupBy("bin").count()
    # The frame of bins hangs off the same one-row aggregate.
    frame = edges.select(F.explode(F.sequence(F.lit(0), F.lit(bins + 2))).alias("bin"), "lo", "hi")
    width = (F.col("hi") - F.col("lo")) / bins
    bounds = F.col("lo") + width * (F.col("bin") - 1), F.col("lo") + width * F.col("bin")
    for number, value in other.items():
        bounds = [F.when(F.col("bin") == number, value).otherwise(b) for b in bounds]
    return frame.join(counted, "bin", "left").filter(f"bin between 1 and {bins} or count > 0").select(
        "bin", bounds[0].alias("lo"), bounds[1].alias("hi"), F.coalesce("count", F.lit(0).cast("long")).alias("count")
    )


def non_finite_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: how many values are ``nan``, ``infinite`` and ``minus_infinite``, none of which a curve can show."""
    x = _values(df, column)
    values = {"nan": "nan", "infinite": "inf", "minus_infinite": "-inf"}
    return x.agg(*[F.count_if(F.col("x") == float(value)).alias(name) for name, value in values.items()])


# exp(-z*z/2) is exactly 0 in double precision from here on.
_KERNEL_REACH = 38.61


def density(df: DataFrame, column: str, points: int = 200, count_scale_bins: int | None = None) -> DataFrame:
    """Gaussian kernel density on an even grid from the lowest to the highest value.

    Returns ``i`` (0 to ``points`` - 1), ``x`` and ``density``. The bandwidth is the
    sample standard deviation times n^(-1/5). ``count_scale_bins`` scales the curve to
    the height of a histogram with that many bins.

    The column is read twice: by a first job for its count, bounds and spread, and for the curve.
    There every task adds its values into one sum per grid point and hands on these
    ``points`` sums; no value is shuffled. A value is added only to the grid points within reach
    of its kernel; a point beyond would add exactly zero. No curve (no rows) comes out when
    there are fewer than two different values. Only finite values count; ``non_finite_counts`` has the others.
    """
    x = _values(df, column).filter(_finite("x"))
    lo, hi, sd, n = _bounds(x, F.min("x"), F.max("x"), F.stddev_samp("x"), F.count("x")).first()
    curve = "i int, x double, density double"
    if not n or not hi > lo:
        return df.sparkSession.createDataFrame([], curve)
    h, step = sd * float(n) ** -0.2, (hi - lo) / (points - 1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(points)
        reach = int(min(points, np.ceil(h * _KERNEL_REACH / step) + 1))
        near = np.arange(-reach, reach + 1)
        for batch in batches:
            values, copies = np.unique(batch.column("x").to_numpy(), return_counts=True)
            rows = max(1, _CELLS // len(near))
            for at in range(0, len(values), rows):
                value = values[at : at + rows, None]
                i = np.rint((value - lo) / step).astype(np.int64) + near
                z = (lo + (hi - lo) * i / (points - 1) - value) / h
                kernel = copies[at : at + rows, None] * np.exp(-0.5 * z * z)
                on = (i >= 0) & (i < points)
                sums += np.bincount(i[on], kernel[on], points)
        yield pa.record_batch({"i": pa.array(np.arange(points, dtype=np.int32)), "k": pa.array(sums)})

    area = n * h * math.sqrt(2 * math.pi)
    scale = 1.0 if count_scale_bins is None else n * (hi - lo) / count_scale_bins
    summed = x.mapInArrow(add, "i int, k double").groupBy("i").agg(F.sum("k").alias("k"))
    return summed.select(
        "i", (F.lit(lo) + F.lit(hi - lo) * F.col("i") / (points - 1)).alias("x"), (F.col("k") / area * scale).alias("density")
    )


def _values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull())


def _finite(name: str) -> Column:
    return ~F.isnan(name) & (F.abs(name) < float("inf"))


def _bounds(x: DataFrame, *stats: Column) -> DataFrame:
    return x.agg(*[stat.alias(name) for stat, name in zip(stats, ("lo", "hi", "sd", "n"))])
