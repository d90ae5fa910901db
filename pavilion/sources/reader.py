"""Table scans."""
from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from pavilion.functions import is_blank, whole_number
from pavilion.operators.groups import totals_by_column


#: What a table may fail with, when it is opened or when its rows are read or written.
FAILURES = (PySparkException, Py4JError, OSError)


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    corrupt_column: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Scan a Parquet or CSV table; any path the session's file systems know will do.

    A declared CSV schema binds by position and turns unreadable cells into null;
    ``corrupt_column`` then keeps the source line of such rows. Without a schema a
    CSV's types are inferred, which costs a pass over the data: declare one for
    anything large. Parquet carries its own schema. ``multi_line`` reads CSV values
    that hold line ends, one task per file.
    """
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", multi_line)
        if schema is None:
            reader = reader.option("inferSchema", True)
        elif corrupt_column:
            schema = StructType(schema.fields + [StructField(corrupt_column, StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def load_tables(
    spark: SparkSession,
    paths: Mapping[str, str],
    fmt: str = "parquet",
    schemas: Mapping[str, StructType] | None = None,
    fail_fast: bool = False,
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Open every table; returns the tables and, by name, why the others would not open.

    One bad table does not stop the others unless ``fail_fast`` is set. Only
    missing paths and unreadable formats show here; bad files and rows show when an action runs, which the
    jobs (``plans.jobs``) catch per table as well.
    """
    tables, errors = {}, {}
    for name, path in paths.items():
        try:
            tables[name] = read_table(spark, path, fmt, (schemas or {}).get(name))
        except FAILURES as problem:
            if fail_fast:
                raise
            errors[name] = str(problem)
    return tables, errors


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make every table visible to ``spark.sql`` under its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, as one DataFrame and so one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def as_text(schema: StructType) -> StructType:
    """The same columns, all as text: a CSV read with it loses no cell."""
    return StructType([StructField(f.name, StringType()) for f in schema])


#: How many of a row's cells ``typed`` could not read.
UNREADABLE = "__unreadable"


def _lost(c: str) -> Column:
    """Whether a cell of an int column holds something that is not read."""
    return whole_number(F.col(c)).isNull() & ~is_blank(F.col(c))


def typed(df: DataFrame, schema: StructType, count: bool = False) -> DataFrame:
    """A table read as text under its declared types: whole numbers are read, anything else in an int column is null.

    With ``count`` the column ``UNREADABLE`` says how many cells of a row held something else.
    """
    ints = [f.name for f in schema if isinstance(f.dataType, IntegerType)]
    columns = [(whole_number(F.col(f.name)) if f.name in ints else F.col(f.name)).alias(f.name) for f in schema]
    if count:
        columns.append(reduce(add, [_lost(c).cast("int") for c in ints], F.lit(0)).alias(UNREADABLE))
    return df.select(*columns)


def cast_losses(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Per int column of a CSV, how many cells ``typed`` cannot read."""
    raw = read_table(spark, path, "csv", as_text(schema))
    ints = [f.name for f in schema if isinstance(f.dataType, IntegerType)]
    return totals_by_column(raw.select(*[_lost(c).cast("int").alias(c) for c in ints]), ints, name="column", total="lost")
