"""Configurable cleaning of one table, its audit, and the run over all tables."""
from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pavilion.functions import (
    DEFAULT_DATE_FORMATS, fill_blank, is_blank, is_true, map_codes, normalise_name, parse_date,
    standardise, whole_or_zero,
)
from pavilion.operators import drop_empty_rows, keep_one, require_keys, totals_by_column
from pavilion.sources import FAILURES, UNREADABLE, read_table, replaced, typed, write_table


@dataclass(frozen=True)
class CleanSpec:
    """What to clean in a table. Only ``strings``, ``dates`` and keys must be present in it."""

    table: str
    keys: tuple[str, ...] = ()
    strings: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    booleans: tuple[str, ...] = ()
    dedup_keys: tuple[str, ...] = ()
    dedup_order: tuple[str, ...] = ()
    codes: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    placeholder: str = "BLANK"
    keep_spelling: tuple[str, ...] = ()
    date_formats: tuple[tuple[str, str], ...] = DEFAULT_DATE_FORMATS
    # Off: empty rows are looked for after blanks are filled, and dates are parsed
    # before their text is trimmed. On, cleaning twice equals cleaning once.
    null_drop_first: bool = False
    trim_before_parse: bool = False


def map_code_columns(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Replace codes by names in the columns the spec lists."""
    return df.withColumns({c: map_codes(F.col(c), names) for c, names in spec.codes.items()})


def fill_integers(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Null, blank and unreadable integers become 0; columns not in the table are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: whole_or_zero(F.col(c), df.schema[c].dataType) for c in present})


def fill_strings(df: DataFrame, columns: tuple[str, ...], placeholder: str = "BLANK") -> DataFrame:
    """Null and blank strings become the placeholder."""
    return df.withColumns({c: fill_blank(F.col(c), placeholder) for c in columns})


def flag_booleans(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """true/1 becomes true, all else false; columns not in the table are skipped."""
    return df.withColumns({c: is_true(F.col(c)) for c in columns if c in df.columns})


def standardise_strings(df: DataFrame, columns: tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
    """Lower, trim, collapse spaces, title-case.

    The value to standardise goes in as the input of a lambda, which is computed once and whose body stays out
    of the generated code. Otherwise the steps before, which are collapsed into the same expression, would be
    repeated wherever it is named, and over many columns the method would be too long for the JVM to compile.
    """
    return df.withColumns({c: F.transform(F.array(c), lambda x: standardise(x, keep))[0] for c in columns})


def parse_dates(
    df: DataFrame,
    columns: tuple[str, ...],
    formats: tuple[tuple[str, str], ...] = DEFAULT_DATE_FORMATS,
    in_place: bool = False,
) -> DataFrame:
    """Parse date strings into ``<column>_cleaned``, or into the column itself."""
    return df.withColumns({c if in_place else f"{c}_cleaned": parse_date(F.col(c), formats) for c in columns})


def normalise_columns(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Strip non-alphanumerics and lower-case."""
    return df.withColumns({c: normalise_name(F.col(c)) for c in columns})


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """The whole cleaner, lazily: everything up to the duplicate removal is one narrow pass."""
    # Once a column is filled no row is empty, so the search for empty rows is left out.
    search = spec.null_drop_first or not _fills(df, spec)
    kept = drop_empty_rows(df) if search else df
    finished = _finished(require_keys(_filled(kept, spec), spec.keys), spec)
    if not spec.dedup_keys:
        return finished
    return keep_one(finished, spec.dedup_keys, spec.dedup_order)


def clean_audit(df: DataFrame, spec: CleanSpec, cleaned: DataFrame | None = None) -> DataFrame:
    """Rows left and removed after each step, from one pass over the raw table.

    The rows left by the duplicate removal are counted in ``cleaned`` when the written
    table is given (Parquet answers that from its footers); otherwise the distinct
    keys are counted, which shuffles them. Where ``df`` says how many cells of a row could not be
    read (``sources.typed``), a last line ``unreadable`` has the rows with such cells; none is removed for it.
    """
    search = spec.null_drop_first or not _fills(df, spec)
    columns = [c for c in df.columns if c != UNREADABLE]
    rows = _filled(df.withColumn("__seen", _any_present(columns) if search else F.lit(True)), spec)
    keyed = reduce(and_, [F.col(k).isNotNull() for k in spec.keys], F.lit(True))
    marked = _finished(rows.withColumn("__keyed", F.col("__seen") & keyed), spec)

    counts = {
        "initial": F.count(F.lit(1)),
        "null_drop": F.count_if("__seen"),
        "key_filter": F.count_if("__keyed"),
    }
    counts["string_clean"] = counts["date_conversion"] = counts["key_filter"]
    if not spec.dedup_keys:
        counts["dedup"] = counts["key_filter"]
    elif cleaned is None:
        counts["dedup"] = F.count_distinct(F.when(F.col("__keyed"), F.struct(*spec.dedup_keys)))
    if UNREADABLE in df.columns:
        counts["unreadable"] = F.count_if(F.col(UNREADABLE) > 0)
    totals = marked.agg(*[c.alias(step) for step, c in counts.items()])
    if "dedup" not in counts:
        left = cleaned.agg(F.count(F.lit(1)).alias("n")).scalar()
        totals = totals.withColumn("dedup", left)

    steps = ["initial", "null_drop", "key_filter", "string_clean", "date_conversion", "dedup"]
    pairs = [
        F.struct(F.lit(step).alias("step"), F.col(step).alias("rows"), (F.col(before) - F.col(step)).alias("removed"))
        for step, before in zip(steps, ["initial"] + steps)
    ]
    if "unreadable" in counts:
        pairs.append(F.struct(F.lit("unreadable").alias("step"), F.col("unreadable").alias("rows"), F.lit(0).cast("long").alias("removed")))
    return totals.select(F.lit(spec.table).alias("table"), F.inline(F.array(*pairs)))


def blank_counts(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """How many values of each column are null or blank, from one pass."""
    flags = df.select([is_blank(F.col(c).cast("string")).cast("int").alias(c) for c in columns])
    return totals_by_column(flags, columns, name="column", total="blanks")


def run_cleaning(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    specs: Mapping[str, CleanSpec],
    target: str,
    fmt: str = "parquet",
    schemas: Mapping[str, StructType] | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """Clean every table into ``<target>/<table>``; returns the audits of all, and by name why the other tables failed.

    A table is written beside its place and swapped in once it is complete and audited, so one that fails, at whatever row,
    neither stops the others nor touches what stood there. The audit of a table, seven rows at most, is
    read at once. With ``schemas`` the tables hold text, are read under these types, and what could not be
    read is in the audit. A raw table is scanned twice, to write and to audit, and must not change in between. Counting
    while writing (``DataFrame.observe``) would save a scan but not be right when executors are lost: the steps
    before the duplicate removal run in map tasks, and Spark adds up the counts of every map task that
    ends, those that run again for lost shuffle files included. Behind the shuffle, where it counts once, the rows
    that the steps drop are gone, and to send them along would cost more than the audit's scan.
    """
    audits, errors = [spark.createDataFrame([], _AUDIT)], {}
    for name, spec in specs.items():
        raw = tables[name]
        try:
            with replaced(spark, f"{target}/{name}") as path:
                cleaned = clean(typed(raw, schemas[name]) if schemas else raw, spec)
                write_table(cleaned, path, fmt)
                written = read_table(spark, path, fmt, cleaned.schema, multi_line=fmt == "csv")
                audit = clean_audit(typed(raw, schemas[name], count=True) if schemas else raw, spec, written).collect()
        except FAILURES as problem:
            errors[name] = str(problem)
        else:
            audits.append(spark.createDataFrame(audit, _AUDIT))
    return reduce(DataFrame.unionByName, audits), errors


_AUDIT = "table string, step string, rows long, removed long"


def _any_present(columns: list[str]) -> Column:
    return reduce(or_, [F.col(c).isNotNull() for c in columns])


def _fills(df: DataFrame, spec: CleanSpec) -> bool:
    return bool(spec.strings) or not set(df.columns).isdisjoint(spec.integers + spec.booleans)


def _filled(df: DataFrame, spec: CleanSpec) -> DataFrame:
    numbered = fill_integers(map_code_columns(df, spec), spec.integers)
    return fill_strings(flag_booleans(numbered, spec.booleans), spec.strings, spec.placeholder)


def _finished(df: DataFrame, spec: CleanSpec) -> DataFrame:
    tidy = standardise_strings(df, spec.strings, spec.keep_spelling)
    if spec.trim_before_parse:
        tidy = tidy.withColumns({c: F.trim(F.col(c).cast("string")) for c in spec.dates})
        return parse_dates(tidy, spec.dates, spec.date_formats)
    dated = parse_dates(tidy, spec.dates, spec.date_formats)
    # Only the text of the last date column is trimmed in this order of steps.
    return dated.withColumns({c: F.trim(F.col(c).cast("string")) for c in spec.dates[-1:]})
