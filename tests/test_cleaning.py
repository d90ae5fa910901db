import datetime
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pavilion.plans.cleaning import CleanSpec, blank_counts, clean, clean_audit, parse_dates
from pavilion.plans.specs import BALL_BY_BALL_PER_INNINGS, SPECS
from pavilion.sources import SCHEMAS, cleaned_schema
from pavilion.sources.schemas import BALL_BY_BALL

SPEC = CleanSpec("T", keys=("k",), strings=("s",), integers=("n", "absent"), dates=("d",), dedup_keys=("k",))
ROWS = [
    (1, " a   B ", None, " 4/22/2013"), (1, " a   B ", 5, " 4/22/2013"), (2, None, 7, "05-12-2013 "),
    (None, "x", 1, "4/22/2013"), (None, None, None, None), (3, "  ", 0, "05-12-2013"),
]


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(ROWS, "k int, s string, n int, d string")


def steps(audit):
    return {r.step: (r.rows, r.removed) for r in audit.collect()}


def test_clean(dirty):
    got = sorted(tuple(r) for r in clean(dirty, SPEC).collect())
    assert got == [
        (1, "A B", 0, "4/22/2013", None), (2, "Blank", 7, "05-12-2013", None),
        (3, "Blank", 0, "05-12-2013", datetime.date(2013, 12, 5)),
    ]


def test_trimming_first_makes_it_idempotent(dirty):
    spec = replace(SPEC, trim_before_parse=True)
    once = clean(dirty, spec)
    again = clean(once.drop("d_cleaned"), spec)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))
    assert once.filter("k = 1").first().d_cleaned == datetime.date(2013, 4, 22)


def test_parse_before_trim_is_not_idempotent(dirty):
    once = clean(dirty, SPEC)
    assert once.filter("k = 1").first().d_cleaned is None
    assert clean(once.drop("d_cleaned"), SPEC).filter("k = 1").first().d_cleaned == datetime.date(2013, 4, 22)


def test_only_the_last_date_is_trimmed(spark):
    df = spark.createDataFrame([(" 4/22/2013", " 4/22/2013")], "a string, b string")
    assert clean(df, CleanSpec("T", dates=("a", "b"))).select("a", "b").first() == (" 4/22/2013", "4/22/2013")


def test_audit_telescopes(dirty):
    got = steps(clean_audit(dirty, SPEC))
    assert got == {"initial": (6, 0), "null_drop": (6, 0), "key_filter": (4, 2), "string_clean": (4, 0),
                   "date_conversion": (4, 0), "dedup": (3, 1)}
    first = steps(clean_audit(dirty, replace(SPEC, null_drop_first=True)))
    assert first["null_drop"] == (5, 1) and first["key_filter"] == (4, 1)
    assert sum(removed for _, removed in got.values()) == 6 - clean(dirty, SPEC).count()
    assert steps(clean_audit(dirty, SPEC, cleaned=clean(dirty, SPEC))) == got
    assert steps(clean_audit(dirty, replace(SPEC, dedup_keys=())))["dedup"] == (4, 0)


def test_empty_rows_go_when_nothing_is_filled(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    spec = CleanSpec("T")
    assert clean(df, spec).count() == 1 and steps(clean_audit(df, spec))["null_drop"] == (1, 1)


def test_null_dedup_keys_are_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    spec = CleanSpec("T", keys=("a",), dedup_keys=("a", "b"))
    assert clean(df, spec).count() == 2 and steps(clean_audit(df, spec))["dedup"] == (2, 1)


def test_options(spark):
    df = spark.createDataFrame([("4", "TRUE", None), (None, "0", "kings  xi punjab")], "code string, flag string, s string")
    spec = CleanSpec("T", strings=("s",), booleans=("flag", "absent"), codes={"code": {"4": "Four"}},
                     placeholder="none", keep_spelling=("Kings XI Punjab",))
    assert sorted(map(tuple, clean(df, spec).collect()), key=repr) == [("Four", True, "None"), (None, False, "Kings XI Punjab")]


def test_missing_string_column_is_an_error(dirty):
    with pytest.raises(AnalysisException):
        clean(dirty, replace(SPEC, strings=("nowhere",)))


def test_dates_in_place(dirty):
    assert dict(parse_dates(dirty, ("d",), in_place=True).dtypes)["d"] == "date"


def test_blank_counts(dirty):
    assert sorted(map(tuple, blank_counts(dirty, ("s", "n")).collect())) == [("n", 2), ("s", 3)]


def test_wider_key_keeps_both_innings(spark):
    fields = SCHEMAS[BALL_BY_BALL]
    balls = spark.createDataFrame(
        [tuple({"match_id": 1, "over_id": 1, "ball_id": 1, "innings_no": i}.get(f.name) for f in fields) for i in (1, 2)], fields)
    assert clean(balls, SPECS[BALL_BY_BALL]).count() == 1
    assert clean(balls, BALL_BY_BALL_PER_INNINGS).count() == 2


@pytest.mark.parametrize("table", list(SPECS))
def test_cleaned_schemas(spark, table):
    empty = spark.createDataFrame([], SCHEMAS[table])
    got = clean(empty, SPECS[table]).schema
    want = cleaned_schema(SCHEMAS[table], SPECS[table].dates)
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in want]


def test_hot_key_leaves_one_row(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("x").alias("s"))
    spec = CleanSpec("T", keys=("k",), strings=("s",), dedup_keys=("k",))
    assert clean(df, spec).count() == 20_001
    assert steps(clean_audit(df, spec))["dedup"] == (20_001, 9_999)
