from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from pavilion.sources import (
    SCHEMAS, cast_losses, load_tables, read_table, register_views, row_counts, schema_differences, write_table,
)
from pavilion.sources.schemas import TEAM
from tests.cricket import write_raw

AB = StructType([StructField("a", IntegerType()), StructField("b", StringType())])


def write(folder: Path, name: str, text: str) -> str:
    path = folder / name
    path.write_text(text)
    return str(path)


def test_declared_csv_binds_by_position_and_nulls_bad_cells(spark, tmp_path):
    path = write(tmp_path, "t.csv", "x,y\n1,p\n2.0,q\nTRUE,\n4\n5,r,extra\n")
    assert [tuple(r) for r in read_table(spark, path, "csv", AB).collect()] == [
        (1, "p"), (None, "q"), (None, None), (4, None), (5, "r")]
    kept = read_table(spark, path, "csv", AB, corrupt_column="line").cache()
    assert sorted(r.line for r in kept.filter("line is not null").collect()) == ["2.0,q", "4", "5,r,extra", "TRUE,"]
    kept.unpersist()
    assert [tuple(r) for r in cast_losses(spark, path, AB).collect()] == [("a", 1)]


def test_inferred_csv(spark, tmp_path):
    path = write(tmp_path, "t.csv", "n,d,u,f,e\n1,2013-04-22,4/22/2013,TRUE,\n2,2013-04-23,4/23/2013,false,\n")
    kinds = dict(read_table(spark, path, "csv").dtypes)
    assert kinds == {"n": "int", "d": "date", "u": "string", "f": "boolean", "e": "string"}


def test_one_bad_table_does_not_stop_the_others(spark, tmp_path):
    good, bad = write(tmp_path, "t.csv", "a,b\n1,x\n"), str(tmp_path / "none.csv")
    tables, errors = load_tables(spark, {"Bad": bad, "Good": good}, "csv", {"Bad": AB, "Good": AB})
    assert list(tables) == ["Good"] and "none.csv" in errors["Bad"]
    with pytest.raises(AnalysisException):
        load_tables(spark, {"Bad": bad, "Good": good}, "csv", fail_fast=True)
    register_views(tables)
    assert spark.sql("select count(*) from GOOD").first()[0] == 1
    assert [tuple(r) for r in row_counts(tables).collect()] == [("Good", 1)]


def test_parquet_over_a_csv_folder_is_reported(spark, tmp_path):
    path = write(tmp_path, "t.csv", "a,b\n1,x\n")
    tables, errors = load_tables(spark, {"T": path})
    assert not tables and "T" in errors


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_round_trip_replaces_what_was_there(spark, tmp_path, fmt):
    target = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "x"), (None, "y")], AB)
    write_table(df.union(df), target, fmt)
    write_table(df, target, fmt, compact=True)
    back = read_table(spark, target, fmt, AB)
    assert back.schema == AB and sorted(map(tuple, back.collect()), key=repr) == [(1, "x"), (None, "y")]
    assert len(list(Path(target).glob(f"part-*.{fmt}*"))) == 1


def test_partitioned_write(spark, tmp_path):
    target = str(tmp_path / "out")
    write_table(spark.range(100).selectExpr("id", "id % 3 as p"), target, partition_by=["p"])
    assert sorted(d.name for d in Path(target).glob("p=*")) == ["p=0", "p=1", "p=2"]
    assert read_table(spark, target).filter("p = 1").count() == 33


def test_schema_differences(spark):
    have = StructType([StructField("b", StringType()), StructField("a", StringType()), StructField("z", IntegerType())])
    got = {r.column: r.problem for r in schema_differences(spark, have, AB).collect()}
    assert got == {"a": "type", "b": "position", "z": "unexpected"}
    missing = schema_differences(spark, StructType([AB["b"]]), AB).filter("column = 'a'").first()
    assert missing.problem == "missing"
    assert schema_differences(spark, AB, AB).count() == 0


def test_the_declared_tables(spark, tmp_path):
    assert {name: len(schema) for name, schema in SCHEMAS.items()} == {
        "Ball_By_Ball": 48, "Match": 17, "Player": 7, "Player_Match": 22, "Team": 3}
    teams = read_table(spark, write_raw(tmp_path) + "/Team.csv", "csv", SCHEMAS[TEAM])
    assert teams.count() == 13 and teams.orderBy("team_id").first().team_name == "Kolkata Knight Riders"
