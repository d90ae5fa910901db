"""The given tables read as the five tables of the star schema.

Every table is a projection of one given table, over all its rows, by way of a few helper
columns. The expressions are written once, in SQL that Spark and DuckDB read alike, and
hold the kinds of dirt the cleaning is for: blanks, null keys, duplicate keys, several date shapes, codes without a
name, keys that the other table does not hold.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from pavilion.sources import SCHEMAS
from pavilion.sources.schemas import BALL_BY_BALL, MATCH, PLAYER, PLAYER_MATCH, TEAM


def _month_first(day: str) -> str:
    return f"cast(month({day}) as string) || '/' || cast(day({day}) as string) || '/' || cast(year({day}) as string)"


def _day_first(day: str) -> str:
    return (
        f"lpad(cast(day({day}) as string), 2, '0') || '-' || lpad(cast(month({day}) as string), 2, '0')"
        f" || '-' || cast(year({day}) as string)"
    )


def _flag(condition: str) -> str:
    return f"case when {condition} then 1 else 0 end"


# Given table: helper columns that the projections below share.
HELPERS: dict[str, dict[str, str]] = {
    "lineitem": {
        "discount": "cast(round(l_discount * 100) as int)",
        "tax": "cast(round(l_tax * 100) as int)",
        "runs": "cast(l_quantity as int)",
        "flag_a": "case l_returnflag when 'A' then 1 else 0 end",
        "mdy": _month_first("l_shipdate"),
        "dmy": _day_first("l_shipdate"),
    },
    "orders": {
        "placed_year": "cast(year(o_orderdate) as int)",
        "placed_month": "cast(month(o_orderdate) as int)",
        "placed_day": "cast(day(o_orderdate) as int)",
        "mdy": _month_first("o_orderdate"),
        "dmy": _day_first("o_orderdate"),
    },
    "supplier": {},
    "events": {"mdy": _month_first("ts"), "dmy": _day_first("ts")},
    "nation": {},
}

# Table: (given table, {column: expression}); a column left out is null throughout.
STAR: dict[str, tuple[str, dict[str, str]]] = {
    BALL_BY_BALL: ("lineitem", {
        "match_id": "cast(l_orderkey as int)",
        "over_id": "l_linenumber",
        "ball_id": "case when runs = 50 then null else tax end",
        "innings_no": "case l_linestatus when 'F' then 1 else 2 end",
        "team_batting": "cast(discount + l_linenumber as string)",
        "team_bowling": "case tax when 0 then null when 1 then '  ' when 2 then ' 3' else cast(tax as string) end",
        "striker_batting_position": "nullif(l_linenumber, 3)",
        "extra_type": "case l_returnflag when 'R' then '   ' when 'A' then '  WIDE   ball ' else 'no-BALL' end",
        "runs_scored": "nullif(runs, 13)",
        "extra_runs": "nullif(discount, 9)",
        "wides": _flag("l_returnflag = 'R'"),
        "legbyes": "tax",
        "byes": "nullif(discount, 0)",
        "noballs": _flag("tax = 8"),
        "penalty": "case discount when 10 then 5 else 0 end",
        "bowler_extras": "nullif(tax, 4)",
        "out_type": "case l_returnflag when 'R' then null when 'A' then 'CAUGHT and  bowled' else 'run-out' end",
        "caught": "flag_a",
        "bowled": _flag("l_returnflag = 'N' and l_linestatus = 'F'"),
        "run_out": "case when tax = 2 then null when discount = 3 then 1 else 0 end",
        "lbw": _flag("discount = 4"),
        "retired_hurt": _flag("runs = 1"),
        "stumped": _flag("runs = 2"),
        "caught_and_bowled": _flag("runs > 40"),
        "hit_wicket": "cast(0 as int)",
        "bowler_wicket": "case when discount = 10 then null when l_linestatus = 'F' then 0 else 1 end",
        "match_date": (
            "case l_linenumber when 1 then mdy when 2 then dmy when 3 then cast(cast(l_shipdate as date) as string)"
            " when 4 then '31-02-2013' when 5 then null when 6 then ' ' else ' ' || mdy || ' ' end"
        ),
        "season": "cast(year(l_shipdate) as int)",
        "striker": "cast(l_suppkey as int)",
        "non_striker": "cast(l_partkey as int)",
        "bowler": "case when tax = 0 then null else cast(l_suppkey as int) end",
        "player_out": "case flag_a when 1 then cast(l_suppkey as int) end",
        "fielders": "case flag_a when 1 then cast(l_partkey as int) end",
        "striker_match_sk": "cast(l_partkey as int)",
        "strikersk": "cast(l_suppkey as int)",
        "bowler_sk": "cast(floor(l_extendedprice) as int)",
        "keeper_catch": _flag("flag_a = 1 and l_linestatus = 'O'"),
        "matchdatesk": _flag("l_linestatus = 'O'"),
    }),
    MATCH: ("orders", {
        "match_sk": "cast(o_orderkey as int)",
        "match_id": "case when o_totalprice > 495000 then -1 - cast(o_orderkey as int) else cast(o_orderkey as int) end",
        "team1": "' team   ' || cast(placed_month as string)",
        "team2": "case o_orderstatus when 'P' then null else 'TEAM ' || cast(placed_day as string) end",
        "match_date": (
            "case o_orderstatus when 'P' then mdy when 'O' then dmy else ' ' || mdy end"
        ),
        "season_year": "case when o_orderstatus = 'P' and placed_month = 12 then null else placed_year end",
        "venue_name": "o_orderpriority || ' ' || o_orderstatus",
        "city_name": "case when placed_day = 1 then null else 'City ' || cast(placed_month as string) end",
        "country_name": "o_orderstatus",
        "toss_winner": "case o_orderstatus when 'F' then '  ' else o_orderpriority end",
        "match_winner": "case when placed_day = 31 then null else 'Team ' || cast(placed_month as string) end",
        "toss_name": "case o_orderstatus when 'F' then 'bat' when 'O' then 'field' end",
        "win_type": "lower(o_orderpriority)",
        "outcome_type": "case o_orderpriority when '5-LOW' then 'No  Result' else o_orderpriority end",
        "manofmach": "cast(o_custkey as string)",
        "win_margin": "case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then null else cast(floor(o_totalprice / 4000) as int) end",
        "country_id": "cast(o_custkey as int)",
    }),
    PLAYER: ("supplier", {
        "player_sk": "cast(s_suppkey as int)",
        "player_id": "case when s_acctbal < 0 then -1 - cast(s_suppkey as int) else cast(s_suppkey as int) end",
        "player_name": "' ' || s_name || '-O''Neil  jr'",
        "dob": "case when s_nationkey < 12 then '4/22/1985' else '05-12-1990' end",
        "batting_hand": "case when s_nationkey < 10 then 'Left-hand bat' when s_nationkey < 20 then 'Right-hand bat' end",
        "bowling_skill": "case when s_acctbal > 7000 then null when s_acctbal > 4000 then 'Legbreak googly' else 'Right-arm MEDIUM' end",
        "country_name": "'Country ' || cast(s_nationkey as string)",
    }),
    PLAYER_MATCH: ("events", {
        "player_match_sk": "cast(event_id as int)",
        "playermatch_key": "case when event_type = 'error' and value > 100 then null else cast(user_id as string) || '/' || event_type end",
        "match_id": "cast(event_id as int)",
        "player_id": "case when user_id % 9 = 4 then null else cast(user_id as int) end",
        "player_name": "'player   ' || cast(user_id as string)",
        "dob": "case event_type when 'view' then mdy when 'click' then dmy end",
        "batting_hand": "case event_type when 'view' then ' ' else 'RIGHT-hand' end",
        "country_name": "props",
        "role_desc": "event_type",
        "player_team": "case when value > 50 then 'HOME  side' else 'away' end",
        "season_year": "2008 + cast(floor(day(ts) / 3) as int)",
        "is_manofthematch": "case event_type when 'signup' then 1 when 'error' then null else 0 end",
        "age_as_on_match": "20 + cast(day(ts) as int)",
        "isplayers_team_won": _flag("value > 20"),
        "player_captain": "case event_type when 'purchase' then 'Y' when 'click' then 'N' end",
        "player_keeper": "case event_type when 'view' then 'y' end",
    }),
    TEAM: ("nation", {
        "team_sk": "nullif(n_nationkey, 24)",
        "team_id": "nullif(n_nationkey, 24)",
        "team_name": "case when n_nationkey = 24 then null when n_regionkey = 0 then ' ' else lower(n_name) || '  XI' end",
    }),
}

# The cleaned tables bring a parsed date, which the analytics read.
_PARSED = {MATCH: ("match_date_cleaned", "cast(o_orderdate as date)")}


def projections(table: str, parsed: bool = False) -> list[tuple[str, str]]:
    """(column, expression) for every declared column of a table, in order."""
    given = STAR[table][1]
    columns = [
        (f.name, f"cast({given.get(f.name, 'null')} as {f.dataType.simpleString()})") for f in SCHEMAS[table]
    ]
    return columns + ([_PARSED[table]] if parsed and table in _PARSED else [])


def star_table(spark: SparkSession, sf_dir: str, table: str, parsed: bool = False) -> DataFrame:
    """A star table over a folder of given tables."""
    given = STAR[table][0]
    source = spark.read.parquet(f"{sf_dir}/{given}.parquet")
    helped = source.selectExpr("*", *[f"{expr} as {name}" for name, expr in HELPERS[given].items()])
    return helped.selectExpr(*[f"{expr} as `{name}`" for name, expr in projections(table, parsed)])


class StarTables(Mapping):
    """The five tables with their parsed dates, each opened when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    def __getitem__(self, table: str) -> DataFrame:
        return star_table(self._spark, self._sf_dir, table, parsed=True)

    def __iter__(self):
        return iter(STAR)

    def __len__(self) -> int:
        return len(STAR)


def star_sql(table: str, parsed: bool = False) -> str:
    """The same star table as a DuckDB SELECT."""
    given = STAR[table][0]
    helpers = "".join(f", {expr} as {name}" for name, expr in HELPERS[given].items())
    columns = ", ".join(f'{expr} as "{name}"' for name, expr in projections(table, parsed))
    return f"select {columns} from (select *{helpers} from {given})"
