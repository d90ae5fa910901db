"""The five declared tables."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

BALL_BY_BALL = "Ball_By_Ball"
MATCH = "Match"
PLAYER = "Player"
PLAYER_MATCH = "Player_Match"
TEAM = "Team"

# The columns of the raw files, in file order.
_COLUMNS = {
    BALL_BY_BALL: """
        match_id int, over_id int, ball_id int, innings_no int, team_batting string,
        team_bowling string, striker_batting_position int, extra_type string, runs_scored int,
        extra_runs int, wides int, legbyes int, byes int, noballs int, penalty int,
        bowler_extras int, out_type string, caught int, bowled int, run_out int, lbw int,
        retired_hurt int, stumped int, caught_and_bowled int, hit_wicket int,
        obstructingfeild int, bowler_wicket int, match_date string, season int, striker int,
        non_striker int, bowler int, player_out int, fielders int, striker_match_sk int,
        strikersk int, nonstriker_match_sk int, nonstriker_sk int, fielder_match_sk int,
        fielder_sk int, bowler_match_sk int, bowler_sk int, playerout_match_sk int,
        battingteam_sk int, bowlingteam_sk int, keeper_catch int, player_out_sk int,
        matchdatesk int""",
    MATCH: """
        match_sk int, match_id int, team1 string, team2 string, match_date string,
        season_year int, venue_name string, city_name string, country_name string,
        toss_winner string, match_winner string, toss_name string, win_type string,
        outcome_type string, manofmach string, win_margin int, country_id int""",
    PLAYER: """
        player_sk int, player_id int, player_name string, dob string, batting_hand string,
        bowling_skill string, country_name string""",
    PLAYER_MATCH: """
        player_match_sk int, playermatch_key string, match_id int, player_id int,
        player_name string, dob string, batting_hand string, bowling_skill string,
        country_name string, role_desc string, player_team string, opposit_team string,
        season_year int, is_manofthematch int, age_as_on_match int, isplayers_team_won int,
        batting_status string, bowling_status string, player_captain string,
        opposit_captain string, player_keeper string, opposit_keeper string""",
    TEAM: "team_sk int, team_id int, team_name string",
}

_TYPES = {"int": IntegerType(), "string": StringType()}


def _declared(columns: str) -> StructType:
    pairs = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, StructType] = {name: _declared(columns) for name, columns in _COLUMNS.items()}


def cleaned_schema(schema: StructType, dates: Iterable[str] = ()) -> StructType:
    """The schema of a cleaned table: the raw columns, then one date per raw date column."""
    return StructType(schema.fields + [StructField(f"{d}_cleaned", DateType()) for d in dates])


def schema_differences(spark: SparkSession, actual: DataFrame | StructType, expected: StructType) -> DataFrame:
    """One row per column that is missing, unexpected, of another type or in another place."""
    found = actual.schema if isinstance(actual, DataFrame) else actual
    have = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(found)}
    want = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(expected)}
    rows = []
    for name, (place, kind) in want.items():
        if name not in have:
            rows.append((name, kind, None, "missing"))
        elif have[name][1] != kind:
            rows.append((name, kind, have[name][1], "type"))
        elif have[name][0] != place:
            rows.append((name, str(place), str(have[name][0]), "position"))
    rows += [(name, None, kind, "unexpected") for name, (_, kind) in have.items() if name not in want]
    return spark.createDataFrame(rows, "column string, expected string, actual string, problem string")
