"""The cleaning of the five tables."""
from __future__ import annotations

from dataclasses import replace

from pavilion.plans.cleaning import CleanSpec
from pavilion.sources.schemas import BALL_BY_BALL, MATCH, PLAYER, PLAYER_MATCH, TEAM

# Team code to team name.
TEAM_NAMES = {
    "1": "Kolkata Knight Riders",
    "2": "Royal Challengers Bangalore",
    "3": "Chennai Super Kings",
    "4": "Kings XI Punjab",
    "5": "Rajasthan Royals",
    "6": "Delhi Daredevils",
    "7": "Mumbai Indians",
    "8": "Deccan Chargers",
    "9": "Kochi Tuskers Kerala",
    "10": "Pune Warriors",
    "11": "Sunrisers Hyderabad",
    "12": "Rising Pune Supergiants",
    "13": "Gujarat Lions",
}

# The columns of each table that are keys, strings, integers and dates.
_SPECS = (
    CleanSpec(
        BALL_BY_BALL,
        keys=("match_id", "over_id", "ball_id"),
        strings=("team_batting", "team_bowling", "extra_type", "out_type"),
        integers=(
            "striker_batting_position", "runs_scored", "extra_runs", "wides", "legbyes", "byes", "noballs",
            "penalty", "bowler_extras", "striker", "non_striker", "bowler", "player_out", "fielders",
        ),
        dates=("match_date",),
        dedup_keys=("match_id", "over_id", "ball_id"),
        codes={"team_batting": TEAM_NAMES, "team_bowling": TEAM_NAMES},
    ),
    CleanSpec(
        MATCH,
        keys=("match_id",),
        strings=(
            "team1", "team2", "venue_name", "city_name", "country_name", "toss_winner", "match_winner",
            "toss_name", "win_type", "outcome_type", "manofmach",
        ),
        dates=("match_date",),
        dedup_keys=("match_id",),
    ),
    CleanSpec(
        PLAYER,
        keys=("player_id",),
        strings=("player_name", "batting_hand", "bowling_skill", "country_name"),
        dates=("dob",),
        dedup_keys=("player_id",),
    ),
    CleanSpec(
        PLAYER_MATCH,
        keys=("player_match_sk", "playermatch_key"),
        strings=(
            "player_name", "batting_hand", "bowling_skill", "country_name", "role_desc", "player_team",
            "opposit_team", "batting_status", "bowling_status", "player_captain", "opposit_captain",
            "player_keeper", "opposit_keeper",
        ),
        dates=("dob",),
        dedup_keys=("player_match_sk", "playermatch_key"),
    ),
    CleanSpec(TEAM, keys=("team_id",), strings=("team_name",), dedup_keys=("team_id",)),
)

SPECS: dict[str, CleanSpec] = {spec.table: spec for spec in _SPECS}

# The declared delivery key has no innings. Where over and ball numbers start again in
# the second innings it loses deliveries; this spec keeps them.
BALL_BY_BALL_PER_INNINGS = replace(
    SPECS[BALL_BY_BALL], dedup_keys=("match_id", "innings_no", "over_id", "ball_id")
)
