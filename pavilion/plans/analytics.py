"""The named analytics over the five cleaned tables.

Each takes the tables by name and returns a DataFrame; ``k`` keeps the first rows of a
ranking and ``k=None`` returns all of it. Deliveries are summed to the join key before
any lookup, and names are looked up for the rows that remain.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pavilion.functions import band, contains_label, date_parts, high_impact, year_after_days_back
from pavilion.operators import (
    best_per_group, density, group_count, group_mean, group_stats, group_sum, histogram, joined_mean,
    lookup_left, mean_of_group_sums, ranked, rows_where_zero, running_total, totals_by_column, value_counts,
)
from pavilion.plans.cleaning import normalise_columns
from pavilion.sources.schemas import BALL_BY_BALL, MATCH, PLAYER, PLAYER_MATCH, TEAM

Tables = Mapping[str, DataFrame]

# The columns that the totals of extras and dismissals are over.
EXTRAS = ("wides", "noballs", "byes", "legbyes", "penalty", "extra_runs")
DISMISSALS = (
    "caught", "bowled", "run_out", "lbw", "retired_hurt", "stumped", "caught_and_bowled", "hit_wicket",
    "obstructingfeild",
)


# Deliveries

def valid_deliveries(tables: Tables) -> DataFrame:
    """Deliveries that are neither wides nor no-balls."""
    return rows_where_zero(tables[BALL_BY_BALL], ["wides", "noballs"])


def delivery_totals(tables: Tables) -> DataFrame:
    """How many deliveries there are, and how many are valid."""
    legal = (F.col("wides") == 0) & (F.col("noballs") == 0)
    return tables[BALL_BY_BALL].agg(F.count(F.lit(1)).alias("total"), F.count_if(legal).alias("valid"))


def innings_scores(tables: Tables, k: int | None = None) -> DataFrame:
    """Total and average runs per match and innings, highest first."""
    keys = ["match_id", "innings_no"]
    scores = group_stats(valid_deliveries(tables), keys, "runs_scored", "total_runs", "average_runs")
    return ranked(scores, [F.desc("total_runs")], keys, k)


def cumulative_runs(tables: Tables, k: int | None = None, keep_innings: bool = False) -> DataFrame:
    """Runs up to the end of each over, highest first.

    Without the innings, two innings that stand level after the same over are one row.
    """
    innings = ["match_id", "innings_no"]
    totals = running_total(valid_deliveries(tables), innings, "over_id", "runs_scored", "running_total_runs")
    columns = [*innings, "over_id"] if keep_innings else ["match_id", "over_id"]
    shown = totals.select(*columns, "running_total_runs")
    if not keep_innings:
        shown = shown.distinct()
    return ranked(shown, [F.desc("running_total_runs")], columns, k)


def season_scorers(tables: Tables, k: int | None = 10, best_only: bool = False) -> DataFrame:
    """Runs off valid deliveries per striker and season, named, highest first.

    ``best_only`` keeps the highest scorer of each season, or several on a tie.
    """
    runs = group_sum(valid_deliveries(tables), ["striker", "season"], "runs_scored", "total_runs")
    if best_only:
        runs = best_per_group(runs, ["season"], "total_runs")
    named = _named(tables, runs, [F.desc("total_runs")], ["striker", "season"], k)
    return named.select("striker", "player_name", "season", "total_runs")


def season_scorers_all(tables: Tables, k: int | None = None) -> DataFrame:
    """Runs off all deliveries per striker and season, named, by season and then highest first."""
    runs = group_sum(tables[BALL_BY_BALL], ["striker", "season"], "runs_scored", "total_runs")
    named = _named(tables, runs, ["season", F.desc("total_runs")], ["striker"], k)
    return named.select("player_name", "season", "total_runs")


def career_scorers(tables: Tables, k: int | None = 10) -> DataFrame:
    """Runs off all deliveries per striker, named, highest first."""
    runs = group_sum(tables[BALL_BY_BALL], ["striker"], "runs_scored", "total_runs")
    return _named(tables, runs, [F.desc("total_runs")], ["striker"], k).select("player_name", "total_runs")


def first_match(tables: Tables) -> DataFrame:
    """Date and venue of the first match with a valid delivery, by the raw date text.

    As text, 10/1/2008 comes before 9/1/2008, and a match that is not in the match
    table (null date) comes before all. ``earliest_match`` goes by the date itself.
    """
    played = valid_deliveries(tables).select("match_id").distinct()
    dated = lookup_left(played, tables[MATCH], "match_id", "match_id", ["match_date", "venue_name"])
    return ranked(dated.select("match_date", "venue_name"), ["match_date"], ["venue_name"], 1)


def earliest_match(tables: Tables) -> DataFrame:
    """Date and venue of the first match by its parsed date; reads the match table only."""
    dated = tables[MATCH].filter(F.col("match_date_cleaned").isNotNull())
    order = ["match_date_cleaned"], ["match_id"]
    return ranked(dated.select("match_id", "match_date_cleaned", "venue_name"), *order, 1)


def high_impact_balls(tables: Tables, k: int | None = None, wicket_value: int = 0) -> DataFrame:
    """Valid deliveries flagged by total runs and wicket, most runs first."""
    total = F.col("extra_runs") + F.col("runs_scored")
    flagged = valid_deliveries(tables).select(
        "match_id",
        "striker",
        total.alias("total_runs_on_high_impact_ball"),
        high_impact(total, F.col("bowler_wicket"), wicket_value=wicket_value).alias("high_impact"),
    )
    return ranked(
        flagged, [F.desc("total_runs_on_high_impact_ball")], ["match_id", "striker", "high_impact"], k
    )


def runs_per_ball(tables: Tables) -> DataFrame:
    """How often each number of runs is scored."""
    return value_counts(tables[BALL_BY_BALL], "runs_scored", by_value=True)


def extras_totals(tables: Tables, columns: Sequence[str] = EXTRAS) -> DataFrame:
    """Total of each kind of extra. ``extra_runs`` already holds the sum of the others."""
    return totals_by_column(tables[BALL_BY_BALL], columns, name="extra_type", total="count")


def dismissal_totals(tables: Tables, columns: Sequence[str] = DISMISSALS) -> DataFrame:
    """Total of each kind of dismissal, most frequent first."""
    totals = totals_by_column(tables[BALL_BY_BALL], columns, name="dismissal_type", total="count")
    return ranked(totals, [F.desc("count")], ["dismissal_type"])


def runs_by_over(tables: Tables) -> DataFrame:
    """Average runs per delivery of each over number."""
    return ranked(group_mean(tables[BALL_BY_BALL], ["over_id"], "runs_scored", "runs_scored"), [], ["over_id"])


def top_strikers(tables: Tables, k: int | None = 10) -> DataFrame:
    """Runs per striker id, the unknown striker 0 included, highest first."""
    known = tables[BALL_BY_BALL].filter(F.col("striker").isNotNull())
    runs = group_sum(known, ["striker"], "runs_scored", "runs_scored")
    return ranked(runs.fillna(0, ["runs_scored"]), [F.desc("runs_scored")], ["striker"], k)


def runs_by_season(tables: Tables) -> DataFrame:
    """Average runs per delivery of each season, the season taken from the match."""
    means = joined_mean(
        tables[BALL_BY_BALL], tables[MATCH], "match_id", "match_id", "season_year", "runs_scored", "runs_scored"
    )
    return ranked(means, [], ["season_year"])


def scoring_venues(tables: Tables, k: int | None = 10) -> DataFrame:
    """Average match total per venue, highest first."""
    means = mean_of_group_sums(
        tables[BALL_BY_BALL], tables[MATCH], "match_id", "match_id", "venue_name", "runs_scored", "avg_runs"
    )
    return ranked(means, [F.desc("avg_runs")], ["venue_name"], k)


# Matches

def match_dates(tables: Tables) -> DataFrame:
    """Matches with year, month and day of the parsed date."""
    return tables[MATCH].withColumns(date_parts(F.col("match_date_cleaned")))


def win_margins(tables: Tables) -> DataFrame:
    """Matches with their margin as High (100 and up), Medium (50 and up) or Low."""
    label = band(F.col("win_margin"), [(100, "High"), (50, "Medium")], "Low")
    return tables[MATCH].withColumn("win_margin_category", label)


def matches_per_season(tables: Tables) -> DataFrame:
    """Matches per season, in season order."""
    return value_counts(tables[MATCH], "season_year", by_value=True)


def top_venues(tables: Tables, k: int | None = 10, exclude: Iterable[str] = ()) -> DataFrame:
    """Venues by number of matches."""
    return value_counts(tables[MATCH], "venue_name", k, exclude=exclude)


def top_cities(tables: Tables, k: int | None = 10, exclude: Iterable[str] = ()) -> DataFrame:
    """Cities by number of matches."""
    return value_counts(tables[MATCH], "city_name", k, exclude=exclude)


def toss_decisions(tables: Tables) -> DataFrame:
    """Matches per toss decision."""
    return value_counts(tables[MATCH], "toss_name")


def result_types(tables: Tables) -> DataFrame:
    """Matches per kind of result."""
    return value_counts(tables[MATCH], "outcome_type")


def win_margin_histogram(tables: Tables, bins: int = 30) -> DataFrame:
    """Histogram of win margins."""
    return histogram(tables[MATCH], "win_margin", bins)


def win_margin_density(tables: Tables, points: int = 200, bins: int = 30) -> DataFrame:
    """The smooth curve over the histogram of win margins, at its scale."""
    return density(tables[MATCH], "win_margin", points, count_scale_bins=bins)


def team_wins(tables: Tables, k: int | None = None) -> DataFrame:
    """Matches won per team, most first; matches without a winner are a row of their own."""
    return ranked(group_count(tables[MATCH], ["match_winner"]), [F.desc("count")], ["match_winner"], k)


# Players

def normalised_players(tables: Tables) -> DataFrame:
    """Players with name, batting hand and bowling skill reduced to lower-case letters and digits."""
    return normalise_columns(tables[PLAYER], ("player_name", "batting_hand", "bowling_skill"))


def batting_styles(tables: Tables) -> DataFrame:
    """Normalised players with their style; anything not left is right."""
    style = contains_label(F.col("batting_hand"), "left", "Left-Handed", "Right-Handed")
    return normalised_players(tables).withColumn("batting_style", style)


def top_countries(tables: Tables, k: int | None = 10, exclude: Iterable[str] = ()) -> DataFrame:
    """Countries by number of players."""
    return value_counts(tables[PLAYER], "country_name", k, exclude=exclude)


def batting_hands(tables: Tables) -> DataFrame:
    """Players per batting hand."""
    return value_counts(tables[PLAYER], "batting_hand")


def bowling_skills(tables: Tables) -> DataFrame:
    """Players per bowling skill, null counted as Unknown, most first."""
    return value_counts(tables[PLAYER].fillna("Unknown", ["bowling_skill"]), "bowling_skill")


# Players in matches

def years_since_season(tables: Tables, as_of: Column | None = None) -> DataFrame:
    """Players in matches with ``years_Since_debut`` as published: a year, not a number of years.

    The season number is taken off the date as days. ``years_since_debut`` counts years.
    """
    day = F.current_date() if as_of is None else as_of
    return tables[PLAYER_MATCH].withColumn("years_Since_debut", year_after_days_back(day, F.col("season_year")))


def years_since_debut(tables: Tables, as_of: Column | None = None) -> DataFrame:
    """Players in matches with the years from the player's first season to ``as_of``.

    Null for a player without an id: which rows are the same player's cannot be told.
    """
    day = F.current_date() if as_of is None else as_of
    played = tables[PLAYER_MATCH]
    debuts = played.groupBy("player_id").agg(F.min("season_year").alias("__debut"))
    placed = lookup_left(played, debuts, "player_id", "player_id", ["__debut"], split_keys=True)
    return placed.withColumn("years_Since_debut", F.year(day) - F.col("__debut")).drop("__debut")


def roles(tables: Tables) -> DataFrame:
    """Players in matches per role, most first."""
    return value_counts(tables[PLAYER_MATCH], "role_desc")


def top_captains(tables: Tables, k: int | None = 10) -> DataFrame:
    """Players by number of matches as captain."""
    led = tables[PLAYER_MATCH].filter(F.col("player_captain") == "Y")
    return ranked(group_count(led, ["player_name"]), [F.desc("count")], ["player_name"], k)


def top_awards(tables: Tables, k: int | None = 10) -> DataFrame:
    """Players by number of man-of-the-match awards."""
    return value_counts(tables[PLAYER_MATCH].filter(F.col("is_manofthematch") == 1), "player_name", k)


# Teams

def teams(tables: Tables) -> DataFrame:
    """Rows per team name."""
    return value_counts(tables[TEAM], "team_name")


def _named(
    tables: Tables, runs: DataFrame, order: Sequence[Column | str], ties: Sequence[str], k: int | None
) -> DataFrame:
    """Rank, then look the names up for the rows kept, then put them back in order."""
    kept = runs if k is None else ranked(runs, order, ties, k)
    named = lookup_left(kept, tables[PLAYER], "striker", "player_id", ["player_name"])
    return ranked(named, order, [*ties, "player_name"], k)


ANALYTICS = {
    f.__name__: f
    for f in (
        valid_deliveries, delivery_totals, innings_scores, cumulative_runs, season_scorers, season_scorers_all,
        career_scorers, first_match, earliest_match, high_impact_balls, runs_per_ball, extras_totals,
        dismissal_totals, runs_by_over, top_strikers, runs_by_season, scoring_venues, match_dates, win_margins,
        matches_per_season, top_venues, top_cities, toss_decisions, result_types, win_margin_histogram,
        win_margin_density, team_wins, normalised_players, batting_styles, top_countries, batting_hands,
        bowling_skills, years_since_season, years_since_debut, roles, top_captains, top_awards, teams,
    )
}
