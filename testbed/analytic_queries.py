"""The named analytics and the cleaning on the star tables."""
from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import functions as F

from pavilion.plans import analytics
from pavilion.plans.analytics import DISMISSALS, EXTRAS
from pavilion.plans.cleaning import blank_counts, clean, clean_audit, parse_dates
from pavilion.plans.specs import BALL_BY_BALL_PER_INNINGS, SPECS, TEAM_NAMES
from pavilion.sources.schemas import BALL_BY_BALL, MATCH, PLAYER, PLAYER_MATCH, TEAM
from testbed.operator_queries import TITLE
from testbed.registry import add
from testbed.star import StarTables, projections, star_sql, star_table

# Names the SQL below uses for the star tables.
_SHORT = {"ball": BALL_BY_BALL, "game": MATCH, "player": PLAYER, "squad": PLAYER_MATCH, "team": TEAM}
_WITH = "with " + ", ".join(f"{short} as ({star_sql(table, parsed=True)})" for short, table in _SHORT.items())
_VALID = "(select * from ball where wides = 0 and noballs = 0)"


def _analytic(name, sql, function=None, finish=lambda df: df, dated=False, **options):
    run = function or analytics.ANALYTICS[name]

    def on_star(spark, sf_dir):
        day = {"as_of": F.lit("2024-01-01").cast("date")} if dated else {}
        return finish(run(StarTables(spark, sf_dir), **options, **day))

    add(name, on_star, f"{_WITH} {sql}")


def _counts(table, column, extra=""):
    return f"select {column}, count(*) as count from {table} where {column} is not null group by {column} {extra}"


def _top(table, column, where="true"):
    return (
        f"select {column}, count(*) as count from {table} where {column} is not null and {where}"
        f" group by {column} order by count desc, {column} limit 10"
    )


def _sums(table, columns, name):
    return " union all ".join(
        f"select '{c}' as {name}, cast(coalesce(sum({c}), 0) as bigint) as count from {table}" for c in columns
    )


_analytic("valid_deliveries", f"select * from {_VALID}")
_analytic("delivery_totals", "select count(*) as total, count(*) filter (where wides = 0 and noballs = 0) as valid from ball")
_analytic("innings_scores", f"""
    select match_id, innings_no, cast(sum(runs_scored) as bigint) as total_runs, avg(runs_scored) as average_runs
    from {_VALID} group by match_id, innings_no""")
_RUNNING = f"""select match_id, innings_no, over_id, cast(sum(runs_scored) over (
    partition by match_id, innings_no order by over_id) as bigint) as running_total_runs from {_VALID}"""
_analytic("cumulative_runs", f"""
    select distinct match_id, over_id, running_total_runs from ({_RUNNING})
    order by running_total_runs desc nulls last, match_id, over_id limit 10""", k=10)
_analytic("cumulative_runs_all", f"select distinct match_id, over_id, running_total_runs from ({_RUNNING})",
          analytics.cumulative_runs)
_analytic("cumulative_runs_by_innings", f"select distinct match_id, innings_no, over_id, running_total_runs from ({_RUNNING})",
          analytics.cumulative_runs, keep_innings=True)
_BY_SEASON = f"""select striker, season, cast(sum(runs_scored) as bigint) as total_runs
    from {_VALID} group by striker, season"""
_analytic("season_scorers", f"""
    select striker, player_name, season, total_runs from ({_BY_SEASON}) left join player on striker = player_id
    order by total_runs desc, striker, season limit 10""")
_analytic("season_scorers_complete", f"""
    select striker, player_name, season, total_runs from ({_BY_SEASON}) left join player on striker = player_id""",
          analytics.season_scorers, k=None)
_analytic("season_winners", f"""
    select striker, player_name, season, total_runs
    from (select *, rank() over (partition by season order by total_runs desc) as place from ({_BY_SEASON}))
    left join player on striker = player_id where place = 1""",
          analytics.season_scorers, k=None, best_only=True)
_analytic("season_scorers_all", """
    select player_name, season, total_runs
    from (select striker, season, cast(sum(runs_scored) as bigint) as total_runs from ball group by striker, season)
    left join player on striker = player_id""")
_analytic("career_scorers", """
    select player_name, total_runs
    from (select striker, cast(sum(runs_scored) as bigint) as total_runs from ball group by striker)
    left join player on striker = player_id order by total_runs desc, striker limit 10""")
_analytic("first_match", f"""
    select g.match_date, g.venue_name from {_VALID} b left join game g on b.match_id = g.match_id
    order by g.match_date nulls first, g.venue_name nulls first limit 1""")
_analytic("earliest_match", """
    select match_id, match_date_cleaned, venue_name from game where match_date_cleaned is not null
    order by match_date_cleaned, match_id limit 1""")
_IMPACT = """select match_id, striker, extra_runs + runs_scored as total_runs_on_high_impact_ball,
    case when extra_runs + runs_scored > 6 or bowler_wicket = {0} then true else false end as high_impact from """ + _VALID
_analytic("high_impact_balls", f"""{_IMPACT.format(0)}
    order by total_runs_on_high_impact_ball desc nulls last, match_id, striker, high_impact limit 10""", k=10)
_analytic("high_impact_all", _IMPACT.format(0), analytics.high_impact_balls)
_analytic("high_impact_wickets", _IMPACT.format(1), analytics.high_impact_balls, wicket_value=1)
_analytic("runs_per_ball", _counts("ball", "runs_scored"))
_analytic("extras_totals", _sums("ball", EXTRAS, "extra_type"))
_analytic("dismissal_totals", _sums("ball", DISMISSALS, "dismissal_type"))
_analytic("runs_by_over", "select over_id, avg(runs_scored) as runs_scored from ball where over_id is not null group by over_id")
_analytic("top_strikers", """
    select striker, cast(coalesce(sum(runs_scored), 0) as bigint) as runs_scored from ball
    where striker is not null group by striker order by runs_scored desc, striker limit 10""")
_analytic("runs_by_season", """
    select season_year, avg(runs_scored) as runs_scored from ball b left join game g on b.match_id = g.match_id
    where season_year is not null group by season_year""")
_VENUES = """select venue_name, avg(total_runs) as avg_runs
    from (select match_id, cast(sum(runs_scored) as bigint) as total_runs from ball group by match_id) b
    left join game g on b.match_id = g.match_id group by venue_name"""
_analytic("scoring_venues", f"{_VENUES} order by avg_runs desc nulls last, venue_name limit 10")
_analytic("scoring_venues_all", _VENUES, analytics.scoring_venues, k=None)

_analytic("match_dates", """
    select *, cast(year(match_date_cleaned) as int) as year, cast(month(match_date_cleaned) as int) as month,
           cast(day(match_date_cleaned) as int) as day from game""")
_analytic("win_margins", """
    select *, case when win_margin >= 100 then 'High' when win_margin >= 50 and win_margin < 100 then 'Medium'
                   else 'Low' end as win_margin_category from game""")
_analytic("matches_per_season", _counts("game", "season_year"))
_analytic("top_venues", _top("game", "venue_name"))
_analytic("top_cities", _top("game", "city_name"))
_analytic("top_cities_without", _top("game", "city_name", "city_name <> 'City 3'"), analytics.top_cities, exclude=["City 3"])
_analytic("toss_decisions", _counts("game", "toss_name"))
_analytic("result_types", _counts("game", "outcome_type"))
_MARGINS = "select cast(win_margin as double) as v from game where win_margin is not null"
_analytic("win_margin_histogram", f"""
    select b.bin, lo + (hi - lo) / 30 * (b.bin - 1) as lo, lo + (hi - lo) / 30 * b.bin as hi,
           cast(coalesce(h.n, 0) as bigint) as count
    from (select cast(range as int) as bin from range(1, 31)) b
    cross join (select min(v) lo, max(v) hi from ({_MARGINS})) e
    left join (select least(cast(floor((v - lo) * 30 / (hi - lo)) as int) + 1, 30) as bin, count(*) as n
               from ({_MARGINS}) cross join (select min(v) lo, max(v) hi from ({_MARGINS})) group by 1) h
      on b.bin = h.bin""")
_analytic("win_margin_density", f"""
    select cast(g.i as int) as i, s.lo + (s.hi - s.lo) * g.i / 199 as x,
           round(sum(d.n * exp(-0.5 * power((s.lo + (s.hi - s.lo) * g.i / 199.0 - d.v) / s.h, 2)))
                 / (max(s.c) * max(s.h) * sqrt(2 * pi())) * max(s.c) * (max(s.hi) - max(s.lo)) / 30, 5) as density
    from (select v, count(*) as n from ({_MARGINS}) group by v) d
    cross join (select min(v) lo, max(v) hi, cast(count(*) as double) c,
                       stddev_samp(v) * power(cast(count(*) as double), -0.2) h from ({_MARGINS})) s
    cross join (select range as i from range(0, 200)) g group by g.i, s.lo, s.hi""",
          finish=lambda df: df.withColumn("density", F.round("density", 5)))
_analytic("team_wins", "select match_winner, count(*) as count from game group by match_winner")
_analytic("team_wins_top10", """
    select match_winner, count(*) as count from game group by match_winner
    order by count desc, match_winner nulls first limit 10""", analytics.team_wins, k=10)

_PLAIN = "lower(regexp_replace({0}, '[^a-zA-Z0-9]', '', 'g')) as {0}"
_NORMALISED = "select * replace (" + ", ".join(
    _PLAIN.format(c) for c in ("player_name", "batting_hand", "bowling_skill")) + ") from player"
_analytic("normalised_players", _NORMALISED)
_analytic("batting_styles", f"""
    select *, case when batting_hand like '%left%' then 'Left-Handed' else 'Right-Handed' end as batting_style
    from ({_NORMALISED})""")
_analytic("top_countries", _top("player", "country_name"))
_analytic("batting_hands", _counts("player", "batting_hand"))
_analytic("bowling_skills", """
    select coalesce(bowling_skill, 'Unknown') as bowling_skill, count(*) as count from player group by 1""")

_analytic("years_since_season", """
    select *, cast(year(date '2024-01-01' - season_year) as int) as "years_Since_debut" from squad""", dated=True)
_analytic("years_since_debut", """
    select *, case when player_id is not null then 2024 - min(season_year) over (partition by player_id) end as "years_Since_debut"
    from squad""", dated=True)
_analytic("roles", _counts("squad", "role_desc"))
_analytic("top_captains", _top("squad", "player_name", "player_captain = 'Y'"))
_analytic("top_awards", _top("squad", "player_name", "is_manofthematch = 1"))
_analytic("teams", _counts("team", "team_name"))


# The cleaning

def _cleaned_sql(spec, columns):
    """The cleaning of a star table, written out for DuckDB, with every option of its spec."""
    codes = "case {0} " + " ".join(f"when '{k}' then '{v}'" for k, v in TEAM_NAMES.items()) + " else {0} end"

    def filled(c):
        coded = codes.format(c) if c in spec.codes else c
        if c in spec.integers:
            return f"coalesce({c}, 0)"
        if c in spec.strings:
            return f"case when {coded} is null or trim({coded}) = '' then '{spec.placeholder}' else {coded} end"
        if c in spec.booleans:
            return f"coalesce(lower(cast({c} as varchar)) in ('true', '1'), false)"
        return c

    def finished(c):
        if c in spec.strings:
            title = TITLE.format(f"regexp_replace(trim(lower({c})), ' +', ' ', 'g')")
            kept = " ".join(f"when '{word.lower()}' then '{word}'" for word in spec.keep_spelling)
            return f"case lower({title}) {kept} else {title} end" if kept else title
        return f"trim({c})" if c in spec.dates else c

    def day(c):
        c = f"trim({c})" if spec.trim_before_parse else c
        return (
            f"cast(case when regexp_matches({c}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') then try_strptime({c}, '%m/%d/%Y')"
            f" when regexp_matches({c}, '^\\d{{2}}-\\d{{2}}-\\d{{4}}$') then try_strptime({c}, '%d-%m-%Y') end as date)"
        )

    names = columns + [f"{c}_cleaned" for c in spec.dates]
    rest = ", ".join(f"{c} nulls first" for c in names if c not in spec.dedup_keys)
    keyed = " and ".join(f"{k} is not null" for k in spec.keys) or "true"
    first = ", ".join(f"{filled(c)} as {c}" for c in columns)
    seen = f"where coalesce({', '.join(f'cast({c} as varchar)' for c in columns)}) is not null" if spec.null_drop_first else ""
    order = ", ".join([*spec.dedup_order, rest])
    second = ", ".join([f"{finished(c)} as {c}" for c in columns] + [f"{day(c)} as {c}_cleaned" for c in spec.dates])
    return f"""
        select {", ".join(names)} from (
            select *, row_number() over (partition by {", ".join(spec.dedup_keys)} order by {order}) as place
            from (select {second} from (select {first} from ({star_sql(spec.table)}) {seen}) where {keyed}))
        where place = 1"""


def _audit_sql(spec, columns):
    keyed = " and ".join(f"{k} is not null" for k in spec.keys)
    steps = ["initial", "null_drop", "key_filter", "string_clean", "date_conversion", "dedup"]
    kept = f"(select count(*) from ({star_sql(spec.table)}) where {keyed})"
    rows = {s: kept for s in steps}
    rows["initial"] = rows["null_drop"] = f"(select count(*) from ({star_sql(spec.table)}))"
    rows["dedup"] = f"(select count(*) from ({_cleaned_sql(spec, columns)}))"
    return " union all ".join(
        f"""select '{spec.table}' as "table", '{step}' as step, {rows[step]} as rows, {rows[before]} - {rows[step]} as removed"""
        for step, before in zip(steps, ["initial"] + steps)
    )


def _blanks_sql(table, columns):
    return " union all ".join(
        f"""select '{c}' as "column", cast(coalesce(sum(case when {c} is null or trim({c}) = '' then 1 else 0 end), 0)"""
        f" as bigint) as blanks from ({star_sql(table)})" for c in columns
    )


def _clean_table(spec, spark, sf_dir):
    return clean(star_table(spark, sf_dir, spec.table), spec)


def _audit_table(spec, spark, sf_dir):
    return clean_audit(star_table(spark, sf_dir, spec.table), spec)


def _blank_table(spec, spark, sf_dir):
    return blank_counts(star_table(spark, sf_dir, spec.table), spec.strings)


# One spec for each option that the five tables leave at its default.
_OPTIONS = {
    "clean_null_drop_first": replace(SPECS[TEAM], keys=(), dedup_keys=("team_id", "team_name"), null_drop_first=True),
    "clean_trim_before_parse": replace(SPECS[MATCH], trim_before_parse=True),
    "clean_booleans": replace(SPECS[PLAYER_MATCH], booleans=("is_manofthematch", "isplayers_team_won")),
    "clean_keep_spelling": replace(SPECS[TEAM], keep_spelling=("India XI", "UNITED KINGDOM XI")),
    "clean_placeholder": replace(SPECS[PLAYER], placeholder="not known"),
    "clean_dedup_order": replace(BALL_BY_BALL_PER_INNINGS, dedup_keys=("match_id", "innings_no"), dedup_order=("runs_scored", "striker", "non_striker")),
}
for _label, _spec in _OPTIONS.items():
    add(_label, partial(_clean_table, _spec), _cleaned_sql(_spec, [name for name, _ in projections(_spec.table)]))

for _spec, _label in [*((s, s.table.lower()) for s in SPECS.values()), (BALL_BY_BALL_PER_INNINGS, "ball_by_ball_per_innings")]:
    _columns = [name for name, _ in projections(_spec.table)]
    add(f"clean_{_label}", partial(_clean_table, _spec), _cleaned_sql(_spec, _columns))
    add(f"audit_{_label}", partial(_audit_table, _spec), _audit_sql(_spec, _columns))
    if _spec is not BALL_BY_BALL_PER_INNINGS:
        add(f"blanks_{_label}", partial(_blank_table, _spec), _blanks_sql(_spec.table, _spec.strings))


def _scores_of_cleaned(spark, sf_dir):
    return analytics.innings_scores({BALL_BY_BALL: _clean_table(SPECS[BALL_BY_BALL], spark, sf_dir)})


add("innings_scores_of_cleaned", _scores_of_cleaned, f"""
    select match_id, innings_no, cast(sum(runs_scored) as bigint) as total_runs, avg(runs_scored) as average_runs
    from ({_cleaned_sql(SPECS[BALL_BY_BALL], [name for name, _ in projections(BALL_BY_BALL)])})
    where wides = 0 and noballs = 0 group by match_id, innings_no""")


def _dates_in_place(spark, sf_dir):
    return parse_dates(star_table(spark, sf_dir, MATCH), ("match_date",), in_place=True).select("match_sk", "match_date")


add("dates_in_place", _dates_in_place, f"""
    select match_sk, cast(case when match_date like '%/%' and match_date not like ' %' then strptime(match_date, '%m/%d/%Y')
                               when match_date like '%-%' then strptime(match_date, '%d-%m-%Y') end as date) as match_date
    from ({star_sql(MATCH)})""")
