"""Raw files to cleaned tables to every analytic, on a small set with known answers."""
import datetime

import pytest
from pyspark.sql import functions as F

from pavilion.plans import analytics
from pavilion.plans.analytics import ANALYTICS
from pavilion.__main__ import main
from pavilion.plans.cleaning import clean, run_cleaning
from pavilion.plans.jobs import clean_all, ingest, load_clean, load_text, report
from pavilion.plans.specs import BALL_BY_BALL_PER_INNINGS, SPECS
from pavilion.sources import SCHEMAS, replaced, typed
from pavilion.sources.schemas import BALL_BY_BALL, MATCH
from tests.cricket import write_raw


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    source = write_raw(tmp_path_factory.mktemp("source"))
    raw, cleaned = str(tmp_path_factory.mktemp("raw")), str(tmp_path_factory.mktemp("clean"))
    assert ingest(spark, source, raw) == {}
    audit, errors = clean_all(spark, raw, cleaned)
    assert errors == {}
    audit = {(r.table, r.step): (r.rows, r.removed) for r in audit.collect()}
    return {"clean": cleaned, "audit": audit, "source": source, "raw": raw}


@pytest.fixture(scope="module")
def tables(spark, folders):
    tables, errors = load_clean(spark, folders["clean"])
    assert errors == {}
    return tables


def lines(df):
    return [tuple(r) for r in df.collect()]


def test_audit(folders):
    audit = folders["audit"]
    assert audit[BALL_BY_BALL, "initial"] == (184, 0)
    assert audit[BALL_BY_BALL, "key_filter"] == (182, 2)
    assert audit[BALL_BY_BALL, "dedup"] == (180, 2)
    assert audit["Team", "dedup"] == (13, 0)


def test_cleaned_deliveries(tables):
    balls = tables[BALL_BY_BALL]
    assert {tuple(r) for r in balls.select("team_batting", "team_bowling").distinct().collect()} == {
        ("Kings Xi Punjab", "14"), ("Mumbai Indians", "Blank")}
    days = {r.match_date: r.match_date_cleaned for r in balls.select("match_date", "match_date_cleaned").distinct().collect()
            if r.match_date != "4/22/2013"}
    assert days == {"05-12-2013": datetime.date(2013, 12, 5), "2013-04-22": None, "31-02-2013": None}
    # Spark's CSV writer trims values, so the copied raw table no longer holds the date with a leading space.
    assert balls.filter("match_date = '4/22/2013' and match_date_cleaned is null").count() == 0
    # One null striker, and one in the key duplicate that sorts first.
    assert balls.filter("striker = 0").count() == 2 and balls.filter("bowler_wicket is null").count() == 1


def test_date_with_leading_space_is_not_parsed_from_the_source(spark, folders):
    texts, errors = load_text(spark, folders["source"])
    raw = {name: typed(df, SCHEMAS[name]) for name, df in texts.items()}
    assert not errors
    days = clean(raw[BALL_BY_BALL], SPECS[BALL_BY_BALL])
    assert days.filter("match_date = '4/22/2013' and match_date_cleaned is null").count() == 1


def test_views_answer_sql(spark, tables):
    assert spark.sql("select count(*) from ball_by_ball").first()[0] == 180


def test_every_analytic_runs(spark, folders, tables):
    for name, analytic in ANALYTICS.items():
        assert analytic(tables).collect(), name
    assert report(spark, folders["clean"], "teams").count() == 13


def test_valid_deliveries(tables):
    assert analytics.delivery_totals(tables).first() == (180, 178)
    assert analytics.valid_deliveries(tables).count() == 178


def test_last_running_total_is_the_innings_total(tables):
    scores = {(r.match_id, r.innings_no): r.total_runs for r in analytics.innings_scores(tables).collect()}
    running = analytics.cumulative_runs(tables, k=None, keep_innings=True)
    last = {(r.match_id, r.innings_no): r.top for r in
            running.groupBy("match_id", "innings_no").agg(F.max("running_total_runs").alias("top")).collect()}
    assert last == scores and len(scores) == 10
    assert analytics.cumulative_runs(tables, k=None).count() <= running.count() == 30


def test_first_match_by_text_and_by_date(tables):
    # Match 9 is not in the match table, so its null date comes first as text.
    assert lines(analytics.first_match(tables)) == [(None, None)]
    known = dict(tables)
    known[BALL_BY_BALL] = tables[BALL_BY_BALL].filter("match_id <> 9")
    assert lines(analytics.first_match(known)) == [("05-12-2013", "Blank")]
    assert analytics.earliest_match(tables).first().match_date_cleaned == datetime.date(2008, 9, 1)


def test_margins_and_dates(tables):
    margins = {r.match_id: r.win_margin_category for r in analytics.win_margins(tables).collect()}
    assert margins == {1: "High", 2: "Medium", 3: "Medium", 4: "Low"}
    parts = {r.match_id: (r.year, r.month, r.day) for r in analytics.match_dates(tables).collect()}
    assert parts == {1: (2008, 10, 1), 2: (2008, 9, 1), 3: (2013, 12, 5), 4: (2013, 4, 22)}


def test_counts(tables):
    seasons = dict(lines(analytics.matches_per_season(tables)))
    assert sum(seasons.values()) == tables[MATCH].filter("season_year is not null").count() == 3
    assert lines(analytics.top_venues(tables)) == [("Wankhede", 2), ("Blank", 1), ("Eden Gardens", 1)]
    assert lines(analytics.top_venues(tables, exclude=["Blank"])) == [("Wankhede", 2), ("Eden Gardens", 1)]
    assert lines(analytics.team_wins(tables, 1)) == [("A", 2)]
    assert lines(analytics.top_captains(tables, 1)) == [("Player 1", 4)]
    assert lines(analytics.top_awards(tables)) == [("Player 1", 1), ("Player 2", 1), ("Player 3", 1)]
    assert lines(analytics.roles(tables)) == [("Player", 8), ("Captain", 4)]
    histogram = analytics.win_margin_histogram(tables)
    assert histogram.agg(F.sum("count")).first()[0] == 3


def test_totals_are_sums(tables):
    balls = tables[BALL_BY_BALL]
    assert dict(lines(analytics.extras_totals(tables))) == {"wides": 1, "noballs": 1, "byes": 2, "legbyes": 0, "penalty": 0, "extra_runs": 4}
    dismissals = lines(analytics.dismissal_totals(tables))
    assert dismissals[0] == ("caught", 1) and len(dismissals) == 9 and {n for _, n in dismissals[1:]} == {0}
    assert sum(n for _, n in lines(analytics.runs_per_ball(tables))) == balls.count()


def test_scorers(tables):
    career = analytics.career_scorers(tables, k=None)
    assert career.filter("player_name is null").count() == 2  # striker 0 and striker 77
    total = tables[BALL_BY_BALL].agg(F.sum("runs_scored")).first()[0]
    assert career.agg(F.sum("total_runs")).first()[0] == total
    assert analytics.season_scorers_all(tables).agg(F.sum("total_runs")).first()[0] == total
    best = analytics.season_scorers(tables, k=None, best_only=True)
    tops = {r.season: r.top for r in analytics.season_scorers(tables, k=None).groupBy("season").agg(F.max("total_runs").alias("top")).collect()}
    assert {r.season: r.total_runs for r in best.collect()} == tops


def test_top_k_is_the_head_of_the_whole(tables):
    for name in ("season_scorers", "career_scorers", "cumulative_runs", "scoring_venues", "top_strikers", "high_impact_balls"):
        analytic = ANALYTICS[name]
        assert lines(analytic(tables, k=3)) == lines(analytic(tables, k=None))[:3], name


def test_players(tables):
    styles = {r.player_id: (r.player_name, r.batting_style) for r in analytics.batting_styles(tables).collect()}
    assert styles[1] == ("msoneildhoni0", "Left-Handed") and styles[3][1] == "Right-Handed"


def test_debuts(tables):
    as_of = F.lit("2026-12-03").cast("date")
    published = {r["years_Since_debut"] for r in analytics.years_since_season(tables, as_of).collect()}
    assert published == {2021}
    years = {r["years_Since_debut"] for r in analytics.years_since_debut(tables, as_of).collect()}
    assert years == {14}


def test_no_job_overwrites_its_source(spark, folders):
    for job in (ingest, clean_all):
        with pytest.raises(ValueError):
            job(spark, folders["source"], folders["source"] + "/")


def test_csv_can_hold_the_cleaned_tables(spark, folders, tmp_path):
    audit, errors = clean_all(spark, folders["source"], str(tmp_path), "csv", suffix=".csv")
    assert errors == {}
    assert audit.filter("step = 'dedup'").agg(F.sum("rows")).first()[0] == 180 + 4 + 4 + 12 + 13
    assert len(SCHEMAS) == audit.select("table").distinct().count()


def test_a_failed_table_is_named(spark, folders, tmp_path):
    import shutil

    partial = tmp_path / "raw"
    shutil.copytree(folders["raw"], partial, ignore=shutil.ignore_patterns("Match"))
    audit, errors = clean_all(spark, str(partial), str(tmp_path / "clean"))
    assert list(errors) == ["Match"] and audit.select("table").distinct().count() == 4
    tables, errors = load_clean(spark, str(tmp_path / "clean"))
    assert list(errors) == ["Match"] and "Match" in errors["Match"]
    with pytest.raises(LookupError, match="Match did not open"):
        analytics.win_margins(tables)
    audit, errors = clean_all(spark, str(tmp_path / "nowhere"), str(tmp_path / "none"))
    assert len(errors) == 5 and audit.count() == 0


def names_in(folder):
    return sorted(p.name for p in folder.iterdir())


def test_a_corrupt_file_fails_its_table_alone(spark, tables, tmp_path):
    """The file opens, since its footer is whole, and fails once its rows are read."""
    paths = {}
    for name in ("Team", "Player"):
        paths[name] = tmp_path / "raw" / name
        tables[name].select(*[f.name for f in SCHEMAS[name]]).coalesce(1).write.parquet(str(paths[name]))
    raw = {name: spark.read.parquet(str(path)) for name, path in paths.items()}
    target, specs = tmp_path / "clean", {name: SPECS[name] for name in paths}
    audit, errors = run_cleaning(spark, raw, specs, str(target))
    assert errors == {} and names_in(target) == ["Player", "Team"]
    before = sorted(lines(spark.read.parquet(str(target / "Team"))))

    (file,) = paths["Team"].glob("*.parquet")
    data = bytearray(file.read_bytes())
    data[4:44] = bytes(40)
    file.write_bytes(data)
    for leftover in paths["Team"].glob(".*.crc"):
        leftover.unlink()
    raw = {name: spark.read.parquet(str(path)) for name, path in paths.items()}
    audit, errors = run_cleaning(spark, raw, specs, str(target))
    assert list(errors) == ["Team"] and {r.table for r in audit.collect()} == {"Player"}
    assert names_in(target) == ["Player", "Team"]
    assert sorted(lines(spark.read.parquet(str(target / "Team")))) == before


def test_a_cut_off_file_ends_the_command_with_1(spark, folders, tmp_path, capsys):
    """A compressed raw file that breaks off: the copy and the cleaning of the other tables go through."""
    import gzip
    import shutil

    raw, out = tmp_path / "raw", tmp_path / "clean"
    shutil.copytree(folders["raw"], raw)
    assert main(["clean", str(raw), str(out)]) == 0
    before = sorted(lines(spark.read.parquet(str(out / "Match"))))
    packed = gzip.compress(b"".join(p.read_bytes() for p in sorted((raw / "Match").glob("*.csv"))))
    for p in (raw / "Match").iterdir():
        p.unlink()
    (raw / "Match" / "part.csv.gz").write_bytes(packed[: len(packed) // 2])
    capsys.readouterr()
    assert main(["clean", str(raw), str(out)]) == 1
    said = capsys.readouterr()
    assert [line.split(":")[0] for line in said.err.splitlines() if line.split(":")[0] in SCHEMAS] == ["Match"]
    assert "\nTeam\tdedup" in said.out and "\nMatch\t" not in said.out
    assert names_in(out) == sorted(SCHEMAS) and sorted(lines(spark.read.parquet(str(out / "Match")))) == before


def test_a_failed_swap_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with replaced(spark, path) as staging:
        spark.range(3).write.parquet(staging)
    with pytest.raises(RuntimeError), replaced(spark, path) as staging:
        spark.range(9).write.parquet(staging)
        raise RuntimeError("before the end")
    with pytest.raises(OSError), replaced(spark, path):
        pass  # nothing was written
    assert spark.read.parquet(path).count() == 3 and names_in(tmp_path) == ["t"]


def test_cells_that_cannot_be_read_are_counted(spark, tmp_path):
    source, raw = tmp_path / "source", tmp_path / "raw"
    source.mkdir()
    write_raw(source)
    rows = ["team_sk,team_id,team_name", "1,2.0,a", "2,x, b ", "3, 4,c", "4,5.5,", '5,1e1,"d"']
    (source / "Team.csv").write_text("\n".join(rows) + "\n")
    assert ingest(spark, str(source), str(raw)) == {}
    copied = spark.read.option("header", True).csv(str(raw / "Team"))
    assert sorted(r.team_id for r in copied.collect()) == ["1e1", "2.0", "4", "5.5", "x"]
    audit, _ = clean_all(spark, str(raw), str(tmp_path / "clean"), specs={"Team": SPECS["Team"]})
    assert {r.step: r.rows for r in audit.collect()} == {
        "initial": 5, "null_drop": 5, "key_filter": 3, "string_clean": 3, "date_conversion": 3, "dedup": 3, "unreadable": 2}
    assert sorted(r.team_id for r in load_clean(spark, str(tmp_path / "clean"))[0]["Team"].collect()) == [2, 4, 10]


def test_values_with_line_ends_survive_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "two\nlines"), (2, 2, "one")], SCHEMAS["Team"])
    audit, errors = run_cleaning(spark, {"Team": df}, {"Team": SPECS["Team"]}, str(tmp_path), "csv")
    assert errors == {} and audit.filter("step = 'dedup'").first()["rows"] == 2


def test_specs_are_chosen(spark, folders, tmp_path):
    specs = SPECS | {BALL_BY_BALL: BALL_BY_BALL_PER_INNINGS}
    audit, _ = clean_all(spark, folders["raw"], str(tmp_path), specs=specs)
    assert audit.filter(f"table = '{BALL_BY_BALL}' and step = 'dedup'").first()["rows"] == 180


def test_jobs_shuffle_only_to_remove_duplicates(spark, folders):
    texts, _ = load_text(spark, folders["source"])
    for name, df in texts.items():
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        plan = clean(typed(df, SCHEMAS[name]), SPECS[name])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == plan.count("Exchange") == 1


def test_command_line(spark, folders, tmp_path, capsys):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "clean")
    assert main(["ingest", folders["source"], raw]) == 0
    assert main(["clean", raw, out]) == 0
    audit = [line for line in capsys.readouterr().out.splitlines() if "\t" in line]
    assert len(audit) == 1 + 5 * 7 and sum(line.startswith("Team\t") for line in audit) == 7
    assert main(["report", out, "innings_scores"]) == 0
    assert len([line for line in capsys.readouterr().out.splitlines() if "\t" in line]) == 1 + 10
    assert main(["report", out, "innings_scores", "-k", "3", "--out", str(tmp_path / "top")]) == 0
    assert spark.read.parquet(str(tmp_path / "top")).count() == 3
    (tmp_path / "raw" / "Match").rename(tmp_path / "elsewhere")
    assert main(["clean", raw, str(tmp_path / "part")]) == 1
    assert "Match: " in capsys.readouterr().err
    assert main(["report", str(tmp_path / "part"), "win_margins"]) == 1
    assert "Match did not open" in capsys.readouterr().err
    assert main(["ingest", str(tmp_path / "nowhere"), str(tmp_path / "x")]) == 1
