"""Small raw CSV tables with every kind of dirt, written as files."""
from __future__ import annotations

import csv
from pathlib import Path

from pavilion.plans.specs import TEAM_NAMES
from pavilion.sources import SCHEMAS
from pavilion.sources.schemas import BALL_BY_BALL, MATCH, PLAYER, PLAYER_MATCH, TEAM

FILE_NAMES = {PLAYER_MATCH: "Player_match"}


def deliveries() -> list[dict]:
    """Matches 1 to 4 and 9 (which is not in Match), two innings, three overs, six balls each."""
    rows = []
    for match in (1, 2, 3, 4, 9):
        for innings in (1, 2):
            for over in (1, 2, 3):
                for ball in range(1, 7):
                    rows.append({
                        "match_id": match, "over_id": over, "ball_id": 10 * innings + ball, "innings_no": innings,
                        "team_batting": "4" if innings == 1 else "7", "team_bowling": "14" if innings == 1 else " ",
                        "extra_type": "", "runs_scored": (match + innings + over + ball) % 5, "extra_runs": 0,
                        "wides": 0, "legbyes": 0, "byes": 0, "noballs": 0, "penalty": 0, "out_type": "Not  APPLICABLE",
                        "caught": 0, "bowled": 0, "bowler_wicket": 1, "match_date": "4/22/2013",
                        "season": 2012 + (match > 2), "striker": 1 + (ball + innings) % 4,
                    })
    rows[0] |= {"wides": 1, "extra_runs": 1}
    rows[1] |= {"noballs": 1}
    rows[2] |= {"caught": 1, "bowler_wicket": 0}
    rows[3] |= {"bowler_wicket": "", "byes": 2, "extra_runs": 2}
    rows[4] |= {"striker": ""}
    rows[5] |= {"striker": 77}
    rows[6] |= {"runs_scored": 6, "extra_runs": 1}
    rows[7] |= {"match_date": "05-12-2013"}
    rows[8] |= {"match_date": "2013-04-22"}
    rows[9] |= {"match_date": " 4/22/2013"}
    rows[10] |= {"match_date": "31-02-2013"}
    rows[11] |= {"runs_scored": "2.0"}
    rows.append(dict(rows[20]))
    rows.append(dict(rows[21], runs_scored=0, striker=""))
    rows.append(dict(rows[22], ball_id=""))
    rows.append({})
    return rows


def matches() -> list[dict]:
    days = ["10/1/2008", "9/1/2008", "05-12-2013", " 4/22/2013"]
    margins = [100, 99, 50, ""]
    return [{
        "match_sk": i, "match_id": i + 1, "team1": "kings   XI PUNJAB", "team2": "", "match_date": days[i],
        "season_year": 2012 + (i > 1) if i != 1 else "", "venue_name": ["Eden  gardens", "wankhede", "", "wankhede"][i],
        "city_name": ["kolkata", "mumbai", "mumbai", " "][i], "country_name": "India", "toss_name": ["bat", "field"][i % 2],
        "match_winner": ["A", "B", "A", ""][i], "outcome_type": "Result", "win_margin": margins[i],
    } for i in range(4)]


def players() -> list[dict]:
    hands = ["Left-hand Bat", "Right-hand bat", "", "left-hand bat"]
    return [{
        "player_sk": i, "player_id": i + 1, "player_name": f" MS o'neil-dhoni {i}", "dob": "7/7/1981",
        "batting_hand": hands[i], "bowling_skill": "Right-arm Medium", "country_name": ["India", "India", "Nepal", ""][i],
    } for i in range(4)]


def squads() -> list[dict]:
    return [{
        "player_match_sk": 10 * m + p, "playermatch_key": f"{m}/{p}", "match_id": m, "player_id": p,
        "player_name": f"player {p}", "dob": "7/7/1981", "role_desc": "Captain" if p == 1 else "Player",
        "season_year": 2011 + m, "is_manofthematch": int(p == m), "player_captain": "y" if p == 1 else "n",
    } for m in (1, 2, 3, 4) for p in (1, 2, 3)]


def teams() -> list[dict]:
    return [{"team_sk": i, "team_id": i + 1, "team_name": name} for i, name in enumerate(TEAM_NAMES.values())]


def write_raw(folder: Path) -> str:
    tables = {BALL_BY_BALL: deliveries(), MATCH: matches(), PLAYER: players(), PLAYER_MATCH: squads(), TEAM: teams()}
    for name, rows in tables.items():
        columns = [f.name for f in SCHEMAS[name]]
        with open(folder / f"{FILE_NAMES.get(name, name)}.csv", "w", newline="") as file:
            writer = csv.writer(file)
            writer.writerow(columns)
            writer.writerows([[row.get(c, "") for c in columns] for row in rows])
    return str(folder)
