"""The whole pipeline on a small invented league read from delimited files."""

import random

import pytest

from panelspark.plans import fixed_values as V
from panelspark.plans.season_panel import LABELS, LONG_SPEC, METRICS, WIDE_SPEC, Inputs, Maps, SeasonPanel

TEAMS = {1: "NJN", 2: "SEA", 3: "CHI"}
NAMES = {"NJN": "New Jersey Nets", "SEA": "Seattle SuperSonics", "CHI": "Chicago Bulls"}


def write(folder, name, header, rows):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [",".join(header)] + [",".join("" if v is None else str(v) for v in row) for row in rows]
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def league(tmp_path_factory):
    folder = tmp_path_factory.mktemp("league")
    rng = random.Random(7)
    players = {t: [t * 100 + i for i in range(10)] for t in TEAMS}
    box, games, game = [], [], 0
    for season in (2004, 2005, 2006):
        for home in TEAMS:
            for away in TEAMS:
                if home == away:
                    continue
                game += 1
                games.append((game, home, away, season, rng.randint(0, 1)))
                for team in (home, away):
                    for at, p in enumerate(players[team]):
                        mins = f"{30 - at}:{rng.randint(10, 59)}" if at < 9 else None
                        counts = [rng.randint(1, 9) for _ in range(13)]
                        fgm, fga, f3m, f3a, ftm, fta, *rest = counts
                        oreb, dreb, ast, stl, blk, to, pts = rest
                        shoots = int(p % 100 != 0)
                        box.append((game, team, TEAMS[team], p, f"Name {p}", "", mins, fgm, fgm + fga, 0.5, f3m * shoots, (f3m + f3a) * shoots,
                                    0.1, ftm, ftm + fta, 0.5, oreb, dreb, oreb + dreb, ast, stl, blk, to, 2, pts, 1))
    salaries, stats = [], []
    for team, members in players.items():
        for p in members[:7]:
            for start in (2004, 2005):
                salaries.append((f"s{p}", NAMES[TEAMS[team]], start, start + 1, 1000 * (p % 100 + 1) + start))
        for p in members:
            label = f"Name {p}" if p != 305 else "Wrong 305*"
            for year in (2006, 2007):
                ows, dws = rng.random(), rng.random()
                stats.append((year, label, "G", "BRK" if TEAMS[team] == "NJN" else TEAMS[team], ows, dws, ows + dws, 1, 10))
    stats.append((2006, "Name 100", "G", "TOT", 9, 9, 18, 1, 1))
    write(folder, "salaries/salaries_1985to2018.csv", ["player_id", "team", "season_start", "season_end", "salary"], salaries)
    names = [(f"s{p}", f"Name {p}" if p != 203 else "Odd 203") for m in players.values() for p in m]
    write(folder, "salaries/players.csv", ["_id", "name"], names)
    columns = ("GAME_ID TEAM_ID TEAM_ABBREVIATION PLAYER_ID PLAYER_NAME START_POSITION MIN FGM FGA FG_PCT FG3M FG3A "
               "FG3_PCT FTM FTA FT_PCT OREB DREB REB AST STL BLK TO PF PTS PLUS_MINUS").split()  # fmt: skip
    write(folder, "games_data/games_details.csv", columns, box)
    write(folder, "games_data/games.csv", ["GAME_ID", "HOME_TEAM_ID", "VISITOR_TEAM_ID", "SEASON", "HOME_TEAM_WINS"], games)
    write(folder, "season_data/Seasons_Stats.csv", ["Year", "Player", "Pos", "Tm", "OWS", "DWS", "WS", "TOV", "PTS"], stats)
    return folder, games


@pytest.fixture(scope="module")
def panel(spark, league):
    maps = Maps(salary_names=["Name 203"], stats_names={"Wrong 305*": "Name 305"})
    return SeasonPanel(Inputs.from_files(spark, str(league[0])), maps, keep=True)


def test_panel_rows(panel):
    rows = panel.season.collect()
    assert len(rows) == 2 * 3 * V.TOP_MEMBERS
    assert len({(r["season"], r["TEAM_ABBREVIATION"], r["PLAYER_ID"]) for r in rows}) == len(rows)
    assert {r["season"] for r in rows} == {2005, 2006}
    # SEA conforms before the salaries are joined, NJN after
    assert {r["TEAM_ABBREVIATION"] for r in rows} == {"OKC", "CHI", "BKN"}
    assert {r["PLAYER_ID"] for r in rows if r["FG3_PCT"] == 0.0} == {100, 200, 300}


def test_shares(panel):
    groups = {}
    for r in panel.concentration.collect():
        groups.setdefault((r["season"], r["TEAM_ABBREVIATION"]), []).append(r)
    for members in groups.values():
        assert sum(r["salary_share"] for r in members) == pytest.approx(100)
        hhi = sum(r["salary_share"] ** 2 for r in members)
        assert all(r["salary_hhi"] == pytest.approx(hhi) for r in members)
        assert 1e4 / len(members) - 1e-6 <= hhi <= 1e4
    # the last of the top eight has no salary: it takes the median of the other seven
    okc = {r["PLAYER_ID"]: r["salary"] for r in groups[2005, "OKC"]}
    assert okc[207] == sorted(v for k, v in okc.items() if k != 207)[3]


def test_repairs(panel):
    assert {r["player_id"] for r in panel.salaries.collect()} >= {203}
    stats = panel.stats.collect()
    assert {r["player_id"] for r in stats} >= {305}
    assert not [r for r in stats if r["WS"] == 18]


def test_wins(panel, league):
    expected = {}
    for _, home, away, season, won in league[1]:
        for team, flag in ((home, won), (away, 1 - won)):
            expected[season, team] = expected.get((season, team), 0) + flag
    got = {(r["season"], r["group_id"]): r["win_flag"] for r in panel.wins.collect()}
    assert got == expected


def test_tables_for_models(panel):
    assert len(WIDE_SPEC.terms) == 81
    assert len(LONG_SPEC.terms) == 23
    wide = panel.wide
    assert set(WIDE_SPEC.features) | {"win_flag"} <= set(wide.columns)
    assert wide.count() == 6
    assert panel.long.count() > 0
    assert panel.cluster_rows.filter("TEAM_ABBREVIATION = 'NJN'").count() == 0  # its statistics carry the new code
    assert panel.minutes_coverage.count() == 2
    first = panel.scaled.filter("rank = 'player_1'").count()
    assert first == 6 and len(LABELS) == 8 and len(METRICS) == 10


def test_positions_must_match(spark, league):
    built = SeasonPanel(Inputs.from_files(spark, str(league[0])), Maps(salary_names=["a", "b"], stats_names={}))
    with pytest.raises(ValueError):
        built.salaries  # noqa: B018
