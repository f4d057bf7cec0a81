"""Schemas of the five delimited inputs and of the team dimension."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {
        "s": T.StringType(),
        "l": T.LongType(),
        "i": T.IntegerType(),
        "d": T.DoubleType(),
    }
    fields = []
    for item in spec.split():
        name, kind = item.rsplit(":", 1)
        fields.append(T.StructField(name, kinds[kind], True))
    return T.StructType(fields)


TEAMS = _struct(
    "LEAGUE_ID:s TEAM_ID:l MIN_YEAR:i MAX_YEAR:i ABBREVIATION:s NICKNAME:s YEARFOUNDED:i CITY:s "
    "ARENA:s ARENACAPACITY:i OWNER:s GENERALMANAGER:s HEADCOACH:s DLEAGUEAFFILIATION:s"
)

# The other four files are known by the columns the work needs; readers find
# them by name, among others and in any order.
SALARIES = _struct("player_id:s team:s season_start:i season_end:i salary:d")
PLAYERS = _struct("_id:s name:s")
BOX_SCORES = _struct(
    "GAME_ID:l TEAM_ID:l TEAM_ABBREVIATION:s PLAYER_ID:l PLAYER_NAME:s START_POSITION:s MIN:s "
    "FGM:d FGA:d FG_PCT:d FG3M:d FG3A:d FG3_PCT:d FTM:d FTA:d FT_PCT:d OREB:d DREB:d REB:d "
    "AST:d STL:d BLK:d TO:d PF:d PTS:d PLUS_MINUS:d"
)
GAMES = _struct("GAME_ID:l HOME_TEAM_ID:l VISITOR_TEAM_ID:l SEASON:i HOME_TEAM_WINS:i")
SEASON_STATS = _struct("Year:i Player:s Pos:s Tm:s OWS:d DWS:d WS:d TOV:d PTS:d")
