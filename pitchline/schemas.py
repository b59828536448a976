"""Schemas and column lists shared by the jobs."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _with(base: T.StructType, **extra: T.DataType) -> T.StructType:
    return T.StructType(base.fields + [T.StructField(n, t) for n, t in extra.items()])


# Payload schemas keep scalars as text, so that the typed layer decides how strict a cast
# is. Open-ended sub-objects stay JSON text: a string field receives the object's source.
MATCH_PAYLOAD = _with(
    _text("match_id", "match_date", "kick_off", "home_score", "away_score"),
    competition=_text("competition_id", "competition_name"),
    season=_text("season_id", "season_name"),
    home_team=_text("home_team_id", "home_team_name"),
    away_team=_text("away_team_id", "away_team_name"),
    stadium=_text("id", "name"),
    referee=_text("id", "name"),
    metadata=_text("data_version", "shot_fidelity_version", "xy_fidelity_version"),
)

EVENT_OBJECTS = ["pass", "shot", "dribble", "carry", "duel", "interception", "clearance", "goalkeeper", "tactics"]

EVENT_PAYLOAD = _with(
    _text(
        "id", "index", "period", "timestamp", "minute", "second", "possession", "duration",
        "under_pressure", "off_camera", "out", "bad_behaviour", *EVENT_OBJECTS,
    ),
    location=T.ArrayType(T.StringType()),
    type=_text("id", "name"),
    team=_text("id", "name"),
    player=_text("id", "name"),
    position=_text("id", "name"),
    possession_team=_text("id", "name"),
    play_pattern=_text("id", "name"),
)

SHOT_PAYLOAD = _with(_text("statsbomb_xg"), outcome=_text("name"))
PASS_PAYLOAD = _with(
    _text("goal_assist", "shot_assist", "aerial_won"),
    end_location=T.ArrayType(T.StringType()),
    outcome=_text("name"),
    type=_text("name"),
)
CARRY_PAYLOAD = _with(T.StructType([]), end_location=T.ArrayType(T.StringType()))
BAD_BEHAVIOUR_PAYLOAD = _with(T.StructType([]), card=_text("name"))
DUEL_PAYLOAD = _with(T.StructType([]), type=_text("name"))
DRIBBLE_PAYLOAD = _with(T.StructType([]), outcome=_text("name"))
CLEARANCE_PAYLOAD = _text("aerial_won")

POSITION = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("position", "from", "to", "start_reason")]
)
LINEUP_PLAYER = _with(
    _text("player_id", "player_name", "player_nickname", "jersey_number", "cards"),
    country=_text("id", "name"),
    positions=T.ArrayType(POSITION),
)
LINEUP_PAYLOAD = _with(_text("team_id", "team_name"), lineup=T.ArrayType(LINEUP_PLAYER))

# Fixed values. Player statistics file: output column -> (type, header names accepted, first present wins).
PLAYER_STATS_HEADERS: dict[str, tuple[str, list[str]]] = {
    "season_name": ("string", ["season"]),
    "competition_name": ("string", ["competition", "comp", "league"]),
    "squad_name": ("string", ["squad", "team"]),
    "player_name": ("string", ["player"]),
    "pos": ("string", ["pos"]),
    "age": ("int", ["age"]),
    "birth_year": ("int", ["born", "birth_year"]),
    "minutes_played": ("double", ["min", "minutes"]),
    "starts": ("int", ["starts"]),
    "nineties": ("double", ["90s", "nineties"]),
    "goals": ("double", ["gls", "goals"]),
    "assists": ("double", ["ast", "assists"]),
    "xg": ("double", ["xg"]),
    "xag": ("double", ["xag"]),
    "shots_total": ("double", ["sh", "shots"]),
    "shots_on_target": ("double", ["sot", "shots_on_target"]),
    "tackles": ("double", ["tkl", "tackles"]),
    "interceptions": ("double", ["int", "interceptions"]),
    "blocks": ("double", ["blocks", "blk"]),
    "clearances": ("double", ["clr", "clearances"]),
    "aerials_won": ("double", ["won", "aerials_won"]),
    "clean_sheets": ("double", ["cs", "clean_sheets"]),
    "save_pct": ("double", ["save%", "save_pct"]),
}
DEFAULT_STATS_SEASON = "2025/2026"

# CSV cells that mean a missing value.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed values. Season statistics from a raw payload: output column -> (type, payload fields, first usable wins).
SEASON_STATS_FIELDS: dict[str, tuple[str, list[str]]] = {
    "matches_played": ("int", ["Playing Time_MP", "MP", "matches", "Matches"]),
    "starts": ("int", ["Playing Time_Starts", "Starts", "starts"]),
    "minutes_played": ("int", ["Playing Time_Min", "Min", "minutes", "Minutes"]),
    "goals": ("int", ["Performance_Gls", "Gls", "goals", "Goals"]),
    "assists": ("int", ["Performance_Ast", "Ast", "assists", "Assists"]),
    "shots": ("int", ["Performance_Sh", "Sh", "shots", "Shots"]),
    "shots_on_target": ("int", ["Performance_SoT", "SoT", "shots_on_target"]),
    "xg": ("double", ["Expected_xG", "xG"]),
    "xa": ("double", ["Expected_xAG", "xAG", "xA"]),
    "progressive_passes": ("int", ["Progression_PrgP", "PrgP"]),
    "progressive_carries": ("int", ["Progression_PrgC", "PrgC"]),
    "key_passes": ("int", ["KP", "Passes_KP", "key_passes"]),
    "tackles": ("int", ["Tackles_Tkl", "Tkl", "tackles"]),
    "interceptions": ("int", ["Int", "interceptions"]),
    "blocks": ("int", ["Blocks_Blocks", "blocks"]),
    "clearances": ("int", ["Clr", "clearances"]),
    "aerial_duels_won": ("int", ["Aerial Duels_Won", "Won", "aerial_duels_won"]),
    "yellow_cards": ("int", ["Performance_CrdY", "CrdY", "yellow_cards"]),
    "red_cards": ("int", ["Performance_CrdR", "CrdR", "red_cards"]),
}
# Fixed values. Identity of a statistics row: output column -> (type, payload fields, first usable wins).
STATS_IDENTITY_FIELDS: dict[str, tuple[str, list[str]]] = {
    "player_name": ("string", ["Player", "player", "player_name"]),
    "nationality": ("string", ["Nation", "nation", "nationality"]),
    "age": ("int", ["Age", "age"]),
    "preferred_position": ("string", ["Pos", "position", "Position"]),
    "team_name": ("string", ["Squad", "Team", "team_name", "team"]),
    "competition_name": ("string", ["Comp", "competition", "league"]),
}

# The competitions and the season that the silver layer is built for.
TARGET_COMPETITIONS = ["Bundesliga", "La Liga", "Ligue 1", "Premier League", "Serie A"]
TARGET_SEASON = "2015/2016"
