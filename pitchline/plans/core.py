"""Silver -> keyed core tables: dimensions, players, lineups, events, season statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions.casts import lenient_double, lenient_int, point
from pitchline.functions.text import simple_name
from pitchline.operators.merge import COALESCE, KEEP, REPLACE, attach, attach_distinct, attach_first, merge, split_rejects, surrogate_key
from pitchline.plans.silver import first_position
from pitchline.schemas import (
    DEFAULT_STATS_SEASON,
    EVENT_PAYLOAD,
    LINEUP_PAYLOAD,
    PASS_PAYLOAD,
    SEASON_STATS_FIELDS,
    STATS_IDENTITY_FIELDS,
)
from pitchline.functions.paths import match_id_text
from pitchline.session import broadcast_if_few, written_down

SOURCE = "statsbomb"
OTHER_SOURCE = "fbref"


def competitions(matches: DataFrame) -> DataFrame:
    rows = matches.select(
        F.lit(SOURCE).alias("source_name"),
        F.col("competition_id").cast("string").alias("source_competition_id"),
        "competition_name",
    ).distinct()
    key = surrogate_key(F.col("source_name"), F.col("source_competition_id"))
    return rows.select(key.alias("competition_id"), "*")


def seasons(matches: DataFrame) -> DataFrame:
    """One season per competition and name, with its first and last match day."""
    comp = surrogate_key(F.lit(SOURCE), F.col("competition_id").cast("string"))
    rows = matches.groupBy(comp.alias("competition_id"), "season_name").agg(
        F.min(F.col("season_id").cast("string")).alias("source_season_id"),
        F.min("match_date").alias("season_start_date"),
        F.max("match_date").alias("season_end_date"),
    )
    key = surrogate_key(F.col("competition_id"), F.col("season_name"))
    return rows.select(key.alias("season_id"), F.lit(SOURCE).alias("source_name"), "*")


def _team_rows(source: str, ident: Column, name: Column) -> list[Column]:
    return [
        F.lit(source).alias("source_name"),
        ident.cast("string").alias("source_team_id"),
        name.alias("team_name"),
        simple_name(name).alias("normalized_team_name"),
    ]


def _keyed_teams(rows: DataFrame) -> DataFrame:
    return rows.select(surrogate_key(F.col("normalized_team_name")).alias("team_id"), "*")


def teams(matches: DataFrame) -> DataFrame:
    """Teams of both sides, one row per normalized name; the smallest source id is kept."""
    sides = F.explode(
        F.array(*[F.struct(F.col(f"{s}_team_id").alias("id"), F.col(f"{s}_team_name").alias("name")) for s in ("home", "away")])
    )
    rows = matches.select(sides.alias("t")).select(*_team_rows(SOURCE, F.col("t.id"), F.col("t.name")), F.col("t.id").alias("_at"))
    return _keyed_teams(merge(None, rows, ["normalized_team_name"], ["_at"], KEEP))


def add_teams(existing: DataFrame, names: DataFrame, column: str = "team_name") -> DataFrame:
    """Get-or-create: teams of another source that no existing name covers are appended."""
    wanted = names.filter(F.col(column).isNotNull() & (F.col(column) != "")).select(
        *_team_rows(OTHER_SOURCE, F.lit(None), F.col(column)), F.col(column).alias("_at")
    )
    return _keyed_teams(merge(existing.drop("team_id"), wanted, ["normalized_team_name"], ["_at"], KEEP))


def coaches(names: DataFrame, column: str = "coach_name") -> DataFrame:
    rows = names.filter(F.col(column).isNotNull()).select(
        F.col(column).alias("coach_name"), simple_name(F.col(column)).alias("normalized_coach_name"), F.col(column).alias("_at")
    )
    one = merge(None, rows, ["normalized_coach_name"], ["_at"], KEEP)
    return one.select(surrogate_key(F.col("normalized_coach_name")).alias("coach_id"), "*")


def matches(silver: DataFrame) -> DataFrame:
    """Core matches: surrogate keys follow from the natural keys, so no lookup is needed."""
    comp = surrogate_key(F.lit(SOURCE), F.col("competition_id").cast("string"))
    text = F.col("match_id").cast("string")
    return silver.select(
        surrogate_key(F.lit(SOURCE), text).alias("match_id"),
        F.lit(SOURCE).alias("source_name"),
        text.alias("source_match_id"),
        comp.alias("competition_id"),
        surrogate_key(comp, F.col("season_name")).alias("season_id"),
        "match_date",
        F.try_to_timestamp(F.concat_ws(" ", F.date_format("match_date", "yyyy-MM-dd"), "kick_off"), F.lit("yyyy-MM-dd HH:mm:ss.SSS")).alias("match_datetime"),
        "stadium_name",
        "referee_name",
        surrogate_key(simple_name(F.col("home_team_name"))).alias("home_team_id"),
        surrogate_key(simple_name(F.col("away_team_name"))).alias("away_team_id"),
        "home_score",
        "away_score",
        F.lit("played").alias("status"),
    )


def in_target(raw: DataFrame, core_matches: DataFrame, via: str = "left_semi") -> DataFrame:
    """Raw rows whose file names a known match (or, with left_anti, those that do not)."""
    ids = core_matches.filter(F.col("source_name") == SOURCE).select("source_match_id")
    return raw.withColumn("source_match_id", match_id_text(F.col("source_file"))).join(ids, "source_match_id", via)


def find_team(rows: DataFrame, team_dimension: DataFrame, source_id: str, name: str, alias: str = "core_team_id") -> DataFrame:
    """Team by source id, else by normalized name; NULL when neither is known."""
    by_id = team_dimension.filter(F.col("source_name") == SOURCE).select(
        F.col("source_team_id"), F.lit(None).cast("string").alias("normalized_team_name"), "team_id"
    )
    keyed = rows.withColumn("_id", F.col(source_id).cast("string")).withColumn(
        "_name", F.nullif(simple_name(F.col(name)), F.lit(""))
    )
    keyed = attach(keyed, by_id, {"_id": "source_team_id"}, "team_id", "_by_id")
    keyed = attach(keyed, team_dimension, {"_name": "normalized_team_name"}, "team_id", "_by_name")
    return keyed.withColumn(alias, F.coalesce("_by_id", "_by_name")).drop("_id", "_name", "_by_id", "_by_name")


def find_player(rows: DataFrame, players: DataFrame, name: str, alias: str = "core_player_id") -> DataFrame:
    """Player by normalized name only; the source id is not used."""
    keyed = rows.withColumn("_name", F.nullif(simple_name(F.col(name)), F.lit("")))
    return attach(keyed, players, {"_name": "normalized_player_name"}, "player_id", alias).drop("_name")


def find_season(
    rows: DataFrame, season_dimension: DataFrame, competition_dimension: DataFrame,
    season: str = "season_name", competition: str = "competition_name", value: str = "season_id",
    alias: str = "core_season_id",
) -> DataFrame:
    """Season by (season, exact competition name), else the season of that name with the smallest ``value``."""
    named = season_dimension.join(competition_dimension.select("competition_id", "competition_name"), "competition_id")
    return attach_first(
        rows, named,
        [{season: "season_name", competition: "competition_name"}, {season: "season_name"}],
        value, alias,
    )


def find_named_season(
    rows: DataFrame, season_name: str, season_dimension: DataFrame, competition_dimension: DataFrame,
    competition: str = "competition_name", alias: str = "core_season_id",
) -> DataFrame:
    """:func:`find_season` where all rows are of one season: the dimension is filtered first and met by competition alone, and
    the season that decides elsewhere is one value."""
    named = season_dimension.filter(F.col("season_name") == season_name).join(competition_dimension.select("competition_id", "competition_name"), "competition_id")
    other = named.agg(F.min("season_id")).first()[0]
    return attach(rows, named, {competition: "competition_name"}, "season_id", "_own").withColumn(alias, F.coalesce("_own", F.lit(other))).drop("_own")


def find_competition(rows: DataFrame, competition_dimension: DataFrame, name: str = "competition_name", alias: str = "core_competition_id") -> DataFrame:
    """Competition by name in any letter case."""
    keyed = rows.withColumn("_low", F.lower(name))
    lowered = competition_dimension.withColumn("_name_low", F.lower("competition_name"))
    return attach(keyed, lowered, {"_low": "_name_low"}, "competition_id", alias).drop("_low")


def insert_players(existing: DataFrame | None, lineup_players: DataFrame) -> DataFrame:
    """Insert-if-absent by normalized name; the first appearance (smallest source id) is kept."""
    first = first_position(F.col("positions"))
    rows = lineup_players.select(
        simple_name(F.col("player_name")).alias("normalized_player_name"),
        "player_name",
        F.lit(None).cast("int").alias("age"),
        F.col("country_name").alias("nationality"),
        first["position_name"].alias("preferred_position"),
        F.col("player_id").alias("_at"),
    )
    base = None if existing is None else existing.drop("player_id")
    return _keyed_players(merge(base, rows, ["normalized_player_name"], ["_at"], KEEP))


def player_key(name: Column) -> Column:
    return surrogate_key(simple_name(name))


def _keyed_players(rows: DataFrame) -> DataFrame:
    return rows.select(surrogate_key(F.col("normalized_player_name")).alias("player_id"), "*")


def parse_stats_payload(raw: DataFrame) -> DataFrame:
    """Identity and season figures of a raw statistics payload; alternative field names are tried in turn."""
    usable = F.map_filter(F.from_json("payload", "map<string,string>"), lambda _, v: ~v.isin("", "nan", "NaN"))
    cells = raw.select("raw_fbref_player_id", usable.alias("m"))
    cast = {"string": lambda c: c, "int": lenient_int, "double": lenient_double}

    def read(dtype: str, names: list[str]) -> Column:
        return cast[dtype](F.coalesce(*[F.try_element_at("m", F.lit(n)) for n in names]))

    wanted = {**STATS_IDENTITY_FIELDS, **SEASON_STATS_FIELDS}
    return cells.select("raw_fbref_player_id", *[read(t, names).alias(n) for n, (t, names) in wanted.items()])


def merge_players(existing: DataFrame | None, parsed: DataFrame) -> DataFrame:
    """Player merge from statistics: new values win unless they are NULL."""
    rows = parsed.filter(F.col("player_name").isNotNull()).select(
        simple_name(F.col("player_name")).alias("normalized_player_name"),
        "player_name", "age", "nationality", "preferred_position",
        F.col("raw_fbref_player_id").alias("_at"),
    )
    base = None if existing is None else existing.drop("player_id")
    return _keyed_players(merge(base, rows, ["normalized_player_name"], ["_at"], COALESCE))


def season_stats(
    existing: DataFrame | None, parsed: DataFrame, team_dimension: DataFrame,
    season_dimension: DataFrame, competition_dimension: DataFrame, season_name: str = DEFAULT_STATS_SEASON,
) -> tuple[DataFrame, DataFrame]:
    """(season statistics by (player, team, season), rejected rows).

    The player merge has created every named player, so the player key follows from the name.
    """
    rows = parsed.withColumn("core_player_id", player_key(F.col("player_name")))
    rows = rows.withColumn("_team", F.nullif(simple_name(F.col("team_name")), F.lit("")))
    rows = attach(rows, team_dimension, {"_team": "normalized_team_name"}, "team_id", "core_team_id").drop("_team")
    rows = find_competition(rows, competition_dimension)
    rows = find_named_season(rows, season_name, season_dimension, competition_dimension)
    good, rejects = split_rejects(
        rows,
        {
            "no player name": F.col("player_name").isNull(),
            "unknown team": F.col("core_team_id").isNull(),
            "unknown season": F.col("core_season_id").isNull(),
        },
    )
    updates = good.select(
        F.col("core_player_id").alias("player_id"),
        F.col("core_team_id").alias("team_id"),
        F.col("core_season_id").alias("season_id"),
        F.col("core_competition_id").alias("competition_id"),
        *SEASON_STATS_FIELDS,
        F.col("raw_fbref_player_id").alias("_at"),
    )
    return merge(existing, updates, ["player_id", "team_id", "season_id"], ["_at"], REPLACE), rejects


def lineups(
    existing: DataFrame | None, raw: DataFrame, core_matches: DataFrame, team_dimension: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(lineups by (match, team, player), raw lineups whose match or team is unknown).

    Payloads are parsed once and written down; teams are looked up by their different names, matches as in :func:`_match_keys`.
    Listed players are inserted before (insert_players), so the player key follows from the name.
    """
    keyed = raw.withColumn("source_match_id", match_id_text(F.col("source_file")))
    keyed = keyed.withColumn("p", F.from_json("payload", LINEUP_PAYLOAD)).select("*", "p.team_id", "p.team_name", "p.lineup").drop("p")
    keyed = written_down(keyed)
    found = _match_keys(keyed, keyed, core_matches, "core_match_id")
    found = attach_distinct(found, ["team_id", "team_name"], lambda d: find_team(d, team_dimension, "team_id", "team_name"), "core_team_id")
    good, rejects = split_rejects(
        found, {"unknown match": F.col("core_match_id").isNull(), "unknown team": F.col("core_team_id").isNull()}
    )
    order = "raw_lineup_id" if "raw_lineup_id" in raw.columns else "source_file"
    listed = good.select("core_match_id", "core_team_id", order, F.posexplode_outer("lineup").alias("at", "x")).filter("at IS NOT NULL")
    listed = listed.select("*", F.col("x.player_name").alias("player_name"), first_position(F.col("x.positions")).alias("first"))
    updates = listed.select(
        F.col("core_match_id").alias("match_id"),
        F.col("core_team_id").alias("team_id"),
        player_key(F.col("player_name")).alias("player_id"),
        "first.position_name",
        "first.starter",
        lenient_int(F.col("x.jersey_number")).alias("jersey_number"),
        "first.minutes_played",
        F.col(order).alias("_file"),
        F.col("at").alias("_at"),
    )
    return merge(existing, updates, ["match_id", "team_id", "player_id"], ["_file", "_at"], REPLACE), rejects


def _match_keys(rows: DataFrame, source: DataFrame, core_matches: DataFrame, alias: str) -> DataFrame:
    """The key of the match that a file's id names, which follows from the id (:func:`matches`); NULL where it is not known.

    Only ids of no known match are looked up, taken from ``source``, so that rows do not move while those are few."""
    ours = core_matches.filter(F.col("source_name") == SOURCE)
    unknown = source.select(F.col("source_match_id").alias("_unknown")).distinct().join(ours, F.col("_unknown") == F.col("source_match_id"), "left_anti")
    rows = rows.join(broadcast_if_few(written_down(unknown)), F.col("source_match_id") == F.col("_unknown"), "left")
    known = F.col("source_match_id").isNotNull() & F.col("_unknown").isNull()
    return rows.withColumn(alias, F.when(known, surrogate_key(F.lit(SOURCE), F.col("source_match_id")))).drop("_unknown")


def match_events(
    existing: DataFrame | None, raw: DataFrame, core_matches: DataFrame, team_dimension: DataFrame, players: DataFrame,
    payload: bool = True, of_match: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(events by (source, event id), last raw id wins; rejected raw events by their ids and reason).

    Payloads are parsed once and their fields written down. Lookups and the choice of the last row run on ids and names alone,
    teams and players by their different names; the match key follows from the file's id (:func:`matches`), so only files of
    no known match are looked up. The payload (``raw_payload``, unless ``payload`` is off) and the other columns
    join the chosen rows once, and rows of ``existing`` that no new row replaces pass through one anti-join. ``of_match`` has
    further columns by ``match_id``, which the chosen ids meet before the payloads do; events of a match it lacks are left out.
    """
    keyed = raw.withColumn("source_match_id", match_id_text(F.col("source_file"))).withColumn(
        "p", F.from_json("payload", EVENT_PAYLOAD)
    )
    end = F.from_json("p.pass", PASS_PAYLOAD)["end_location"]
    start_xy, end_xy = point(F.col("p.location")), point(end)
    flat = keyed.select(
        "source_match_id",
        "raw_event_id",
        F.lit(SOURCE).alias("source_name"),
        F.col("p.id").alias("source_event_id"),
        F.col("p.team.id").alias("_team_source_id"),
        F.col("p.team.name").alias("_team_name"),
        F.col("p.player.name").alias("_player_name"),
        lenient_int(F.col("p.index")).alias("event_index"),
        lenient_int(F.col("p.period")).alias("period"),
        lenient_int(F.col("p.minute")).alias("minute"),
        lenient_double(F.col("p.second")).alias("second"),
        lenient_int(F.col("p.possession")).alias("possession"),
        F.col("p.type.name").alias("event_type_name"),
        F.col("p.play_pattern.name").alias("play_pattern_name"),
        F.col("p.possession_team.name").alias("possession_team_name"),
        F.col("p.position.name").alias("position_name"),
        F.col("p.timestamp").alias("event_timestamp"),
        F.col("p.under_pressure").try_cast("boolean").alias("under_pressure"),
        F.col("p.off_camera").try_cast("boolean").alias("off_camera"),
        F.col("p.out").try_cast("boolean").alias("out_of_play"),
        start_xy["x"].alias("start_x"),
        start_xy["y"].alias("start_y"),
        end_xy["x"].alias("end_x"),
        end_xy["y"].alias("end_y"),
        *([F.col("payload").alias("raw_payload")] if payload else []),
        F.xxhash64("payload").alias("_tie"),
    )
    flat = written_down(flat)
    names = ["source_match_id", "_team_source_id", "_team_name", "_player_name"]
    key, version = ["source_name", "source_event_id"], ["raw_event_id", "_tie"]
    found = attach_distinct(
        flat.select(*key, *version, *names), ["_team_source_id", "_team_name"],
        lambda d: find_team(d, team_dimension, "_team_source_id", "_team_name", "team_id"), "team_id",
    )
    found = attach_distinct(found, ["_player_name"], lambda d: find_player(d, players, "_player_name", "player_id"), "player_id")
    found = _match_keys(found, flat, core_matches, "match_id")
    good, rejects = split_rejects(
        found, {"unknown match": F.col("match_id").isNull(), "no event id": F.col("source_event_id").isNull()}
    )
    last = good.groupBy(*key).agg(F.max(F.struct(*version, "match_id", "team_id", "player_id")).alias("last")).select(*key, "last.*")
    if of_match is not None:
        last = last.join(of_match, "match_id")
    if existing is not None:
        last = written_down(last)  # read by two joins
    events = flat.drop(*names).join(last, [*key, *version]).dropDuplicates([*key, *version]).drop(*version)
    if existing is not None:
        kept = existing.join(last.select(*key), key, "left_anti")
        events = kept.select(*events.columns).unionByName(events)
    return events, rejects


def source_players(players: DataFrame, core_lineups: DataFrame, team_dimension: DataFrame) -> DataFrame:
    """Distinct (player, team) pairs that appear in lineups."""
    pairs = core_lineups.select("player_id", "team_id").distinct()
    return (
        pairs.join(players.select("player_id", "player_name"), "player_id")
        .join(team_dimension.select("team_id", "team_name"), "team_id")
        .select("player_id", "player_name", "team_name")
        .distinct()
    )


def stats_players(
    stats: DataFrame, players: DataFrame, team_dimension: DataFrame, season_dimension: DataFrame, season_name: str
) -> DataFrame:
    """Distinct (player, team) pairs with statistics in the season."""
    wanted = season_dimension.filter(F.col("season_name") == season_name).select("season_id")
    pairs = stats.join(wanted, "season_id", "left_semi").select("player_id", "team_id").distinct()
    return (
        pairs.join(players.select("player_id", "player_name"), "player_id")
        .join(team_dimension.select("team_id", "team_name"), "team_id")
        .select("player_id", "player_name", "team_name")
        .distinct()
    )
