"""Raw payloads -> curated slice -> typed silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions.casts import strict
from pitchline.functions.labels import match_result
from pitchline.functions.paths import base_name, match_id_from_file
from pitchline.schemas import EVENT_OBJECTS, EVENT_PAYLOAD, LINEUP_PAYLOAD, MATCH_PAYLOAD
from pitchline.session import written_down


def curated_matches(raw: DataFrame, competitions: list[str] | None = None, season: str | None = None) -> DataFrame:
    """Raw matches of the wanted competitions and season (all when not given), payload parsed as ``p``."""
    parsed = raw.withColumn("p", F.from_json("payload", MATCH_PAYLOAD))
    if competitions is not None:
        parsed = parsed.filter(F.col("p.competition.competition_name").isin(*competitions))
    if season is not None:
        parsed = parsed.filter(F.col("p.season.season_name") == season)
    return parsed


def _match_columns() -> dict[str, Column]:
    return {
        "match_id": F.col("p.match_id").cast("long"),
        "competition_id": strict(F.col("p.competition.competition_id"), "int"),
        "competition_name": F.col("p.competition.competition_name"),
        "season_id": strict(F.col("p.season.season_id"), "int"),
        "season_name": F.col("p.season.season_name"),
        "match_date": F.to_date("p.match_date", "yyyy-MM-dd"),
        "kick_off": F.col("p.kick_off"),
        "home_team_id": strict(F.col("p.home_team.home_team_id"), "long"),
        "home_team_name": F.col("p.home_team.home_team_name"),
        "away_team_id": strict(F.col("p.away_team.away_team_id"), "long"),
        "away_team_name": F.col("p.away_team.away_team_name"),
        "home_score": strict(F.col("p.home_score"), "int"),
        "away_score": strict(F.col("p.away_score"), "int"),
    }


def target_matches(curated: DataFrame) -> DataFrame:
    """Key columns of the slice plus the file name its events are stored under."""
    columns = {
        "match_id_text": F.col("p.match_id"),
        "match_file_name": F.concat("p.match_id", F.lit(".json")),
        **_match_columns(),
    }
    return curated.select(*[c.alias(n) for n, c in columns.items()])


def silver_matches(curated: DataFrame) -> DataFrame:
    """Typed matches; text that is no number fails the job."""
    columns = _match_columns()
    columns |= {
        "match_result": match_result(columns["home_score"], columns["away_score"]),
        "stadium_id": strict(F.col("p.stadium.id"), "long"),
        "stadium_name": F.col("p.stadium.name"),
        "referee_id": strict(F.col("p.referee.id"), "long"),
        "referee_name": F.col("p.referee.name"),
        "data_version": F.col("p.metadata.data_version"),
        "shot_fidelity_version": F.col("p.metadata.shot_fidelity_version"),
        "xy_fidelity_version": F.col("p.metadata.xy_fidelity_version"),
        "source_dataset": F.col("source_dataset"),
        "source_file": F.col("source_file"),
        "raw_payload": F.col("payload"),
    }
    return curated.select(*[c.alias(n) for n, c in columns.items()])


MEASURED_IDS = 200_000  # ids of unknown matches that a broadcast may hold


def curated_by_file(raw: DataFrame, targets: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Raw rows whose file belongs to a target match, with ``match_id``.

    Targets are unique by match id, so the join only filters. The ids of the files are read first: where few of them belong to
    no target, those are broadcast and payloads stay where they are; else payloads meet the targets by a shuffle. ``files`` holds
    at least the ``source_file`` of all rows, where that is cheaper to read than from ``raw``.
    """
    keyed = _match_of_file(raw.withColumn("normalized_source_file", base_name(F.col("source_file"))))
    ids = targets.select("match_id")
    unknown = written_down(_match_of_file(raw if files is None else files).select("match_id").distinct().join(ids, "match_id", "left_anti"))
    if unknown.count() <= MEASURED_IDS:
        return keyed.join(F.broadcast(unknown), "match_id", "left_anti")
    return keyed.join(ids, "match_id", "left_semi")


def _match_of_file(raw: DataFrame) -> DataFrame:
    return raw.withColumn("match_id", match_id_from_file(F.col("source_file"))).filter(F.col("match_id").isNotNull())


def target_events(raw: DataFrame, targets: DataFrame) -> DataFrame:
    """``silver_events(curated_by_file(raw, targets))`` for readers of some of its columns: payloads are parsed where they are
    read, and the join moves the fields that are wanted instead of the payload. Casts follow the join, so that bad text of
    other matches fails nothing."""
    fields = _event_fields(_match_of_file(raw))
    return _typed_events(fields.join(targets.select("match_id"), "match_id", "left_semi"))


def silver_events(curated: DataFrame) -> DataFrame:
    """One typed row per event; open-ended sub-objects stay JSON text."""
    return _typed_events(_event_fields(curated))


EVENT_FIELDS = {  # column -> field of the payload
    "event_id": "id", "event_index": "index", "period": "period", "event_timestamp": "timestamp", "minute": "minute", "second": "second",
    "possession": "possession", "possession_team_id": "possession_team.id", "possession_team_name": "possession_team.name",
    "play_pattern_id": "play_pattern.id", "play_pattern_name": "play_pattern.name", "team_id": "team.id", "team_name": "team.name",
    "player_id": "player.id", "player_name": "player.name", "position_id": "position.id", "position_name": "position.name",
    "event_type_id": "type.id", "event_type_name": "type.name", "duration": "duration", "under_pressure": "under_pressure",
    "off_camera": "off_camera", "out_of_play": "out", "location": "location",
    **{f"{name}_payload": name for name in EVENT_OBJECTS}, "bad_behaviour_payload": "bad_behaviour",
}
EVENT_TYPES = {
    "event_index": "int", "period": "int", "minute": "int", "second": "decimal(18,6)", "possession": "int", "possession_team_id": "long",
    "play_pattern_id": "int", "team_id": "long", "player_id": "long", "position_id": "int", "event_type_id": "int",
    "duration": "decimal(18,6)", "under_pressure": "boolean", "off_camera": "boolean", "out_of_play": "boolean",
}


def _event_fields(rows: DataFrame) -> DataFrame:
    """The payload's fields as they are written."""
    parsed = rows.withColumn("p", F.from_json("payload", EVENT_PAYLOAD))
    fields = [F.col(f"p.{path}").alias(name) for name, path in EVENT_FIELDS.items()]
    return parsed.select("match_id", *fields, "source_dataset", "source_file", F.col("payload").alias("raw_payload"))


def _typed_events(fields: DataFrame) -> DataFrame:
    typed = {c: strict(F.col(c), t) for c, t in EVENT_TYPES.items()}
    typed["event_timestamp"] = F.nullif(F.col("event_timestamp"), F.lit(""))
    order = ["event_id", "match_id", *[c for c in EVENT_FIELDS if c != "event_id"], "source_dataset", "source_file", "raw_payload"]
    return fields.select(*[typed.get(c, F.col(c)).alias(c) for c in order])


def silver_lineups(curated: DataFrame) -> DataFrame:
    """Lineup headers."""
    p = curated.withColumn("p", F.from_json("payload", LINEUP_PAYLOAD))
    return p.select(
        "match_id",
        strict(F.col("p.team_id"), "long").alias("team_id"),
        F.col("p.team_name").alias("team_name"),
        "source_dataset",
        "source_file",
        F.col("payload").alias("raw_payload"),
    )


def silver_lineup_players(curated: DataFrame) -> DataFrame:
    """One row per listed player; an absent or empty list gives none."""
    p = curated.withColumn("p", F.from_json("payload", LINEUP_PAYLOAD))
    # a plain explode gets a filter on its list, which Spark moves below the parsing and so parses each payload again
    x = p.select("match_id", "p.team_id", "p.team_name", F.posexplode_outer("p.lineup").alias("at", "x")).filter("at IS NOT NULL")
    return x.select(
        "match_id",
        strict(F.col("team_id"), "long").alias("team_id"),
        "team_name",
        strict(F.col("x.player_id"), "long").alias("player_id"),
        F.col("x.player_name").alias("player_name"),
        F.nullif(F.col("x.player_nickname"), F.lit("")).alias("player_nickname"),
        strict(F.col("x.jersey_number"), "int").alias("jersey_number"),
        strict(F.col("x.country.id"), "long").alias("country_id"),
        F.col("x.country.name").alias("country_name"),
        F.col("x.positions").alias("positions"),
        F.col("x.cards").alias("cards_payload"),
        F.to_json("x").alias("raw_player_payload"),
    )


def first_position(positions: Column) -> Column:
    """First listed position: name, starter flag, minutes.

    The starter flag is true for any non-empty start reason, substitutes included; minutes
    are to - from of that position and NULL unless both are whole numbers.
    """
    first = F.try_element_at(positions, F.lit(1))
    whole = lambda c: F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(c).try_cast("int"))
    return F.struct(
        first["position"].alias("position_name"),
        F.coalesce(first["start_reason"] != "", F.lit(False)).alias("starter"),
        (whole(first["to"]) - whole(first["from"])).alias("minutes_played"),
    )
