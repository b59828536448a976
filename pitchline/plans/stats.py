"""Statistics per match and team, per match and player, per player and season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions.casts import point
from pitchline.plans.inplay import ON_TARGET
from pitchline.schemas import (
    BAD_BEHAVIOUR_PAYLOAD,
    CARRY_PAYLOAD,
    CLEARANCE_PAYLOAD,
    DRIBBLE_PAYLOAD,
    DUEL_PAYLOAD,
    PASS_PAYLOAD,
    SHOT_PAYLOAD,
)

PROGRESS = 10.0  # a ball moved at least this far forward counts as progressive
COUNTED = [
    "goals", "shots", "shots_on_target", "passes_completed", "passes_attempted", "key_passes", "assists",
    "progressive_passes", "progressive_carries", "corners", "dribbles_completed", "tackles", "interceptions",
    "blocks", "clearances", "aerial_duels_won", "fouls_committed", "yellow_cards", "red_cards", "offsides",
]
TEAM_COUNTS = [c for c in COUNTED if c not in ("goals", "assists", "dribbles_completed")]
PLAYER_COUNTS = [c for c in COUNTED if c not in ("corners", "offsides")]
SEASON_COUNTS = [
    "goals", "assists", "shots", "shots_on_target", "progressive_passes", "progressive_carries", "key_passes",
    "tackles", "interceptions", "blocks", "clearances", "aerial_duels_won", "yellow_cards", "red_cards",
]


def parse_details(silver_events: DataFrame) -> DataFrame:
    """Flat columns out of the JSON sub-objects of silver events."""
    e = silver_events.select(
        "*",
        F.from_json("shot_payload", SHOT_PAYLOAD).alias("_shot"),
        F.from_json("pass_payload", PASS_PAYLOAD).alias("_pass"),
        F.from_json("carry_payload", CARRY_PAYLOAD).alias("_carry"),
        F.from_json("bad_behaviour_payload", BAD_BEHAVIOUR_PAYLOAD).alias("_card"),
        F.from_json("duel_payload", DUEL_PAYLOAD).alias("_duel"),
        F.from_json("dribble_payload", DRIBBLE_PAYLOAD).alias("_dribble"),
        F.from_json("clearance_payload", CLEARANCE_PAYLOAD).alias("_clearance"),
    )
    yes = lambda c: F.coalesce(F.col(c) == "true", F.lit(False))
    return e.withColumns(
        {
            "shot_outcome": F.col("_shot.outcome.name"),
            "shot_xg": F.col("_shot.statsbomb_xg").cast("decimal(19,18)"),
            "card": F.col("_card.card.name"),
            "pass_outcome": F.col("_pass.outcome.name"),
            "pass_goal_assist": yes("_pass.goal_assist"),
            "pass_shot_assist": yes("_pass.shot_assist"),
            "pass_type": F.col("_pass.type.name"),
            "duel_type": F.col("_duel.type.name"),
            "dribble_outcome": F.col("_dribble.outcome.name"),
            "aerial_won": yes("_clearance.aerial_won") | yes("_pass.aerial_won"),
            "end_location": F.coalesce("_pass.end_location", "_carry.end_location"),
        }
    ).drop("_shot", "_pass", "_carry", "_card", "_duel", "_dribble", "_clearance")


def _counts() -> list[Column]:
    kind = F.col("event_type_name")
    shot, passed = kind == "Shot", kind == "Pass"
    forward = point(F.col("end_location").cast("array<string>"))["x"] - point(F.col("location").cast("array<string>"))["x"]
    completed = passed & F.col("pass_outcome").isNull()
    rules = {
        "goals": shot & (F.col("shot_outcome") == "Goal"),
        "shots": shot,
        "shots_on_target": shot & F.col("shot_outcome").isin(*ON_TARGET),
        "passes_completed": completed,
        "passes_attempted": passed,
        "key_passes": passed & (F.col("pass_shot_assist") | F.col("pass_goal_assist")),
        "assists": passed & F.col("pass_goal_assist"),
        "progressive_passes": completed & (forward >= PROGRESS),
        "progressive_carries": (kind == "Carry") & (forward >= PROGRESS),
        "corners": passed & (F.col("pass_type") == "Corner"),
        "dribbles_completed": (kind == "Dribble") & (F.col("dribble_outcome") == "Complete"),
        "tackles": (kind == "Duel") & (F.col("duel_type") == "Tackle"),
        "interceptions": kind == "Interception",
        "blocks": kind == "Block",
        "clearances": kind == "Clearance",
        "aerial_duels_won": F.col("aerial_won"),
        "fouls_committed": kind == "Foul Committed",
        "yellow_cards": F.col("card") == "Yellow Card",
        "red_cards": F.col("card").isin("Red Card", "Second Yellow"),
        "offsides": kind == "Offside",
    }
    xg = F.coalesce(F.sum(F.when(shot, F.col("shot_xg").cast("decimal(19,18)"))), F.lit(0))
    return [F.count_if(rules[c]).alias(c) for c in COUNTED] + [xg.cast("decimal(38,18)").alias("xg")]


def team_stats(events: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per match and side. Possession is the share of the match's passes.

    Goals come from the score; a side without events has zeros.
    """
    per_team = events.filter(F.col("team_id").isNotNull()).groupBy("match_id", "team_id").agg(*_counts())

    def side(own: str, other: str) -> Column:
        return F.struct(
            F.col(f"{own}_team_id").alias("team_id"),
            F.col(f"{other}_team_id").alias("opponent_team_id"),
            F.lit(own == "home").alias("is_home"),
            F.coalesce(f"{own}_score", F.lit(0)).alias("goals_scored"),
            F.coalesce(f"{other}_score", F.lit(0)).alias("goals_conceded"),
        )

    sides = matches.select("match_id", F.explode(F.array(side("home", "away"), side("away", "home"))).alias("s"))
    rows = (
        sides.select("match_id", "s.*")
        .join(per_team.drop("goals", "assists", "dribbles_completed"), ["match_id", "team_id"], "left")
        .fillna(0, [*TEAM_COUNTS])
        .withColumn("xg", F.coalesce("xg", F.lit(0)))
    )
    passes = rows.groupBy("match_id").agg(F.sum("passes_attempted").alias("match_passes"))
    share = F.try_divide(F.col("passes_attempted") * 100, F.col("match_passes")).cast("decimal(5,2)")
    return rows.join(passes, "match_id").withColumn("possession_pct", share).drop("match_passes")


def player_stats(events: DataFrame, lineups: DataFrame) -> DataFrame:
    """One row per listed player of a match, players without events included."""
    keys = ["match_id", "team_id", "player_id"]
    seen = events.filter(F.col("team_id").isNotNull() & F.col("player_id").isNotNull())
    per_player = seen.groupBy(*keys).agg(*_counts())
    listed = lineups.groupBy(*keys).agg(
        F.max(F.coalesce("minutes_played", F.lit(0))).alias("minutes_played"), F.max("starter").alias("started")
    )
    return (
        listed.join(per_player.drop("corners", "offsides"), keys, "left")
        .fillna(0, PLAYER_COUNTS)
        .withColumn("xg", F.coalesce("xg", F.lit(0)))
    )


def season_stats(per_match: DataFrame, matches: DataFrame) -> DataFrame:
    """Match rows of a player summed by team, competition and season."""
    info = matches.select("match_id", "competition_id", "season_id")
    return (
        per_match.join(info, "match_id")
        .groupBy("player_id", "team_id", "competition_id", "season_id")
        .agg(
            F.count(F.lit(1)).alias("matches_played"),
            F.count_if("started").alias("starts"),
            F.sum("minutes_played").alias("minutes_played"),
            *[F.sum(c).alias(c) for c in SEASON_COUNTS],
            F.sum("xg").cast("decimal(38,18)").alias("xg"),
        )
    )
