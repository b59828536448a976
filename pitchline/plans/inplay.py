"""In-play features: one row per match and minute 1..90.

Events collapse to counts per (match, team, minute) before anything else is shuffled, so a
match with very many events leaves at most 180 rows. Grid rows of zeros are added by union,
one repartition by match follows, and the dense grid and the running windows reuse that
one partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.schemas import BAD_BEHAVIOUR_PAYLOAD, SHOT_PAYLOAD
from pitchline.session import shuffle_pieces

XG = "decimal(38,18)"  # sums do not depend on the order of addition
SHOT_XG = "decimal(19,18)"
ON_TARGET = ["Goal", "Saved", "Saved To Post"]  # fixed values: shot outcomes on target
COUNTS = ["goals", "shots", "shots_on_target", "xg", "fouls", "red_cards", "passes"]
TRAILING = ["shots", "shots_on_target", "xg"]
LAST_MINUTE = 90

MATCH_COLUMNS = [
    "match_id", "match_date", "competition_name", "season_name",
    "home_team_id", "home_team_name", "away_team_id", "away_team_name",
]
# feature of one side -> rolled-up column it comes from
SIDE = {
    "score_now": "goals_cum",
    "shots_cum": "shots_cum",
    "shots_on_target_cum": "shots_on_target_cum",
    "xg_cum": "xg_cum",
    "shots_last_10": "shots_last_10",
    "shots_on_target_last_10": "shots_on_target_last_10",
    "xg_last_10": "xg_last_10",
    "red_cards": "red_cards_cum",
    "fouls_cum": "fouls_cum",
    "passes_cum": "passes_cum",
}
DIFFS = [s for s in SIDE if s != "score_now"]
FEATURES = [
    "minute", "home_score_now", "away_score_now", "goal_diff_now",
    *[f"{side}_{s}" for s in DIFFS for side in ("home", "away")],
    *[f"diff_{s}" for s in DIFFS],
    "remaining_minutes",
]
DERIVED = [
    "is_draw_now", "abs_goal_diff_now", "minute_progress", "score_pressure",
    "late_game_draw", "xg_pressure_diff", "shots_pressure_diff", "passes_pressure_diff",
]


def filter_matches(matches: DataFrame, competitions: list[str] | None = None, season: str | None = None) -> DataFrame:
    """Matches of the wanted competitions and season; all when not given."""
    if competitions is not None:
        matches = matches.filter(F.col("competition_name").isin(*competitions))
    if season is not None:
        matches = matches.filter(F.col("season_name") == season)
    return matches.select(*MATCH_COLUMNS, "home_score", "away_score", "match_result")


def parse_event_objects(silver_events: DataFrame) -> DataFrame:
    """shot_outcome, shot_xg and card out of the JSON sub-objects of silver events."""
    shot = F.from_json("shot_payload", SHOT_PAYLOAD)
    behaviour = F.from_json("bad_behaviour_payload", BAD_BEHAVIOUR_PAYLOAD)
    return (
        silver_events.withColumn("shot_outcome", shot["outcome"]["name"])
        .withColumn("shot_xg", shot["statsbomb_xg"].cast(SHOT_XG))
        .withColumn("card", behaviour["card"]["name"])
    )


def minute_counts(
    events: DataFrame, matches: DataFrame, minutes: tuple[int, int] = (1, LAST_MINUTE), red_cards: Column | None = None
) -> DataFrame:
    """Counts per (match, team, minute). A missing minute is 0 and so out of range.

    ``red_cards`` replaces the default rule (type Card with a red-card payload).
    """
    shot = F.col("event_type_name") == "Shot"
    if red_cards is None:
        red_cards = (F.col("event_type_name") == "Card") & (F.col("card") == "Red Card")
    minute = F.coalesce("minute", F.lit(0))
    inside = events.filter(minute.between(*minutes)).join(matches.select("match_id"), "match_id", "left_semi")
    return inside.groupBy("match_id", "team_id", minute.alias("minute")).agg(
        F.count_if(shot & (F.col("shot_outcome") == "Goal")).alias("goals"),
        F.count_if(shot).alias("shots"),
        F.count_if(shot & F.col("shot_outcome").isin(*ON_TARGET)).alias("shots_on_target"),
        F.coalesce(F.sum(F.when(shot, F.col("shot_xg").cast(SHOT_XG))), F.lit(0)).cast(XG).alias("xg"),
        F.count_if(F.col("event_type_name") == "Foul Committed").alias("fouls"),
        F.count_if(red_cards).alias("red_cards"),
        F.count_if(F.col("event_type_name") == "Pass").alias("passes"),
    )


def _type(name: str) -> str:
    return XG if name.startswith(("xg", "home_xg", "away_xg")) else "long"


def _dense(counts: DataFrame, matches: DataFrame, names: list[str], extra_keys: list[str]) -> DataFrame:
    """Union of ``counts`` with zero rows for minutes 1..90, summed, partitioned by match.

    ``matches`` carries match_id and ``extra_keys``; the one repartition serves every later
    step, because all of them group or window within a match.
    """
    keys = ["match_id", *extra_keys, "minute"]
    grid = matches.select("match_id", *extra_keys, F.explode(F.sequence(F.lit(1), F.lit(LAST_MINUTE))).alias("minute"))
    zeros = grid.select(*keys, *[F.expr(f"CAST(0 AS {_type(c)}) AS {c}") for c in names])
    # a fixed number of partitions: rows of zeros shrink so far that pieces merged by their bytes would hold millions
    both = zeros.unionByName(counts.select(*keys, *names)).repartition(shuffle_pieces(matches.sparkSession), "match_id")
    return both.groupBy(*keys).agg(*[F.expr(f"CAST(sum({c}) AS {_type(c)}) AS {c}") for c in names])


def team_minute_grid(counts: DataFrame, matches: DataFrame) -> DataFrame:
    """90 rows for both teams of every match, gaps filled with 0.

    Counts of teams that do not play the match, NULL included, fall away.
    """
    teams = matches.select("match_id", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    played = counts.join(teams, ["match_id", "team_id"], "left_semi")
    return _dense(played, teams, COUNTS, ["team_id"])


def _rolled(names: list[str], trailing: list[str], keys: str) -> list[Column]:
    """Running and trailing ten-minute sums; all frames share one partitioning and one sort."""

    def total(name: str, frame: str, alias: str) -> Column:
        window = f"PARTITION BY {keys} ORDER BY minute ROWS BETWEEN {frame} PRECEDING AND CURRENT ROW"
        return F.expr(f"CAST(sum({name}) OVER ({window}) AS {_type(name)}) AS {alias}")

    return [total(c, "UNBOUNDED", f"{c}_cum") for c in names] + [total(c, "9", f"{c}_last_10") for c in trailing]


def rollups(grid: DataFrame) -> DataFrame:
    """Running totals and trailing ten-minute totals per (match, team)."""
    return grid.select("match_id", "team_id", "minute", *_rolled(COUNTS, TRAILING, "match_id, team_id"))


def paired_rollups(counts: DataFrame, matches: DataFrame) -> DataFrame:
    """The same totals with home and away side by side: half the rows to sort, no join after."""
    sides = matches.select("match_id", "home_team_id", "away_team_id")
    names = [f"{side}_{c}" for c in COUNTS for side in ("home", "away")]
    contributions = [
        F.expr(f"CAST(CASE WHEN team_id = {side}_team_id THEN {c} ELSE 0 END AS {_type(c)}) AS {side}_{c}")
        for c in COUNTS
        for side in ("home", "away")
    ]
    found = counts.join(sides, "match_id").select("match_id", "minute", *contributions)
    trailing = [f"{side}_{c}" for c in TRAILING for side in ("home", "away")]
    return _dense(found, sides, names, []).select("match_id", "minute", *_rolled(names, trailing, "match_id"))


def features(paired: DataFrame, matches: DataFrame) -> DataFrame:
    """Home and away values, differences, remaining minutes and the final result."""
    values = {f"{side}_{name}": f"{side}_{source}" for name, source in SIDE.items() for side in ("home", "away")}

    def difference(name: str) -> str:
        return f"CAST({values[f'home_{name}']} - {values[f'away_{name}']} AS {_type(name)})"

    info = matches.select(*MATCH_COLUMNS, F.col("match_result").alias("target_result_final"))
    return paired.join(info, "match_id").selectExpr(
        *MATCH_COLUMNS,
        "minute",
        *[f"{column} AS {name}" for name, column in values.items()],
        f"{difference('score_now')} AS goal_diff_now",
        *[f"{difference(name)} AS diff_{name}" for name in DIFFS],
        f"{LAST_MINUTE} - minute AS remaining_minutes",
        "target_result_final",
    )


def build(events: DataFrame, matches: DataFrame, competitions: list[str] | None = None, season: str | None = None) -> DataFrame:
    """Whole job: events need shot_outcome, shot_xg and card (see parse_event_objects)."""
    wanted = filter_matches(matches, competitions, season)
    return features(paired_rollups(minute_counts(events, wanted), wanted), wanted)


def derive(df: DataFrame) -> DataFrame:
    """Columns the calibration models add."""
    level = F.col("goal_diff_now") == 0
    progress = F.col("minute") / 90.0
    real = lambda c: F.col(c).cast("double")
    return df.select(
        "*",
        level.cast("int").alias("is_draw_now"),
        F.abs("goal_diff_now").alias("abs_goal_diff_now"),
        progress.alias("minute_progress"),
        (real("goal_diff_now") * progress).alias("score_pressure"),
        (level & (F.col("minute") >= 60)).cast("int").alias("late_game_draw"),
        (real("diff_xg_last_10") * progress).alias("xg_pressure_diff"),
        (real("diff_shots_last_10") * progress).alias("shots_pressure_diff"),
        (real("diff_passes_cum") * progress).alias("passes_pressure_diff"),
    )
