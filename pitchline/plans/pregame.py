"""Pre-game features: only what happened before a match may enter its row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions.text import folded_name
from pitchline.operators.history import mean_of, team_perspective, with_recent
from pitchline.plans.inplay import ON_TARGET

FORM = {  # feature -> field of the earlier match it averages
    "last5_points_avg": "points",
    "last5_win_rate": "win",
    "last5_draw_rate": "draw",
    "last5_loss_rate": "loss",
    "last5_goals_for_avg": "goals_for",
    "last5_goals_against_avg": "goals_against",
}
VENUE = {k: FORM[k] for k in ("last5_points_avg", "last5_goals_for_avg", "last5_goals_against_avg")}
LINEUP_SUMS = ["xg", "xag", "shots", "shots_on_target", "tackles", "interceptions", "blocks"]
STATS_SOURCE = {"shots": "shots_total"}  # lineup sum -> statistics column, where names differ

TEAM_FEATURES = [
    "matches_played_before", "days_since_last_match", *FORM, "last5_goal_diff_avg",
    "distinct_players_last5", "last5_shots_avg", "last5_shots_on_target_avg",
    *[f"lineup_{s}_sum" for s in LINEUP_SUMS], "goalkeeper_save_pct", "fbref_matched_players",
]
DIFFS = {  # difference -> team feature
    "diff_points_avg": "last5_points_avg",
    "diff_win_rate": "last5_win_rate",
    "diff_goals_for_avg": "last5_goals_for_avg",
    "diff_goals_against_avg": "last5_goals_against_avg",
    "diff_goal_diff_avg": "last5_goal_diff_avg",
    "diff_shots_avg": "last5_shots_avg",
    "diff_shots_on_target_avg": "last5_shots_on_target_avg",
}
DERIVED_DIFFS = {
    "diff_days_rest": "days_since_last_match",
    "diff_lineup_xg": "lineup_xg_sum",
    "diff_lineup_xag": "lineup_xag_sum",
    "diff_lineup_shots": "lineup_shots_sum",
    "diff_lineup_shots_on_target": "lineup_shots_on_target_sum",
    "diff_goalkeeper_save_pct": "goalkeeper_save_pct",
}
DEFENSE = ["tackles", "interceptions", "blocks"]
NUMERIC_FEATURES = [
    *[f"{side}_{t}" for t in TEAM_FEATURES for side in ("home", "away")],
    *[f"{side}_{side}_{v}" for v in VENUE for side in ("home", "away")],
    *DIFFS, *DERIVED_DIFFS, "diff_home_strength", "diff_lineup_defense",
]
CATEGORICAL_FEATURES = ["competition_name"]
TARGETS = ["target_result", "target_home_win", "target_draw", "target_away_win", "target_over_25", "target_btts"]
MATCH_COLUMNS = [
    "match_id", "match_date", "competition_name", "season_name",
    "home_team_id", "home_team_name", "away_team_id", "away_team_name",
]


def history(matches: DataFrame, n: int = 5) -> DataFrame:
    """Per (match, team): form over the last ``n`` matches, earlier matches, days of rest,
    and ``recent`` for joins to what those matches held."""
    rows = with_recent(team_perspective(matches), ["team_id"], ["is_home", *dict.fromkeys(FORM.values())], n)
    last = F.try_element_at("recent", F.lit(-1))
    rows = rows.select(
        *["match_id", "match_date", "team_id", "is_home", "recent"],
        F.col("played_before").alias("matches_played_before"),
        F.datediff("match_date", last["match_date"]).alias("days_since_last_match"),
        *[mean_of(field).alias(name) for name, field in FORM.items()],
    )
    return rows.withColumn("last5_goal_diff_avg", F.col("last5_goals_for_avg") - F.col("last5_goals_against_avg"))


def venue_history(matches: DataFrame, n: int = 5) -> DataFrame:
    """Form over the last ``n`` matches at the same venue, home matches for the home side."""
    rows = with_recent(team_perspective(matches), ["team_id", "is_home"], list(VENUE.values()), n)
    return rows.select("match_id", "team_id", "is_home", *[mean_of(f).alias(f"venue_{v}") for v, f in VENUE.items()])


def recent_links(hist: DataFrame) -> DataFrame:
    """One row per (match, team, earlier match), at most five per team and match."""
    r = hist.select("match_id", "team_id", F.explode("recent").alias("r"))
    return r.select("match_id", "team_id", F.col("r.match_id").alias("earlier_id"), F.col("r.is_home").alias("was_home"))


def distinct_players(links: DataFrame, lineup_players: DataFrame) -> DataFrame:
    """Different players a team used in its linked matches; 0 without any."""
    used = lineup_players.select(F.col("match_id").alias("earlier_id"), "team_id", "player_id").distinct()
    return (
        links.select("match_id", "team_id", "earlier_id")
        .join(used, ["earlier_id", "team_id"])
        .groupBy("match_id", "team_id")
        .agg(F.count_distinct("player_id").alias("distinct_players_last5"))
    )


def match_shots(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Shots of both sides for every match that has any event."""
    shot = F.col("event_type_name") == "Shot"
    per_team = events.groupBy("match_id", "team_id").agg(
        F.count_if(shot).alias("shots"),
        F.count_if(shot & F.col("shot_outcome").isin(*ON_TARGET)).alias("on_target"),
    )
    sides = matches.select("match_id", "home_team_id", "away_team_id")

    def side(name: str, column: str) -> Column:
        own = F.col("team_id") == F.col(f"{name}_team_id")
        return F.sum(F.when(own, F.col(column)).otherwise(0)).alias(f"{name}_{column}")

    return (
        per_team.join(sides, "match_id")
        .groupBy("match_id")
        .agg(*[side(n, c) for n in ("home", "away") for c in ("shots", "on_target")])
    )


def recent_shots(links: DataFrame, shots: DataFrame) -> DataFrame:
    """Average shots over the linked matches; matches without events do not count."""
    known = links.join(shots.withColumnRenamed("match_id", "earlier_id"), "earlier_id")

    def mean(column: str) -> Column:
        own = F.when(F.col("was_home"), F.col(f"home_{column}")).otherwise(F.col(f"away_{column}"))
        return F.sum(own).cast("double") / F.count(own)

    return known.groupBy("match_id", "team_id").agg(
        mean("shots").alias("last5_shots_avg"), mean("on_target").alias("last5_shots_on_target_avg")
    )


def lineup_strength(lineup_players: DataFrame, stats: DataFrame) -> DataFrame:
    """Sums of season statistics over the listed players of a (match, team).

    Players meet their statistics on the folded name. Statistics are reduced to one row per
    name first (sums over clubs, best save percentage), so a common name cannot multiply
    lineup rows.
    """
    source = {s: STATS_SOURCE.get(s, s) for s in LINEUP_SUMS}
    money = "decimal(28,6)"  # exact sums, whatever the order of addition
    by_name = (
        stats.filter(F.col("normalized_player_name").isNotNull())
        .groupBy("normalized_player_name")
        .agg(
            *[F.sum(F.col(c).cast("decimal(18,6)")).cast(money).alias(s) for s, c in source.items()],
            F.max(F.when(F.col("pos").contains("GK"), F.col("save_pct"))).alias("save_pct"),
        )
    )
    listed = (
        lineup_players.groupBy("match_id", "team_id", "player_id", "player_name")
        .agg(F.lit(1).alias("one"))
        .withColumn("normalized_player_name", folded_name(F.col("player_name")))
    )
    return (
        listed.join(by_name, "normalized_player_name")
        .groupBy("match_id", "team_id")
        .agg(
            *[F.sum(s).cast("double").alias(f"lineup_{s}_sum") for s in LINEUP_SUMS],
            F.max("save_pct").alias("goalkeeper_save_pct"),
            F.count_distinct("player_id").alias("fbref_matched_players"),
        )
    )


def targets(matches: DataFrame) -> DataFrame:
    """What the models predict; NULL without a score."""
    h, a = F.col("home_score"), F.col("away_score")
    known = h.isNotNull() & a.isNotNull()
    return matches.select(
        "match_id",
        F.when(known, F.col("match_result")).alias("target_result"),
        (h > a).alias("target_home_win"),
        (h == a).alias("target_draw"),
        (h < a).alias("target_away_win"),
        (h + a > 2.5).alias("target_over_25"),
        F.when(known, (h > 0) & (a > 0)).alias("target_btts"),
    )


def add_derived(df: DataFrame) -> DataFrame:
    """Differences the training job adds. Only the defence difference reads NULL as 0."""

    def defense(side: str) -> str:
        return " + ".join(f"coalesce({side}_lineup_{s}_sum, 0D)" for s in DEFENSE)

    return df.withColumns(
        {
            **{name: F.expr(f"home_{source} - away_{source}") for name, source in DERIVED_DIFFS.items()},
            "diff_home_strength": F.expr("home_home_last5_points_avg - away_away_last5_points_avg"),
            "diff_lineup_defense": F.expr(f"({defense('home')}) - ({defense('away')})"),
        }
    )


def build(matches: DataFrame, events: DataFrame, lineup_players: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per match: keys, 63 numeric features, targets."""
    hist = history(matches)
    links = recent_links(hist)
    team = ["match_id", "team_id"]
    per_team = (
        hist.drop("recent", "match_date")
        .join(venue_history(matches).drop("is_home"), team)
        .join(distinct_players(links, lineup_players), team, "left")
        .join(recent_shots(links, match_shots(events, matches)), team, "left")
        .join(lineup_strength(lineup_players, stats), team, "left")
        .fillna(0, ["distinct_players_last5", "fbref_matched_players"])
    )

    def of(side: str, column: str, name: str) -> Column:
        return F.expr(f"max(CASE WHEN is_home = {side == 'home'} THEN {column} END) AS {name}")

    wide = per_team.groupBy("match_id").agg(
        *[of(side, t, f"{side}_{t}") for t in TEAM_FEATURES for side in ("home", "away")],
        *[of(side, f"venue_{v}", f"{side}_{side}_{v}") for v in VENUE for side in ("home", "away")],
    )
    diffs = {name: F.expr(f"home_{t} - away_{t}") for name, t in DIFFS.items()}
    rows = wide.join(matches.select(*MATCH_COLUMNS), "match_id").join(targets(matches), "match_id")
    return add_derived(rows.withColumns(diffs)).select(*MATCH_COLUMNS, *NUMERIC_FEATURES, *TARGETS)


def short_form(df: DataFrame) -> DataFrame:
    """The smaller feature table: the same values under its own names, four decimals."""
    keep = ["points_avg", "goals_for_avg", "goals_against_avg", "win_rate"]
    number = lambda c: F.col(c).cast("decimal(10,4)")
    return df.select(
        "match_id", "match_date", "home_team_id", "away_team_id",
        *[number(f"{side}_last5_{k}").alias(f"{side}_last5_{k}") for side in ("home", "away") for k in keep],
        number("diff_points_avg").alias("form_diff"),
        number("diff_goals_for_avg").alias("goals_diff"),
        number("diff_goals_against_avg").alias("defense_diff"),
        F.col("home_days_since_last_match").alias("home_days_rest"),
        F.col("away_days_since_last_match").alias("away_days_rest"),
        F.col("diff_days_rest").alias("days_rest_diff"),
        *TARGETS[1:],
    )


def enough_history(df: DataFrame, matches: int = 5, players: int = 6) -> DataFrame:
    """Rows where both sides have played enough and enough listed players have statistics."""
    return df.filter(
        (F.col("home_matches_played_before") >= matches)
        & (F.col("away_matches_played_before") >= matches)
        & (F.col("home_fbref_matched_players") >= players)
        & (F.col("away_fbref_matched_players") >= players)
    )
