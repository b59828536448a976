"""User-facing queries, for all matches or teams at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.functions.labels import comparison_shares, fair_odd, fair_odd_text, match_label, result_label
from pitchline.operators.history import last_n, team_perspective

LIST_COLUMNS = ["match_id", "match_date", "competition_name", "season_name", "home_team_name", "away_team_name", "home_score", "away_score"]
SUMMARY_COLUMNS = [*LIST_COLUMNS, "match_result"]
# The features that are compared, and how they are shown.
COMPARED = {  # shown metric -> home column, away column
    "Pontos médios últimos 5": ("home_last5_points_avg", "away_last5_points_avg"),
    "Win rate últimos 5": ("home_last5_win_rate", "away_last5_win_rate"),
    "Gols marcados médios": ("home_last5_goals_for_avg", "away_last5_goals_for_avg"),
    "Gols sofridos médios": ("home_last5_goals_against_avg", "away_last5_goals_against_avg"),
    "Saldo médio": ("home_last5_goal_diff_avg", "away_last5_goal_diff_avg"),
    "Pontos em casa/fora": ("home_home_last5_points_avg", "away_away_last5_points_avg"),
    "Finalizações médias": ("home_last5_shots_avg", "away_last5_shots_avg"),
    "Finalizações no alvo": ("home_last5_shots_on_target_avg", "away_last5_shots_on_target_avg"),
    "Jogadores distintos últimos 5": ("home_distinct_players_last5", "away_distinct_players_last5"),
}
SHARED = [m for m in COMPARED if m not in ("Win rate últimos 5", "Jogadores distintos últimos 5")]

# Fixed values. Insight texts: value, threshold, text when home leads, when away leads, when level.
INSIGHTS = [
    ("points", 0.5, "{home} chega com melhor forma recente em pontos.",
     "{away} chega com melhor forma recente em pontos.", "A forma recente em pontos indica equilíbrio."),
    ("goals", 0.3, "{home} apresenta melhor saldo recente de gols.",
     "{away} apresenta melhor saldo recente de gols.", "O saldo recente de gols está equilibrado."),
    ("on_target", 0.4, "{home} cria mais volume de chances no alvo.",
     "{away} cria mais volume de chances no alvo.", None),
    ("wins", 0.15, "{home} tem taxa de vitória recente superior.",
     "{away} tem taxa de vitória recente superior.", None),
]
# Risk levels of a coupon: lowest model probability each level accepts.
RISK_FLOOR = {"low": 0.55, "medium": 0.35, "high": 0.0}


def _newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("match_date"), F.desc("match_id"))


def match_list(matches: DataFrame) -> DataFrame:
    """All matches, newest first, with the label a picker shows."""
    label = match_label(F.col("match_date"), F.col("competition_name"), F.col("home_team_name"), F.col("away_team_name"))
    return _newest_first(matches).select(*LIST_COLUMNS, label.alias("label"))


def latest_matches(matches: DataFrame, n: int = 20) -> DataFrame:
    return _newest_first(matches.select("match_id", "match_date", "competition_name", "home_team_name", "away_team_name")).limit(n)


def by_match(df: DataFrame, match_id: int) -> DataFrame:
    """One row of a table keyed by match."""
    return df.filter(F.col("match_id") == match_id).limit(1)


def match_summary(matches: DataFrame, match_id: int) -> DataFrame:
    return by_match(matches.select(*SUMMARY_COLUMNS), match_id)


def team_matches(matches: DataFrame, team: str, n: int = 5) -> DataFrame:
    """Latest matches of one team, on either side."""
    mine = matches.filter((F.col("home_team_name") == team) | (F.col("away_team_name") == team))
    return _newest_first(mine).limit(n)


def recent_form(matches: DataFrame, n: int = 5) -> DataFrame:
    """Last ``n`` matches of every team, newest first, with the form letter from its side."""
    rows = last_n(team_perspective(matches), ["team_id"], n)
    return rows.select(
        "team_id", "team_name", "position", "match_id", "match_date", "is_home",
        "opponent_team_id", "goals_for", "goals_against", "form",
    )


def form_strip(matches: DataFrame, n: int = 5) -> DataFrame:
    """The letters of ``recent_form`` as one text per team, newest first; '-' without a score."""
    letters = F.sort_array(F.collect_list(F.struct("position", F.coalesce("form", F.lit("-")).alias("form"))))
    rows = recent_form(matches, n).groupBy("team_id", "team_name").agg(letters.alias("l"))
    return rows.select("team_id", "team_name", F.concat_ws("", F.transform("l", lambda x: x["form"])).alias("form"))


def comparison_table(features: DataFrame) -> DataFrame:
    """(match, metric, home value, away value) for every compared metric."""
    cells = [
        F.struct(F.lit(m).alias("metric"), F.col(h).cast("double").alias("home_value"), F.col(a).cast("double").alias("away_value"))
        for m, (h, a) in COMPARED.items()
    ]
    return features.select("match_id", "home_team_name", "away_team_name", F.explode(F.array(*cells)).alias("c")).select(
        "match_id", "home_team_name", "away_team_name", "c.*"
    )


def comparison_bars(features: DataFrame) -> DataFrame:
    """Bar widths of the metrics shown as bars."""
    rows = comparison_table(features).filter(F.col("metric").isin(*SHARED))
    return rows.select("match_id", "metric", "home_value", "away_value", comparison_shares(F.col("home_value"), F.col("away_value")).alias("s")).select(
        "match_id", "metric", "home_value", "away_value", "s.home_pct", "s.away_pct"
    )


def insights(features: DataFrame, most: int = 4) -> DataFrame:
    """Rule texts that apply to a match, in rule order, at most ``most``."""
    value = {
        "points": F.col("diff_points_avg"),
        "goals": F.col("diff_goal_diff_avg"),
        "on_target": F.col("diff_shots_on_target_avg"),
        "wins": F.col("home_last5_win_rate") - F.col("away_last5_win_rate"),
    }

    def fill(text: str | None) -> Column:
        if text is None:
            return F.lit(None).cast("string")
        side = "home" if "{home}" in text else "away"
        team = F.col(f"{side}_team_name")
        return F.replace(F.lit(text), F.lit("{" + side + "}"), team) if "{" in text else F.lit(text)

    rules = [
        F.when(value[v] > limit, fill(home)).when(value[v] < -limit, fill(away)).when(value[v].isNotNull(), fill(level))
        for v, limit, home, away, level in INSIGHTS
    ]
    texts = F.slice(F.array_compact(F.array(*rules)), 1, most)
    return features.select("match_id", F.posexplode(texts).alias("position", "insight"))


def with_odds(predictions: DataFrame) -> DataFrame:
    """Fair odds and label next to the class probabilities p_H, p_D, p_A."""
    return predictions.select(
        "*",
        *[fair_odd(F.col(f"p_{c}")).alias(f"odd_{c}") for c in "HDA"],
        *[fair_odd_text(F.col(f"p_{c}")).alias(f"odd_text_{c}") for c in "HDA"],
        result_label(F.col("prediction")).alias("prediction_label"),
    )


def recommendations(offers: DataFrame) -> DataFrame:
    """Offers (match, outcome, model_probability, market_odd) with their score, best first."""
    score = F.col("model_probability") * F.col("market_odd")
    return offers.withColumn("recommendation_score", score).orderBy(F.desc("recommendation_score"), "match_id", "outcome")


def coupon_picks(requests: DataFrame, offers: DataFrame) -> DataFrame:
    """Per request the best offers of its risk level, at most max_selections, and one outcome of a match.

    Requests list (user_id, target_risk, max_selections, match_ids). The list is exploded and
    joined to the offers, so the rows per user are those the user asked for. A first cut per
    (user, slice of matches) keeps one user's large list from meeting in a single task.
    """
    floor = F.create_map(*[F.lit(x) for kv in RISK_FLOOR.items() for x in kv])
    asked = requests.select("user_id", "target_risk", "max_selections", F.explode("match_ids").alias("match_id"))
    scored = offers.withColumn("recommendation_score", F.col("model_probability") * F.col("market_odd"))
    fit = asked.join(scored, "match_id").filter(
        F.col("model_probability") >= F.try_element_at(floor, F.col("target_risk"))
    )
    best = [F.desc("recommendation_score"), "match_id", "outcome"]
    fit = fit.withColumn("_slice", F.pmod(F.xxhash64("match_id"), F.lit(64)))
    for keys, most in ((["user_id", "match_id"], F.lit(1)), (["user_id", "_slice"], F.col("max_selections")), (["user_id"], F.col("max_selections"))):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        fit = fit.withColumn("position", place).filter(F.col("position") <= most)
    return fit.select(
        "user_id", "position", "match_id", "outcome", "model_probability", "market_odd", "recommendation_score"
    )


def coupons(picks: DataFrame) -> DataFrame:
    """One row per user: number of selections and total odd."""
    return picks.groupBy("user_id").agg(F.count(F.lit(1)).alias("selections"), F.product("market_odd").alias("total_odd"))


def shots_by_team(events: DataFrame, match_id: int | None = None) -> DataFrame:
    """Shots per team of one match, most first; of every match when none is named."""
    shots = events.filter(F.col("event_type_name") == "Shot")
    if match_id is not None:
        shots = shots.filter(F.col("match_id") == match_id)
    return (
        shots.groupBy("match_id", "team_name")
        .agg(F.count(F.lit(1)).alias("total_shots"))
        .orderBy("match_id", F.desc("total_shots"), "team_name")
    )


def export_rows(df: DataFrame, match_ids: list[int]) -> DataFrame:
    """Rows of the listed matches in match order, for a CSV export."""
    return df.filter(F.col("match_id").isin(*match_ids)).orderBy("match_id")
