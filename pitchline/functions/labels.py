"""Labels, codes, thresholds and display values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Result codes of the in-play model, mapping thresholds, display labels.
INPLAY_CODES = {"H": 0, "D": 1, "A": 2}
PREGAME_CODES = {"A": 0, "D": 1, "H": 2}
AUTO_APPROVE_SCORE = 95.0
REVIEW_SCORE = 85.0
RESULT_LABELS = {"H": "Vitória mandante", "D": "Empate", "A": "Vitória visitante"}


def match_result(home: Column, away: Column) -> Column:
    """H, A or D; a missing score counts as D."""
    return F.when(home > away, "H").when(home < away, "A").otherwise("D")


def result_code(label: Column, codes: dict[str, int]) -> Column:
    out = F.lit(None).cast("int")
    for name, code in codes.items():
        out = F.when(label == name, F.lit(code)).otherwise(out)
    return out


def result_label(code: Column) -> Column:
    """Display text of a result code; unknown codes stay as they are."""
    out = code
    for name, text in RESULT_LABELS.items():
        out = F.when(code == name, F.lit(text)).otherwise(out)
    return out


def form_letter(goals_for: Column, goals_against: Column) -> Column:
    """W, D or L from one team's side; NULL without a score."""
    return F.when(goals_for > goals_against, "W").when(goals_for == goals_against, "D").when(
        goals_for < goals_against, "L"
    )


def mapping_status(score: Column) -> Column:
    return (
        F.when(score >= AUTO_APPROVE_SCORE, "auto_approved")
        .when(score >= REVIEW_SCORE, "needs_review")
        .otherwise("low_confidence")
    )


def fair_odd(probability: Column) -> Column:
    """1/p, NULL when p is missing or not positive."""
    return F.when(probability > 0, 1 / probability)


def two_decimals(value: Column) -> Column:
    """Two decimals of a number from 1 on, rounded half to even on its exact binary value.

    Its fraction is a whole number of steps of 2**-52, so integers hold it exactly. Other numbers are formatted by
    their shortest decimal text.
    """
    whole = F.floor(value)
    steps = ((value - whole) * float(1 << 52)).cast("long") * 100
    cents, rest, half = F.shiftright(steps, 52), steps.bitwiseAND(F.lit((1 << 52) - 1)), F.lit(1 << 51)
    up = (rest > half) | ((rest == half) & (cents % 2 == 1))
    total = whole * 100 + cents + F.when(up, 1).otherwise(0)
    text = F.concat(F.floor(total / 100).cast("string"), F.lit("."), F.lpad((total % 100).cast("string"), 2, "0"))
    return F.when((value >= 1) & (value < 1e12), text).otherwise(F.format_string("%.2f", value))


def fair_odd_text(probability: Column) -> Column:
    """Two decimals, '-' when there is no odd."""
    return F.when(probability > 0, two_decimals(1 / probability)).otherwise("-")


def comparison_shares(home: Column, away: Column) -> Column:
    """Bar widths in percent: (home_pct, away_pct), each at least 8, 50/50 when both are zero."""
    h, a = F.abs(F.coalesce(home, F.lit(0.0))), F.abs(F.coalesce(away, F.lit(0.0)))
    total = h + a
    share = F.floor(F.try_divide(h, total) * 100).cast("int")
    home_pct = F.when(total == 0, 50).otherwise(F.greatest(F.lit(8), share))
    away_pct = F.when(total == 0, 50).otherwise(F.greatest(F.lit(8), 100 - home_pct))
    return F.struct(home_pct.alias("home_pct"), away_pct.alias("away_pct"))


def match_label(date: Column, competition: Column, home: Column, away: Column) -> Column:
    return F.concat_ws(" | ", F.date_format(date, "yyyy-MM-dd"), competition, F.concat_ws(" vs ", home, away))
