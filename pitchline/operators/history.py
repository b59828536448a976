"""What a team did before a match.

A window over a team's whole history would put a team with a third of all matches into one
task. Rows are therefore dealt by ranges of (team, date, match): a prefix scan in segments. Each range is windowed by
itself, and the last ``n`` rows of a team in a range are carried to its next ones. A range cuts at most one team, so what is
carried is one row for each team and range, and a team's longest list is the number of ranges.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchline.functions.labels import form_letter
from pitchline.session import written_down

BLOCK_DAYS = 30


def team_perspective(matches: DataFrame) -> DataFrame:
    """Two rows per match, one from each side; results are NULL without a score."""

    def side(own: str, other: str, is_home: bool):
        return F.struct(
            F.col(f"{own}_team_id").alias("team_id"),
            F.col(f"{own}_team_name").alias("team_name"),
            F.col(f"{other}_team_id").alias("opponent_team_id"),
            F.lit(is_home).alias("is_home"),
            F.col(f"{own}_score").alias("goals_for"),
            F.col(f"{other}_score").alias("goals_against"),
        )

    sides = F.explode(F.array(side("home", "away", True), side("away", "home", False)))
    rows = matches.select("match_id", "match_date", "competition_name", "season_name", sides.alias("s")).select(
        "match_id", "match_date", "competition_name", "season_name", "s.*"
    )
    letter = form_letter(F.col("goals_for"), F.col("goals_against"))
    return (
        rows.withColumn("form", letter)
        .withColumn("win", (F.col("form") == "W").cast("int"))
        .withColumn("draw", (F.col("form") == "D").cast("int"))
        .withColumn("loss", (F.col("form") == "L").cast("int"))
        .withColumn("points", F.col("win") * 3 + F.col("draw"))
    )


def with_recent(
    rows: DataFrame,
    keys: list[str],
    payload: list[str],
    n: int = 5,
    date: str = "match_date",
    tie: str = "match_id",
    ranges: int | None = None,
) -> DataFrame:
    """Adds ``played_before`` and ``recent``: up to ``n`` earlier rows of the key, oldest first.

    Order is (date, tie); the row itself and anything later are excluded. Rows without a date or a key have no
    history and are in nobody else's.
    """
    fields = list(dict.fromkeys([date, tie, *payload]))
    group = [*keys, "_range"]
    inside = Window.partitionBy(*group).orderBy(date, tie)
    item = F.struct(*fields)
    placed = reduce(and_, [F.col(c).isNotNull() for c in [*keys, date]])
    ranges = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written down, so that every use sees the same ranges
    dealt = written_down(rows.filter(placed).repartitionByRange(ranges, *keys, date, tie).withColumn("_range", F.spark_partition_id()))
    last = (
        dealt.select(*group, *[c for c in fields if c not in group])
        .withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(date), F.desc(tie))))
        .filter(F.col("_r") <= n)
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list(item)).alias("_last"))
    )
    sizes = dealt.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    across = Window.partitionBy(*keys).orderBy("_range")
    carried = sizes.join(last, group).select(
        *group,
        F.flatten(F.collect_list("_last").over(across.rowsBetween(-n, -1))).alias("_carry"),
        F.coalesce(F.sum("_size").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    local = dealt.withColumn("_in", F.collect_list(item).over(inside.rowsBetween(-n, -1))).withColumn(
        "_pos", F.row_number().over(inside)
    )
    joined = local.join(carried, group, "left")
    seen = F.concat("_carry", "_in")
    whole = joined.withColumn("recent", F.slice(seen, F.greatest(F.size(seen) - n + 1, F.lit(1)), n)).withColumn(
        "played_before", (F.col("_before") + F.col("_pos") - 1).cast("long")
    )
    whole = whole.select(*rows.columns, "recent", "played_before")
    unplaced = rows.filter(~F.coalesce(placed, F.lit(False)))
    return whole.unionByName(
        unplaced.withColumn("recent", F.array().cast(whole.schema["recent"].dataType)).withColumn("played_before", F.lit(0).cast("long"))
    )


def mean_of(field: str, over: str = "recent"):
    """Mean of one field over the recent rows, NULLs skipped; NULL without any value."""
    values = f"filter(transform({over}, r -> r.{field}), v -> v IS NOT NULL)"
    return F.expr(f"try_divide(CAST(aggregate({values}, 0L, (a, v) -> a + v) AS DOUBLE), CAST(size({values}) AS DOUBLE))")


def last_n(rows: DataFrame, keys: list[str], n: int, date: str = "match_date", tie: str = "match_id") -> DataFrame:
    """The ``n`` newest rows per key. Spark trims every map task to ``n`` rows per key and block
    before the first shuffle, so a hot key leaves at most ``n`` rows per block for the second."""
    rows = rows.withColumn("_block", F.floor(F.unix_date(date) / BLOCK_DAYS))
    newest = [F.desc(date), F.desc(tie)]
    for group in ([*keys, "_block"], keys):
        rows = rows.withColumn("position", F.row_number().over(Window.partitionBy(*group).orderBy(*newest))).filter(
            F.col("position") <= n
        )
    return rows.drop("_block")
