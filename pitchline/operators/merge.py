"""Upserts, get-or-create and keyed lookups as joins and aggregations.

Merging is one grouped aggregation over target and updates together. The aggregates combine
on the map side, so a key that fills a third of the updates leaves one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.session import broadcast_if_few, written_down

REPLACE, COALESCE, KEEP = "replace", "coalesce", "keep"


def merge(
    target: DataFrame | None, updates: DataFrame, keys: list[str], order: list[str], mode: str = REPLACE
) -> DataFrame:
    """Target after the updates were applied in ``order``.

    replace: the last row of a key wins on every column. coalesce: the last non-NULL value
    wins column by column. keep: the first row of a key stays, target rows before updates.
    ``order`` columns belong to the updates only and are dropped; rows of equal order are
    told apart by a hash of their values, so the result does not depend on partitioning.
    """
    values = [c for c in updates.columns if c not in keys and c not in order]
    rank = F.struct(F.lit(1).alias("layer"), F.struct(*[F.col(c) for c in order]).alias("at"))
    rows = updates.select(*keys, *values, rank.alias("_rank"))
    if target is not None:
        nowhere = F.lit(None).cast(rows.schema["_rank"].dataType["at"].dataType)
        first = F.struct(F.lit(0).alias("layer"), nowhere.alias("at"))
        rows = target.select(*keys, *values, first.alias("_rank")).unionByName(rows)
    if not values:
        return rows.select(*keys).distinct()
    whole = F.struct(*[F.col(c) for c in values])
    tie = F.xxhash64(*values).alias("tie")
    if mode == COALESCE:
        picked = [
            F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("_rank", F.col(c).alias("tie")))).alias(c) for c in values
        ]
        return rows.groupBy(*keys).agg(*picked).select(*keys, *values)
    pick = F.min_by if mode == KEEP else F.max_by
    merged = rows.groupBy(*keys).agg(pick(whole, F.struct("_rank", tie)).alias("_row"))
    return merged.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])


def surrogate_key(*natural: Column) -> Column:
    """Stable key from the natural key: reruns give the same value."""
    return F.xxhash64(*natural)


def attach(rows: DataFrame, dimension: DataFrame, on: dict[str, str], value: str, alias: str) -> DataFrame:
    """Left lookup: ``alias`` is the smallest ``value`` of the matching dimension rows, else NULL.

    Reducing the dimension to one row per key first keeps the row count of ``rows``.
    """
    one = dimension.groupBy(*[F.col(d).alias(f"_{d}") for d in on.values()]).agg(F.min(value).alias(alias))
    condition = [F.col(r) == F.col(f"_{d}") for r, d in on.items()]
    return rows.join(one, condition, "left").drop(*[f"_{d}" for d in on.values()])


def attach_first(
    rows: DataFrame, dimension: DataFrame, attempts: list[dict[str, str]], value: str, alias: str
) -> DataFrame:
    """Lookup with fallbacks: the first attempt that finds a row decides."""
    names = [f"_try{i}" for i in range(len(attempts))]
    for name, on in zip(names, attempts):
        rows = attach(rows, dimension, on, value, name)
    return rows.withColumn(alias, F.coalesce(*names)).drop(*names)


def attach_distinct(rows: DataFrame, columns: list[str], lookup: Callable[[DataFrame], DataFrame], alias: str) -> DataFrame:
    """What ``lookup`` adds to rows as ``alias``, looked up once for each different value of ``columns`` (NULL is one): however
    many joins the lookup has, the rows meet its result in one."""
    found = lookup(rows.select(*columns).distinct()).select(*[F.col(c).alias(f"_of_{c}") for c in columns], alias)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns])
    return rows.join(broadcast_if_few(written_down(found)), same, "left").drop(*[f"_of_{c}" for c in columns])


def split_rejects(rows: DataFrame, reasons: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with the first ``reason`` that applies)."""
    reason = F.coalesce(*[F.when(bad, F.lit(text)) for text, bad in reasons.items()])
    marked = rows.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def run_counters(rows: DataFrame, status: Column) -> DataFrame:
    """How many rows ended in which state."""
    return rows.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("rows"))


def replace_slices(existing: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Delete-then-insert: existing rows of the slices present in the updates give way to them."""
    slices = updates.select(*keys).distinct()
    return existing.join(slices, keys, "left_anti").unionByName(updates)
