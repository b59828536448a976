"""Data-quality checks. Each returns a frame; ``require_*`` raise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    refs = parent.select(*[F.col(p).alias(f"_{p}") for p in on.values()])
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    return child.filter(present).join(refs, [F.col(c) == F.col(f"_{p}") for c, p in on.items()], "left_anti")


def outside_domain(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values outside the allowed list with their counts; NULL is not a value."""
    return df.filter(~F.col(column).isin(*allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, nulls) for the columns that have NULLs, most first; one pass over the data."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("nulls")) for c in columns]))
    return (
        counted.select(pairs.alias("p")).select("p.*").filter(F.col("nulls") > 0).orderBy(F.desc("nulls"), "feature")
    )


def shares(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """Rows and share of each value, optionally within groups. NULL is not a value."""
    by = by or []
    counts = df.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("rows"))
    # the window runs over one row per value, not over the data
    total = F.sum("rows").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))
    return counts.withColumn("share", F.col("rows") / total)


def layer_counts(layers: dict[str, DataFrame], flag: Column | None = None) -> DataFrame:
    """(layer, rows, flagged): row conservation side by side, ``flag`` counted where it applies."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            (F.count_if(flag) if flag is not None else F.lit(None).cast("long")).alias("flagged"),
        ).select(F.lit(name).alias("layer"), "rows", "flagged")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: list[str]) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {missing}")


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")


def require_unique(df: DataFrame, keys: list[str]) -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicate keys on {keys}")


def require_domain(df: DataFrame, column: str, allowed: list[str]) -> None:
    bad = outside_domain(df, column, allowed)
    found = bad.agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).first()
    if found["n"]:
        examples = [r[column] for r in bad.orderBy(F.desc("rows"), column).limit(20).collect()]
        raise ValueError(f"{column} outside {allowed}: {found['n']} values in {found['rows']} rows, such as {examples}")


def require_no_nulls(df: DataFrame, columns: list[str]) -> None:
    nulls = {r.feature: r.nulls for r in null_counts(df, columns).collect()}
    if nulls:
        raise ValueError(f"NULLs found: {nulls}")
