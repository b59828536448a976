"""Positions in a global order without sorting everything into one task.

A split point is found by counting, not by numbering rows: one grouped count per day, then
histograms over the tie-breaking id inside the one day that holds the point. Rows are then
labelled by comparing them with literals, with no shuffle.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass
from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096


def kth_smallest(df: DataFrame, column: str, k: int) -> int:
    """k-th smallest (from 0) of an integer column, by narrowing histograms of at most BINS bins."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = -(-(high - low + 1) // BINS)
        inside = df.filter(F.col(column).between(low, high))
        # decimals: the span of 64-bit ids does not fit 64 bits
        bin_of = F.expr(f"(CAST(`{column}` AS DECIMAL(38, 0)) - CAST({low} AS DECIMAL(38, 0))) DIV {width}BD")
        counts = inside.groupBy(bin_of.alias("bin")).count().orderBy("bin").collect()
        for row in counts:
            if k < row["count"]:
                low = low + row["bin"] * width
                high = min(high, low + width - 1)
                break
            k -= row["count"]
    return low


@dataclass(frozen=True)
class Cut:
    """Rows before (day, id) come before the split point."""

    day: Date | None
    id: int | None

    def before(self, day: Column, ident: Column) -> Column:
        if self.day is None:
            return F.lit(True)
        return (day < F.lit(self.day)) | ((day == F.lit(self.day)) & (ident < F.lit(self.id)))


def cut_at(keys: DataFrame, positions: list[int], day: str = "match_date", ident: str = "match_id") -> list[Cut]:
    """The row at each position of the order (day, id); a position past the end cuts nothing off.

    ``keys`` holds one row per id. The per-day counts are bounded by the calendar.
    """
    days = keys.groupBy(day).count().orderBy(day).collect()
    cuts = []
    for position in positions:
        rest = position
        for row in days:
            if rest < row["count"]:
                same_day = keys.filter(F.col(day) == F.lit(row[day]))
                cuts.append(Cut(row[day], kth_smallest(same_day, ident, rest)))
                break
            rest -= row["count"]
        else:
            cuts.append(Cut(None, None))
    return cuts


def _floor_share(n: int, share: float) -> int:
    """int(n * share) with binary floating point, as the split rule is defined."""
    return math.floor(n * share)


def split_by_rows(df: DataFrame, train: float = 0.70, valid_end: float = 0.85) -> DataFrame:
    """70/15/15 by (match_date, match_id); one row per match expected. Rows without a date or id get no split."""
    return _label(df, df.select("match_date", "match_id"), train, valid_end)


def split_by_match(df: DataFrame, train: float = 0.70, valid: float = 0.15, minimum: int = 10) -> DataFrame:
    """Split where all rows of a match go to the same side; fewer than ``minimum`` matches is an error."""
    keys = df.select("match_date", "match_id").dropna().distinct()
    n = keys.count()
    if n < minimum:
        raise ValueError(f"{n} matches are too few for a time split, {minimum} needed")
    return _label(df, keys, train, train + valid, n)


def _label(df: DataFrame, keys: DataFrame, train: float, valid_end: float, n: int | None = None) -> DataFrame:
    keys = keys.dropna()
    n = keys.count() if n is None else n
    first, second = cut_at(keys, [_floor_share(n, train), _floor_share(n, valid_end)])
    day, ident = F.col("match_date"), F.col("match_id")
    split = F.when(first.before(day, ident), "train").when(second.before(day, ident), "valid").otherwise("test")
    return df.withColumn("split", F.when(day.isNotNull() & ident.isNotNull(), split))


# ---------------------------------------------------------------- medians

DIGIT = 10  # bits that one round of the selection decides
_INFINITE, _NAN = 0x7FF << 52, 0x7FF8 << 48


def order_key(value: Column) -> Column:
    """64-bit number in the order of doubles: the bits of the absolute value, negative for negative ones; NULL for NULL.

    NaN comes last, both zeros are 0.
    """
    a = F.abs(value)
    rough = F.floor(F.log2(a))
    power = lambda e: F.pow(F.lit(2.0), e)  # exact for powers of two
    exponent = F.when(power(rough) > a, rough - 1).when((rough < 1023) & (power(rough + 1) <= a), rough + 1).otherwise(rough)
    normal = (exponent + 1023) * F.lit(1 << 52) + ((a / power(exponent) - 1) * F.lit(float(1 << 52))).cast("long")
    bits = (
        F.when(F.isnan(a), F.lit(_NAN)).when(a == float("inf"), F.lit(_INFINITE)).when(a == 0, F.lit(0).cast("long"))
        .when(a < 2.0**-1022, (a / 2.0**-1074).cast("long")).otherwise(normal)
    )
    return F.when(value.isNotNull(), F.when(value < 0, -bits).otherwise(bits))


def value_of_key(key: int) -> float:
    return math.copysign(struct.unpack(">d", struct.pack(">q", abs(key)))[0], key)


def kth_of_all(df: DataFrame, columns: list[str], places: dict[str, list[int]], digit: int = DIGIT) -> dict[str, list[float]]:
    """Values at the given places (from 0) in the order of each column, NULLs skipped: radix selection.

    Each round counts, for all columns at once, the next bits of those keys that agree with a wanted value so far. A
    column is done when what is left is one value. At most 2**digit counts a wanted value come to the driver.
    """
    values = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    long = df.select(F.explode(values).alias("x")).select("x.*").where("v IS NOT NULL").select("i", order_key(F.col("v")).alias("key"))
    wanted = {(i, k): (0, k) for i, c in enumerate(columns) for k in places.get(c, [])}  # prefix so far, place within it
    found: dict[tuple[int, int], float] = {}
    bits = 0
    while wanted:
        shift = max(0, 64 - bits - digit)
        if bits:
            known = {i: sorted({p for (j, _), (p, _) in wanted.items() if j == i}) for i in {i for i, _ in wanted}}
            prefixes = F.create_map(*[x for i, ps in known.items() for x in (F.lit(i), F.array(*[F.lit(p).cast("long") for p in ps]))])
            inside = long.where(F.array_contains(F.try_element_at(prefixes, F.col("i")), F.shiftright("key", 64 - bits)))
        else:
            inside = long.where(F.col("i").isin(sorted({i for i, _ in wanted})))
        counted = inside.groupBy("i", F.shiftright("key", shift).alias("prefix")).agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"))
        counts: dict[int, list] = {}
        for r in sorted(map(tuple, counted.collect())):
            counts.setdefault(r[0], []).append(r)
        rest = {}
        for (i, k), (prefix, place) in wanted.items():
            for _, p, rows, low, high in counts[i]:
                if bits and p >> (64 - bits - shift) != prefix:
                    continue
                if place < rows:
                    if low == high:
                        found[i, k] = value_of_key(low)
                    else:
                        rest[i, k] = (p, place)
                    break
                place -= rows
        wanted, bits = rest, 64 - shift
    return {c: [found[i, k] for k in places.get(c, [])] for i, c in enumerate(columns)}


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Exact median per numeric column, NULLs skipped; None without any value."""
    counts = df.agg(*[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)]).first()
    places = {c: sorted({(counts[i] - 1) // 2, counts[i] // 2}) for i, c in enumerate(columns) if counts[i]}
    middle = kth_of_all(df, columns, places)
    return {c: (middle[c][0] + middle[c][-1]) / 2 if c in places else None for c in columns}
