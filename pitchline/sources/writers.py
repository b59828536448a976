"""Payloads, table writes, CSV export."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _json_ready(value: Column, dtype: T.DataType) -> Column:
    """NaN to NULL and timestamps to ISO text (fraction only when there is one), at any depth."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = "yyyy-MM-dd'T'HH:mm:ss"
        exact = F.date_trunc("second", value) == value
        return F.when(exact, F.date_format(value, whole)).otherwise(F.date_format(value, whole + ".SSSSSS"))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _json_ready(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [_json_ready(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def row_payload(columns: list[str]) -> Column:
    """All columns of a row as one JSON object, NULL fields kept."""
    return F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in columns]), {"ignoreNullFields": "false"})


def to_payload(df: DataFrame) -> DataFrame:
    """One column ``payload``: the row as JSON, NaN as null, timestamps in ISO form."""
    clean = df.select(*[_json_ready(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
    return clean.select(row_payload(clean.columns).alias("payload"))


def rebuild(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Idempotent create-or-replace. The path must not be an input of ``df``."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def rebuild_sorted(df: DataFrame, path: str, key: str, partition_by: list[str] | None = None) -> None:
    """As :func:`rebuild`, in order of a key, with a Bloom filter of it in each row group: a scan for one key skips files
    and row groups by their bounds, and by the filter where bounds do not exclude it."""
    order = [*(partition_by or []), key]
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = rows.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{key}", "true")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_seasons(df: DataFrame, path: str) -> None:
    """Delete-then-insert by season: only the season folders present in ``df`` are rewritten."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("season_name")
        .parquet(path)
    )


def export_csv(df: DataFrame, path: str) -> bool:
    """CSV with header; an empty result writes nothing and warns."""
    if df.isEmpty():
        warnings.warn(f"no rows for {path}, nothing written", stacklevel=2)
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True
