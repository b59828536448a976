"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Only where the session names none, a folder inside its warehouse is set (the warehouse is shared as well).
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = sc._jsc.sc().getCheckpointDir()
        folder = known.get() if known.isDefined() else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoint"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def new_name(name: str) -> str:
    """A column name that no input has."""
    return f"{name}_{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors, keeps column pruning."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """Tells the texts of rows with one doc_id apart (null and empty differ)."""
    return F.xxhash64(F.coalesce(text, F.lit("\0null")), F.length(text))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Batches between Spark and Python end at some bytes: 10,000 texts would be held outside the heap, and again in Python."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


SLICE_ROWS = 500  # rows whose values are Python objects at once
SLICE_BYTES = 32 << 20


def batch_rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """Values of the columns, some rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            yield tuple(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns)


def bounded_rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """The same with a bound of bytes as well: a slice is small, or a single row."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, SLICE_ROWS)
            while part.num_rows > 1 and part.nbytes > SLICE_BYTES:
                part = part.slice(0, part.num_rows // 2)
            yield tuple(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns)
            at += part.num_rows
