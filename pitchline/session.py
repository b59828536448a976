"""Session settings and lineage cutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "pitchline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here relies on (ANSI casts, UTC, AQE)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


PARTITION_BYTES = 1 << 20  # input files hold this many bytes for each shuffle partition before small ones are merged

BROADCAST_BYTES = "1m"  # a plan has some ten joins, and the driver holds each broadcast side several times over


def sized_settings(spark: SparkSession, folder: str) -> None:
    """UTC, and joins and shuffles that follow measured sizes instead of the sizes of compressed files.

    A file of a few MB can hold a million rows, which a broadcast collects in the driver: a side is broadcast only if its
    shuffle has measured it as small, and hashed in place of two sorts if its pieces are. Shuffles are cut by the size of the
    input and merged up to 8 MB a task.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": BROADCAST_BYTES,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "8m",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
    }.items():
        spark.conf.set(key, value)


def shuffle_pieces(spark: SparkSession) -> int:
    """Partitions of a shuffle before small ones are merged: they follow the size of the input (:func:`sized_settings`)."""
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; only where none is, one inside the warehouse, which is shared as well."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoint").rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, so that later passes read files and survive lost executors. Partitions and
    their order stay."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written_down(df: DataFrame) -> DataFrame:
    """As :func:`cut_lineage`, in compressed Parquet, of which later passes read the columns they need; partitions may change.

    A checkpoint holds whole rows without compression. A column without a type, which no file holds, is checkpointed.
    """
    if "void" in df.schema.simpleString():
        return cut_lineage(df)
    place = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


MEASURED_ROWS = 10_000  # rows of a few short columns that make about BROADCAST_BYTES


def broadcast_if_few(df: DataFrame) -> DataFrame:
    """A written frame as a broadcast side, if it was counted as small; joins with it then move no rows."""
    return F.broadcast(df) if df.limit(MEASURED_ROWS + 1).count() <= MEASURED_ROWS else df
