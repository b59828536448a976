"""Sharding by a consistent-hash ring with virtual nodes and bounded loads; the law is ``bytes``.

Every shard has ``NODES`` places on a ring of ``ARCS`` arcs, and a row's hash gives its arc. Arcs are offered to the shards
clockwise from them, larger ones first; a shard that would hold more than ``1 + SLACK`` times the mean is full, and the
arc continues clockwise to the next shard. So no shard exceeds its bound, and most arcs stay where they are when shards
are added or rows change. Only sums per arc leave the cluster: at most ``ARCS`` numbers and those of split arcs.

Large groups: an arc with more than ``1 / SPLIT`` of a mean shard (rows that repeat, or one very common row) is split into
sub-arcs by the rows' places, which go on clockwise one by one. Slots are numbered by counts per (shard, arc) added up,
and inside an arc, never over a whole shard in one task.

Cases: null texts have size 1 and checksum 0. Rows that repeat each get a slot. Null doc_ids are hashed like others. A
row larger than what any shard has left goes to the emptiest. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.llm.common import read_table, stored

SHARDS = 8
NODES = 256
ARC_BITS = 16
ARCS = 1 << ARC_BITS
SLACK = 0.002
SPLIT = 64


def ring(shards: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """Places on the ring in order, and the shard of each."""
    places = np.array([[xxhash.xxh64_intdigest(f"shard {s} node {v}") >> (64 - ARC_BITS) for v in range(nodes)] for s in range(shards)], np.int64)
    order = np.lexsort((np.repeat(np.arange(shards), nodes), places.ravel()))
    return places.ravel()[order], np.repeat(np.arange(shards), nodes)[order]


def clockwise(arc: int, places: np.ndarray, owners: np.ndarray, shards: int):
    """The shards in the order in which they follow the arc."""
    seen: set[int] = set()
    at = int(np.searchsorted(places, arc))
    for step in range(len(places)):
        shard = int(owners[(at + step) % len(places)])
        if shard not in seen:
            seen.add(shard)
            yield shard
            if len(seen) == shards:
                return


def assign(arcs: list[tuple[int, int, int]], shards: int, slack: float = SLACK) -> tuple[list[int], np.ndarray]:
    """Shard of each (arc, sub-arc, size), and the shards' loads."""
    places, owners = ring(shards)
    bound = (1 + slack) * sum(a[2] for a in arcs) / shards
    loads, out = np.zeros(shards, np.int64), [0] * len(arcs)
    for i in sorted(range(len(arcs)), key=lambda i: (-arcs[i][2], arcs[i][:2])):
        arc, _, size = arcs[i]
        shard = next((s for s in clockwise(arc, places, owners, shards) if loads[s] + size <= bound), None)
        out[i] = int(loads.argmin()) if shard is None else shard
        loads[out[i]] += size
    return out, loads


def shard_rows(docs: DataFrame, shards: int = SHARDS, slack: float = SLACK) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows.withColumn("arc", F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "size"), 64 - ARC_BITS).cast("int")), "sharded")
    sizes = rows.groupBy("arc").agg(F.sum("size").alias("size")).toArrow()  # at most ARCS rows
    by_arc = dict(zip(sizes.column("arc").to_pylist(), sizes.column("size").to_pylist()))
    share = max(1, sum(by_arc.values()) // (shards * SPLIT))
    splits = {arc: -(-size // share) for arc, size in by_arc.items() if size > share}  # at most shards * SPLIT
    parts = spark.createDataFrame(pa.table({"arc": pa.array(list(splits), pa.int32()), "parts": pa.array(list(splits.values()), pa.int64())}))
    sub = F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0)).cast("int")
    rows = rows.join(F.broadcast(parts), "arc", "left").withColumn("sub", sub).drop("parts")
    cells = rows.groupBy("arc", "sub").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).toArrow()  # at most ARCS and 2 * shards * SPLIT rows
    arc, part, size, n = (cells.column(c).to_pylist() for c in ("arc", "sub", "size", "n"))
    owner, _ = assign(list(zip(arc, part, size)), shards, slack)
    filled, before = [0] * shards, [0] * len(arc)
    for i in sorted(range(len(arc)), key=lambda i: (arc[i], part[i])):
        before[i] = filled[owner[i]]
        filled[owner[i]] += n[i]
    plan = spark.createDataFrame(pa.table({"arc": pa.array(arc, pa.int32()), "sub": pa.array(part, pa.int32()), "shard": pa.array(owner, pa.int32()), "before": pa.array(before, pa.int64())}))
    inside = F.row_number().over(Window.partitionBy("arc", "sub").orderBy("row")) - 1
    rows = rows.withColumn("inside", inside).join(F.broadcast(plan), ["arc", "sub"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("inside")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op4_ring_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_rows(read_table(spark, folder, "documents"))
