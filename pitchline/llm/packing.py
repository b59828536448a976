"""Best-fit decreasing packing of token sequences, with a segment tree over remaining capacities.

Longer documents are cut into pieces of the full length; the first piece is the shorter one. Pieces of one length are
interchangeable, so the placing needs only how many pieces each length has (at most ``capacity`` numbers, whatever the
table's size). Lengths are placed in decreasing order: the tree has a leaf for each remaining capacity that says
whether open bins have it, and finds the tightest that fits in logarithmic time. Bins with equal capacity are kept as
ranges of bin numbers, so that one step places many pieces. The result is the one that piece-by-piece best fit gives.

Each piece then gets its rank among the pieces of its length (counts of small groups, added up, no global sort), and
the plan's ranges map (length, rank) to a bin and a place. The plan depends on the distinct lengths only.

Cases: null is empty, and an empty document is the end id alone. Rows that repeat are packed each. Null doc_ids are
kept. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.llm.common import batch_rows, read_table, stored
from pitchline.llm.word_ids import tokenizer, vocabulary_path

CAPACITY = 2048
END_ID = 0
RANK_GROUP = 50_000  # pieces of one length that are ranked together, about

Range = tuple[int, int, int, int, int]  # first rank, pieces, first bin, pieces a bin, place in the bin


class CapacityTree:
    """Which remaining capacities have open bins; finds the smallest that is at least a given one."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, value: bool) -> None:
        at = capacity + self.leaves
        self.open[at] = value
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        at = least + self.leaves
        if self.open[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def best_fit(counts: dict[int, int], capacity: int) -> tuple[dict[int, list[Range]], int]:
    """Ranges of ranks for each length, and the number of bins."""
    tree, bins = CapacityTree(capacity), 0
    open_bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    plan: dict[int, list[Range]] = {}

    def put(left: int, first: int, n: int) -> None:
        if n and left:
            open_bins[left].append((first, n))
            tree.set(left, True)

    for length in sorted(counts, reverse=True):
        todo, rank, ranges = counts[length], 0, []
        while todo:
            left = tree.tightest(length)
            if left is None:
                left, first = capacity, bins
                n = -(-todo // (capacity // length))
                bins += n
            else:
                first, n = open_bins[left].pop()
                tree.set(left, bool(open_bins[left]))
            each = left // length  # a bin takes pieces of this length as long as they fit: it stays the tightest
            full = min(n, todo // each)
            if full:
                ranges.append((rank, full * each, first, each, capacity - left))
                put(left - each * length, first, full)
            rank, todo, first, n = rank + full * each, todo - full * each, first + full, n - full
            if n and todo:  # fewer pieces than one more bin takes
                ranges.append((rank, todo, first, todo, capacity - left))
                put(left - todo * length, first, 1)
                rank, todo, first, n = rank + todo, 0, first + 1, n - 1
            put(left, first, n)
        plan[length] = ranges
    return plan, bins


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """piece, start, length, crc32 of each piece; ids are 32-bit."""
    n = len(ids) // 4
    end = n % capacity or min(n, capacity)
    start = piece = 0
    while start < n:
        yield piece, start, end - start, zlib.crc32(ids[4 * start:4 * end])
        piece, start, end = piece + 1, end, end + capacity


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32."""
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for ids, texts in batch_rows(batches, "doc_id", "text"):
            rows = [(doc, *piece) for doc, raw in zip(ids, own.encode(texts), strict=True) for piece in pieces_of(raw + last, capacity)]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Adds ``rank``, gapless from 0 among the pieces of one length; ``id`` tells pieces apart."""
    groups = 1 + max(counts.values(), default=0) // RANK_GROUP
    placed = pieces.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups)))
    sizes = placed.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("id")) - 1
    return placed.withColumn("own", own).join(sizes, ["length", "part"]).withColumn("rank", F.col("before") + F.col("own")).drop("part", "own", "before")


def _place(plan: dict[int, list[Range]]):
    starts = {length: [r[0] for r in ranges] for length, ranges in plan.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins, places = [], []
                for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist(), strict=True):
                    first_rank, _, first, each, place = plan[length][bisect_right(starts[length], rank) - 1]
                    bins.append(first + (rank - first_rank) // each)
                    places.append(place + (rank - first_rank) % each * length)
                kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(bins, pa.int64()), pa.array(places, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32) of 1 to ``capacity`` tokens.

    A piece of the full length is a sequence of its own, numbered below 0 by its place in the table.
    """
    pieces = stored(pieces.withColumn("id", F.monotonically_increasing_id()), "pieces")
    short = pieces.where(F.col("length") < capacity)
    counts = {r["length"]: r["count"] for r in short.groupBy("length").count().collect()}  # fewer than capacity rows
    plan, _ = best_fit(counts, capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = pieces.where(F.col("length") >= capacity).select(*columns, (-1 - F.col("id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed = ranked(short, counts).mapInArrow(_place(plan), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return whole.unionByName(placed)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """All documents as pieces with their sequence and place there."""
    return pack(token_pieces(docs, path or vocabulary_path("byte_bpe_50k.json"), capacity, end_id), capacity)


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(read_table(spark, folder, "documents"))
