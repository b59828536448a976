"""Exact duplicates by an extendible-hash index on shared files.

A text is normalised (every run of ASCII white space becomes one blank) and hashed to 64 bits. The directory has a slot for
each value of the hash's leading bits; it doubles until no bucket is overfull, and buckets that are not overfull keep
fewer bits, so a bucket is a range of keys. Owner tasks take buckets: they chain the texts of a key, compare bytes along the
chain, and write the bucket: one entry with bytes for each different text, with its group. Bytes alone decide which texts are
equal; bytes move once and are stored once. Depth and tasks follow from the measured bytes.

Large groups: a task that reads keeps the texts it has seen, up to ``HELD_BYTES``, and hands on one entry for each, with the
number of its rows and the first of them. So a text reaches its owner once for each task that reads it, however many rows
it has, and the rows find their group by the place of the first equal row of their task, which as a key is never hot.

Cases: null and empty texts are equal. Null doc_ids come after all others. Of rows that repeat a doc_id and its text
the first stays. An empty table gives no rows. Extra columns are ignored, whatever their names. Very long texts are taken
whole. ``docs`` must give the same rows in the same places each time it is read (a table or files).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.common import bounded_rows, new_folder, new_name, read_table

BUCKET_ROWS = 50_000  # a bucket with more rows is overfull
BUCKET_BYTES = 16 << 20  # an owner task sorts, chains and writes this much
SLOT_BITS = 14  # leading bits that are counted; deeper buckets are taken as even
KEY_BITS = 64
HELD_BYTES = 16 << 20
_CONTROLS = bytes(0x20 if 9 <= b <= 13 else b for b in range(256))
ENTRY = "bucket long, key long, first_row long, doc_id long, row long, n long, bytes binary"
INDEX = "bucket long, key long, chain int, bytes binary, first_row long, keep_id long, keep_row long, group_size long, text_sha256 string"


def normalised(text: str | None) -> bytes:
    raw = (text or "").encode().translate(_CONTROLS)
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    return raw


def key_of(raw: bytes, bits: int = KEY_BITS) -> int:
    """64-bit hash; with fewer ``bits`` only the leading ones are kept, so that texts collide."""
    return xxhash.xxh64_intdigest(raw, seed=9) >> (64 - bits) << (64 - bits)


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


class _Held:
    """Texts a task has seen, by key: the place of the first row of each, found by its bytes."""

    def __init__(self, limit: int):
        self.limit, self.size, self.texts = limit, 0, {}

    def first_row(self, key: int, raw: bytes, row: int) -> int:
        chain = self.texts.get(key, ())
        for other, first in chain:
            if other == raw:
                return first
        if self.size + len(raw) > self.limit and self.texts:  # the text comes again as an entry of its own
            self.texts, self.size, chain = {}, 0, ()
        self.texts[key] = (*chain, (raw, row))
        self.size += len(raw)
        return row


def _firsts(texts: list, rows: list, held: _Held, bits: int) -> Iterator[tuple[int, bytes, int]]:
    """(key, text, place of the first equal row of the task) of each row."""
    for text, row in zip(texts, rows, strict=True):
        raw = normalised(text)
        key = key_of(raw, bits)
        yield key, raw, held.first_row(key, raw, row)


def _histogram(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = np.zeros(1 << SLOT_BITS, np.int64), np.zeros(1 << SLOT_BITS, np.int64)
        for (texts,) in bounded_rows(batches, "text"):
            raws = [normalised(t) for t in texts]
            slot = np.array([key_of(r, bits) >> (64 - SLOT_BITS) for r in raws], np.int64)
            np.add.at(rows, slot, 1)
            np.add.at(size, slot, [len(r) for r in raws])
        seen = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(rows[seen]), pa.array(size[seen])], ["slot", "rows", "bytes"])

    return run


class Directory:
    """Bucket of every key: doubling from one bucket, an overfull bucket is split on its next bit until none is.

    ``slots`` has rows and bytes by the leading SLOT_BITS bits. A slot that is still overfull gets as many further bits
    as make its share of even keys fit.
    """

    def __init__(self, slots: dict[int, tuple[int, int]], bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES):
        counts = np.zeros((1 << SLOT_BITS, 2), np.int64)
        for slot, pair in slots.items():
            counts[slot] = pair
        total = np.vstack([np.zeros((1, 2), np.int64), counts.cumsum(axis=0)])
        self.base, self.bits = np.zeros(1 << SLOT_BITS, np.int64), np.zeros(1 << SLOT_BITS, np.int64)
        self.buckets, self.depth, waiting = 0, 0, [(0, 0)]
        while waiting:
            prefix, local = waiting.pop()
            low, high = prefix << (SLOT_BITS - local), (prefix + 1) << (SLOT_BITS - local)
            n, size = (total[high] - total[low]).tolist()
            overfull = max(-(-n // bucket_rows), -(-size // bucket_bytes), 1)
            if overfull > 1 and local < SLOT_BITS:
                waiting += [(2 * prefix + 1, local + 1), (2 * prefix, local + 1)]
                continue
            more = (overfull - 1).bit_length()
            self.base[low:high], self.bits[low:high] = self.buckets, more
            self.buckets += 1 << more
            self.depth = max(self.depth, local + more)

    def bucket(self, key: int) -> int:
        slot = key >> (64 - SLOT_BITS)
        more = int(self.bits[slot])
        return int(self.base[slot]) + ((key << SLOT_BITS & (1 << 64) - 1) >> (64 - more) if more else 0)


def _entries(directory: Directory, held_bytes: int, bits: int):
    """One entry for each text a task holds: its bytes, the rows of the task that are equal and the first of their doc_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = _Held(held_bytes), {}

        def batch():
            columns = list(zip(*((directory.bucket(k), _signed(k), first, low[1] if not low[0] else None, low[2], n, raw) for first, (k, raw, low, n) in found.items())))
            names = ["bucket", "key", "first_row", "doc_id", "row", "n", "bytes"]
            types = [*[pa.int64()] * 6, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for ids, rows, texts in bounded_rows(batches, "doc_id", "row", "text"):
            if found and held.size > held.limit // 2:
                yield batch()
                held, found = _Held(held_bytes), {}
            for doc_id, row, (key, raw, first) in zip(ids, rows, _firsts(texts, rows, held, bits), strict=True):
                low = (doc_id is None, doc_id or 0, row)
                _, _, least, n = found.get(first, (0, b"", low, 0))
                found[first] = (key, raw, min(least, low), n + 1)
        if found:
            yield batch()

    return run


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries come in key order: chains the texts of a key by their bytes; the first entry of a chain carries them."""
    names = [c.split()[0] for c in INDEX.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    now, chains = None, []  # of a key: [bytes, first rows, first of all rows, rows]

    def rows():
        out = []
        for number, (raw, firsts, low, n) in enumerate(chains):
            sha = hashlib.sha256(raw).hexdigest()
            keep = (None if low[0] else low[1], low[2])
            out += [(*now, number, raw if k == 0 else None, first, *keep, n, sha) for k, first in enumerate(firsts)]
        return out

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    for columns in bounded_rows(batches, "bucket", "key", "first_row", "doc_id", "row", "n", "bytes"):
        done = []
        for bucket, key, first, doc_id, row, n, raw in zip(*columns, strict=True):
            if (bucket, key) != now:
                done += rows()
                now, chains = (bucket, key), []
            low = (doc_id is None, doc_id or 0, row)
            for chain in chains:
                if chain[0] == raw:
                    chain[1].append(first)
                    chain[2], chain[3] = min(chain[2], low), chain[3] + n
                    break
            else:
                chains.append([raw, [first], low, n])
        if done:
            yield batch(done)
    if chains:
        yield batch(rows())


def _placed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col("text"))


def write_index(
    docs: DataFrame, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES, held_bytes: int = HELD_BYTES, key_bits: int = KEY_BITS
) -> DataFrame:
    """Write the index of (doc_id, text) into a new shared folder and read it back."""
    spark = docs.sparkSession
    texts = _placed(docs)
    found = texts.select("text").mapInArrow(_histogram(key_bits), "slot long, rows long, bytes long").groupBy("slot").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    slots = {r["slot"]: (r["rows"], r["bytes"]) for r in found.collect()}  # at most 2**SLOT_BITS rows
    directory = Directory(slots, bucket_rows, bucket_bytes)
    entries = texts.mapInArrow(_entries(directory, held_bytes, key_bits), ENTRY)
    tasks = max(1, min(directory.buckets, 1 << SLOT_BITS))
    # dealt by number, not by its hash, which puts several buckets into one task and none into others
    owned = entries.repartitionById(tasks, (F.col("bucket") % tasks).cast("int")).sortWithinPartitions("bucket", "key", "first_row")
    path = new_folder(spark, "exact-index")
    owned.mapInArrow(_owners, INDEX).write.parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def _rows(held_bytes: int, bits: int):
    """Each row with the first equal row of its task: the same as :func:`_entries` has found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = _Held(held_bytes), False
        for ids, rows, texts in bounded_rows(batches, "doc_id", "row", "text"):
            if seen and held.size > held.limit // 2:
                held = _Held(held_bytes)
            seen = True
            firsts = [first for _, _, first in _firsts(texts, rows, held, bits)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(firsts, pa.int64())], ["doc_id", "row", "first_row"])

    return run


def exact_groups(
    docs: DataFrame, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES, held_bytes: int = HELD_BYTES, key_bits: int = KEY_BITS
) -> DataFrame:
    """One row per document: doc_id, row (place in the table), keep_id, group_size, kept, text_sha256."""
    index = write_index(docs, bucket_rows, bucket_bytes, held_bytes, key_bits)
    rows = _placed(docs).mapInArrow(_rows(held_bytes, key_bits), "doc_id long, row long, first_row long")
    groups = index.select("first_row", "keep_id", "keep_row", "group_size", "text_sha256")
    return rows.join(groups, "first_row").select("doc_id", "row", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns. The index alone tells which."""
    place, kept = new_name("row"), new_name("kept")
    groups = write_index(docs).where("bytes IS NOT NULL").select(F.col("keep_row").alias(kept))
    return docs.withColumn(place, F.monotonically_increasing_id()).join(groups, F.col(place) == F.col(kept), "left_semi").drop(place)


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(read_table(spark, folder, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP9_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t
"""
