"""SimHash near duplicates, found with Golay-code fuzzy hashing.

A fingerprint has 64 bits, each the majority of that bit over the XXH64 of all 3-word shingles. Fingerprints link at up
to 3 differing bits; equal ones are one node. A fingerprint is cut into segments of 22, 21 and 21 bits, each read as
a word of the perfect (23, 12) Golay code, which maps any word to the one codeword at most 3 bits away. Words one bit
apart share a codeword index if one of them also takes the indices of its neighbours (at most 6 in all); as one bit
changes the parity, only words of odd weight need to.

Pigeonhole: of 3 errors over 3 segments, either one segment is equal and another has at most one error (keys: the equal
segment and an index of the other, for the 6 ordered pairs), or each has one (keys: an index of each). Rows with one
key are compared; linked ones are joined into stars within the task, so that a clique costs no more rows than members.

Large groups: a key that more than ``HOT_RUN`` fingerprints share hands them over. These are linked through values in
between instead: fingerprints 3 bits apart are one and two bits away from a common value, and all fingerprints two bits
from a value are tied to the lowest that is one bit from it. That is exact, and linear in their number.

Cases: null, empty and blank texts have fingerprint zero and link like any other; texts of fewer than 3 words have one
shingle, the whole sequence. Null doc_ids count as larger than all others. Rows that repeat are kept apart. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.common import batch_rows, new_name, read_table, shuffle_partitions, stored
from pitchline.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3  # what the segments below are made for
HOT_RUN = 1024
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the binary Golay code
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return digest(joined, SEED)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[: len(words) - SHINGLE]]
    hashes = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1:])], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


@cache
def codeword_index() -> np.ndarray:
    """Index of the codeword at most 3 bits from each 23-bit word."""
    words = np.zeros(1, np.int64)
    for shift in range(12):
        words = np.concatenate([words, words ^ (GENERATOR << shift)])
    table = np.full(1 << 23, -1, np.int16)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            table[words ^ sum(1 << b for b in bits)] = np.arange(len(words))
    if (table < 0).any():
        raise AssertionError("not a perfect code")
    return table


def _indices(words: np.ndarray, bits: int) -> np.ndarray:
    """Codeword indices of each word, -1 where there are fewer than 6: its own, and for odd weight its neighbours'."""
    table = codeword_index()
    own = table[words][:, None]
    around = table[words[:, None] ^ (1 << np.arange(bits))[None, :]]
    odd = (np.bitwise_count(words) & 1).astype(bool)
    found = np.sort(np.where(odd[:, None], np.hstack([own, around]), own), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return -np.sort(-found, axis=1)[:, :6]


def join_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints, and the place of each key's fingerprint. Two within 3 bits share a key at least."""
    words = [((prints >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    found = [_indices(w, bits).astype(np.int64) for w, (_, bits) in zip(words, SEGMENTS)]
    keys, rows = [], []
    for kind, (same, near) in enumerate((a, b) for a in range(3) for b in range(3) if a != b):
        at, which = np.nonzero(found[near] >= 0)
        keys.append(kind << 40 | words[same][at] << 12 | found[near][at, which])
        rows.append(at)
    grid = (found[0][:, :, None, None] >= 0) & (found[1][:, None, :, None] >= 0) & (found[2][:, None, None, :] >= 0)
    at, i, j, k = np.nonzero(grid)
    keys.append(6 << 40 | found[0][at, i] << 24 | found[1][at, j] << 12 | found[2][at, k])
    rows.append(at)
    return np.concatenate(keys), np.concatenate(rows)


def stars(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (left, right) as stars: each value but the lowest of its component, and that one."""
    names, places = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = places[: len(left)], places[len(left):]
    root = np.arange(len(names))
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root = root[root]
    leaf = np.flatnonzero(root != np.arange(len(names)))
    return names[leaf], names[root[leaf]]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, ids, texts in batch_rows(batches, "row", "doc_id", "text"):
        prints = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(prints)], ["row", "doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """row (place in the table), doc_id, print of every document."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_fingerprints, "row long, doc_id long, print long")


def _longs(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("print").to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 4096):
            part = prints[at:at + 4096]
            keys, rows = join_keys(part.view(np.uint64))
            yield _longs(key=keys, print=part[rows])


def _runs(keys: np.ndarray, prints: np.ndarray, hot_run: int) -> Iterator[pa.RecordBatch]:
    """Links of runs of equal keys; the members of runs that are too long, each as a link to itself."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    hot = np.repeat(sizes > hot_run, sizes)
    if hot.any():
        members = np.unique(prints[hot])
        yield _longs(u=members, v=members)
    keep = np.repeat((sizes > 1) & (sizes <= hot_run), sizes)
    keys, prints = keys[keep], prints[keep].view(np.uint64)
    left, right, at, gap = [], [], np.arange(len(keys)), 0
    while len(at):
        gap += 1
        at = at[at + gap < len(keys)]
        at = at[keys[at] == keys[at + gap]]
        linked = at[np.bitwise_count(prints[at] ^ prints[at + gap]) <= MAX_BITS]
        left.append(prints[linked])
        right.append(prints[linked + gap])
    if left and sum(map(len, left)):
        leaf, root = stars(np.concatenate(left), np.concatenate(right))
        yield _longs(u=leaf.view(np.int64), v=root.view(np.int64))


def _links(hot_run: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.r_[keys, batch.column("key").to_numpy(zero_copy_only=False)]
            prints = np.r_[prints, batch.column("print").to_numpy(zero_copy_only=False)]
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))  # rows come in key order; the last run may go on
            yield from _runs(keys[:cut], prints[:cut], hot_run)
            keys, prints = keys[cut:], prints[cut:]
            if len(keys) > 2 * hot_run:  # goes on, and is too long already: hand over all but what keeps it so
                yield from _runs(keys[hot_run + 1:], prints[hot_run + 1:], 0)
                keys, prints = keys[: hot_run + 1], prints[: hot_run + 1]
        yield from _runs(keys, prints, hot_run)

    return run


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values within two bits of each fingerprint; far is 0 for those within one."""
    one = [0, *(1 << i for i in range(64))]
    two = [1 << i | 1 << j for i, j in combinations(range(64), 2)]
    flips, far = np.array(one + two, np.uint64), np.array([0] * len(one) + [1] * len(two), np.int64)
    for batch in batches:
        for value in batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64):
            yield _longs(value=(flips ^ value).view(np.int64), far=far, print=np.full(len(flips), value).view(np.int64))


def _tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by value, those within one bit first: ties all of a value to its first, if that is within one bit."""
    value, first = None, None
    for batch in batches:
        left, right = [], []
        for v, far, own in zip(*(batch.column(c).to_pylist() for c in ("value", "far", "print")), strict=True):
            if v != value:
                value, first = v, None if far else own
            elif first is not None:
                left.append(own)
                right.append(first)
        if left:
            leaf, root = stars(np.array(left, np.int64), np.array(right, np.int64))
            yield _longs(u=leaf, v=root)


def links(prints: DataFrame, hot_run: int = HOT_RUN) -> DataFrame:
    """Links (u, v) with the components of all links of up to 3 bits between the distinct values of ``print``."""
    tasks = shuffle_partitions(prints.sparkSession)  # a number of its own keeps small rows that grow from being merged
    nodes = prints.select("print").distinct().repartition(tasks, "print")
    keyed = nodes.mapInArrow(_keyed, "key long, print long").repartition("key").sortWithinPartitions("key")
    found = stored(keyed.mapInArrow(_links(hot_run), "u long, v long"), "links")
    hot = found.where("u = v").select(F.col("u").alias("print")).distinct()
    between = hot.repartition(tasks, "print").mapInArrow(_between, "value long, far long, print long").repartition("value").sortWithinPartitions("value", "far", "print")
    return found.where("u <> v").unionByName(between.mapInArrow(_tied, "u long, v long"))


def near_groups(docs: DataFrame, hot_run: int = HOT_RUN) -> DataFrame:
    """Per document: row, doc_id, print, root (lowest fingerprint of its component), component_id."""
    prints = stored(fingerprints(docs), "fingerprints")
    roots = components(links(prints, hot_run))
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("lowest"))
    nodes = nodes.join(roots, F.col("print") == F.col("node"), "left").select("print", "lowest", F.coalesce("root", "print").alias("root"))
    nodes = stored(nodes, "nodes")
    groups = nodes.groupBy("root").agg(F.min("lowest").alias("component_id"))
    groups = stored(nodes.join(groups, "root").select("print", "root", "component_id"), "groups")
    return prints.join(groups, "print").select("row", "doc_id", "print", "root", "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component stays: that with the lowest doc_id, the first of several. All columns are kept."""
    place, stays = new_name("row"), new_name("kept")
    kept = near_groups(docs).where("doc_id <=> component_id").groupBy("root").agg(F.min("row").alias(stays))
    return docs.withColumn(place, F.monotonically_increasing_id()).join(kept, F.col(place) == F.col(stays), "left_semi").drop(place)


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(read_table(spark, folder, "documents")).select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
