"""Benchmark decontamination by winnowing.

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. A text's fingerprints are the smallest
k-gram hash of each window of ``w`` k-grams (the last of equal ones). A span of ``w + k - 1`` shared words holds a whole
window, so both texts select the same k-gram there, and no shared span of that length is missed. Items of at least
``WINDOW`` words use ``w + k - 1 = WINDOW``; shorter items are one window, and each shorter length present has its own
k and w.

A training fingerprint carries the ``w - 1`` words around it on both sides, all that a window with it can hold. It first passes
a bitmap of the test fingerprints (of fixed size; a larger benchmark only lets more pass) and is joined with their distinct
hashes. A hit is extended to the windows that hold it, and these meet the distinct windows of the items by their words, so
nothing depends on a hash being free of collisions.

Skew: a distinct window of the items is one row, however many items hold it, so a document's place meets it once, and a
passage that many documents and many items share gives a row for each document and window. The items are gathered for each
different set of windows once, not for each document.

Cases: null and empty texts have no words and are not contaminated; such items have no windows. Items that repeat an
item_id count once, items without one mark words but are not listed. Rows that repeat are kept apart. Empty tables of
either kind work. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.llm.common import batch_rows, new_name, read_table, stored

WINDOW = 13
BITMAP_BITS = 24  # 2 MB
CHUNK_BYTES = 1 << 20
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_SEED = "hash long, pos int, before int, context binary"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


def shape(length: int) -> tuple[int, int]:
    """k and w for windows of ``length`` words."""
    k = (length + 1) // 2
    return k, length + 1 - k


@lru_cache(maxsize=8)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    with np.errstate(over="ignore"):
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Words:
    """Words of some texts in one row, with their hashes and the text that each belongs to."""

    def __init__(self, texts: list[str | None]):
        raws = [(t or "").encode().translate(_WORDS) for t in texts]
        self.raw = b" ".join([*raws, b""]) if raws else b""
        chars = np.frombuffer(self.raw, np.uint8)
        inside = np.concatenate([[False], chars != 32, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        size = max(1024, 1 << max(1, len(chars)).bit_length())
        up, down = _powers(size)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(chars.astype(np.uint64) * up[: len(chars)])])
        self.hashes = _mixed((total[self.ends] - total[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))
        text_ends = np.cumsum([len(r) + 1 for r in raws]) if raws else np.zeros(0, np.int64)
        self.text = np.searchsorted(text_ends, self.starts, side="right")
        self.counts = np.bincount(self.text, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def selected(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the k-grams that winnowing selects, and their hashes."""
        k, w = shape(length)
        grams = len(self.hashes) - k + 1
        windows = grams - w + 1
        if windows < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.full(grams, length, np.uint64)
        for j in range(k):
            h = h * np.uint64(_BASE) + self.hashes[j:j + grams]
        h = _mixed(h)
        best, at = h[:windows].copy(), np.arange(windows)
        for j in range(1, w):
            better = h[j:j + windows] <= best
            best[better] = h[j:j + windows][better]
            at[better] = np.flatnonzero(better) + j
        whole = self.text[:windows] == self.text[length - 1:length - 1 + windows]
        chosen = np.zeros(grams, bool)
        chosen[at[whole]] = True
        places = np.flatnonzero(chosen)
        return places, h[places]

    def context(self, place: int, length: int) -> tuple[int, bytes]:
        """Words before the k-gram in its context, and the context."""
        k, w = shape(length)
        text = self.text[place]
        low, high = max(place - w + 1, self.first[text]), min(place + k + w - 1, self.first[text + 1])
        return int(place - low), b" ".join(self.raw[self.starts[low]:self.ends[high - 1]].split())


def _chunks(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[list[tuple]]:
    """Rows in parts whose texts (the last column) are of bounded size together."""
    for values in batch_rows(batches, *columns):
        part, size = [], 0
        for row in zip(*values, strict=True):
            part.append(row)
            size += len(row[-1] or "")
            if size > CHUNK_BYTES:
                yield part
                part, size = [], 0
        if part:
            yield part


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of the items (no window), and their windows (no hash)."""
    for part in _chunks(batches, "item_id", "text"):
        items, out = [r[0] for r in part], []
        words = Words([r[1] for r in part])
        lengths = np.minimum(words.counts, WINDOW)
        for length in np.unique(lengths[lengths > 0]).tolist():
            places, values = words.selected(length)
            chosen = values[lengths[words.text[places]] == length].view(np.int64)
            out += [(None, length, h, None) for h in np.unique(chosen).tolist()]
            for text in np.flatnonzero(lengths == length).tolist():
                found = words_of(part[text][1])
                out += [(items[text], length, None, b" ".join(found[i:i + length])) for i in range(len(found) - length + 1)]
        types = (pa.string(), pa.int32(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["item_id", "length", "hash", "window"])


def _slot(values: np.ndarray) -> np.ndarray:
    return values.view(np.uint64) >> np.uint64(64 - BITMAP_BITS)


def _doc_prints(lengths: list[int], bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _chunks(batches, "row", "doc_id", "text"):
            words = Words([r[2] for r in part])
            seeds: list[list[dict]] = [[] for _ in part]
            for length in lengths:
                places, values = words.selected(length)
                slots = _slot(values)
                hit = (bitmap[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1) != 0
                for place, value in zip(places[hit].tolist(), values[hit].view(np.int64).tolist()):
                    before, context = words.context(place, length)
                    text = int(words.text[place])
                    seeds[text].append({"hash": value, "pos": int(place - words.first[text]), "before": before, "context": context})
            kind = pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int32()), ("before", pa.int32()), ("context", pa.binary())]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()), pa.array(words.counts, pa.int64()), pa.array(seeds, kind)], ["row", "doc_id", "n_words", "seeds"])

    return run


def windows_around(k: int, length: int, words: list[bytes], before: int) -> Iterator[tuple[int, bytes]]:
    """Windows of ``length`` words that hold the k-gram after ``before`` words: where each starts, and its words."""
    for start in range(max(0, before + k - length), min(before, len(words) - length) + 1):
        yield start, b" ".join(words[start:start + length])


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for columns in batch_rows(batches, "row", "pos", "before", "context", "length"):
        out = []
        for row, pos, before, context, length in zip(*columns, strict=True):
            for start, window in windows_around(shape(length)[0], length, context.split(b" "), before):
                low = pos - before + start
                out.append((row, low, low + length, window))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["row", "low", "high", "window"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: row (place in the table), doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    found = stored(items.mapInArrow(_item_prints, "item_id string, length int, hash long, window binary"), "item-prints")
    distinct = stored(found.where("hash IS NOT NULL").select("length", "hash").distinct(), "distinct-prints")
    windows = stored(found.where("window IS NOT NULL").select("window").distinct().withColumn("node", F.monotonically_increasing_id()), "item-windows")
    holders = stored(found.where("window IS NOT NULL AND item_id IS NOT NULL").join(windows, "window").select("node", "item_id").distinct(), "window-items")
    lengths = [r["length"] for r in distinct.select("length").distinct().collect()]  # at most WINDOW
    slot = F.shiftrightunsigned("hash", 64 - BITMAP_BITS)
    words = distinct.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.cast("int").bitwiseAND(63))).alias("bits"))
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    words = words.toArrow()  # at most 2**(BITMAP_BITS - 6) rows
    bitmap[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(rows.mapInArrow(_doc_prints(sorted(lengths), bitmap), f"row long, doc_id long, n_words long, seeds array<struct<{', '.join(x.replace(' ', ':', 1) for x in _SEED.split(', '))}>>"), "doc-prints")
    seeds = rows.where("size(seeds) > 0").select("row", F.explode("seeds").alias("s")).select("row", "s.*")
    hits = seeds.join(distinct, "hash").select("row", "pos", "before", "context", "length")
    hits = hits.mapInArrow(_extend, "row long, low long, high long, window binary").join(windows, "window")
    hits = stored(hits.select("row", "low", "high", "node").distinct(), "hits")
    spans = hits.groupBy("row", "low").agg(F.max("high").alias("high"))
    reached = F.max("high").over(Window.partitionBy("row").orderBy("low").rowsBetween(Window.unboundedPreceding, -1))
    covered = spans.withColumn("reached", F.coalesce(reached, F.lit(0))).groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("high") - F.greatest("low", "reached"))).alias("n_hit"))
    sets = stored(hits.groupBy("row").agg(F.sort_array(F.collect_set("node")).alias("nodes")), "window-sets")
    different = stored(sets.select("nodes").distinct().withColumn("set", F.monotonically_increasing_id()), "different-sets")
    named = different.select("set", F.explode("nodes").alias("node")).join(holders, "node").groupBy("set").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    named = named.select("set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    listed = sets.join(different, "nodes").join(named, "set").select("row", "n_items", "items_sha256")
    result = rows.select("row", "doc_id", "n_words").join(covered.join(listed, "row", "left"), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return result.select(
        "row", "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all columns."""
    place, goes = new_name("row"), new_name("gone")
    gone = contamination(docs, benchmark).where("contaminated").select(F.col("row").alias(goes))
    return docs.withColumn(place, F.monotonically_increasing_id()).join(gone, F.col(place) == F.col(goes), "left_anti").drop(place)


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")).drop("row")


OP5_SQL = r"""
WITH lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
places AS (SELECT item_id, ws, least(13, len(ws)) AS m, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM items WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item_id, m, array_to_string(ws[i:i + m - 1], ' ') AS span FROM places),
sizes AS (SELECT DISTINCT m FROM windows),
starts AS (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM lists, sizes WHERE len(ws) >= m),
spans AS (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS span FROM starts),
hits AS (SELECT doc_id, i, s.m, item_id FROM spans s JOIN windows w ON s.span = w.span AND s.m = w.m),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT l.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM lists l LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
