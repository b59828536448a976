"""Repeated strings of at least ``LENGTH`` bytes, by merging Burrows-Wheeler transforms of shards.

Bringing together what may repeat. The windows of LENGTH bytes are grouped by their anchor, the smallest hash of the
``GRAM``-byte strings in them (the leftmost of equal ones), which depends on the window's bytes alone. Neighbouring windows
with one anchor form a stretch. Only stretches whose anchor string occurs again can repeat: stretches that are equal as a
whole need no more than their first place, and the distinct ones left are compared in groups, one group an anchor.

Merging. In a task, the stretches of some groups are a collection of strings whose shards are the input partitions they
come from. Each shard's suffixes are sorted by themselves, giving its transform. The transforms are interleaved by
refinement: rows in the order known so far are dealt by the character before them, stably, which orders them by one
character more; a boundary between two rows is found at the depth of their common prefix. Rows alone between boundaries
are done, and so are rows from which no window's start is reached with the depths left. The work ends with exactly the
repeated intervals: rows with LENGTH common characters. No step sorts the suffixes of all shards.

Of equal windows the first (smallest doc_id, then smallest place) stays; the bytes of all others are removed.

Large groups: a task keeps one place for equal stretches of its own rows and reports the rest at once. An anchor with more
than ``HOT_STRETCHES`` distinct stretches is split into its windows, which are compared by 128-bit hashes of the whole window in
an aggregation that combines before it shuffles. Texts longer than ``SEGMENT`` are read in overlapping parts.

Equal stretches are recognised by their anchor's 64-bit hash and a second 64-bit hash of their bytes.

Cases: null is empty. Null doc_ids come last; rows that repeat a doc_id are different documents in table order. Texts
shorter than LENGTH lose nothing. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.llm.common import batch_rows, read_table, stored

LENGTH = 100
GRAM = 40
SEGMENT = 1 << 20  # window starts read together
PLACE_BITS = 23  # of a place among those; the other bits of a gram's hash decide which is smallest
CHUNK_ROWS = 250_000  # suffixes merged together, about
HOT_STRETCHES = 20_000
LAST = (1 << 63) - 1  # stands for a null doc_id
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

STRETCH = ["key", "content", "doc", "row", "start", "n"]
FOUND = "kind int, row long, doc long, start long, n long, key long"
REMOVED, COMPARE, HOT = 0, 1, 2


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Hashes:
    """Hashes of any part of a byte string."""

    def __init__(self, chars: np.ndarray, base: int):
        size = 1 << max(10, len(chars).bit_length())
        up, self.down = _powers(base, size)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(chars * up[: len(chars)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.total[end] - self.total[start]) * self.down[start])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, ~np.uint64(0))
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def stretches(raws: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of texts of up to SEGMENT bytes together, about: text, start, windows, key and content hash of each stretch."""
    sizes = np.array([len(r) for r in raws], np.int64)
    chars = np.frombuffer(b"".join(raws), np.uint8).astype(np.uint64)
    if len(chars) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    ends = sizes.cumsum()
    first, second = Hashes(chars, _BASES[0]), Hashes(chars, _BASES[1])
    places = np.arange(len(chars) - gram + 1)
    hashes = first.of(places, places + gram)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    anchors = (_smallest((hashes & ~mask) | places.astype(np.uint64), length - gram + 1) & mask).astype(np.int64)
    owner = np.repeat(np.arange(len(raws)), sizes)
    starts = np.flatnonzero(owner[: len(anchors)] == owner[length - 1:])
    anchors = anchors[starts]
    opens = np.flatnonzero(np.r_[True, (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)]) if len(starts) else np.zeros(0, np.int64)
    low, n = starts[opens], np.diff(np.r_[opens, len(starts)])
    at = anchors[opens]
    content = _mixed(second.of(low, low + n + length - 1) + n.astype(np.uint64) * np.uint64(_BASES[0]) + (at - low).astype(np.uint64))
    text = owner[low]
    return text, low - (ends - sizes)[text], n, hashes[at], content


def _arrow(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _ordered(key, content, doc, row, start) -> np.ndarray:
    return np.lexsort((start, row, doc, content, key))


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    changed = np.zeros(len(columns[0]), bool)
    changed[:1] = True
    for c in columns:
        changed[1:] |= c[1:] != c[:-1]
    return changed


def _document_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of a task's documents: the first place of each, and (known = 1) the others, which are removed for certain."""
    kept: list[tuple[np.ndarray, ...]] = []

    def read(part: list[tuple[int, int, int, bytes]]) -> None:
        text, start, n, key, content = stretches([p[3] for p in part])
        doc, row, shift = (np.array([p[i] for p in part], np.int64)[text] for i in (0, 1, 2))
        kept.append((key.view(np.int64), content.view(np.int64), doc, row, start + shift, n))

    part, size = [], 0
    for rows, ids, texts in batch_rows(batches, "row", "doc", "text"):
        for row, doc, text in zip(rows, ids, texts, strict=True):
            raw = text.encode()
            for shift in range(0, max(1, len(raw) - LENGTH + 1), SEGMENT):
                part.append((doc, row, shift, raw[shift:shift + SEGMENT + LENGTH - 1]))
                size += len(part[-1][3])
                if size >= SEGMENT:
                    read(part)
                    part, size = [], 0
    if part:
        read(part)
    if kept:
        columns = [np.concatenate(c) for c in zip(*kept, strict=True)]
        columns = [c[order] for order in (_ordered(*columns[:5]),) for c in columns]
        known = (~_new(columns[0], columns[1])).astype(np.int32)
        for at in range(0, len(known), 100_000):
            yield _arrow(**{name: c[at:at + 100_000] for name, c in zip(STRETCH, columns, strict=True)}, known=known[at:at + 100_000])


def _report(columns: list[np.ndarray], hot: bool | None, hot_stretches: int) -> Iterator[pa.RecordBatch]:
    """What to do with the places of whole anchors, in order of key, content and place."""
    key, content, doc, row, start, n = columns
    if not len(key):
        return
    first = _new(key, content)
    opens = np.flatnonzero(_new(key))
    group = np.repeat(np.arange(len(opens)), np.diff(np.r_[opens, len(key)]))
    distinct = np.bincount(group, first)[group]
    kind = np.where(~first, REMOVED, np.where(distinct > hot_stretches, HOT, np.where(distinct > 1, COMPARE, -1)))
    if hot:
        kind[first] = HOT
    keep = kind >= 0
    if keep.any():
        yield _arrow(kind=kind[keep].astype(np.int32), row=row[keep], doc=doc[keep], start=start[keep], n=n[keep], key=key[keep])


def _sorted_anchors(hot_stretches: int):
    """Rows come in order of key, content and place; the last anchor of a batch may go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64) for _ in STRETCH]
        hot_key, last = None, (0, 0)  # of a hot anchor that goes on: its key, and the key and content reported last
        for batch in batches:
            held = [np.r_[h, batch.column(c).to_numpy(zero_copy_only=False)] for h, c in zip(held, STRETCH, strict=True)]
            if not len(held[0]):
                continue
            if hot_key is not None:
                cut = int(np.searchsorted(held[0], hot_key, "right"))
                yield from _hot([h[:cut] for h in held], last)
                if cut:
                    last = (held[0][cut - 1], held[1][cut - 1])
                held = [h[cut:] for h in held]
                if not len(held[0]):
                    continue
                hot_key = None
            cut = int(np.searchsorted(held[0], held[0][-1]))
            yield from _report([h[:cut] for h in held], None, hot_stretches)
            held = [h[cut:] for h in held]
            if np.count_nonzero(_new(held[1])) > hot_stretches:
                yield from _report(held, True, hot_stretches)
                hot_key, last = held[0][-1], (held[0][-1], held[1][-1])
                held = [h[:0] for h in held]
        yield from _report(held, None, hot_stretches)

    return run


def _hot(columns: list[np.ndarray], last: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """More places of an anchor known to be hot; those that go on with the stretch reported last are removed."""
    key, content, doc, row, start, n = columns
    if len(key):
        first = _new(key, content)
        first[0] &= (key[0], content[0]) != last
        yield _arrow(kind=np.where(first, HOT, REMOVED).astype(np.int32), row=row, doc=doc, start=start, n=n, key=key)


# ---------------------------------------------------------------- transforms


class Transforms:
    """Burrows-Wheeler transforms of shards of strings; rows are numbered shard after shard.

    ``before`` is the character before each row's suffix (0 at a string's start), ``back`` the row of the suffix that
    begins there, ``place`` where the suffix begins in ``chars``. Characters are bytes plus one; 0 ends a string.
    """

    def __init__(self, strings: list[bytes], shards: np.ndarray):
        sizes = np.array([len(s) + 1 for s in strings], np.int64)
        self.ends = sizes.cumsum()
        self.starts = self.ends - sizes
        raw = np.frombuffer(b"\xff".join([*strings, b""]), np.uint8)
        self.chars = (raw + np.uint8(1)).astype(np.uint8)  # a text in UTF-8 has no byte 255, so the separator becomes 0
        self.string = np.repeat(np.arange(len(strings)), sizes)
        self.left = self.ends[self.string] - np.arange(len(raw))  # characters up to the end, which counts
        self.place = self._sorted(shards[self.string])
        row = np.empty(len(raw), np.int64)
        row[self.place] = np.arange(len(raw))
        opens = self.place == self.starts[self.string[self.place]]
        self.before = np.where(opens, 0, self.chars[self.place - 1]).astype(np.uint8)
        self.back = np.where(opens, -1, row[self.place - 1])

    def _sorted(self, shard: np.ndarray) -> np.ndarray:
        """Suffixes in order inside their shard, by doubling the characters compared; equal ones in string order."""
        n = len(self.chars)
        padded = np.concatenate([self.chars, np.zeros(8, np.uint8)]).astype(np.uint64)
        word = np.zeros(n, np.uint64)
        for j in range(8):
            word = (word << np.uint64(8)) | np.where(self.left > j, padded[j:j + n], np.uint64(0))
        order = np.lexsort((word, shard))
        rank, width = np.empty(n, np.int64), 8
        rank[order] = np.cumsum(_new(shard[order], word[order]))
        longest = int((self.ends - self.starts).max(initial=0))
        while width < longest and rank.max(initial=0) < n:
            after = np.where(self.left > width, rank[np.minimum(np.arange(n) + width, n - 1)], 0)
            pair = rank * (n + 1) + after
            order = np.argsort(pair, kind="stable")
            rank[order] = np.cumsum(_new(pair[order]))
            width *= 2
        return np.argsort(rank, kind="stable")


def merge(transforms: Transforms, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that share ``depth`` characters with another row, in merged order, and their interval.

    The interleave starts as shard after shard, one interval; each step deals the rows by the character before them.
    """
    inside = transforms.place - transforms.starts[transforms.string[transforms.place]]
    rows = np.flatnonzero(inside >= depth)
    interval = np.zeros(len(rows), np.int64)
    for known in range(1, depth + 1):
        character = transforms.before[rows]
        dealt = np.argsort(character, kind="stable")
        character, interval, rows = character[dealt], interval[dealt], transforms.back[rows[dealt]]
        opens = _new(character, interval)
        interval = np.cumsum(opens)
        closes = np.ones(len(opens), bool)
        closes[:-1] = opens[1:]
        keep = ~(opens & closes) & (inside[rows] >= depth - known)  # not alone, and no window begins before its string
        rows, interval = rows[keep], interval[keep]
    return rows, interval


def repeated(strings: list[bytes], shards: np.ndarray, doc: np.ndarray, row: np.ndarray, start: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """String and place in it of every window that an earlier place holds as well."""
    transforms = Transforms(strings, shards)
    rows, interval = merge(transforms, length)
    place = transforms.place[rows]
    string = transforms.string[place]
    inside = place - transforms.starts[string]
    order = np.lexsort((start[string] + inside, row[string], doc[string], interval))
    later = ~_new(interval[order])
    return string[order][later], inside[order][later]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by key. Parts of texts (row, start, end) to remove, from groups of stretches with one key."""
    held: list[tuple] = []

    def done(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        _, doc, row, start, raw = zip(*rows, strict=True)
        doc, row, start = (np.array(x, np.int64) for x in (doc, row, start))
        string, inside = repeated(list(raw), row >> 33, doc, row, start)
        if len(string):
            string, inside = (x[order] for order in (np.lexsort((inside, string)),) for x in (string, inside))
            opens = np.flatnonzero(np.r_[True, (string[1:] != string[:-1]) | (inside[1:] != inside[:-1] + 1)])
            closes = np.r_[opens[1:], len(string)] - 1
            low = start[string[opens]] + inside[opens]
            yield _arrow(row=row[string[opens]], low=low, high=low + inside[closes] - inside[opens] + LENGTH)

    size, last = 0, None
    for columns in batch_rows(batches, "key", "doc", "row", "start", "raw"):
        for item in zip(*columns, strict=True):
            if size >= CHUNK_ROWS and item[0] != last:
                yield from done(held)
                held, size = [], 0
            held.append(item)
            size += len(item[4]) + 1
            last = item[0]
    if held:
        yield from done(held)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of the stretches of hot anchors, by 128 bits of a hash of their bytes."""
    for docs, rows, starts, raws in batch_rows(batches, "doc", "row", "start", "raw"):
        for doc, row, start, raw in zip(docs, rows, starts, raws, strict=True):
            n = len(raw) - LENGTH + 1
            digests = np.frombuffer(b"".join(hashlib.blake2b(raw[i:i + LENGTH], digest_size=16).digest() for i in range(n)), "<i8").reshape(-1, 2)
            yield _arrow(a=digests[:, 0], b=digests[:, 1], doc=np.full(n, doc), row=np.full(n, row), low=start + np.arange(n))


def removed_spans(docs: DataFrame, hot_stretches: int = HOT_STRETCHES) -> tuple[DataFrame, DataFrame]:
    """The documents (row, doc_id, text) and the parts of them to remove (row, low, high; not yet joined up)."""
    doc = F.col("doc_id").cast("long")
    texts = docs.select(F.monotonically_increasing_id().alias("row"), doc.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = texts.select("row", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text")
    places = own.mapInArrow(_document_stretches, "key long, content long, doc long, row long, start long, n long, known int")
    # rows known to be removed need no comparing: they only pass through, dealt by row
    dealt = places.withColumn("at", F.when(F.col("known") == 1, F.col("row")).otherwise(F.col("key"))).repartition("at").drop("at")
    ordered = dealt.sortWithinPartitions("known", "key", "content", "doc", "row", "start")
    found = stored(ordered.mapInArrow(_split_known(hot_stretches), FOUND), "stretches")
    parts = found.where(F.col("kind") != REMOVED).select("kind", "key", "doc", F.col("row").alias("at"), "start", "n")
    parts = parts.join(texts.select("row", F.col("text").cast("binary").alias("raw")), F.col("at") == F.col("row"))
    parts = parts.select("kind", "key", "doc", "row", "start", F.call_function("substring", F.col("raw"), (F.col("start") + 1).cast("int"), (F.col("n") + LENGTH - 1).cast("int")).alias("raw"))
    parts = stored(parts, "parts")
    spans = "row long, low long, high long"
    compared = parts.where(F.col("kind") == COMPARE).drop("kind").repartition("key").sortWithinPartitions("key").mapInArrow(_compare, spans)
    windows = parts.where(F.col("kind") == HOT).select("doc", "row", "start", "raw").mapInArrow(_windows, "a long, b long, doc long, row long, low long")
    windows = stored(windows, "windows")
    first = windows.groupBy("a", "b").agg(F.min(F.struct("doc", "row", "low")).alias("first"))
    later = windows.join(stored(first, "first"), ["a", "b"]).where(F.struct("doc", "row", "low") != F.col("first")).select("row", "low", (F.col("low") + LENGTH).alias("high"))
    removed = found.where(F.col("kind") == REMOVED).select("row", F.col("start").alias("low"), (F.col("start") + F.col("n") + LENGTH - 1).alias("high"))
    return texts, removed.unionByName(compared).unionByName(later)


def _split_known(hot_stretches: int):
    """Passes rows known to be removed on, and gives the rest to the anchors' step; the rest come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: list[pa.RecordBatch] = []

        def open_rows() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                known = batch.column("known").to_numpy(zero_copy_only=False)
                cut = int(np.searchsorted(known, 1))
                if cut:
                    yield batch.slice(0, cut)
                if cut < len(known):
                    passed.append(batch.slice(cut))
                    return

        def removed(batch: pa.RecordBatch) -> pa.RecordBatch:
            kind = pa.array(np.full(batch.num_rows, REMOVED, np.int32))
            return pa.RecordBatch.from_arrays([kind, *(batch.column(c) for c in ("row", "doc", "start", "n", "key"))], ["kind", "row", "doc", "start", "n", "key"])

        yield from _sorted_anchors(hot_stretches)(open_rows())
        for batch in passed:
            yield removed(batch)
        for batch in batches:
            if batch.num_rows:
                yield removed(batch)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts, spans in batch_rows(batches, "doc_id", "text", "spans"):
        rows = []
        for doc, text, cuts in zip(ids, texts, spans, strict=True):
            raw, at, digest, gone = text.encode(), 0, hashlib.sha256(), 0
            for cut in cuts or []:
                digest.update(raw[at:cut["low"]])
                at = cut["high"]
                gone += cut["high"] - cut["low"]
            digest.update(raw[at:])
            rows.append((doc, len(raw), gone, len(cuts or []), digest.hexdigest()))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, hot_stretches: int = HOT_STRETCHES) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts, parts = removed_spans(docs, hot_stretches)
    parts = parts.groupBy("row", "low").agg(F.max("high").alias("high"))
    by_row = Window.partitionBy("row").orderBy("low")
    reached = F.max("high").over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("opens", (F.coalesce(reached, F.lit(-1)) < F.col("low")).cast("int"))
    parts = parts.withColumn("span", F.sum("opens").over(by_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spans = parts.groupBy("row", "span").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    spans = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"))
    return texts.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read_table(spark, folder, "documents"))


#: Windows as hexadecimal text; documents are cut into parts first, as taking a part of a long string is slow.
OP8_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
parts AS MATERIALIZED (SELECT doc_id, start, n, substring(h, 2 * start + 1, 800) AS part FROM (SELECT doc_id, h, n, unnest(range(0, n - 99, 300)) AS start FROM d WHERE n >= 100)),
w AS (SELECT doc_id, start + j AS i, substring(part, 2 * j + 1, 200) AS s FROM (SELECT doc_id, start, part, unnest(range(least(300, n - 99 - start))) AS j FROM parts)),
later AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER o + 100, true)::INT AS opens FROM later WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
spans AS (SELECT doc_id, min(i) AS low, max(i) + 100 AS high FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked) GROUP BY doc_id, span),
cuts AS (SELECT doc_id, low, high, coalesce(lag(high) OVER o, 0) AS before FROM spans WINDOW o AS (PARTITION BY doc_id ORDER BY low)),
kept AS (SELECT c.doc_id, sum(high - low) AS gone, count(*) AS n_spans, max(high) AS last, string_agg(substring(h, 2 * before + 1, 2 * (low - before)), '' ORDER BY low) AS part
         FROM cuts c JOIN d ON c.doc_id = d.doc_id GROUP BY c.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(from_hex(coalesce(part || substring(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
