"""Ranked lexical search for many queries at once, with shared sub-sums.

Terms are maximal runs of letters, digits and non-ASCII characters, A-Z in lower case. A document's score for an item is
the sum over the item's terms of an integer that depends on term and document alone, so items that share terms share
partial sums. The terms shared by items are mined into a graph: terms that occur in the same items are one node, and the
pair of nodes that most items hold becomes a node of its own, again and again, until no pair is shared. A document
then gets one accumulator for each node that its terms reach; every node is summed once, from two others, and
the items are sums of the nodes left to them. All of it is done for many documents at a time, on columns of numbers.

Two passes over tables: one over the texts, which stores each document's length and the counts of those terms that
items hold, with the document counts of each part of the table; one over that, which scores and keeps the best of each task.
The best of all are found by a window whose rows are limited before they move.

Large tables: the items are taken in blocks of bounded text (``BLOCK_CHARS``; an item longer than that is a block of its
own), each against all documents; a block's terms are what is collected and sent to tasks. A task holds one text
at a time and ``SLICE_CELLS`` accumulator cells. Mining stops after ``MAX_PAIRS`` pairs; that changes only how much is shared.

Cases: null and empty texts have no terms, are in no count and no result. An item without terms, or of which no document
holds a term of weight above zero, has no rows. Null doc_ids come after all others of their score; rows that repeat a
doc_id are documents of their own, ranked by their place in the table. Items that repeat an item_id are ranked apart.
Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.llm.common import batch_rows, read_table, stored

TOP = 10
BLOCK_CHARS = 8 << 20  # text of the items that are searched at once
MAX_PAIRS = 4_000_000
SLICE_CELLS = 4_000_000  # accumulator cells at once, 32 MB
SLICE_DOCS = 1024
SALTS = 64
# Bytes of a term stay, A-Z in lower case; all others part terms.
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_KEEP).split(b" ")


def counted(text: str | None) -> Counter:
    found = Counter(terms(text))
    found.pop(b"", None)
    return found


class Plan:
    """What to sum: ``groups`` (terms of each first node), ``sums`` (two nodes for each further node), ``items`` (nodes of each).

    Node numbers: the groups in order, then the sums in order, each after the two it is made of.
    """

    def __init__(self, items: list[set[int]], max_pairs: int = MAX_PAIRS):
        where: dict[int, list[int]] = defaultdict(list)
        for i, held in enumerate(items):
            for term in held:
                where[term].append(i)
        same: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for term in sorted(where):
            same[tuple(where[term])].append(term)
        self.groups = list(same.values())
        nodes: list[set[int]] = [set() for _ in items]
        for node, holders in enumerate(same):
            for i in holders:
                nodes[i].add(node)
        self.sums = self._mine(nodes, {n: set(holders) for n, holders in enumerate(same) if len(holders) > 1}, max_pairs)
        self.items = [sorted(held) for held in nodes]

    def _mine(self, nodes: list[set[int]], holders: dict[int, set[int]], max_pairs: int) -> list[tuple[int, int]]:
        """Turns the pair that most items hold into a node while two items hold one; changes ``nodes``."""
        pairs: Counter = Counter()
        for i, held in enumerate(nodes):
            shared = sorted(n for n in held if n in holders)
            if len(pairs) + len(shared) * (len(shared) - 1) // 2 > max_pairs:
                continue  # this item shares only what others bring
            pairs.update((a, b) for k, a in enumerate(shared) for b in shared[k + 1:])
        heap = [(-n, p) for p, n in pairs.items() if n > 1]
        heapq.heapify(heap)
        sums: list[tuple[int, int]] = []
        while heap:
            n, (a, b) = heapq.heappop(heap)
            both = holders[a] & holders[b]
            if len(both) < 2:
                continue
            if len(both) < -n:
                heapq.heappush(heap, (-len(both), (a, b)))
                continue
            new = len(self.groups) + len(sums)
            sums.append((a, b))
            holders[a] -= both
            holders[b] -= both
            holders[new] = both
            beside: Counter = Counter()
            for i in both:
                nodes[i] -= {a, b}
                beside.update(x for x in nodes[i] if x in holders)
                nodes[i].add(new)
            for x, m in beside.items():
                if m > 1:
                    heapq.heappush(heap, (-m, (min(x, new), max(x, new))))
        return sums

    def additions(self) -> int:
        """Sums of two numbers that one document needs at most."""
        return len(self.sums) + sum(max(0, len(held) - 1) for held in self.items) + sum(len(g) - 1 for g in self.groups)


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str, list[bytes]]]]:
    """Blocks of (place, item_id, terms), a bounded length of text each, or a single longer item."""
    sizes = items.select(F.monotonically_increasing_id().alias("place"), "item_id", "text")
    sizes = sizes.where(F.length("text") > 0)
    up_to = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parted = sizes.withColumn("part", F.shiftright("place", 33)).withColumn("end", F.sum(F.length("text")).over(up_to))
    parted = stored(parted.withColumn("cut", F.floor((F.col("end") - 1) / block_chars)), "item-blocks")
    for part, cut in sorted(map(tuple, parted.select("part", "cut").distinct().collect())):
        rows = parted.where((F.col("part") == part) & (F.col("cut") == cut)).select("place", "item_id", "text").collect()
        found = [(r.place, r.item_id, sorted(counted(r.text))) for r in rows]
        found = sorted((f for f in found if f[2]), key=lambda f: f[0])
        if found:
            yield found


def _postings(vocabulary: dict[bytes, int]):
    """Rows of documents with terms (n, terms, counts of those in the vocabulary), and one row of sums for the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, total = np.zeros(len(vocabulary), np.int64), 0, 0

        def batch(columns):
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["row", "doc_id", "docs", "n", "term", "tf"])

        for rows, ids, texts in batch_rows(batches, "row", "doc_id", "text"):
            out = []
            for row, doc_id, text in zip(rows, ids, texts, strict=True):
                found = counted(text)
                if not found:
                    continue
                n = sum(found.values())
                docs, total = docs + 1, total + n
                held = sorted((vocabulary[t], c) for t, c in found.items() if t in vocabulary)
                if held:
                    term, tf = zip(*held)
                    df[list(term)] += 1
                    out.append((row, doc_id, 0, n, term, tf))
            if out:
                yield batch(zip(*out))
        if docs:
            seen = np.flatnonzero(df)
            yield batch(zip((None, None, docs, total, seen.tolist(), df[seen].tolist())))

    return run


def _weights(postings: DataFrame, terms_count: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, their terms, and the weight of each term of the vocabulary."""
    sums = postings.where("docs > 0")
    totals = sums.agg(F.sum("docs"), F.sum("n")).first()
    docs, total = totals[0] or 0, totals[1] or 0
    weights = np.zeros(terms_count, np.int64)
    pairs = sums.select(F.explode(F.arrays_zip("term", "tf")).alias("p"))
    for term, df in pairs.groupBy("p.term").agg(F.sum("p.tf").alias("df")).collect():  # at most the vocabulary
        weights[term] = math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))
    return docs, total, weights


class _Best:
    """The best documents of one item: rows of (-score, doc_id is null, doc_id, row), sorted."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    def add(self, scores: np.ndarray, ids: list, rows: list) -> None:
        least = -self.rows[-1][0] if len(self.rows) == self.top else 1
        at = np.flatnonzero(scores >= max(least, 1))
        if len(at) > self.top:  # all that reach the score of the last of the best
            limit = np.partition(scores[at], len(at) - self.top)[len(at) - self.top]
            at = at[scores[at] >= limit]
        if len(at):
            new = [(-int(scores[k]), ids[k] is None, ids[k] or 0, rows[k]) for k in at.tolist()]
            self.rows = sorted(self.rows + new)[: self.top]


def _scored(plan: Plan, places: list[int], docs: int, total: int, weights: np.ndarray, top: int):
    """Best documents of each item within the task."""
    group_of = np.zeros(len(weights), np.int64)
    for node, held in enumerate(plan.groups):
        group_of[held] = node
    nodes = len(plan.groups) + len(plan.sums)
    width = max(1, min(SLICE_DOCS, SLICE_CELLS // max(1, nodes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(top) for _ in places]
        for batch in batches:
            for at in range(0, batch.num_rows, width):
                part = batch.slice(at, width)
                n = part.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
                lists = part.column("term")
                sizes = np.diff(lists.offsets.to_numpy())
                doc = np.repeat(np.arange(len(n)), sizes)
                term, tf = lists.flatten().to_numpy(), part.column("tf").flatten().to_numpy()
                m = 100 - 90 + (90 * n * docs) // total
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                sums = np.zeros((nodes, len(n)), np.int64)
                np.add.at(sums, (group_of[term], doc), value)
                for k, (a, b) in enumerate(plan.sums, len(plan.groups)):
                    np.add(sums[a], sums[b], out=sums[k])
                ids, rows = part.column("doc_id").to_pylist(), part.column("row").to_pylist()
                for i, held in enumerate(plan.items):
                    best[i].add(sums[held].sum(axis=0), ids, rows)
        for i, kept in enumerate(best):
            if kept.rows:
                score, none, doc_id, row = zip(*kept.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([places[i]] * len(row), pa.int64()), pa.array([None if x else d for x, d in zip(none, doc_id)], pa.int64()),
                        pa.array(row, pa.int64()), pa.array([-s for s in score], pa.int64()),
                    ],
                    ["place", "doc_id", "row", "score"],
                )

    return run


def _highest(found: DataFrame, top: int, *more: str) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("place", *more).orderBy(*order))).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score, place (of the item in its table), row (place of the document in its table)."""
    spark = docs.sparkSession
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    id_type = items.schema["item_id"].dataType.simpleString()
    result = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long, place long, row long")
    for block in item_blocks(items, block_chars):
        words = sorted(set().union(*(held for _, _, held in block)))
        vocabulary = {w: k for k, w in enumerate(words)}
        plan = Plan([{vocabulary[t] for t in held} for _, _, held in block])
        places = [place for place, _, _ in block]
        schema = "row long, doc_id long, docs long, n long, term array<int>, tf array<long>"
        postings = stored(texts.mapInArrow(_postings(vocabulary), schema), "postings")
        count, total, weights = _weights(postings, len(words))
        scored = postings.where("docs = 0").mapInArrow(_scored(plan, places, count, total, weights, top), "place long, doc_id long, row long, score long")
        some = _highest(stored(scored.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS))), "best"), top, "salt").drop("rank")
        names = spark.createDataFrame([(p, i) for p, i, _ in block], f"place long, item_id {id_type}")
        best = _highest(some, top).join(names, "place")
        result = result.unionByName(best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score", "place", "row"))
    return result


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")).select("item_id", "rank", "doc_id", "score")


OP12_SQL = r"""
WITH low AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM low GROUP BY doc_id, term),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
tot AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
s AS (
  SELECT q.item_id, tf.doc_id, sum(floor(1000 * ln((2 * nd + 2) / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))))::BIGINT AS score
  FROM q JOIN tf ON tf.term = q.term JOIN df ON df.term = q.term JOIN len ON len.doc_id = tf.doc_id CROSS JOIN tot
  GROUP BY q.item_id, tf.doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""
