"""MinHash near duplicates by bottom-k sketches of one hash function.

A document's set holds its distinct 5-word shingles. Its sketch retains the 256 smallest hashes of the set (all, if there
are fewer), so two sketches together hold the sketch of the union. Documents whose sets have 100 * intersection >=
percent * union link; equal sets are one node.

Inverted lists of retained values generate candidates. Linked sets share at least ``sure_overlap`` retained values (all
but 1e-12 of the time where a set is larger than the sketch, always where both are retained whole). So a document that
shares fewer with all others together is in no list, which is decided on the 64 smallest first, then on all retained
values of those that are left. Of a document's shared values the smallest are listed: as many as decide for sure, or 16
if that is fewer (a linked pair has none of them in common once in 1e13). A pair that shares a list is estimated on the
union's sketch; what passes is verified on the shingles themselves, read from the texts again.

Large groups: no list is turned into all its pairs. First every member is held against one leader, the lowest member of
most of its lists. Then only members outside the largest component of a list are held against the others, in blocks of
bounded size, once for each pair (in its smallest common list), and that join lets only pairs through whose sketches'
bit signatures allow a link. Nothing is capped: blocks cover every pair of a list that is not joined already. The work,
not the rows, grows with the square of the members of a list that link with neither leader nor component.

Cases: null, empty and blank texts have the empty set and link with nothing. Texts of fewer than five words have one
shingle, the whole sequence. Null doc_ids count as larger than all others. Rows that repeat are documents of their own
with equal sets. An empty table gives no rows. Extra columns are ignored. Very long texts are taken whole; a task holds
the shingles of one text, or of two when it verifies.

Equal sets are recognised by 128 bits over the sorted 64-bit hashes of the shingles. ``docs`` must give the same rows in
the same places each time it is read (a table or files).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.common import bounded_rows, read_table, stored
from pitchline.llm.components import components

WIDTH = 5
PERCENT = 85
SKETCH = 256
FIRST = 64  # retained values that decide which documents are looked at at all
LISTED = 16
SIGNATURE = 16  # numbers of 64 bits
SEED = 11
_BITS = [f"b{k}" for k in range(SIGNATURE)]
MISS = 1e-12  # chance that two linked sets share fewer retained values than asked for
BLOCK = 512  # members of a list, or of a leader, that meet in one group
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: str | None, width: int = WIDTH) -> set[bytes]:
    """Distinct shingles: words between ASCII white space, A-Z in lower case, joined by blanks."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return set()
    joined = b" ".join(words)
    if len(words) <= width:
        return {joined}
    ends = list(accumulate(len(w) + 1 for w in words))
    return {joined[a:b - 1] for a, b in zip([0, *ends[: len(words) - width]], ends[width - 1:])}


def hashes(found: set[bytes]) -> np.ndarray:
    """Sorted hashes of shingles, as signed numbers."""
    digest = xxhash.xxh64_intdigest
    return np.sort(np.fromiter((digest(s, SEED) for s in found), np.uint64, len(found)).view(np.int64))


def sure_overlap(percent: int = PERCENT, size: int = SKETCH, miss: float = MISS) -> int:
    """Most retained values of a union's sketch that sets of that similarity share, but for a chance of ``miss``."""
    p, tail = percent / 100, 0.0
    for found in range(size + 1):
        tail += comb(size, found) * p**found * (1 - p) ** (size - found)
        if tail > miss:
            return max(found, 1)
    return size


def signature(values: np.ndarray) -> np.ndarray:
    """Bits of the sketch's values; two sketches differ by at least as many values as these by bits."""
    bits = np.zeros(64 * SIGNATURE, np.uint8)
    bits[(values & (64 * SIGNATURE - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def _sets(width: int, size: int):
    def lists_of(arrays: list[np.ndarray]) -> pa.ListArray:
        ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, texts in bounded_rows(batches, "row", "doc_id", "text"):
            counts, digests, sketches = [], [], []
            for text in texts:
                values = hashes(shingles(text, width))
                counts.append(len(values))
                digests.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                sketches.append(values[:size].copy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), lists_of(sketches), lists_of([signature(v) for v in sketches])],
                ["row", "doc_id", "n", "digest", "sketch", "bits"],
            )

    return run


def sketches(docs: DataFrame, width: int = WIDTH, size: int = SKETCH) -> DataFrame:
    """row (place in the table), doc_id, n (set size), digest of the set (null: empty), sketch and its bits of every document."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_sets(width, size), "row long, doc_id long, n long, digest binary, sketch array<long>, bits array<long>")


def union_overlap(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Values of the union's sketch that both sketches hold."""
    return F.size(F.array_intersect(F.array_intersect(a, b), F.slice(F.sort_array(F.array_union(a, b)), 1, size)))


def _may_link(percent: int, size: int) -> Column:
    """The union's sketch of sides a and b allows a link."""
    n, m = F.col("a.n"), F.col("b.n")
    overlap = union_overlap(F.col("a.sketch"), F.col("b.sketch"), size)
    whole = F.greatest(n, m) <= size  # both sketches are the sets
    return F.when(whole, 100 * overlap >= percent * (n + m - overlap)).otherwise(overlap >= sure_overlap(percent, size))


def _bits_allow(percent: int, size: int) -> Column:
    """Set sizes, and signatures that differ by no more bits than the sketches of a linked pair by values, of sides a and b."""
    unlike = sum((F.bit_count(F.col(f"a.b{k}").bitwiseXOR(F.col(f"b.b{k}"))) for k in range(SIGNATURE)), F.lit(0))
    n, m = F.col("a.n"), F.col("b.n")
    # of n + m = union + intersection values, with intersection >= p union, at most (1 - p) / (1 + p) are not shared
    whole = unlike * (100 + percent) <= (100 - percent) * (n + m)
    allowed = F.when(F.greatest(n, m) <= size, whole).otherwise(unlike <= 2 * (size - sure_overlap(percent, size)))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & allowed


def _shared(nodes: DataFrame, percent: int, size: int) -> DataFrame:
    """node, shared (retained values that another node has as well), needed (as many as a link asks for), where these do."""
    values = nodes.select("node", "n", F.explode(F.slice("sketch", 1, size)).alias("value"))
    common = stored(values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("value"), "common-values")
    # sets that even a partner of greatest size leaves whole: the shares of the sets hold for the sketches
    needed = F.when(100 * F.col("n") <= percent * size, F.ceil(F.col("n") * percent / 100)).otherwise(F.lit(sure_overlap(percent, size)))
    found = values.join(common.hint("merge"), "value").groupBy("node", needed.alias("needed")).agg(F.collect_list("value").alias("shared"))
    return found.where(F.size("shared") >= F.col("needed"))


def lists(nodes: DataFrame, percent: int = PERCENT, size: int = SKETCH, listed: int = LISTED) -> DataFrame:
    """node, listed: the values in whose inverted lists each node stands."""
    found = _shared(nodes, percent, size)
    take = F.least(F.size("shared") - F.col("needed") + 1, F.lit(listed)).cast("int")
    return found.select("node", F.slice(F.sort_array("shared"), F.lit(1), take).alias("listed"))


def _linked(percent: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, set()
        for leaders, members, texts in bounded_rows(batches, "u", "v", "text"):
            left, right = [], []
            for u, v, text in zip(leaders, members, texts, strict=True):
                if v is None:
                    leader, own = u, shingles(text, width)
                    continue
                if u != leader:
                    raise AssertionError("a member without its leader")
                other = shingles(text, width)
                both = len(own & other)
                if 100 * both >= percent * (len(own) + len(other) - both):
                    left.append(v)
                    right.append(u)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["u", "v"])

    return run


def verified(texts: DataFrame, pairs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Pairs (u, v) of rows of ``texts`` (row, text) that link. A leader u is read once for each block of its members."""
    blocks = stored(pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")), "blocks")
    dealt = pairs.join(blocks, "u").select("u", F.pmod(F.xxhash64("v"), "blocks").alias("block"), "v")
    wanted = dealt.select("u", "block", "v", F.col("v").alias("row")).unionByName(
        blocks.select("u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("long").alias("v"), F.col("u").alias("row"))
    )
    rows = wanted.join(texts.hint("merge"), "row").select("u", "block", "v", "text")
    return rows.repartition("u", "block").sortWithinPartitions("u", "block", F.col("v").asc_nulls_first()).mapInArrow(_linked(percent, width), "u long, v long")


def _leader_pairs(listed: DataFrame, nodes: DataFrame, percent: int, size: int) -> DataFrame:
    """Each node with one leader: the lowest member of most of its lists."""
    entries = stored(listed.select(F.explode("listed").alias("value"), "node"), "entries")
    lowest = stored(entries.groupBy("value").agg(F.min("node").alias("leader")), "leaders")
    votes = entries.join(lowest.hint("merge"), "value").where("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("node").agg(F.max(F.struct("n", (-F.col("leader")).alias("minus"))).alias("b"))
    pairs = best.select((-F.col("b.minus")).alias("u"), F.col("node").alias("v"))
    side = lambda name, alias: nodes.select(F.col("node").alias(name), F.struct("n", *_BITS).alias(alias)).hint("merge")
    allowed = pairs.join(side("u", "a"), "u").join(side("v", "b"), "v").where(_bits_allow(percent, size)).select("u", "v")
    return _estimated(allowed, nodes, percent, size)


def _rest_pairs(listed: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int, size: int, block: int) -> DataFrame:
    """Pairs of different components that share a list and may link: members outside a list's largest component (side
    a) with all members (side b), each group at most about ``block`` of either."""
    named = listed.join(roots.hint("merge"), "node", "left").select("node", "listed", F.coalesce("root", "node").alias("comp"))
    named = stored(named.select(F.explode("listed").alias("value"), "node", "comp"), "named-lists")
    counts = named.groupBy("value", "comp").agg(F.count(F.lit(1)).alias("n"))
    open_ = counts.groupBy("value").agg(F.sum("n").alias("all"), F.max(F.struct("n", "comp")).alias("top")).where(F.col("all") > F.col("top.n"))
    blocks = lambda c: F.ceil(c / block).cast("int")
    open_ = stored(open_.select("value", F.col("top.comp").alias("main"), blocks(F.col("all") - F.col("top.n")).alias("few"), blocks(F.col("all")).alias("many")), "open-lists")
    members = nodes.drop("sketch").join(listed.hint("merge"), "node")
    rows = stored(named.join(open_.hint("merge"), "value").join(members.hint("merge"), "node"), "open-rows")
    deal = lambda count: F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    whole = lambda side: F.struct("node", "comp", "n", "listed", *_BITS, (F.col("comp") != F.col("main")).alias("few")).alias(side)
    a = rows.where("comp <> main").select("value", deal("few").alias("i"), each("many").alias("j"), whole("a"))
    b = rows.select("value", each("few").alias("i"), deal("many").alias("j"), whole("b"))
    once = (F.col("a.comp") != F.col("b.comp")) & (~F.col("b.few") | (F.col("a.node") < F.col("b.node")))
    first = F.array_min(F.array_intersect("a.listed", "b.listed")) == F.col("value")
    met = a.join(b.hint("merge"), ["value", "i", "j"]).where(once & _bits_allow(percent, size) & first)
    return _estimated(met.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct(), nodes, percent, size)


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int, size: int) -> DataFrame:
    """Pairs (u, v) that may link by the union's sketch."""
    side = lambda name, alias: nodes.select(F.col("node").alias(name), F.struct("n", "sketch").alias(alias)).hint("merge")
    return pairs.join(side("u", "a"), "u").join(side("v", "b"), "v").where(_may_link(percent, size)).select("u", "v")


def near_groups(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, size: int = SKETCH, block: int = BLOCK) -> DataFrame:
    """Per document: row, doc_id, n (set size), root (place of the first of its component), component_id."""
    sets = stored(sketches(docs, width, size), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("lowest")
    classes = stored(sets.where("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("node"), first), "set-classes")
    rows = sets.where("digest IS NOT NULL").select(F.col("row").alias("node"), "n", "sketch", "bits")
    some = _shared(rows.drop("bits"), percent, min(FIRST, size)).select("node")  # copies share with each other: one of each goes on
    some = stored(some.join(classes.select("node").hint("merge"), "node", "left_semi"), "first-shared")
    nodes = stored(rows.join(some.hint("merge"), "node", "left_semi"), "first-nodes")
    listed = stored(lists(nodes, percent, size), "lists")
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "text")
    texts = stored(texts.join(listed.select(F.col("node").alias("row")).hint("merge"), "row", "left_semi"), "listed-texts")
    # for estimates the upper halves of the values do: they keep the order, and what they take for equal adds overlap
    short = F.transform("sketch", lambda v: F.shiftright(v, 32).cast("int")).alias("sketch")
    nodes = nodes.join(listed.select("node").hint("merge"), "node", "left_semi")
    nodes = stored(nodes.select("node", "n", short, *[F.col("bits")[k].alias(f"b{k}") for k in range(SIGNATURE)]), "listed-nodes")
    links = stored(verified(texts, stored(_leader_pairs(listed, nodes, percent, size), "leader-pairs"), percent, width), "leader-links")
    rest = stored(_rest_pairs(listed, nodes, components(links), percent, size, block), "rest-pairs")
    roots = components(links.unionByName(verified(texts, rest, percent, width)))
    named = stored(classes.join(roots, "node", "left").select("digest", "lowest", F.coalesce("root", "node").alias("root")), "named-classes")
    groups = stored(named.groupBy("root").agg(F.min("lowest").alias("lowest")), "groups")
    decided = stored(named.drop("lowest").join(groups, "root").select("digest", "root", F.col("lowest.doc_id").alias("component_id")), "decided")
    linked = sets.drop("sketch", "bits").where("digest IS NOT NULL").join(decided, "digest").select("row", "doc_id", "n", "root", "component_id")
    return linked.unionByName(sets.where("digest IS NULL").select("row", "doc_id", "n", F.col("row").alias("root"), F.col("doc_id").alias("component_id")))


def op11_minhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_groups(read_table(spark, folder, "documents"))
    return groups.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
    FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.other)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.other) AS component_id, d.doc_id = min(r.other) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""
