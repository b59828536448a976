"""Spelling variants of words: pairs one edit apart, found with asymmetric q-chunks, and the form that variants go back to.

Words are runs of letters, A-Z in lower case, counted over whole texts. For each pair of words the shorter one (either, of
two equally long) contributes two disjoint chunks, its halves; the other contributes the positional grams that can equal
them, in place or shifted by one. One edit lies in one half at most, so the other is preserved: in place, or one further
on if a code point was put in before it. Words that share a chunk have one edit between what is left of them, and the
same holds again there: groups that stay large are split on the halves of the rest, until a group is small or the rest
is one code point (so at most one word for each letter of the alphabet). Members of a group are compared; nothing is capped.

A word's form is its near word that occurs most, if that occurs at least ``RATIO`` times as often; following forms ends at a
root, found by pointer doubling (counts grow ``RATIO`` times a step, so the number of rounds is the logarithm of a logarithm).

The corruption that the query asks for (one code point of a run goes where a checksum of document number and run is
divisible by ``DROP``) is a parameter of the counting, off by default.

Cases: null and empty texts have no words. A null doc_id counts as an empty one in the checksum. Rows that repeat count again.
Ties of counts go to the word that is smaller in code-point order. An empty table gives no rows. Extra columns are ignored.
A task holds one text's words at a time, and at most about ``HELD_WORDS`` counts before it hands them on.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.common import batch_rows, read_table, shuffle_partitions, stored

MIN_LENGTH, MIN_COUNT, RATIO, DROP = 6, 5, 5, 199
HELD_WORDS = 200_000
GROUP = 4096  # pairs of members that a group may have before it is split
LETTERS = r"[A-Za-zÀ-ÿ]"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def document_words(text: str | None, doc_id: int | None, drop: int = 0, least: int = MIN_LENGTH) -> Counter:
    """Words of a text with at least that many code points, and their counts."""
    runs = Counter(re.findall(f"{LETTERS}{{{least},}}", (text or "").encode().translate(_LOWER).decode()))
    if not drop:
        return runs
    found, prefix = Counter(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        check = zlib.crc32(run.encode(), prefix)
        if check % drop == 0:
            at = check % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= least:
            found[run] += n
    return found


def _counts(drop: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for ids, texts in batch_rows(batches, "doc_id", "text"):
            for doc_id, text in zip(ids, texts, strict=True):
                held.update(document_words(text, doc_id, drop, least))
                if len(held) > HELD_WORDS:
                    yield batch()
                    held.clear()
        yield batch()

    return run


def word_counts(docs: DataFrame, drop: int = 0, least: int = MIN_LENGTH, occurrences: int = MIN_COUNT) -> DataFrame:
    """word, n of the words that occur at least ``occurrences`` times."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_counts(drop, least), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def _piece(which: int, length: Column, at: Column, take: Column, rest: str) -> Column:
    """Key of a chunk or gram (length of the chunk's word, which half, its text) and what is left of the word."""
    text = F.col(rest)
    left = F.concat(F.substring(text, F.lit(1), at), F.substring(text, at + take + 1, F.length(text)))
    return F.struct(length.alias("of"), F.lit(which).alias("half"), F.substring(text, at + 1, take).alias("text"), left.alias("left"))


def _halves(length: Column) -> tuple[Column, Column]:
    first = F.floor(length / 2).cast("int")
    return first, length - first


def chunks(rest: str) -> Column:
    """The two disjoint chunks of a word."""
    length = F.length(rest)
    first, second = _halves(length)
    return F.array(_piece(0, length, F.lit(0), first, rest), _piece(1, length, first, second, rest))


def grams(rest: str) -> Column:
    """The positional grams of a word that equal a chunk of a word as long (one replaced), or shorter by one (one put in).

    A chunk of the shorter word is preserved in place, or shifted by one; where the first is shifted, so is the second,
    and where the second is in place, so is the first, so one of each is enough.
    """
    length = F.length(rest)
    first, second = _halves(length)
    fewer_first, fewer_second = _halves(length - 1)
    return F.array(
        _piece(0, length, F.lit(0), first, rest), _piece(1, length, first, second, rest),
        _piece(0, length - 1, F.lit(0), fewer_first, rest), _piece(1, length - 1, fewer_first + 1, fewer_second, rest),
    )


def _split(groups: DataFrame, side: str) -> DataFrame:
    """One level deeper: a row for each piece of the rest; the key is a hash of all pieces so far."""
    piece = chunks("rest") if side == "a" else grams("rest")
    rows = groups.select("key", "word", F.explode(piece).alias("p"))
    return rows.select(F.xxhash64("key", "p.of", "p.half", "p.text").alias("key"), "word", F.col("p.left").alias("rest"))


def one_edit(a: str, b: str) -> Column:
    """Exactly one code point put in, taken out or replaced."""
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """Pairs of different words (word, other), both ways round."""
    spark = words.sparkSession
    tasks = shuffle_partitions(spark)
    whole = words.select(F.lit(0).cast("long").alias("key"), "word", F.col("word").alias("rest")).repartition(tasks, "word")
    sides, found = {"a": whole, "b": whole}, None
    while True:
        sides = {side: stored(_split(rows, side), f"pieces-{side}") for side, rows in sides.items()}
        count = lambda side: sides[side].groupBy("key").agg(F.count(F.lit(1)).alias(side), F.max(F.length("rest")).alias(f"{side}_left"))  # noqa: B023, E731
        sizes = count("a").join(count("b"), "key")
        large = (F.col("a") * F.col("b") > group) & (F.col("a_left") > 1)
        sizes = stored(sizes.where((F.col("a") > 1) | (F.col("b") > 1) | (F.col("a_left") != F.col("b_left"))).select("key", large.alias("large")), "piece-groups")
        a, b = (sides[s].join(sizes.where("NOT large"), "key").select("key", F.col("word").alias(f"{s}_word")) for s in "ab")
        # equally long words meet both ways round; one is enough
        once = (F.length("a_word") < F.length("b_word")) | (F.col("a_word") < F.col("b_word"))
        met = a.join(b, "key").where(once & one_edit("a_word", "b_word")).select("a_word", "b_word").distinct()
        met = stored(met, "near-pairs")
        found = met if found is None else found.unionByName(met)
        if sizes.where("large").isEmpty():
            break
        sides = {side: rows.join(sizes.where("large"), "key").select("key", "word", "rest") for side, rows in sides.items()}
    found = found.distinct()
    both = found.select(F.col("a_word").alias("word"), F.col("b_word").alias("other"))
    return both.unionByName(found.select(F.col("b_word").alias("word"), F.col("a_word").alias("other")))


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n of every word."""
    other = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    first = F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("first")  # most frequent, then smallest
    most = pairs.join(other, "other").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first)
    named = words.join(most.select("word", "n_near", F.col("first.other").alias("form"), (-F.col("first.minus")).alias("form_n")), "word", "left")
    kept = F.col("form_n") >= ratio * F.col("n")
    return named.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(kept, F.col("form")).alias("form"), F.when(kept, F.col("form_n")).alias("form_n")
    )


def with_roots(named: DataFrame) -> DataFrame:
    """Adds root: the end of the chain of forms, by pointer doubling over the words that have one."""
    steps = stored(named.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return named.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, drop: int = 0, least: int = MIN_LENGTH, occurrences: int = MIN_COUNT, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    words = stored(word_counts(docs, drop, least, occurrences), "words")
    named = stored(forms(words, stored(near_pairs(words, group), "pairs"), ratio), "forms")
    return with_roots(named).select("word", "form", "root", "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants(read_table(spark, folder, "documents"), drop=DROP)
