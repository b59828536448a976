import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fixture_rows import FOLDER, ODD
from pitchline.llm import exact_dedup


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[norm(t)].append(d)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda d: (d is None, d))
        out += [(d, ids[0], len(ids), i == 0, hashlib.sha256(text.encode()).hexdigest()) for i, d in enumerate(ids)]
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_table_equals_brute_force(spark, texts):
    assert rows_of(entry.queries()["op9_exact_dedup"](spark, FOLDER)) == brute(texts)


def test_odd_rows_and_tables(odd, none):
    assert rows_of(exact_dedup.exact_groups(odd)) == brute(ODD)
    assert exact_dedup.exact_groups(none).count() == 0
    kept = exact_dedup.drop_copies(odd).collect()
    assert sorted(norm(r.text) for r in kept) == sorted({norm(t) for _, t in ODD}) and len(kept[0]) == 9


def test_overfull_buckets_are_split_and_hot_texts_counted_first(spark):
    rows = [(i, f"text {i}" if i % 3 else "hot text") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()
    assert rows_of(exact_dedup.exact_groups(frame, bucket_rows=20)) == brute(rows)
    index = exact_dedup.write_index(frame, bucket_rows=20)
    assert index.where("keep_id = 0").count() == 5 and index.where("keep_id = 0 AND bytes IS NOT NULL").count() == 1
    assert index.select("bucket").distinct().count() > 20 and index.where("bytes IS NOT NULL").count() == 401


@pytest.mark.parametrize("key_bits", [0, 1, 64])
def test_bytes_decide_where_keys_collide(spark, key_bits):
    rows = [(i, f"text {i % 40}" + " " * (i % 3)) for i in range(200)] + [(900, None), (901, ""), (902, " ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()
    for held in (exact_dedup.HELD_BYTES, 60, 1):  # tasks that hold few texts hand on more entries
        assert rows_of(exact_dedup.exact_groups(frame, key_bits=key_bits, held_bytes=held)) == brute(rows)


def test_clashing_names_stay(spark):
    docs = spark.createDataFrame([(1, "a", 5, 6, 7, 8), (2, "a", 5, 6, 7, 8), (3, "b", 5, 6, 7, 8)], "doc_id long, text string, __row int, __kept_row int, first_row int, bucket int").cache()
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == [(1, "a", 5, 6, 7, 8), (3, "b", 5, 6, 7, 8)]


def test_directory_covers_every_key_and_splits_only_overfull_buckets():
    rng = np.random.default_rng(1)
    size = 1 << exact_dedup.SLOT_BITS
    slots = {int(s): (int(n), int(n)) for s, n in zip(rng.choice(size, 500, replace=False), rng.integers(1, 9, 500))}
    slots[7] = (1000, 1000)
    found = exact_dedup.Directory(slots, bucket_rows=50)
    at = lambda slot, rest=0: found.bucket(slot << (64 - exact_dedup.SLOT_BITS) | rest)
    buckets = np.array([at(s) for s in range(size)])
    load = np.bincount(buckets[list(slots)], [n for n, _ in slots.values()], found.buckets)
    last = at(7, (1 << (64 - exact_dedup.SLOT_BITS)) - 1)
    assert (np.diff(buckets) >= 0).all() and at(size - 1, (1 << (64 - exact_dedup.SLOT_BITS)) - 1) == found.buckets - 1
    assert (load <= 50).sum() == found.buckets - 1 and last - at(7) == 31 and found.depth == exact_dedup.SLOT_BITS + 5
    assert exact_dedup.Directory({}).buckets == 1


@pytest.mark.parametrize("raw", [" a  b ", "a\n\n\tb", "\x0b\x0c", "\x85 a", "a"])
def test_normalised_equals_the_pattern(raw):
    assert exact_dedup.normalised(raw).decode() == norm(raw)


def test_an_owner_task_takes_one_bucket(spark):
    rows = [(i, f"text {i}") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()
    index = exact_dedup.write_index(frame, bucket_rows=20)
    buckets = [len(r.b) for r in index.groupBy(F.input_file_name()).agg(F.collect_set("bucket").alias("b")).collect()]
    assert len(buckets) > 20 and max(buckets) == 1
