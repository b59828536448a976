import hashlib
import re

import numpy as np
import pytest

import __spark_entry__ as entry
from fixture_rows import FOLDER
from pitchline.llm import decontaminate
from pitchline.llm.common import read_table

PATTERN = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def words(text):
    return re.findall(PATTERN, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        found = words(text)
        m = min(13, len(found))
        for i in range(len(found) - m + 1 if m else 0):
            windows.setdefault(tuple(found[i:i + m]), set()).add(item)
    out = []
    for doc, text in docs:
        found = words(text)
        hit, named = np.zeros(len(found), bool), set()
        for m in {len(w) for w in windows}:
            for i in range(len(found) - m + 1):
                if (w := tuple(found[i:i + m])) in windows:
                    hit[i:i + m] = True
                    named |= windows[w]
        listed = sorted(str(i) for i in named if i is not None)
        n = int(hit.sum())
        out.append((doc, len(found), n, len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), n > 0 and 20 * n >= len(found)))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.drop("row").collect()), key=repr)


def test_table_equals_brute_force(spark, texts):
    items = [tuple(r) for r in read_table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    want = brute(texts, items)
    assert rows_of(entry.queries()["op5_decontamination"](spark, FOLDER)) == want and any(r[5] for r in want)


def cases():
    rng = np.random.default_rng(6)
    vocabulary = ["a", "b", "Cé", "d1", "e"]
    items = [(i, " ".join(rng.choice(vocabulary, n))) for i, n in enumerate([1, 2, 5, 12, 13, 14, 30, 40, 13, 0])]
    items += [(20, items[6][1]), (20, items[6][1]), (None, items[7][1]), (21, None), (22, "!? --"), (23, "unique"), (24, "tail of the text")]
    docs = [(i, "; ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(60)]
    for i, (_, text) in enumerate(items):
        docs.append((100 + i, f"X y {text or ''} z"))
        docs.append((100 + i, f"X y {text or ''} z"))
    docs += [(200, None), (201, ""), (None, items[7][1]), (202, "unique"), (203, "the tail of the text"), (204, "word " * 4000 + (items[6][1] or ""))]
    return docs, items


@pytest.mark.parametrize("short", [True, False])
def test_odd_rows_and_short_items(spark, short):
    docs, items = cases()
    items = [i for i in items if short or len(words(i[1])) >= 13]
    frame = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], "doc_id long, text string, row int, hash long, context string").repartition(4).cache()
    tests = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, length int")
    want = brute(docs, items)
    assert rows_of(decontaminate.contamination(frame, tests)) == want
    kept = decontaminate.drop_contaminated(frame, tests)
    assert kept.columns == frame.columns and kept.count() == sum(not r[5] for r in want)


def test_empty_tables(spark, odd, none):
    items = none.withColumnRenamed("doc_id", "item_id")
    assert decontaminate.contamination(none, items).count() == 0
    assert {r.contaminated for r in decontaminate.contamination(odd, items).collect()} == {False}


def test_every_long_shared_span_shares_a_fingerprint():
    rng = np.random.default_rng(3)
    for length in range(1, 14):
        for _ in range(30):
            span = " ".join(rng.choice(["a", "b", "cc"], length))
            left, right = ("x " * int(rng.integers(0, 5)) + span + " y" * int(rng.integers(0, 5)) for _ in range(2))
            prints = [{int(h) for h in decontaminate.Words([t]).selected(length)[1]} for t in (left, right)]
            assert prints[0] & prints[1]


def test_a_passage_of_many_items_and_documents_gives_no_pairs(spark, monkeypatch):
    phrase = " ".join(f"p{i}" for i in range(13))
    items = [(i, f"before{i} {phrase} after{i}") for i in range(400)]
    docs = [(i, f"x{i} y {phrase} z{i}") for i in range(400)]
    rows = {}

    def counted(df, name):
        out = stored(df, name)
        rows[name] = out.count()
        return out

    stored = decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", counted)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).cache()
    got = rows_of(decontaminate.contamination(frame, spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute(docs, items) and rows["hits"] == 400 and rows["different-sets"] == 1 and max(rows.values()) < 2000
