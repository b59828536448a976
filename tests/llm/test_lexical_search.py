import math
import random
import re
from collections import Counter

import pyarrow.parquet as pq

import __spark_entry__ as entry
from fixture_rows import FOLDER, ODD
from pitchline.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, top=10):
    held = [(d, Counter(brute_terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    count, total, out = len(held), sum(n for *_, n in held), []
    df = Counter(t for _, c, _ in held for t in c)
    for item_id, text in items:
        scores = []
        for k, (d, c, n) in enumerate(held):
            m = 100 - 90 + 90 * n * count // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(brute_terms(text)) if t in c)
            if score > 0:
                scores.append((-score, d is None, d, k))
        out += [(item_id, r, d, -s) for r, (s, _, d, _) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def test_table_equals_brute_force(spark, texts):
    items = list(zip(*(c.to_pylist() for c in pq.read_table(f"{FOLDER}/benchmark.parquet", columns=["item_id", "text"]).columns)))
    assert found(entry.queries()["op12_lexical_search"](spark, FOLDER)) == brute(texts, items)


ITEMS = [("a", "One two"), ("b", None), ("c", "don't wörld 1234567890 one"), ("d", "?!"), ("e", "absent"), ("a", "TWO words word"), (None, "one word"), ("f", "one one two " * 50)]


def test_odd_rows_and_tables(spark, odd, none):
    items = spark.createDataFrame([(i, t, 1, 2) for i, t in ITEMS], "item_id string, text string, rank int, score int").repartition(2).cache()
    assert found(ls.search(odd, items)) == brute(ODD, ITEMS)
    assert found(ls.search(odd, items, top=3, block_chars=20)) == brute(ODD, ITEMS, 3)
    assert ls.search(none, items).count() == 0 and ls.search(odd, items.limit(0)).count() == 0


def test_ties_go_to_the_smaller_number(spark):
    docs = [(i, "same words here") for i in range(60, 0, -1)] + [(100 + i, "other things") for i in range(80)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = ls.search(frame, spark.createDataFrame([(1, "Same HERE")], "item_id long, text string")).collect()
    assert [r.doc_id for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, 11))


def members(plan):
    """Terms of each node."""
    held = [list(g) for g in plan.groups]
    for a, b in plan.sums:
        held.append(held[a] + held[b])
    return held


def test_graph_holds_each_term_of_an_item_once_and_saves_sums():
    rng = random.Random(1)
    shared = [set(rng.sample(range(400), 12)) for _ in range(6)]
    items = [set(rng.sample(range(400), 10)) | shared[i % 6] | (shared[(i * 5) % 6] if i % 3 else set()) for i in range(80)] + [set()]
    for limit in (ls.MAX_PAIRS, 50, 0):
        plan = ls.Plan(items, limit)
        held = members(plan)
        assert [sorted(t for n in nodes for t in held[n]) for nodes in plan.items] == [sorted(i) for i in items]
    plain = sum(len(i) - 1 for i in items if i)
    assert ls.Plan(items).additions() < 0.6 * plain
