from collections import defaultdict

import numpy as np
import xxhash

import __spark_entry__ as entry
from fixture_rows import FOLDER, ODD
from pitchline.llm import simhash
from pitchline.llm.components import components


def brute_print(text):
    words = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values):
    values = np.array(sorted(set(values)), np.uint64)
    group = {int(v): int(v) for v in values}
    changed = True
    near = {int(v): [int(x) for x in values[np.bitwise_count(values ^ v) <= 3]] for v in values}
    while changed:
        changed = False
        for v, others in near.items():
            low = min(group[o] for o in others)
            if low < group[v]:
                group[v], changed = low, True
    return group


def brute(docs):
    prints = [brute_print(t) for _, t in docs]
    group, lowest = brute_components(prints), defaultdict(list)
    for (d, _), p in zip(docs, prints):
        lowest[group[p]].append(d)
    low = {g: min((d for d in ids if d is not None), default=None) for g, ids in lowest.items()}
    return sorted(((d, f"{p:016x}", low[group[p]]) for (d, _), p in zip(docs, prints)), key=repr)


def test_table_equals_brute_force(spark, texts):
    rows = entry.queries()["op10_simhash"](spark, FOLDER).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(texts)


def test_odd_rows_and_tables(odd, none):
    rows = simhash.near_groups(odd).collect()
    assert sorted(((r.doc_id, f"{r.print & (1 << 64) - 1:016x}", r.component_id) for r in rows), key=repr) == brute(ODD)
    assert simhash.near_groups(none).count() == 0
    kept = simhash.drop_near_copies(odd)
    assert kept.count() == len(set(brute_components([brute_print(t) for _, t in ODD]).values())) and kept.columns == odd.columns


def test_values_three_bits_apart_share_a_key():
    rng = np.random.default_rng(2)
    left = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 3000, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in left], np.uint64)
    keys_of = []
    for values in (left, left ^ flips):
        keys, rows = simhash.join_keys(values)
        found = defaultdict(set)
        for k, r in zip(keys.tolist(), rows.tolist()):
            found[r].add(k)
        keys_of.append(found)
    assert all(keys_of[0][i] & keys_of[1][i] for i in range(len(left)))
    assert np.mean([len(k) for k in keys_of[0].values()]) < 60


def planted(rng, n):
    base = rng.integers(0, 1 << 62, n, dtype=np.uint64)
    near = base ^ np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for _ in base], np.uint64)
    hub = [int(base[0]) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 3), replace=False)) for _ in range(300)]
    return [*base.tolist(), *near.tolist(), *hub]


def test_links_equal_brute_force_with_and_without_hot_runs(spark):
    values = planted(np.random.default_rng(4), 400)
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "print long")
    want = brute_components(values)
    for hot_run in (simhash.HOT_RUN, 3):
        found = {r.node & (1 << 64) - 1: r.root for r in components(simhash.links(frame, hot_run)).collect()}
        groups, expected = defaultdict(set), defaultdict(set)
        for v in want:
            groups[found.get(v, v - (1 << 64) if v >> 63 else v)].add(v)
            expected[want[v]].add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 150)} | {201: 200, 202: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
