import random

import __spark_entry__ as entry
from fixture_rows import FOLDER, ODD
from pitchline.llm import minhash


def brute_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs):
    sets = [brute_set(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 85 * len(sets[i] | sets[j]) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    low = {}
    for (d, _), g in zip(docs, group):
        low[g] = min((x for x in (low.get(g), d) if x is not None), default=None)
    return sorted(((d, len(s), low[g], d == low[g]) for (d, _), s, g in zip(docs, sets, group)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.n, r.component_id, r.doc_id == r.component_id) for r in df.collect()), key=repr)


def words(rng, n, of=400):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return out


def planted(rng):
    """Groups at and around the limit, one large group, and documents that share only a passage."""
    texts = []
    for size in (5, 9, 20, 60, 70, 150, 400):
        for _ in range(4):
            base = words(rng, size)
            texts += [base, *(edited(rng, base, e) for e in (0, 1, 1, 2, 3, 5, 8))]
    hub = words(rng, 300)
    texts += [edited(rng, hub, rng.randrange(8)) for _ in range(150)]
    line = words(rng, 40)
    texts += [words(rng, rng.randrange(50)) + line + words(rng, rng.randrange(80)) for _ in range(150)]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_table_equals_brute_force(spark, texts):
    rows = entry.queries()["op11_minhash"](spark, FOLDER).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(texts)


def test_planted_groups_equal_brute_force_with_small_blocks(spark):
    docs = planted(random.Random(3))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).cache()
    want = brute(docs)
    assert len({w[2] for w in want}) < len(docs) - 150
    assert found(minhash.near_groups(frame)) == want
    assert found(minhash.near_groups(frame, size=24, block=7)) == want


def test_odd_rows_and_tables(odd, none):
    assert found(minhash.near_groups(odd)) == brute(ODD)
    assert minhash.near_groups(none).count() == 0


def test_members_outside_the_first_component_still_meet(spark):
    """A chain: neighbours link, others do not, so that a leader reaches few of its lists' members."""
    rng = random.Random(5)
    chain = [words(rng, 200)]
    for _ in range(40):
        chain.append(edited(rng, chain[-1], 2))
    docs = [(i, " ".join(t)) for i, t in enumerate(chain)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).cache()
    assert found(minhash.near_groups(frame, block=5)) == brute(docs)


def test_overlap_that_links_are_sure_to_have():
    assert minhash.sure_overlap() in range(160, 190) and minhash.sure_overlap(100) == 256 and minhash.sure_overlap(85, 24) >= 1
