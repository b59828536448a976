import random
import re
import zlib
from collections import Counter

import __spark_entry__ as entry
from fixture_rows import FOLDER, ODD
from pitchline.llm import spelling


def brute_counts(docs, drop=199, least=6):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop and h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                found[run] += 1
    return found


def around(word, letters):
    """All strings one edit away."""
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in letters}
    return (out | {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}) - {word}


def brute(docs, drop=199, occurrences=5, ratio=5):
    n = {w: c for w, c in brute_counts(docs, drop).items() if c >= occurrences}
    letters = set("".join(n))
    near = {w: [x for x in around(w, letters) if x in n] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(rows, key=repr)


def found(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4).cache()


def test_table_equals_brute_force(spark, texts):
    rows = found(entry.queries()["op13_spelling_variants"](spark, FOLDER))
    assert rows == brute(texts) and len(rows) > 100 and sum(r[4] for r in rows) > 20


def planted(rng):
    """Chains of edits, words with accents and signs of the range, ties, and many words that differ in two letters only."""
    words = Counter()
    for _ in range(60):
        word = "".join(rng.choice("abcdeéÿ×") for _ in range(rng.randrange(6, 14)))
        n = 5 * 6 ** 3
        while n >= 3:
            words[word] += n
            words["".join(rng.sample(word, len(word)))] += 5
            at, c = rng.randrange(len(word)), rng.choice("abcdeéÿ")
            word = rng.choice([word[:at] + word[at + 1:], word[:at] + c + word[at:], word[:at] + c + word[at + 1:]])
            n //= rng.choice([1, 5, 6])
            if rng.random() < 0.1:
                break
    for a in "abcdefghijklmnop":
        for b in "abcdefghijklmnop":
            words["prefix" + a + b] += rng.randrange(5, 40)
            words[a + b + "suffixes"] += rng.randrange(5, 40)
    runs = [w for w, n in words.items() for _ in range(n)]
    rng.shuffle(runs)
    return [(i, " ".join(w.upper() if w.isascii() and k % 3 == 0 else w for k, w in enumerate(runs[i::50]))) for i in range(50)]


def test_planted_words_equal_brute_force_with_small_groups(spark):
    docs = planted(random.Random(8))
    docs_frame, want = frame(spark, docs), brute(docs)
    assert max(r[4] for r in want) > 20 and sum(1 for r in want if r[1] and r[2] != r[1]) > 5
    assert found(spelling.variants(docs_frame, drop=199)) == want
    assert found(spelling.variants(docs_frame, drop=199, group=4)) == want
    assert found(spelling.variants(docs_frame)) == brute(docs, drop=0)


def test_odd_rows_and_tables(odd, none):
    assert found(spelling.variants(odd, drop=3, occurrences=1)) == brute(ODD, drop=3, occurrences=1)
    assert spelling.variants(none).count() == 0


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    docs = [(i, " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopq'[k]}" for k in range(7))) for i in range(100)]
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    assert dict(map(tuple, spelling.word_counts(frame(spark, docs)).collect())) == dict(brute_counts(docs, 0))
