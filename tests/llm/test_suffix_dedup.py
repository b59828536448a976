import hashlib

import numpy as np
import pytest

import __spark_entry__ as entry
from fixture_rows import FOLDER, ODD
from pitchline.llm import suffix_dedup


def brute(docs, length=100):
    """Documents in order; a set of all strings of ``length`` bytes seen so far."""
    seen, out = set(), []
    for doc, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            part = raw[i:i + length]
            if part in seen:
                gone[i:i + length] = True
            seen.add(part)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), int(gone.sum()), int((gone[:-1] > np.r_[False, gone[:-2]]).sum()) if len(raw) else 0, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_table_equals_brute_force(spark, texts):
    assert rows_of(entry.queries()["op8_suffix_dedup"](spark, FOLDER)) == brute(texts)


def test_odd_rows_and_tables(odd, none):
    rows = rows_of(suffix_dedup.remove_repeats(odd))
    assert sorted(map(str, rows)) == sorted(map(str, brute(ODD)))
    assert suffix_dedup.remove_repeats(none).count() == 0


def passages(rng):
    """Documents made of shared passages, frequent lines, copies, periods, and what is between."""
    words = ["".join(rng.choice(list("abcdeé "), 6)) for _ in range(60)]

    def text(n):
        return " ".join(rng.choice(words, n))

    shared, line, copied = [text(rng.integers(10, 60)) for _ in range(6)], text(16), text(80)
    docs = []
    for i in range(160):
        parts = [text(rng.integers(0, 30)), rng.choice(shared) if rng.random() < 0.5 else "", line if i % 2 else "", text(rng.integers(0, 40))]
        docs.append((i * 3, copied if i % 7 == 0 else "".join(parts)))
    return [*docs, (1, "x" * 700), (2, "xy" * 300), (4, "x" * 99), (5, "x" * 100)]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_STRETCHES, 4])
def test_shared_passages_and_hot_anchors(spark, monkeypatch, hot):
    docs = passages(np.random.default_rng(8))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6).cache()
    assert rows_of(suffix_dedup.remove_repeats(frame, hot_stretches=hot)) == brute(docs)


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    docs = passages(rng)
    docs.append((999, "".join(d[1] for d in docs)))
    raws = [d[1].encode() for d in docs]

    def windows(parts):
        out = set()
        for doc, shift, raw in parts:
            text, start, n, _, _ = suffix_dedup.stretches([raw])
            out |= {(doc, shift + s + j) for s, k in zip(start, n) for j in range(k)}
        return out

    whole = windows([(i, 0, r) for i, r in enumerate(raws)])
    size = 500
    cut = windows([(i, a, r[a:a + size + 99]) for i, r in enumerate(raws) for a in range(0, max(1, len(r) - 99), size)])
    assert whole == cut == {(i, a) for i, r in enumerate(raws) for a in range(len(r) - 99)}


def test_merged_transforms_hold_the_repeated_intervals():
    rng = np.random.default_rng(1)
    strings = [bytes(rng.choice(list(b"ab"), rng.integers(1, 40)).tolist()) for _ in range(60)]
    shards = rng.integers(0, 5, 60)
    transforms = suffix_dedup.Transforms(strings, shards)
    for shard in range(5):  # each shard's rows are its suffixes in order
        own = [p for p in transforms.place if shards[transforms.string[p]] == shard]
        suffixes = [strings[transforms.string[p]][p - transforms.starts[transforms.string[p]]:] for p in own]
        assert suffixes == sorted(suffixes)
    for depth in (1, 3, 8):
        rows, interval = suffix_dedup.merge(transforms, depth)
        found, parts = {}, []
        for r, i in zip(rows, interval):
            p = transforms.place[r]
            part = strings[transforms.string[p]][p - transforms.starts[transforms.string[p]]:][:depth]
            assert found.setdefault(i, part) == part
            parts.append(part)
        assert parts == sorted(parts) and len(set(found.values())) == len(found)
        every = [s[i:i + depth] for s in strings for i in range(len(s) - depth + 1)]
        assert len(parts) == sum(every.count(p) for p in set(every) if every.count(p) > 1)


def test_stretches_cover_each_window_once_and_depend_on_its_bytes():
    raws = [b"", b"a" * 99, b"a" * 250, b"0123456789" * 30, b"z" + b"0123456789" * 30]
    text, start, n, key, content = suffix_dedup.stretches(raws)
    covered = [(t, s + j) for t, s, k in zip(text, start, n) for j in range(k)]
    assert sorted(covered) == [(t, i) for t, r in enumerate(raws) for i in range(len(r) - 99)]
    anchors = {}
    for t, s, k, a in zip(text, start, n, key):
        for j in range(k):
            assert anchors.setdefault(raws[t][s + j:s + j + 100], a) == a
