import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitchline.functions.fuzzy import EncodedStrings, ratio, sorted_ratio, token_sort_ratio
from pitchline.operators import checks, history, isotonic, merge, metrics, ordering, resolve

# ---------------------------------------------------------------- merge


def test_merge_modes(spark):
    target = spark.createDataFrame([("a", 1, "t"), ("b", None, "t")], "k string, v int, w string")
    updates = spark.createDataFrame([("a", None, "u1", 1), ("a", 3, "u2", 2), ("a", None, "u3", 3), ("b", 5, "u", 1), ("c", 7, "u", 1)], "k string, v int, w string, at int")
    run = lambda mode, t=target: sorted(map(tuple, merge.merge(t, updates, ["k"], ["at"], mode).collect()))
    assert run(merge.REPLACE) == [("a", None, "u3"), ("b", 5, "u"), ("c", 7, "u")]
    assert run(merge.COALESCE) == [("a", 3, "u3"), ("b", 5, "u"), ("c", 7, "u")]
    assert run(merge.KEEP) == [("a", 1, "t"), ("b", None, "t"), ("c", 7, "u")]
    once = merge.merge(target, updates, ["k"], ["at"])
    assert sorted(map(tuple, merge.merge(once, updates, ["k"], ["at"]).collect())) == run(merge.REPLACE)


def test_lookup_falls_back_and_keeps_rows(spark):
    dim = spark.createDataFrame([("1", "x", 10), ("1", "x2", 9), ("2", "y", 20)], "id string, name string, key int")
    rows = spark.createDataFrame([(0, "1", "y"), (1, "9", "y"), (2, None, None), (3, "1", "q")], "r int, i string, n string")
    out = merge.attach_first(rows, dim, [{"i": "id"}, {"n": "name"}], "key", "found")
    assert sorted((r.r, r.found) for r in out.collect()) == [(0, 9), (1, 20), (2, None), (3, 9)]


def test_rejects_carry_the_first_reason(spark):
    rows = spark.createDataFrame([(1, None), (2, 5), (None, None)], "a int, b int")
    good, bad = merge.split_rejects(rows, {"no a": F.col("a").isNull(), "no b": F.col("b").isNull()})
    assert [tuple(r) for r in good.collect()] == [(2, 5)]
    assert sorted(r.reason for r in bad.collect()) == ["no a", "no b"]
    assert {(r.status, r.rows) for r in merge.run_counters(bad, F.col("reason")).collect()} == {("no a", 1), ("no b", 1)}


# ---------------------------------------------------------------- ordering


def days_and_ids(n, hot_day=False):
    rng = random.Random(n)
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(n)]
    return [(i, dt.date(2016, 1, 1) + dt.timedelta(days=0 if hot_day and k % 3 else rng.randrange(20))) for k, i in enumerate(ids)]


@pytest.mark.parametrize("n,sizes", [(10, (7, 1, 2)), (11, (7, 2, 2)), (500, (350, 75, 75))])
def test_row_split(spark, n, sizes):
    rows = days_and_ids(n, hot_day=True)
    df = spark.createDataFrame(rows, "match_id long, match_date date")
    got = {r.match_id: r.split for r in ordering.split_by_rows(df).collect()}
    want = {}
    for place, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0]))):
        want[i] = "train" if place < sizes[0] else "valid" if place < sizes[0] + sizes[1] else "test"
    assert got == want


def test_match_split_keeps_matches_together(spark):
    rows = [(i, d, m) for i, d in days_and_ids(40) for m in range(3)]
    out = ordering.split_by_match(spark.createDataFrame(rows, "match_id long, match_date date, minute int"))
    assert out.groupBy("match_id").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()
    with pytest.raises(ValueError):
        ordering.split_by_match(spark.createDataFrame(rows[:27], "match_id long, match_date date, minute int"))


def test_exact_medians(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"a": rng.normal(size=5001), "b": rng.integers(0, 3, 5001).astype(float), "c": rng.lognormal(size=5001), "d": [None] * 5001})
    frame.loc[::7, "c"] = None
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), "a double, b double, c double, d double")
    got = ordering.exact_medians(df, list("abcd"))
    assert got == {"a": frame.a.median(), "b": frame.b.median(), "c": frame.c.astype(float).median(), "d": None}


# ---------------------------------------------------------------- fuzzy matching


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


words = st.text(alphabet="abcdé ", max_size=90)


@settings(max_examples=200, deadline=None)
@given(words, st.lists(words, min_size=1, max_size=6))
def test_ratio_equals_dynamic_programming(a, others):
    got = EncodedStrings(others).ratios(a)
    for b, r in zip(others, got):
        total = len(a) + len(b)
        want = 100.0 if total == 0 else (1.0 - (total - 2 * lcs(a, b)) / total) * 100.0
        assert r == want == ratio(a, b) == ratio(b, a) and 0 <= r <= 100


def test_token_sort_ratio(spark):
    rows = [("Lionel  MESSI", "messi lionel"), ("", ""), ("a", ""), (None, "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(token_sort_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [100.0, 100.0, 0.0, 0.0]


def test_ratio_columns_equal_dynamic_programming(spark):
    rng = random.Random(2)
    text = lambda: "".join(rng.choice("abcdé 😀x") for _ in range(rng.choice([0, 1, 5, 20, 61, 62, 63, 64, 100, 124, 125, 200])))
    df = spark.createDataFrame([(text(), text()) for _ in range(300)] + [("", ""), ("a", "")], "a string, b string").withColumn("r", sorted_ratio(F.col("a"), F.col("b")))
    assert all(r.r == ratio(r.a, r.b) for r in df.collect())
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString() and "Arrow" not in df._jdf.queryExecution().executedPlan().toString()


def test_bounds_of_the_name_index_hold(spark):
    """Letter signatures and shared pairs bound every ratio."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("aaabcdeé") for _ in range(rng.randrange(0, 9)))
    rows = [(" ".join(sorted([word(), word()])).strip(), " ".join(sorted([word(), word()])).strip()) for _ in range(400)]
    rows += [(a, a[:k] + a[k + 1:]) for a, _ in rows for k in (1, 4)]
    df = spark.createDataFrame(rows, "a string, b string")
    pairs = {c: resolve.name_pairs(F.col(c)) for c in "ab"}
    differ = F.bit_count(resolve.letter_signature(F.col("a")).bitwiseXOR(resolve.letter_signature(F.col("b"))))
    shared = F.size(F.array_intersect(pairs["a"], pairs["b"]))
    ratio_ab = sorted_ratio(F.col("a"), F.col("b"))
    out = df.select("a", "b", differ.alias("differ"), shared.alias("shared"), ratio_ab.alias("ratio"), resolve.shared_pairs(F.length("a"), ratio_ab).alias("needed"), F.size(pairs["a"]).alias("n")).collect()
    for r in out:
        total = len(r.a) + len(r.b)
        assert r.differ <= round((1 - r.ratio / 100) * total) and r.shared >= r.needed and r.n == len(r.a) + 1
    assert sum(r.needed > 3 for r in out) > 100


def brute_mapping(left, right):
    from pitchline.functions.fuzzy import ratio as r

    norm = lambda s: " ".join(sorted((s or "").strip().lower().split()))
    out = {}
    for key, name, team in left:
        best = None
        for rid, rn, rt in sorted(right, key=lambda x: (x[0], x[1], x[2] or "")):
            score = round(0.8 * r(norm(name), norm(rn)) + 0.2 * r(norm(team), norm(rt)), 2)
            if score > (best[0] if best else 0.0):
                best = (score, rid)
        if best:
            out[key, team] = best
    return out


@pytest.mark.parametrize("piece", [7, 20000])
def test_best_match_equals_brute_force(spark, piece):
    rng = random.Random(5)
    first, last = ["jose", "joão", "carl", "karl", "ana", "li", "maximilian"], ["silva", "santos", "sanchez", "li", "o", "müller-lüdenscheidt"]
    name = lambda: " ".join(rng.sample(first, rng.randrange(1, 3)) + [rng.choice(last)])
    left = [(i, name() if i % 3 else "jose silva", rng.choice(["real", "real b", "porto", "benfica", ""])) for i in range(60)]
    left += [(100, "", "zzz"), (101, "qqq", "www"), (102, "x" * 80 + " jose", "porto")]
    right = [(1000 - i, rng.choice([name(), "  Jose  SILVA", "silva jose"]), rng.choice(["Real", "Porto CF", "benfica", None])) for i in range(80)]
    right += [(5, "x" * 90, "porto")]
    schema = "player_id long, player_name string, team_name string"
    got = resolve.best_matches(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "player_id", "player_name", "team_name", piece)
    assert {(r.player_id, r.team_name): (r.score, r.match.id) for r in got.collect()} == brute_mapping(left, right)


@pytest.mark.parametrize("piece", [5, 20000])
def test_best_match_by_the_index_equals_brute_force(spark, piece):
    """Names with close ones, equal teams, a name that many keys share, and some without any close name."""
    rng = random.Random(11)
    letters = "abcdefghijklmnoprstuvz"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) + " " + "".join(rng.choice(letters) for _ in range(rng.randrange(4, 10))) for _ in range(70)]

    def spoilt(name):
        at = rng.randrange(len(name))
        return rng.choice([name, name[:at] + name[at + 1:], name[:at] + "x" + name[at:], name[:at] + "q" + name[at + 1:], name.upper()])

    teams = ["Real Madrid", "Porto", "Benfica", "Real Sociedad", "", "AC Milan"]
    left = [(i, spoilt(spoilt(n)), rng.choice(teams)) for i, n in enumerate(base)] + [(200 + k, base[0], t) for k, t in enumerate(teams)]
    left += [(300, "wwwww", "Porto"), (301, "", ""), (302, "yy", "zz")]
    right = [(500 - i, spoilt(n), rng.choice([*teams, None, "Madrid Real", "SL Benfica"])) for i, n in enumerate(base * 2)]
    schema = "player_id long, player_name string, team_name string"
    frames = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = resolve.best_matches(*frames, "player_id", "player_name", "team_name", piece)
    assert {(r.player_id, r.team_name): (r.score, r.match.id) for r in got.collect()} == brute_mapping(left, right)
    names = [f.select(resolve.sorted_tokens(resolve.simple_name(F.col("player_name"))).alias(f"{c}_name"), resolve.sorted_tokens(resolve.simple_name(F.col("team_name"))).alias(f"{c}_team")).distinct() for f, c in zip(frames, "lr")]
    keyed, found = resolve.possible_names(*names, (0.8, 0.2))
    assert keyed.where("by_index").count() > 50 and found.count() < 0.1 * 70 * 140


def test_names_that_share_all_common_pairs(spark, monkeypatch):
    """Numbered names without close ones: a first score meets a bucket of right names, nothing that met is sorted, ties go to the smallest id."""
    monkeypatch.setattr(resolve, "PROBED", 8)
    kinds = ["BUILDING", "AUTOMOBILE", "MACHINERY"]
    left = [(i, f"Supplier#{i:09d}", None) for i in range(0, 120, 2)]
    right = [(900 - i, f"{i:09d} Supplier Club {kinds[i % 3]}", None) for i in range(400)]
    schema = "team_id long, team_name string, none string"
    frames = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = resolve.best_matches(*frames, "team_id", "team_name", piece=150)
    want = {k: (s, i) for (k, _), (s, i) in brute_names(left, right).items()}
    assert {r.team_id: (r.score, r.match.id) for r in got.collect()} == want
    names = [f.select(resolve.sorted_tokens(resolve.simple_name(F.col("team_name")))) for f in frames]
    index = resolve.NameIndex(*names)
    assert 0 < index.probes().count() <= 60 * resolve.PROBES * 3 * 8
    assert "SortAggregate" not in index.first_scores()._jdf.queryExecution().executedPlan().toString()


def brute_names(left, right):
    norm = lambda s: " ".join(sorted(s.lower().split()))
    out, texts = {}, EncodedStrings([norm(rn) for _, rn, _ in right])
    for key, name, _ in left:
        scores = [(-round(float(s), 2), rid) for s, (rid, _, _) in zip(texts.ratios(norm(name)), right)]
        out[key, None] = (-min(scores)[0], min(scores)[1])
    return out


def test_strings_that_end_alike_share_their_bits():
    """Numbers before the same words: fewer columns than characters are computed."""
    names = EncodedStrings([f"{i:04d} building club supplier" for i in range(1000)])
    assert sum(len(column) for _, column in names.levels) < 3 * 1000


def test_mapping_rows(spark):
    schema = "player_id long, player_name string, team_name string"
    rows = resolve.player_mapping(spark.createDataFrame([(1, "Ana Li", "Porto")], schema), spark.createDataFrame([(7, "li ana", "Porto"), (8, "li ana", "Porto")], schema), "2025/2026")
    r = rows.first()
    assert (r.fbref_player_id, float(r.confidence_score), r.mapping_status, r.notes) == ("7", 100.0, "auto_approved", "name/team fuzzy match - score=100.0")
    none = resolve.player_mapping(spark.createDataFrame([(1, "Ana Li", "Porto")], schema), spark.createDataFrame([], schema), "x")
    assert none.isEmpty()


# ---------------------------------------------------------------- checks and metrics


def test_checks(spark):
    df = spark.createDataFrame([(1, "H", None), (1, "X", 2.0), (2, None, None)], "k int, t string, f double")
    assert [tuple(r) for r in checks.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in checks.outside_domain(df, "t", ["H"]).collect()] == [("X", 1)]
    assert [tuple(r) for r in checks.null_counts(df, ["f", "t", "k"]).collect()] == [("f", 2), ("t", 1)]
    parents = spark.createDataFrame([(2,)], "id int")
    assert checks.orphans(df, parents, {"k": "id"}).count() == 2
    assert {(r.t, r.share) for r in checks.shares(df, "t").collect()} == {("H", 0.5), ("X", 0.5)}
    for call in (
        lambda: checks.require_columns(df, ["k", "zz"]), lambda: checks.require_rows(df.limit(0), "x"), lambda: checks.require_unique(df, ["k"]),
        lambda: checks.require_domain(df, "t", ["H"]), lambda: checks.require_no_nulls(df, ["f"]),
    ):
        with pytest.raises(ValueError):
            call()


def test_metrics(spark):
    rows = [("A", "A", 0.5), ("A", "D", 0.25), ("H", "H", 1.0), ("H", "H", 0.0)]
    df = spark.createDataFrame(rows, "label string, prediction string, p double")
    s = metrics.scores(df, p_true=F.col("p")).first()
    assert (s.rows, s.accuracy, s.balanced_accuracy) == (4, 0.75, 0.75)
    assert s.log_loss == pytest.approx(-(np.log(0.5) + np.log(0.25) + np.log(np.finfo(float).eps)) / 4)
    report = {r["class"]: tuple(r)[1:] for r in metrics.classification_report(df).collect()}
    assert report == {"A": (1.0, 0.5, 2 / 3, 2), "D": (0.0, 0.0, 0.0, 0), "H": (1.0, 1.0, 1.0, 2)}
    matrix = [tuple(r) for r in metrics.confusion_matrix(df).collect()]
    assert matrix == [("A", 1, 1, 0), ("D", 0, 0, 0), ("H", 0, 0, 2)]


# ---------------------------------------------------------------- selection, histories, isotonic fit


def test_order_keys_are_the_bits_of_doubles(spark):
    import struct

    rng = random.Random(4)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 1023.9999999999999]
    values += [2.0**k * f for k in (-1074, -1023, -1022, -3, 0, 52, 1023) for f in (1.0, 1 + 2**-52)] + [rng.uniform(-1, 1) * 10.0**rng.randrange(-300, 300) for _ in range(500)]
    values = [v for v in values if v == v]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordering.order_key(F.col("v")).alias("k")).collect()
    for v, k in rows:
        bits = struct.unpack(">q", struct.pack(">d", abs(v)))[0]
        assert k == (-bits if v < 0 else bits) and ordering.value_of_key(k) == v
    assert spark.createDataFrame([(None,)], "v double").select(ordering.order_key(F.col("v"))).first()[0] is None


def test_medians_of_wide_and_hot_columns(spark):
    rng = random.Random(6)
    rows = [(rng.choice([0.0, 0.0, 1.5]), rng.uniform(-1e-300, 1e300), rng.gauss(0, 1), None if i % 3 else float(i), 7.0, None) for i in range(2001)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(6)
    want = {c: (None if not (v := [r[i] for r in rows if r[i] is not None]) else float(np.median(v))) for i, c in enumerate("abcdef")}
    assert ordering.exact_medians(df, list("abcdef")) == want
    assert ordering.kth_of_all(df, ["c"], {"c": [0, 17, 2000]}, digit=3) == {"c": [sorted(r[2] for r in rows)[k] for k in (0, 17, 2000)]}


def test_history_of_a_team_with_a_third_of_all_rows_on_one_day(spark):
    rng = random.Random(3)
    day = dt.date(2024, 1, 1)
    rows = [(i, 1 if i % 3 == 0 else rng.randrange(2, 40), day if i % 3 == 0 else day + dt.timedelta(days=rng.randrange(400)), rng.randrange(9)) for i in range(3000)]
    rows += [(5000, None, day, 1), (5001, 3, None, 1), (5002, 99, day, 4)]
    df = spark.createDataFrame(rows, "match_id long, team int, match_date date, v int").repartition(7)
    got = {r.match_id: r for r in history.with_recent(df, ["team"], ["v"], 5, ranges=12).collect()}
    past = {}
    for m, team, when, v in sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: (r[2], r[0])):
        mine = past.setdefault(team, [])
        assert [(x.match_id, x.v) for x in got[m].recent] == mine[-5:] and got[m].played_before == len(mine)
        mine.append((m, v))
    assert [got[m].recent for m in (5000, 5001)] == [[], []] and len(got) == len(rows)


def test_ranges_of_a_history_are_even(spark):
    """No task gets above twice the median, though one team has a third of all rows on one day."""
    rows = spark.range(60_000).selectExpr("id AS match_id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 977 END AS team", "date_add(date'2024-01-01', CASE WHEN id % 3 = 0 THEN 0 ELSE CAST(id % 300 AS INT) END) AS match_date")
    dealt = rows.repartitionByRange(16, "team", "match_date", "match_id").groupBy(F.spark_partition_id()).count()
    counts = sorted(r["count"] for r in dealt.collect())
    assert counts[-1] <= 2 * counts[len(counts) // 2]


def brute_isotonic(points):
    """Max over starts of min over ends of the weighted mean, at each score."""
    scores = sorted({x for x, _, _ in points})
    total, weight = np.zeros(len(scores) + 1), np.zeros(len(scores) + 1)
    for x, y, w in points:
        total[scores.index(x) + 1] += y * w
        weight[scores.index(x) + 1] += w
    total, weight = total.cumsum(), weight.cumsum()
    mean = lambda a, b: (total[b] - total[a]) / (weight[b] - weight[a])
    return {x: max(min(mean(a, b) for b in range(i + 1, len(scores) + 1)) for a in range(i + 1)) for i, x in enumerate(scores)}


@pytest.mark.parametrize("ranges", [1, 5])
def test_isotonic_fit_equals_brute_force(spark, ranges):
    rng = random.Random(ranges)
    points = [(x := rng.randrange(60) / 64, float(rng.random() < x), float(rng.randrange(1, 4))) for _ in range(400)]
    df = spark.createDataFrame([*points, (None, 1.0, 1.0), (0.5, None, 1.0), (0.5, 1.0, 0.0)], "s double, y double, w double")
    blocks = sorted(map(tuple, isotonic.isotonic_blocks(df, "s", "y", "w", ranges).collect()))
    want = brute_isotonic(points)
    for x, v in want.items():
        inside = [t / w for lo, hi, t, w in blocks if lo <= x <= hi]
        assert len(inside) == 1 and inside[0] == pytest.approx(v, abs=1e-12)
    assert all(a[1] < b[0] and a[2] / a[3] < b[2] / b[3] for a, b in zip(blocks, blocks[1:]))


def test_isotonic_fit_is_straight_between_blocks_and_flat_beyond(spark):
    rng = random.Random(8)
    points = [(x := rng.random(), float(rng.random() < x)) for _ in range(300)]
    fit = isotonic.IsotonicFit.fit(spark.createDataFrame(points, "s double, y double"), "s", "y")
    want = brute_isotonic([(x, y, 1.0) for x, y in points])
    xs, probes = sorted(want), [-1.0, 0.0, 0.3, 0.77777, 1.0, 2.0]
    got = fit.transform(spark.createDataFrame([(v, 1) for v in [*xs, *probes, None]], "s double, x0 int"), "s", "p").collect()
    assert all(r.p == pytest.approx(np.interp(r.s, xs, [want[x] for x in xs]), abs=1e-9) for r in got if r.s is not None)
    assert len(got) == len(xs) + 7 and [r.p for r in got if r.s is None] == [None] and got[0].x0 == 1
    none = isotonic.IsotonicFit.fit(spark.createDataFrame([], "s double, y double"), "s", "y")
    assert none.transform(spark.createDataFrame([(0.5,)], "s double"), "s", "p").first().p is None
