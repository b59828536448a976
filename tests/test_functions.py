import pytest
from pyspark.sql import functions as F

from pitchline.functions import casts, labels, paths, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_file_names(spark):
    rows = [("C:\\d\\events\\123.json",), ("/d/events/123.json",), ("x.json",), ("/d/other/9.json",), (None,)]
    p = F.col("p")
    got = values(spark, rows, "p string", paths.base_name(p), paths.match_id_from_file(p), paths.match_id_text(p), paths.target_table(p))
    assert got == [
        ("123.json", 123, "123", "raw_events"), ("123.json", 123, "123", "raw_events"), ("x.json", None, "x", None),
        ("9.json", 9, "9", None), (None, None, None, None),
    ]


def test_odd_file_names(spark):
    rows = [("d/12\\.json",), ("d/12/.json",), ("d/a12b034.json",), ("12.json.json",), ("d/5.JSON",), ("d\ne/7.json",), ("d/7.json\n",), ("d/8.jsonx",)]
    p = F.col("p")
    got = values(spark, rows, "p string", paths.base_name(p), paths.match_id_from_file(p))
    assert got == [
        (".json", None), (".json", None), ("a12b034.json", 34), ("12.json.json", None), ("5.JSON", None), ("7.json", 7), ("7.json\n", 7), ("8.jsonx", None),
    ]


def test_result_labels(spark):
    rows = [(2, 1), (1, 2), (1, 1), (None, 1)]
    h, a = F.col("h"), F.col("a")
    got = values(spark, rows, "h int, a int", labels.match_result(h, a), labels.form_letter(h, a))
    assert got == [("H", "W"), ("A", "L"), ("D", "D"), ("D", None)]


def test_lenient_casts(spark):
    rows = [(v,) for v in ("3.7", "-3.7", "nan", "inf", "abc", "", None, "1e12")]
    got = values(spark, rows, "v string", casts.lenient_int(F.col("v")), casts.lenient_double(F.col("v")))
    assert [g[0] for g in got] == [3, -3, None, None, None, None, None, None]
    assert [g[1] for g in got] == [3.7, -3.7, None, float("inf"), None, None, None, 1e12]


def test_strict_cast_fails_on_text(spark):
    assert values(spark, [("",), ("7",)], "v string", casts.strict(F.col("v"), "int")) == [(None,), (7,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, [("abc",)], "v string", casts.strict(F.col("v"), "int"))


def test_points(spark):
    rows = [(["1", "2.5", "9"],), (["1"],), (["x", "2"],), ([None, "2"],), (None,), ([],)]
    got = values(spark, rows, "l array<string>", casts.point(F.col("l"))["x"], casts.point(F.col("l"))["y"])
    assert got == [(1.0, 2.5), (None, None), (None, None), (None, 2.0), (None, None), (None, None)]


def test_names(spark):
    rows = [("José  María",), ("Søren-X",), (" ",), (None,), ("A\u00a0 B\tC",)]
    n = F.col("n")
    got = values(spark, rows, "n string", text.folded_name(n), text.simple_name(n))
    assert got == [("jose maria", "josé maría"), ("s ren x", "søren-x"), (None, ""), (None, ""), ("a b c", "a b c")]
    blank = [("\t",), ("\u00a0 x\u2003",), (" a b ",), ("",), (None,)]
    assert values(spark, blank, "n string", text.stripped(n)) == [("",), ("x",), ("a b",), ("",), (None,)]


def test_odds_and_bars(spark):
    got = values(spark, [(0.5,), (0.0,), (None,)], "p double", labels.fair_odd_text(F.col("p")))
    assert got == [("2.00",), ("-",), ("-",)]
    odds = [1.005, 2.675, 1.125, 1.375, 2.5, 33.335, 1.0, 99.995, 123456.785]
    got = values(spark, [(o,) for o in odds], "o double", labels.two_decimals(F.col("o")))
    assert [g[0] for g in got] == [f"{o:.2f}" for o in odds]
    s = labels.comparison_shares(F.col("h"), F.col("a"))
    got = values(spark, [(0.0, 0.0), (0.0, 5.0), (3.0, 1.0), (None, None)], "h double, a double", s["home_pct"], s["away_pct"])
    assert got == [(50, 50), (8, 92), (75, 25), (50, 50)]


def test_mapping_status(spark):
    got = values(spark, [(95.0,), (94.99,), (85.0,), (84.99,)], "s double", labels.mapping_status(F.col("s")))
    assert [g[0] for g in got] == ["auto_approved", "needs_review", "needs_review", "low_confidence"]
