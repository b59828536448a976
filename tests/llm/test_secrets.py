import hashlib
import random
import re

import __spark_entry__ as entry
from fixture_rows import FOLDER, ODD
from pitchline.llm import secrets
from pyspark.sql import functions as F

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    order = ["assign", "access", "hex"]
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def parsed(spans):
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)]


def check(rows, docs):
    want = sorted((str(d), *[sum(s[0] == k for s in base(t)) for k in ("assign", "access", "hex")], digest(base(t))) for d, t in docs)
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == want
    for r in rows:
        spans = parsed(r.spans)
        assert [s for s in spans if s[0] != "random"] == [s for s in spans if s[0] in ("assign", "access", "hex")]
        assert digest([s for s in spans if s[0] != "random"]) == r.base_sha256 and len([s for s in spans if s[0] == "random"]) == r.n_random


def test_table_equals_the_patterns(spark, texts):
    check(entry.queries()["op7_secret_scan"](spark, FOLDER).collect(), texts)


def samples():
    rng = random.Random(3)
    parts = ["password", "Passwd=", "secret: ", "token", "api_key", "APIKEY = '", '"', "'", " ", ":", "=", "abcdef0123", "AKIA", "ABCD1234EFGH5678", "x/y.z-_", "deadbeef", "é", "😀", "\n", "0", "g"]
    docs = [(i, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for i in range(400)]
    return [*docs, (401, "token: password: \"abcdefghijklmn\""), (402, "AKIAAKIA" * 5), (403, "password=" * 30), (404, "hex " + "0123456789abcdef" * 2000)]


def test_patterns_on_random_mixtures(spark):
    docs = samples()
    check(secrets.secrets(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)


def test_odd_rows_and_tables(odd, none):
    check(secrets.secrets(odd).collect(), ODD)
    assert secrets.secrets(none).count() == 0


def test_random_strings_are_found_and_ordinary_ones_are_not(spark):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choices(letters, k=rng.randint(40, 60))) for _ in range(60)]
    plain = ["a_long_name_of_a_function_Number1_that_returns_something", "https/example/Path/to/some/page/Index2/with/more/words", "A" * 30 + "b1" * 15, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "Aa0" * 20]
    docs = [(i, f"é key {k} end") for i, k in enumerate(keys)] + [(100 + i, f"see {p} there") for i, p in enumerate(plain)]
    rows = {r.doc_id: r for r in secrets.secrets(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = [i for i, k in enumerate(keys) if ("random", 6, 6 + len(k)) in parsed(rows[i].spans)]
    assert len(found) >= 50
    assert all(rows[100 + i].n_random == 0 for i in range(len(plain)))


def test_random_values_of_names_and_urls_are_found(spark):
    rng = random.Random(7)
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    forms = ["AUTH={}", "client_key={}\nNEXT=1", "https://example.org/a/b?sig={}&v=2", "level=info,a_long_name_of_a_field_Number1={} done", "x=={}"]
    keys = [("".join(rng.choices(base64, k=40 + i % 20)) + "=" * (i % 3), f) for i, f in enumerate(forms * 12)]
    keys += [("".join(rng.choices(base64[26:62], k=45 + i % 15)), f) for i, f in enumerate([*forms, "see {} there"] * 10)]
    keys += [("".join(rng.choices("abcdefghijklmnopqrstuvwxyz234567", k=400)), f) for f in [*forms, "see {} there"] * 10]
    plain = ["name=a_long_name_of_a_function_Number1_that_returns_something", "x=" + "aaaabbbb11" * 5, "y=abcdefghijklmnopqrstuvwxyz0123456789", "1" * 40 + "=" * 9]
    docs = [(i, f.format(k)) for i, (k, f) in enumerate(keys)] + [(1000 + i, t) for i, t in enumerate(plain)]
    rows = {r.doc_id: r for r in secrets.secrets(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = [("random", f.index("{}"), f.index("{}") + len(k)) in parsed(rows[i].spans) for i, (k, f) in enumerate(keys)]
    assert sum(found[:60]) >= 50 and sum(found[60:120]) >= 50 and sum(found[120:]) >= 50
    assert all(rows[1000 + i].n_random == 0 for i in range(len(plain)))


def test_no_python_in_the_plan(spark):
    plan = entry.queries()["op7_secret_scan"](spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.search("EvalPython|MapIn|InPandas|InArrow|InMemoryRelation|PythonUDF", plan)


def test_normal_distribution(spark):
    from math import erf, sqrt

    rows = spark.range(-40, 41).select((F.col("id") / 8).alias("z")).select("z", secrets._at_or_below(F.col("z")).alias("p")).collect()
    assert all(abs(r.p - (1 + erf(r.z / sqrt(2))) / 2) < 1e-6 for r in rows)
