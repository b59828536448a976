import zlib

import numpy as np

import __spark_entry__ as entry
from fixture_rows import FOLDER, ODD
from pitchline.llm import language_id
from pitchline.llm.common import read_table


def test_held_out_accuracy(spark, texts):
    rows = entry.queries()["op2_language_id"](spark, FOLDER).collect()
    langs = {r.doc_id: r.lang for r in read_table(spark, FOLDER, "documents").select("doc_id", "lang").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.97


def test_lang_and_source_are_no_inputs(spark):
    docs = read_table(spark, FOLDER, "documents")
    filters = language_id.train(docs.where(~language_id.held_out()))
    plain = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source")
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in language_id.predictions(d, filters).collect()} for d in (docs, plain))
    assert a == b


def test_odd_rows_and_tables(spark, odd, none):
    filters = language_id.train(read_table(spark, FOLDER, "documents"))
    rows = language_id.predictions(odd, filters).collect()
    want = [(d, t is None or not any(map(str.isalpha, t))) for d, t in ODD]
    assert sorted(map(str, ((r.doc_id, r.lang_pred == "und") for r in rows))) == sorted(map(str, want))
    assert language_id.predictions(none, filters).count() == 0 and language_id.keep_known(odd, filters).columns == odd.columns
    empty = language_id.train(none.selectExpr("*", "CAST(NULL AS STRING) AS lang"))
    assert {r.lang_pred for r in language_id.predictions(odd, empty).collect()} == {"und"}


def test_one_look_up_gives_all_languages_of_an_ngram(spark):
    rows = [(f"l{i:02d}", f"abc word{i:02d}x") for i in range(70)]
    filters = language_id.train(spark.createDataFrame(rows, "lang string, text string"))
    assert len(filters.languages) == 70 and filters.masks.shape[1] == 2
    shares = filters.shares([language_id.normalised("abc"), language_id.normalised("qqqqqqqq")])
    assert (shares[0] > 0.9).all() and (shares[1] < 0.1).all()


def test_counts_are_corrected_for_false_positives():
    rng = np.random.default_rng(0)
    masks = (rng.random((1 << 12, 1)) < 0.5).astype(np.uint8)  # a filter half full of chance
    filters = language_id.Filters(["a"], 12, masks, np.array([np.mean(masks) ** language_id.PROBES]))
    text = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 20000))
    assert filters.shares([language_id.normalised(text)])[0, 0] < 0.02


def test_short_clean_texts_are_kept_and_noise_is_rejected(spark):
    filters = language_id.train(read_table(spark, FOLDER, "documents"))
    docs = read_table(spark, FOLDER, "documents")
    assert language_id.keep_known(docs, filters).count() >= 0.99 * docs.count()
    noise = spark.createDataFrame([(1, "zxqj vkwpz qqxz jjkx"), (2, "12345 !!!"), (3, None)], "doc_id long, text string")
    assert language_id.keep_known(noise, filters).count() == 0


def test_copies_count_once_in_training(spark):
    words = [f"{a}{b}o{a}{b}" for a in "bcdfg" for b in "aeiu"]
    rows = [("aa", f"{w} {w[::-1]}") for w in words] + [("aa", "the hot line")] * 3000
    filters = language_id.train(spark.createDataFrame(rows, "lang string, text string"))
    assert (filters.shares([language_id.normalised(t) for _, t in rows[:21]]) > 0.9).all()


def test_a_language_of_few_distinct_texts_is_learned(spark):
    rows = [(f"l{i}", f"only text {i}") for i in range(4) for _ in range(3000)] + [("many", f"text of number {i}x") for i in range(3000)]
    filters = language_id.train(spark.createDataFrame(rows, "lang string, text string"), train_docs=5)
    assert filters.languages[:4] == ["l0", "l1", "l2", "l3"]
