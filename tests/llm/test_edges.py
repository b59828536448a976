"""What holds for several operators: names of extra columns, slices of bounded size."""

import pyarrow as pa

from pitchline.llm import common, decontaminate, exact_dedup, simhash

CLASH = ["__row", "__kept_row", "__gone", "row", "place", "node", "value", "first_row", "bucket"]


def test_operators_keep_columns_of_any_name(spark):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(i, t, *range(len(CLASH))) for i, t in enumerate([words, words, "other text of its own kind", None, "the item has these thirteen words in it and all of them are here"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} int" for c in CLASH)).cache()
    items = spark.createDataFrame([(1, rows[-1][1])], "item_id int, text string")
    for kept, left in ((exact_dedup.drop_copies(docs), [0, 2, 3, 4]), (simhash.drop_near_copies(docs), [0, 2, 3, 4]), (decontaminate.drop_contaminated(docs, items), [0, 1, 2, 3])):
        found = sorted(kept.collect())
        assert kept.columns == docs.columns and [r.doc_id for r in found] == left and all(tuple(r)[2:] == tuple(range(len(CLASH))) for r in found)


def test_slices_are_bounded(monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 1000)
    texts = ["a" * n for n in (10, 900, 900, 5000, 1, 2, 3, 400)]
    batch = pa.RecordBatch.from_pydict({"n": list(range(8)), "text": texts})
    slices = list(common.bounded_rows(iter([batch]), "text", "n"))
    assert [t for part, _ in slices for t in part] == texts and all(sum(map(len, p)) <= 1000 or len(p) == 1 for p, _ in slices)
    assert [n for _, part in slices for n in part] == list(range(8)) and len(slices) < 8
