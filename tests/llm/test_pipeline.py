from collections import defaultdict

import corpus_pipeline
from fixture_rows import FOLDER
from pitchline.llm.common import read_table
from test_decontaminate import brute as brute_contamination
from test_exact_dedup import norm
from test_simhash import brute_components, brute_print


def first(docs, group):
    """The rows with the smallest doc_id of each group."""
    kept = {}
    for d, t in sorted(docs):
        kept.setdefault(group(t), (d, t))
    return sorted(kept.values())


def test_stages_equal_brute_force(spark):
    docs = read_table(spark, FOLDER, "documents")
    items = [tuple(r) for r in read_table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    want = sorted((r.doc_id, r.text) for r in docs.collect())
    found = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, FOLDER), f"test-{name}")
        found[name] = sorted((r.doc_id, r.text) for r in docs.collect())
        assert docs.columns == before.columns
    assert found["language_id"] == want  # every document is in a known language
    want = first(want, norm)
    assert found["exact_dedup"] == want
    groups = brute_components([brute_print(t) for _, t in want])
    want = first(want, lambda t: groups[brute_print(t)])
    assert found["near_dedup"] == want
    gone = {r[0] for r in brute_contamination(want, items) if r[5]}
    want = [d for d in want if d[0] not in gone]
    assert found["decontamination"] == want and gone
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in pieces} == {d for d, _ in want}
    sequences = defaultdict(int)
    for r in pieces:
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 2048
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).select("doc_id", "piece", "length").collect()) == sorted((r.doc_id, r.piece, r.length) for r in pieces)


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    read_table(spark, FOLDER, "documents").where("false").write.parquet(f"{folder}/documents.parquet")
    read_table(spark, FOLDER, "benchmark").where("false").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
