import signal
import zlib
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from fixture_rows import FOLDER, ODD
from pitchline.llm import id_files, packing, token_counts, word_ids
from pitchline.llm.word_ids import WordTokenizer, vocabulary_path

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def pieces_model():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def whole(name, text):
    return tokenizers.Tokenizer.from_file(vocabulary_path(name)).encode(text or "", add_special_tokens=False).ids


# ---------------------------------------------------------------- counts


def test_counts_equal_the_library(spark, texts, pieces_model):
    rows = entry.queries()["op1_token_counts"](spark, FOLDER).collect()
    want = {d: (len(t.encode()), len(pieces_model.encode(t))) for d, t in texts}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == want and len(rows) == len(want)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in rows)


def test_every_prefix_has_its_exact_count(pieces_model):
    own = token_counts.PrefixCounter(vocabulary_path("piece_bpe_32k.model"))
    for text in ["", " ", "the  end.\nAnd so, on", "<s>▁héé 你好 😀\t x", "aaaaaaaaaaaaaaaaaaaa", "tokens: tokenization's 12345."]:
        assert own.prefixes(text).tolist() == [len(pieces_model.encode(text[:i])) for i in range(len(text) + 1)]


def test_counts_of_odd_rows_and_tables(odd, none, pieces_model):
    rows = token_counts.token_counts(odd, limit=20, with_tables=True).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == sorted((d or -1, len(pieces_model.encode(t or ""))) for d, t in ODD)
    for r in rows:
        table = np.frombuffer(r.prefix_counts, "<i4")
        assert table[r.fits_chars] <= 20 and (table[r.fits_chars + 1 :] > 20).all()
    assert token_counts.token_counts(none).count() == 0


# ---------------------------------------------------------------- packing


def brute_best_fit(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, left in enumerate(bins) if left >= length]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= length
        else:
            bins.append(capacity - length)
    return sorted(bins)


def test_plan_equals_piece_by_piece_best_fit():
    rng = np.random.default_rng(3)
    for capacity in (1, 7, 64, 100):
        for n in (0, 1, 5, 300):
            lengths = rng.integers(1, capacity + 1, n).tolist()
            counts = {x: lengths.count(x) for x in set(lengths)}
            plan, bins = packing.best_fit(counts, capacity)
            used = defaultdict(list)
            for length, ranges in plan.items():
                for first_rank, size, first, each, place in ranges:
                    for i in range(size):
                        used[first + i // each].append((place + i % each * length, length))
            assert len(used) == bins
            for parts in used.values():
                end = 0
                for place, length in sorted(parts):
                    assert place == end
                    end += length
            assert sorted(capacity - sum(x for _, x in p) for p in used.values()) == brute_best_fit(lengths, capacity)


def check_packing(rows, docs):
    name, sequences, by_doc = "byte_bpe_50k.json", defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    want = defaultdict(list)
    for doc, text in docs:
        ids = whole(name, text) + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, 2048)]
        want[doc] += [(i, a, b - a, crc(ids[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert {d: sorted(x) for d, x in by_doc.items()} == {d: sorted(x) for d, x in want.items()}
    for parts in sequences.values():
        end = 0
        for place, length in sorted(parts):
            assert place == end
            end += length
        assert end <= 2048
    assert len(sequences) == len(brute_best_fit([r.length for r in rows], 2048))


def test_packing_of_the_table(spark, texts):
    check_packing(entry.queries()["op3_best_fit_packing"](spark, FOLDER).collect(), texts)


def test_packing_of_odd_rows_and_tables(odd, none):
    check_packing(packing.pack_documents(odd).collect(), ODD)
    assert packing.pack_documents(none).count() == 0


def test_ranks_of_a_hot_length_are_gapless(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_GROUP", 10)
    frame = spark.range(500).selectExpr("id", "IF(id % 3 = 0, 7L, id % 5 + 1) AS length")
    counts = {r["length"]: r["count"] for r in frame.groupBy("length").count().collect()}
    found = defaultdict(list)
    for r in packing.ranked(frame, counts).collect():
        found[r["length"]].append(r["rank"])
    assert {k: sorted(v) for k, v in found.items()} == {k: list(range(n)) for k, n in counts.items()}


# ---------------------------------------------------------------- id files


def check_files(rows, docs):
    start, want = 0, []
    for doc, text in docs:
        ids = whole("word_bpe_49k.json", text) + [1]
        want.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == [(s, d, n, c) for d, s, n, c in want]


def test_files_of_the_table_read_back(spark, texts):
    check_files(entry.queries()["op6_id_files"](spark, FOLDER).collect(), sorted(texts))


def test_files_of_odd_rows_and_tables(spark, odd, none, tmp_path, monkeypatch):
    monkeypatch.setattr(id_files, "BLOCK_IDS", 100)
    path = vocabulary_path("word_bpe_49k.json")
    id_files.write_ids(odd, str(tmp_path / "odd"), path)
    rows = id_files.read_digests(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((d for d, _ in ODD), key=lambda d: -1 if d is None else d)
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows[:-1])]).tolist()
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in rows) == sorted((d or -1, len(i := whole("word_bpe_49k.json", t) + [1]), crc(i)) for d, t in ODD)
    for doc in (9, 11, 14, 99):
        assert sorted(id_files.read_document(spark, str(tmp_path / "odd"), doc)) == sorted(whole("word_bpe_49k.json", t) + [1] for d, t in ODD if d == doc)
    id_files.write_ids(none, str(tmp_path / "none"), path)
    assert id_files.read_digests(spark, str(tmp_path / "none")).count() == 0


def test_a_wrong_dictionary_is_refused(spark, odd, tmp_path):
    id_files.write_ids(odd, str(tmp_path / "a"), vocabulary_path("word_bpe_49k.json"))
    rows = spark.read.parquet(str(tmp_path / "a" / "dictionary")).withColumnRenamed("dictionary", "d").selectExpr("dict_hash", "unhex('00') AS dictionary", "width")
    rows.write.parquet(str(tmp_path / "b" / "dictionary"))
    with pytest.raises(ValueError, match="dictionary"):
        id_files.read_digests(spark, str(tmp_path / "b"))


def test_pieces_equal_whole_texts():
    rng, parts = np.random.default_rng(5), [*"ab the\n\tçé.,'\"<s>0 9AÉıİß²½\xad\xa0你", "'s", "'re", "'S", "  ", "don't", "\r\n", "<|", "<|endoftext|>", "!'", "́"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        own = WordTokenizer(vocabulary_path(name))
        samples = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(1500)]
        for text, ids in zip(samples, own.encode(samples), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == own.library.encode(text, add_special_tokens=False).ids


def test_a_text_with_more_pieces_than_the_table_has_places(monkeypatch):
    def late(*_):
        raise TimeoutError("the table is full")

    monkeypatch.setattr(word_ids, "TABLE_BITS", 6)
    monkeypatch.setattr(word_ids, "KEPT_PIECES", 40)
    own = WordTokenizer(vocabulary_path("word_bpe_49k.json"))
    texts = ["a few words", " ".join(map(str, range(3000))), None, "w" * 60 + " 17 " + "x" * 60, " ".join(f"w{i}" for i in range(500))]
    before = signal.signal(signal.SIGALRM, late)
    signal.alarm(60)
    try:
        for _ in range(2):
            for text in texts:  # a chunk each, then all in one
                assert np.frombuffer(next(own.encode([text])), "<u4").tolist() == whole("word_bpe_49k.json", text)
            for text, ids in zip(texts, own.encode(texts), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == whole("word_bpe_49k.json", text)
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, before)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_that_go_to_the_model_equal_the_library(name):
    import random

    from tokenizers import Tokenizer

    path = word_ids.vocabulary_path(name)
    own, library = word_ids.WordTokenizer(path), Tokenizer.from_file(path)
    assert own.blank is not None
    letters = [c for c in map(chr, range(0x180)) if word_ids._RUN.fullmatch(c)]
    rng = random.Random(3)
    words = letters + ["".join(rng.choices(letters if k % 2 else letters[:52], k=rng.randrange(1, 14))) for k in range(4000)]
    for before in ("", " "):
        want = [e.ids for e in library.encode_batch([before + w for w in words], add_special_tokens=False)]
        assert [list(memoryview(x).cast("I")) for x in own._encode([before + w for w in words])] == want
