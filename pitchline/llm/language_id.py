"""Language identification by n-gram filters that hold a bit for every language.

Training: of at most about ``TRAIN_DOCS`` distinct labelled texts of each language (by a hash of the text; copies count once), the byte n-grams and the share of
the language's texts that have them. An n-gram belongs to a language if that share is at least ``MIN_SHARE`` and
at least ``RELATIVE`` times the largest share it has in any. As shares are bounded below, the number of n-grams depends on
the lengths of texts and not on how many there are.

Filter: a Bloom filter with bit slices. Each position holds a mask with a bit for each language; an n-gram sets its
languages' bits at ``PROBES`` positions. One look-up (the masks at its positions, and-ed) gives all languages that hold an n-gram.

Prediction: for each language the n-grams of the whole text with its bit are counted. With the share f of positions that
have the bit, an n-gram that is in no set has it by chance with probability f ** PROBES; the count is corrected for that.
The language with the largest corrected share of the text's n-grams wins (the first by name of equals), and this share
is the score.

Cases: null, and texts without a letter, are ``und`` with score 0. Without labelled texts all are ``und``. Null doc_ids
count as not held out. Empty tables give no rows. Extra columns are kept by the filter and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.llm.common import batch_rows, read_table

ORDERS = (3, 5)  # bytes of an n-gram
TRAIN_DOCS = 4000
MIN_SHARE = 0.002
RELATIVE = 0.02
PROBES = 3
POSITIONS_PER_GRAM = 12
MAX_POSITION_BITS = 22  # 32 MB for up to 64 languages
MIN_SCORE = 0.4  # a text with less of its n-grams in its best language is rejected
CHUNK_BYTES = 1 << 18  # texts whose n-grams are held at once
UNDETERMINED = "und"
_LETTERS = bytes(b if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def normalised(text: str | None) -> bytes:
    """Lower-case words between single blanks; empty without a letter."""
    if not text or not any(map(str.isalpha, text)):
        return b""
    return b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "


def _mixed(codes: np.ndarray) -> np.ndarray:
    h = codes * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of normalised texts, and the text of each."""
    chars = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    codes, owners = [], []
    for order in ORDERS:
        n = len(chars) - order + 1
        if n < 1:
            continue
        code = np.full(n, order, np.uint64)
        for j in range(order):
            code = (code << np.uint64(8)) | chars[j:j + n]
        whole = owner[:n] == owner[order - 1:]
        codes.append(code[whole])
        owners.append(owner[:n][whole])
    if not codes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(codes), np.concatenate(owners)


def positions(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    h, out = _mixed(codes), []
    for _ in range(PROBES):
        out.append((h >> np.uint64(64 - bits)).astype(np.int64))
        h = _mixed(h)
    return out


@dataclass(frozen=True)
class Filters:
    """The masks (positions x words of 64 languages), the languages in name order, the chance of a false positive of each."""

    languages: list[str]
    bits: int
    masks: np.ndarray
    chance: np.ndarray

    @classmethod
    def of(cls, languages: list[str], bits: int, rows: pa.Table) -> Filters:
        masks = np.zeros((1 << bits, max(1, -(-len(languages) // 64))), np.uint64)
        at, word, mask = (rows.column(c).to_numpy() for c in ("at", "word", "mask"))
        masks[at, word] = mask.view(np.uint64)
        full = [np.count_nonzero((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)) / len(masks) for i in range(len(languages))]
        if len(languages) <= 8:
            masks = masks.astype(np.uint8)  # eight times less memory to look up in
        return cls(languages, bits, masks, np.array(full) ** PROBES)

    def shares(self, texts: list[bytes]) -> np.ndarray:
        """Corrected share of each text's n-grams (rows) that each language (columns) holds."""
        codes, owner = grams(texts)
        total = np.bincount(owner, minlength=len(texts))
        out, places = np.zeros((len(texts), len(self.languages))), positions(codes, self.bits)
        for word in range(self.masks.shape[1]):
            column = self.masks[:, word]
            found = column[places[0]]
            for place in places[1:]:
                found &= column[place]
            for i in range(64 * word, min(64 * word + 64, len(self.languages))):
                out[:, i] = np.bincount(owner, (found >> found.dtype.type(i % 64)) & found.dtype.type(1), len(texts))
        size = np.maximum(total, 1)[:, None]
        return np.clip((out / size - self.chance) / np.maximum(1 - self.chance, 1e-9), 0, 1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores, at = [], [], 0
        while at < len(texts):
            part, size = [], 0
            while at < len(texts) and size < CHUNK_BYTES:
                part.append(normalised(texts[at]))
                size += len(part[-1])
                at += 1
            if not self.languages:
                names, scores = names + [UNDETERMINED] * len(part), scores + [0.0] * len(part)
                continue
            shares = self.shares(part)
            best = shares.argmax(axis=1)
            names += [self.languages[b] if t else UNDETERMINED for t, b in zip(part, best)]
            scores += [float(s) if t else 0.0 for t, s in zip(part, shares.max(axis=1))]
        return names, scores


def _document_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each n-gram, by language and some texts together; code 0 counts the texts."""

    def counted(lang: str, own: list[bytes]) -> pa.RecordBatch:
        codes, n = np.unique(np.concatenate([np.unique(grams([raw])[0]) for raw in own]), return_counts=True)
        codes, n = np.r_[np.zeros(1, np.uint64), codes], np.r_[len(own), n]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes.view(np.int64)), pa.array(n)], ["lang", "code", "n"])

    for langs, texts in batch_rows(batches, "lang", "text"):
        for lang in sorted(set(langs)):
            own, size = [], 0
            for x, text in zip(langs, texts, strict=True):
                if x == lang and (raw := normalised(text)):
                    own.append(raw)
                    size += len(raw)
                    if size > 4 * CHUNK_BYTES:
                        yield counted(lang, own)
                        own, size = [], 0
            if own:
                yield counted(lang, own)


def _set_bits(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, ids = batch.column("code").to_numpy(zero_copy_only=False).view(np.uint64), batch.column("id").to_numpy(zero_copy_only=False)
            for place in positions(codes, bits):
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(ids // 64, pa.int32()), pa.array((np.uint64(1) << (ids % 64).astype(np.uint64)).view(np.int64))], ["at", "word", "mask"])

    return run


def train(labelled: DataFrame, train_docs: int = TRAIN_DOCS) -> Filters:
    """Filters from the texts and non-null languages of ``labelled``."""
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text")
    key = F.xxhash64("text")
    sizes = {r["lang"]: r["count"] for r in labelled.select("lang", key).distinct().groupBy("lang").count().collect()}  # a row a language
    if not sizes:
        return Filters([], 1, np.zeros((2, 1), np.uint64), np.zeros(0))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, train_docs / n))])
    sample = labelled.where(F.pmod(key, F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)).distinct()
    counts = sample.mapInArrow(_document_grams, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    texts = {r["lang"]: r["n"] for r in sample.mapInArrow(_document_counts, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n")).collect() if r["n"]}
    languages = sorted(texts)
    if not languages:
        return Filters([], 1, np.zeros((2, 1), np.uint64), np.zeros(0))
    ids = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
    of = F.create_map(*[F.lit(x) for lang in languages for x in (lang, float(texts[lang]))])
    rates = counts.where("code <> 0").select(ids[F.col("lang")].alias("id"), "code", (F.col("n") / of[F.col("lang")]).alias("rate")).where(F.col("rate") >= MIN_SHARE)
    most = F.max("rate").over(Window.partitionBy("code"))
    kept = rates.withColumn("most", most).where(F.col("rate") >= RELATIVE * F.col("most")).select("code", "id").persist()
    number = kept.select("code").distinct().count()
    bits = min(MAX_POSITION_BITS, max(10, int(np.ceil(np.log2(POSITIONS_PER_GRAM * max(1, number))))))
    rows = kept.mapInArrow(_set_bits(bits), "at long, word int, mask long").groupBy("at", "word").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most 2**bits rows
    kept.unpersist()
    return Filters.of(languages, bits, rows)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for langs, texts in batch_rows(batches, "lang", "text"):
        names = [x for x, t in zip(langs, texts) if any(map(str.isalpha, t))]
        found = sorted(set(names))
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([names.count(x) for x in found], pa.int64())], ["lang", "n"])


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def predictions(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held, texts in batch_rows(batches, "doc_id", "held_out", "text"):
            names, scores = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, filters: Filters, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language, with all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for (texts,) in batch_rows(iter([batch]), "text"):
                names, scores = shared.value.predict(texts)
                kept += [n != UNDETERMINED and s >= min_score for n, s in zip(names, scores)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return predictions(docs, train(docs.where(~held_out()).select("lang", "text")))
