"""Token ids in a file format for short-document access: one zstandard dictionary, each document compressed by itself.

Format (Parquet, so that every store Spark reads holds it): ``dictionary`` has one row (hash, dictionary, width).
``blocks`` has rows of up to ``BLOCK_IDS`` ids: part, block, first_doc, last_doc, docs, ids, dict_hash, the doc_ids and
token counts of its documents, the offset index (where each document's frame starts in the payload, one more at the
end) and the payload, the frames one after another. ``parts`` has the number of ids before each part. Documents are in
ascending doc_id order through parts and blocks, so one is found by its doc_id range and decompressed alone.

The dictionary is trained on the ids of the beginnings of about ``SAMPLE_DOCS`` documents, chosen by a hash of doc_id and text whose bound
follows from the number of documents; it changes only how small the files are. Ids are written with 16 bits where the vocabulary allows it.

Cases: null is empty and has the end id only. Null doc_ids come first. Rows that repeat a doc_id stand side by side,
and many of them are spread over parts. An empty table gives empty files. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.llm.common import batch_rows, bounded_rows, new_folder, read_table, shuffle_partitions
from pitchline.llm.word_ids import tokenizer, vocabulary_path

END_ID = 1
BLOCK_IDS = 500_000
SAMPLE_DOCS = 400
SAMPLE_LENGTH = 1 << 16  # characters of a sampled text that reach the driver
SAMPLE_BYTES = 8 << 20  # a dictionary gains nothing from more
DICTIONARY_BYTES = 64 << 10
LEVEL = 3

BLOCKS = (
    "part int, block int, first_doc long, last_doc long, docs int, ids long, dict_hash string, doc_ids array<long>, "
    "counts array<long>, offsets array<long>, payload binary"
)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from serialized id arrays; empty where the samples are too few to train one."""
    chosen, total = [], 0
    for sample in samples:
        chosen.append(sample[: SAMPLE_BYTES // 8])
        total += len(chosen[-1])
        if total > SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 10)), chosen).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _codec(kind, dictionary: bytes, **options):
    return kind(dict_data=zstandard.ZstdCompressionDict(dictionary), **options) if dictionary else kind(**options)


def _blocks(path: str, end_id: int, dictionary: bytes, width: str):
    digest, types = hashlib.sha256(dictionary).hexdigest(), [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    names = ["part", "block", "first_doc", "last_doc", "docs", "ids", "dict_hash", "doc_ids", "counts", "offsets", "payload"]
    last = np.array([end_id], width).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, own, codec, block = TaskContext.get().partitionId(), tokenizer(path), _codec(zstandard.ZstdCompressor, dictionary, level=LEVEL), 0
        docs, counts, frames = [], [], []

        def row() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist()
            numbered = [d for d in docs if d is not None] or [None]
            values = (part, block, numbered[0], numbered[-1], len(docs), sum(counts), digest, docs, counts, offsets, b"".join(frames))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        for ids, texts in batch_rows(batches, "doc_id", "text"):
            for doc, raw in zip(ids, own.encode(texts), strict=True):
                raw = np.frombuffer(raw, "<u4").astype(width).tobytes() + last
                docs.append(doc)
                counts.append(len(raw) // np.dtype(width).itemsize)
                frames.append(codec.compress(raw))
                if sum(counts) >= BLOCK_IDS if len(counts) % 64 == 0 else counts[-1] >= BLOCK_IDS:
                    yield row()
                    block, docs, counts, frames = block + 1, [], [], []
        if docs:
            yield row()

    return run


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> None:
    """Write all documents' ids under ``folder``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    share = int((1 << 40) * min(1.0, SAMPLE_DOCS / max(1, texts.count())))
    chosen = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < share)
    sample = [r["text"] for r in chosen.select(F.substring("text", 1, SAMPLE_LENGTH).alias("text")).distinct().collect()]
    own = tokenizer(path)
    width = "<u2" if own.library.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"
    dictionary = train_dictionary([np.frombuffer(raw, "<u4").astype(width).tobytes() for raw in own.encode(sample)])
    row = [(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary), width)]
    spark.createDataFrame(row, "dict_hash string, dictionary binary, width string").coalesce(1).write.parquet(f"{folder}/dictionary")
    # rows of one doc_id, should they be many, differ in where they come from, so a range can split them
    ordered = texts.withColumn("origin", F.spark_partition_id()).repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), "origin")
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "origin").select("doc_id", "text")
    ordered.mapInArrow(_blocks(path, end_id, dictionary, width), BLOCKS).write.parquet(f"{folder}/blocks")
    sizes = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("ids").alias("ids")).collect()  # a row a part
    before, rows = 0, []
    for part, ids in sorted((r["part"], r["ids"]) for r in sizes):
        rows.append((part, before))
        before += ids
    spark.createDataFrame(rows, "part int, ids_before long").coalesce(1).write.parquet(f"{folder}/parts")


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes, str]:
    row = spark.read.schema("dict_hash string, dictionary binary, width string").parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(row["dictionary"]).hexdigest() != row["dict_hash"]:
        raise ValueError("the dictionary is not the one its hash names")
    return row["dict_hash"], bytes(row["dictionary"]), row["width"]


def _decoder(digest: str, dictionary: bytes, width: str):
    codec = _codec(zstandard.ZstdDecompressor, dictionary)

    def decode(dict_hash: str, payload: bytes, start: int, end: int) -> np.ndarray:
        if dict_hash != digest:
            raise ValueError("a block was written with another dictionary")
        return np.frombuffer(codec.decompress(payload[start:end]), width).astype("<u4")

    return decode


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, frame_bytes."""
    digest, dictionary, width = _dictionary(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _decoder(digest, dictionary, width)
        for parts, blocks, hashes, ids, counts, offsets, payloads in bounded_rows(batches, "part", "block", "dict_hash", "doc_ids", "counts", "offsets", "payload"):
            for part, block, dict_hash, docs, sizes, places, payload in zip(parts, blocks, hashes, ids, counts, offsets, payloads, strict=True):
                found = [decode(dict_hash, payload, places[i], places[i + 1]) for i in range(len(docs))]
                if [len(f) for f in found] != sizes:
                    raise ValueError("a frame holds another number of ids than its index says")
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(docs), pa.int32()), pa.array([block] * len(docs), pa.int32()), pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array([zlib.crc32(f.tobytes()) for f in found], pa.int64()), pa.array(np.diff(places), pa.int64())],
                    ["part", "block", "doc_id", "own_start", "n_tokens", "ids_crc32", "frame_bytes"],
                )

    stored = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    # ids before a block: those of its part's earlier blocks (short rows), and those before the part
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = stored.select("part", "block", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("inside"))
    parts = spark.read.schema("part int, ids_before long").parquet(f"{folder}/parts")
    places = places.join(parts, "part").select("part", "block", (F.col("inside") + F.col("ids_before")).alias("before"))
    rows = stored.mapInArrow(run, "part int, block int, doc_id long, own_start long, n_tokens long, ids_crc32 long, frame_bytes long")
    return rows.join(places, ["part", "block"]).select("doc_id", (F.col("before") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32", "frame_bytes")


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of every document with this doc_id; reads only blocks whose range holds it, decompresses only its frames."""
    decode = _decoder(*_dictionary(spark, folder))
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    at = F.expr(f"filter(sequence(1, docs), i -> doc_ids[i - 1] = {int(doc_id)}L)")
    place = F.explode(at)
    frames = blocks.select("part", "block", "dict_hash", "offsets", "payload", place.alias("i")).selectExpr("part", "block", "i", "dict_hash", "substring(payload, CAST(offsets[i - 1] + 1 AS INT), CAST(offsets[i] - offsets[i - 1] AS INT)) AS frame")
    return [decode(r["dict_hash"], bytes(r["frame"]), 0, len(r["frame"])).tolist() for r in frames.orderBy("part", "block", "i").collect()]


def op6_id_files(spark: SparkSession, folder: str) -> DataFrame:
    target = new_folder(spark, "id-files")
    write_ids(read_table(spark, folder, "documents"), target, vocabulary_path("word_bpe_49k.json"))
    return read_digests(spark, target)
