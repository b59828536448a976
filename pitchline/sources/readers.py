"""File discovery, JSON and CSV scans, raw tables with provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from pitchline.functions.paths import match_id_text, target_table
from pitchline.sources import blocks


class NoInputFiles(FileNotFoundError):
    """Nothing under the folder matched."""


def any_case_glob(extension: str) -> str:
    """Glob for a file extension in any letter case: ``*.[cC][sS][vV]``."""
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension.lstrip("."))


def list_files(spark: SparkSession, folder: str, extension: str | None = None) -> DataFrame:
    """(path, length) of every file below the folder, sorted; no match is an error."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if extension:
        reader = reader.option("pathGlobFilter", any_case_glob(extension))
    try:
        files = reader.load(folder).select("path", "length")
    except AnalysisException as missing:
        raise NoInputFiles(folder) from missing
    if files.isEmpty():
        raise NoInputFiles(f"no {extension or ''} file under {folder}")
    return files.orderBy("path")


def read_csv(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """CSV with header, every column as text; the typed layer casts.

    Only with ``multi_line`` may quoted cells hold line breaks; each file is then read by one task.
    """
    return (
        spark.read.option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", any_case_glob("csv"))
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per file: an array gives its elements as rows, an object one flattened row.

    Other JSON values raise, and so does any other file extension.
    """
    if not path.lower().endswith(".json"):
        raise ValueError(f"unsupported file extension: {path}")
    first = spark.read.text(path, wholetext=True).select(F.substring(F.trim(F.translate("value", "\t\r\n", "   ")), 1, 1).alias("c"))
    if not first.filter(~F.col("c").isin("[", "{")).isEmpty():
        raise ValueError(f"unsupported JSON value in {path}")
    rows = spark.read.option("multiLine", True).json(path)
    return flatten(rows) if first.filter(F.col("c") == "[").isEmpty() else rows


def flatten(df: DataFrame) -> DataFrame:
    """Struct columns spread into dotted names, at every depth."""

    def leaves(schema: T.StructType, path: list[str]):
        for field in schema.fields:
            here = path + [field.name]
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield here

    def quoted(path: list[str]) -> str:
        return ".".join(f"`{p}`" for p in path)

    return df.select(*[F.col(quoted(p)).alias(".".join(p)) for p in leaves(df.schema, [])])


SPLIT_BYTES = 64 << 20  # larger files are read by many tasks


def json_documents(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(source_file, value) of the JSON files below the folder up to a size: whole files, however many lines they have."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=any_case_glob("json"))
    return files.where(F.col("_metadata.file_size") <= split_bytes).select(F.col("_metadata.file_path").alias("source_file"), "value")


def raw_rows(documents: DataFrame, dataset: str, loaded_at: Column) -> tuple[DataFrame, DataFrame]:
    """Raw rows of (source_file, value) documents, and the documents that are no JSON array or object.

    An array gives a row for each element, an object one. Keys keep their order and numbers their value. Columns:
    raw_id (the same for the same place in the same file), target_table (by folder name), source_dataset,
    source_file, source_match_id, row_in_file, payload, loaded_at. Files without a known folder keep a NULL target and
    can be counted. Rejects: source_file, reason, loaded_at.
    """
    text = F.regexp_replace("value", r"^\uFEFF?\s*|\s+$", "")
    is_array = F.startswith(text, F.lit("[")) & F.endswith(text, F.lit("]"))
    is_object = F.startswith(text, F.lit("{")) & F.try_parse_json(text).isNotNull()
    items = F.when(is_array, F.from_json(text, T.ArrayType(T.StringType()))).when(is_object, F.array(text))
    parsed = documents.select("source_file", items.alias("items"))
    rejects = parsed.filter(F.col("items").isNull()).select(
        "source_file", F.lit("no JSON array or object").alias("reason"), loaded_at.alias("loaded_at")
    )
    return _routed(parsed.select("source_file", F.posexplode("items").alias("row_in_file", "payload")), dataset, loaded_at), rejects


def _routed(rows: DataFrame, dataset: str, loaded_at: Column) -> DataFrame:
    """Elements (source_file, row_in_file, payload) with their ids, targets and provenance."""
    in_file = F.shiftleft(F.xxhash64("source_file").bitwiseAND(F.lit((1 << 36) - 1)), 27)
    return rows.select(
        (in_file + F.col("row_in_file")).alias("raw_id"),
        target_table(F.col("source_file")).alias("target_table"),
        F.lit(dataset).alias("source_dataset"),
        "source_file",
        match_id_text(F.col("source_file")).alias("source_match_id"),
        "row_in_file",
        "payload",
        loaded_at.alias("loaded_at"),
    )


def large_rows(
    spark: SparkSession, folder: str, dataset: str, loaded_at: Column, split_bytes: int = SPLIT_BYTES, keep_complete: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Raw rows and rejects of the files above a size, as :func:`raw_rows` gives them, each file read by many tasks.

    A file that holds no array is one document, put together again for the task that parses it. With ``keep_complete``
    the whole elements of a truncated array are kept; its rejected row says where it comes from all the same.
    """
    found = blocks.pieces(spark, folder, any_case_glob("json"), "}").where(F.col("size") > split_bytes)
    is_array = F.regexp_like("head", F.lit(r"^[\s\x{FEFF}]*\["))
    kinds = found.where("block = 0").groupBy("source_file").agg(F.min_by("value", "piece").alias("head")).select("source_file", is_array.alias("is_array"))
    marked = found.join(kinds, "source_file")
    elements, faults = blocks.array_elements(marked.where("is_array").drop("is_array"), keep_complete)
    rows, rejects = raw_rows(blocks.whole(marked.where("NOT is_array"), "}"), dataset, loaded_at)
    return rows.unionByName(_routed(elements, dataset, loaded_at)), rejects.unionByName(faults.select("source_file", "reason", loaded_at.alias("loaded_at")))


RAW_IDS = {"raw_matches": "raw_match_id", "raw_events": "raw_event_id", "raw_lineups": "raw_lineup_id", "raw_player_stats": "raw_player_stats_id"}


def raw_table(rows: DataFrame, table: str) -> DataFrame:
    """The rows routed to one raw table, with its id column."""
    wanted = rows.filter(F.col("target_table") == table)
    return wanted.withColumnRenamed("raw_id", RAW_IDS[table]).drop("target_table", "row_in_file")


def read_raw(
    spark: SparkSession, folder: str, dataset: str, loaded_at: Column | None = None, split_bytes: int = SPLIT_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Raw rows and rejects of all JSON files below the folder; see :func:`raw_rows`. Large ones are split among tasks."""
    now = F.current_timestamp() if loaded_at is None else loaded_at
    rows, rejects = raw_rows(json_documents(spark, folder, split_bytes), dataset, now)
    large, faults = large_rows(spark, folder, dataset, now, split_bytes)
    return rows.unionByName(large), rejects.unionByName(faults)
