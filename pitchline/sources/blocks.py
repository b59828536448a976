"""Large text files cut into pieces that many tasks read, and sums carried over the pieces of a file.

Spark's text reader cuts a file into byte blocks and ends records at any separator, so a file without line breaks can be
read by many tasks as well. What a piece means may depend on all before it (inside quotes or not, how deep). That is
a running sum over the pieces of a file: one sum a block, carried from block to block, then a sum inside each block.
The longest list is the number of blocks of a file; a task holds the pieces of one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACE = ["source_file", "block", "piece"]


def pieces(spark: SparkSession, folder: str, glob: str, separator: str | None = None) -> DataFrame:
    """source_file, block (byte its block starts at), piece (order within the block), size of the file, value.

    ``value`` is the text up to the next separator (a line by default), without it.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if separator:
        reader = reader.option("lineSep", separator)
    return reader.text(folder).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("piece"), F.col("_metadata.file_size").alias("size"), "value",
    )


def carried(rows: DataFrame, amounts: dict[str, Column]) -> DataFrame:
    """Adds under each name the sum of an amount over all earlier pieces of the file."""
    valued = rows.select("*", *[a.alias(f"_{n}") for n, a in amounts.items()])
    sums = valued.groupBy("source_file", "block").agg(*[F.sum(f"_{n}").alias(f"_all_{n}") for n in amounts])
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source_file", "block", *[F.coalesce(F.sum(f"_all_{n}").over(earlier), F.lit(0)).alias(f"_start_{n}") for n in amounts])
    inside = Window.partitionBy("source_file", "block").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    local = valued.select("*", *[F.coalesce(F.sum(f"_{n}").over(inside), F.lit(0)).alias(f"_in_{n}") for n in amounts])
    placed = local.join(starts, ["source_file", "block"])
    return placed.select(*rows.columns, *[(F.col(f"_start_{n}") + F.col(f"_in_{n}")).alias(n) for n in amounts])


def occurrences(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character)))


def _with_ends(found: DataFrame) -> DataFrame:
    """Adds final (the last piece of its file) and cut (the last piece, and no separator comes after it).

    The reader does not tell whether a separator ends a file, but its size does (a byte order mark, which the reader
    drops, counts three).
    """
    held = F.sum(F.octet_length("value")) + F.count(F.lit(1)) - 1
    ends = found.groupBy("source_file").agg(F.max(F.struct("block", "piece")).alias("end"), (F.max("size") - held).alias("more"))
    final = F.struct("block", "piece") == F.col("end")
    return found.join(ends, "source_file").select(*found.columns, final.alias("final"), (final & (F.col("more") % 3 == 0)).alias("cut"))


def whole(found: DataFrame, separator: str) -> DataFrame:
    """source_file, value: the pieces of each file put together."""
    text = F.concat("value", F.when(F.col("cut"), "").otherwise(separator))
    parts = F.sort_array(F.collect_list(F.struct("block", "piece", text.alias("text"))))
    return _with_ends(found).groupBy("source_file").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("value"))


# ---------------------------------------------------------------- CSV records


def csv_records(lines: DataFrame) -> DataFrame:
    """source_file, line, value of the records of CSV files from their lines: quoted cells may hold line breaks.

    A line is inside a quoted cell if an odd number of quotes comes before it. Lines of one record are joined again.
    """
    quoted = carried(lines, {"quotes": occurrences(F.col("value"), '"')})
    begins = F.col("quotes") % 2 == 0
    numbered = carried(quoted.withColumn("begins", begins.cast("int")), {"before": F.col("begins")})
    numbered = numbered.withColumn("record", F.col("before") + F.col("begins"))
    parts = F.sort_array(F.collect_list(F.struct("block", "piece", "value")))
    records = numbered.groupBy("source_file", "record").agg(parts.alias("parts"))
    return records.select("source_file", F.col("record").alias("line"), F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))


# ---------------------------------------------------------------- JSON arrays

_SPACE = r"[\s\x{FEFF}]*"


def _structure(value: Column, inside: Column) -> Column:
    """What of a piece stands outside strings; ``inside`` says whether it starts within one."""
    plain = F.regexp_replace(value, r"(?s)\\.", "")
    return F.regexp_replace(F.concat(F.when(inside, '"').otherwise(""), plain), r'"[^"]*(?:"|$)', "")


def array_elements(found: DataFrame, keep_complete: bool = False) -> tuple[DataFrame, DataFrame]:
    """Elements of files that hold one JSON array each, from their pieces up to each ``}``; and the files at fault.

    Elements: source_file, row_in_file, payload. Faults: source_file, reason. An element ends where the depth comes back
    to one; what lies between two such places is parsed by itself, with its neighbours' commas. A file at fault (no array,
    text after it, a missing or extra comma, a truncated tail) gives no elements, or with ``keep_complete`` those that are
    whole.
    """
    quotes = occurrences(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    known = carried(_with_ends(found), {"quotes": quotes}).withColumn("inside", F.col("quotes") % 2 == 1)
    known = known.withColumn("ends_inside", (F.col("quotes") + quotes) % 2 == 1).withColumn("outer", _structure(F.col("value"), F.col("inside")))
    opened = occurrences(F.col("outer"), "{") + occurrences(F.col("outer"), "[") - occurrences(F.col("outer"), "}") - occurrences(F.col("outer"), "]")
    # the separator closes an object unless it stands in a string, or the file ends without it
    closed = F.when(F.col("cut") | F.col("ends_inside"), 0).otherwise(1)
    deep = carried(known.withColumn("change", opened - closed), {"depth": F.col("change")}).drop("outer")
    complete = ~F.col("final") & ~F.col("ends_inside") & (F.col("depth") + F.col("change") == 1)
    numbered = carried(deep.withColumn("complete", complete.cast("int")), {"part": F.col("complete")})
    text = F.concat("value", F.when(F.col("cut"), "").otherwise("}"))
    parts = numbered.groupBy("source_file", "part").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "piece", text.alias("text")))), lambda p: p["text"]), "").alias("text"),
        F.max("final").alias("final"), F.max(F.when(F.col("final"), F.col("depth") + F.col("change"))).alias("left"),
        F.max(F.when(F.col("final"), F.col("ends_inside"))).alias("open"),
    )
    first = F.col("part") == 0
    starts = F.when(first, F.regexp_like("text", F.lit(rf"^{_SPACE}\["))).otherwise(F.regexp_like("text", F.lit(r"^\s*,")) | (F.col("final") & F.regexp_like("text", F.lit(r"^\s*\]\s*$"))))
    closes = ~F.col("final") | (F.regexp_like("text", F.lit(r"\]\s*$")) & (F.col("left") == 0) & ~F.col("open"))
    body = F.regexp_replace(F.regexp_replace("text", F.when(first, rf"^{_SPACE}\[").otherwise(r"^\s*,"), ""), F.when(F.col("final"), r"\]\s*$").otherwise(r"$^"), "")
    blank = F.regexp_like(body, F.lit(r"^\s*$"))
    none = F.array().cast("array<string>")
    bare_end = F.col("final") & ~first & F.regexp_like("text", F.lit(r"^\s*\]\s*$"))
    items = F.when(bare_end | (first & F.col("final") & blank), none).when(~blank, F.from_json(F.concat(F.lit("["), body, F.lit("]")), T.ArrayType(T.StringType())))
    parsed = parts.select("source_file", "part", "final", F.when(starts & closes, items).alias("items"))
    state = parsed.groupBy("source_file").agg(F.max(F.col("items").isNull()).alias("bad"), F.min(F.when(F.col("items").isNull(), F.col("part"))).alias("from"))
    faults = state.where("bad").select("source_file", F.when(F.col("from") == 0, "no JSON array").otherwise("truncated or broken JSON array").alias("reason"))
    good = parsed.where("items IS NOT NULL").join(state, "source_file").where(F.col("part") < F.coalesce("from", F.lit(2**62)) if keep_complete else ~F.col("bad"))
    # places go on from part to part; parts are dealt into blocks of their own for the sums
    sized = good.select("source_file", F.floor(F.col("part") / 10_000).alias("block"), F.col("part").alias("piece"), "items")
    placed = carried(sized, {"before": F.size("items")})
    rows = placed.select("source_file", "before", F.posexplode("items").alias("at", "payload"))
    return rows.select("source_file", (F.col("before") + F.col("at")).cast("int").alias("row_in_file"), "payload"), faults
