"""Player-statistics files with drifting headers -> one fixed schema."""

from __future__ import annotations

import csv
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.functions.casts import lenient_double, lenient_int
from pitchline.functions.paths import base_name
from pitchline.functions.text import folded_name, stripped
from pitchline.schemas import DEFAULT_STATS_SEASON, MISSING_CELLS, PLAYER_STATS_HEADERS
from pitchline.session import cut_lineage
from pitchline.sources import blocks
from pitchline.sources.readers import NoInputFiles, any_case_glob
from pitchline.sources.writers import row_payload

_CAST = {"string": lambda c: c, "int": lenient_int, "double": lenient_double}


def resolve_header(columns: list[str], names: list[str]) -> str | None:
    """Actual column for a list of accepted names, ignoring case and outer blanks."""
    present = {c.strip().lower(): c for c in columns}
    return next((present[n] for n in names if n in present), None)


def _fixed(cell: Callable[[str], Column]) -> list[Column]:
    """The columns of the fixed schema; ``cell`` gives the text of one, NULL where a file has no such column.

    Cells that say missing are NULL.
    """

    def value(name: str, dtype: str) -> Column:
        text = cell(name)
        return _CAST[dtype](F.when(~text.isin(MISSING_CELLS), text))

    typed = {name: value(name, dtype) for name, (dtype, _) in PLAYER_STATS_HEADERS.items()}
    typed["season_name"] = F.coalesce(typed["season_name"], F.lit(DEFAULT_STATS_SEASON))
    return [
        *[c.alias(n) for n, c in typed.items()],
        folded_name(typed["squad_name"]).alias("normalized_squad_name"),
        folded_name(typed["player_name"]).alias("normalized_player_name"),
    ]


def normalise(df: DataFrame, source_file: Column, columns: list[str] | None = None) -> DataFrame:
    """Fixed schema from one header layout (``columns``, all by default). Without a player column the result is empty.

    Cells that say missing are NULL, as is a name of white space only.
    """
    columns = df.columns if columns is None else columns
    headers = {name: resolve_header(columns, accepted) for name, (_, accepted) in PLAYER_STATS_HEADERS.items()}
    cell = lambda name: (F.lit(None) if headers[name] is None else F.col(f"`{headers[name]}`")).cast("string")
    rows = df.select(source_file.alias("source_file"), *_fixed(cell), row_payload(columns).alias("raw_payload"))
    return rows.filter(F.lit(headers["player_name"] is not None) & (stripped(F.col("player_name")) != ""))


def layouts(lines: DataFrame) -> tuple[DataFrame, list[str]]:
    """Header line of every file (source_file, header, first), and the distinct ones, sorted.

    ``lines`` has (source_file, line, value); the first line of a file is its header. Only the distinct header lines
    come to the driver: their number is that of the layouts, not of the files.
    """
    headers = cut_lineage(lines.groupBy("source_file").agg(F.min_by("value", "line").alias("header"), F.min("line").alias("first")))
    return headers, [r.header for r in headers.select("header").distinct().orderBy("header").collect()]


def column_names(header: str) -> list[str]:
    """Names of a header line; one that repeats is numbered."""
    names = next(csv.reader([header.removeprefix("\ufeff")]))
    return [n if names.index(n) == i else f"{n}.{names[:i].count(n)}" for i, n in enumerate(names)]


def from_lines(lines: DataFrame, first_lines: DataFrame | None = None) -> DataFrame:
    """Player statistics from the lines (source_file, line, value) of CSV files with any headers.

    All layouts are read in one pass: a line becomes a list of cells, and where a column stands in it comes from a table of
    positions by header.
    """
    headers, found = layouts(lines if first_lines is None else first_lines)
    if not found:
        raise NoInputFiles("no CSV lines")
    names = {header: column_names(header) for header in found}
    width = max(map(len, names.values()))

    def places(columns: list[str]) -> Column:
        headers = [resolve_header(columns, accepted) for _, accepted in PLAYER_STATS_HEADERS.values()]
        at = [F.lit(None if h is None else columns.index(h)).cast("int") for h in headers]
        return F.struct(F.array(*at).alias("at"), F.array(*[F.lit(n) for n in columns]).alias("names"))

    layout = F.create_map(*[x for header in found for x in (F.lit(header), places(names[header]))])
    schema = ", ".join(f"c{i} string" for i in range(width))
    cells = F.from_csv("value", schema, {"escape": '"'})
    kept = lines.join(headers, "source_file").filter((F.col("line") != F.col("first")) & (stripped(F.col("value")) != ""))
    rows = kept.select("source_file", layout[F.col("header")].alias("layout"), cells.alias("c"))
    rows = rows.select("source_file", "layout", F.array(*[F.col(f"c.c{i}") for i in range(width)]).alias("cells"))
    order = list(PLAYER_STATS_HEADERS)
    cell = lambda name: F.get("cells", F.col("layout.at")[order.index(name)])
    payload = F.to_json(F.map_from_arrays("layout.names", F.slice("cells", F.lit(1), F.size("layout.names"))), {"ignoreNullFields": "false"})
    typed = rows.select(base_name(F.col("source_file")).alias("source_file"), *_fixed(cell), payload.alias("raw_payload"))
    return typed.filter(stripped(F.col("player_name")) != "")


def read_player_stats(spark: SparkSession, folder: str, multi_line: bool = False) -> DataFrame:
    """All CSV files below the folder, whatever their headers; no file is an error.

    Large files are split among tasks, also with ``multi_line``, which lets quoted cells hold line breaks.
    """
    found = blocks.pieces(spark, folder, any_case_glob("csv"))
    if multi_line:
        lines = blocks.csv_records(found)
        first = blocks.csv_records(found.where("block = 0")).where("line = 1")
    else:
        lines = found.select("source_file", F.col("piece").alias("line"), "value")
        first = found.where("block = 0").select("source_file", F.col("piece").alias("line"), "value")
    if first.isEmpty():
        raise NoInputFiles(f"no CSV file under {folder}")
    return from_lines(lines, first)
