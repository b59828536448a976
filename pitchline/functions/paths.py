"""File-name expressions: base name, match id, target table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folder name in a path -> raw table it feeds.
TABLE_BY_FOLDER = {
    "matches": "raw_matches",
    "events": "raw_events",
    "lineups": "raw_lineups",
    "players": "raw_player_stats",
}


def base_name(path: Column) -> Column:
    """Last path part, whatever it holds; Windows and POSIX separators are both accepted."""
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def match_id_from_file(path: Column) -> Column:
    """Digits right before ``.json`` as bigint, NULL when there are none."""
    # no digit is a separator, so the whole path gives what its last part would
    digits = F.regexp_extract(path, r"([0-9]+)\.json$", 1)
    return F.nullif(digits, F.lit("")).cast("long")


def match_id_text(path: Column) -> Column:
    """Last path part with every ``.json`` removed, as text."""
    return F.replace(base_name(path), F.lit(".json"), F.lit(""))


def target_table(path: Column) -> Column:
    """Raw table for a file, by the folders on its path; NULL when none applies."""
    parts = F.split(F.translate(path, "\\", "/"), "/")
    folders = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    choice = F.lit(None).cast("string")
    for folder, table in reversed(list(TABLE_BY_FOLDER.items())):
        choice = F.when(F.array_contains(folders, folder), F.lit(table)).otherwise(choice)
    return choice
