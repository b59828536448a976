"""Name normalisation. The two forms do not agree on purpose: each job names the one it uses."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: whitespace as Python's str.split() sees it, no-break space and the
# U+001C..U+001F separators included.
_SPACES = r"[\s\x1c-\x1f\x85\p{Z}]+"


def stripped(text: Column) -> Column:
    """Outer white space removed, as Python's str.strip() sees it."""
    return F.regexp_replace(text, f"^{_SPACES}|{_SPACES}$", "")


def simple_name(name: Column) -> Column:
    """Lower case, runs of white space become one blank, ends trimmed; NULL becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(name), _SPACES, " ")), F.lit(""))


@F.pandas_udf(T.StringType())
def _fold_accents(names: pd.Series) -> pd.Series:
    def fold(name):
        if name is None:
            return None
        return "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))

    return names.map(fold)


def folded_name(name: Column) -> Column:
    """Accents removed, anything but a-z, 0-9 becomes a blank, blanks collapse; empty is NULL.

    Spark has no NFKD fold, so that one step is an Arrow UDF. ASCII names reach it as
    NULL and cost next to nothing.
    """
    low = F.lower(name)
    folded = F.coalesce(_fold_accents(F.when(low.rlike(r"[^\x00-\x7F]"), low)), low)
    spaced = F.regexp_replace(folded, r"[^a-z0-9]+", " ")
    return F.nullif(F.trim(spaced), F.lit(""))


def sorted_tokens(name: Column) -> Column:
    """Words of an already simplified name in ascending order, joined by blanks."""
    return F.array_join(F.array_sort(F.split(name, " ")), " ")

