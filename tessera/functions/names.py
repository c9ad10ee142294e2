"""Names read off files and registers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What files of unknown authors are called, and endings of firms' names.
NO_AUTHOR = ("unknown", "unbekannt", "anonym", "anonymous", "nn", "n.n")
FIRM_ENDINGS = (", inc.", " inc.", ", inc", " inc", ", llc", " llc", " co.", " corp.")


def file_author(filename: Column) -> Column:
    """The author that a file is named by: without its suffix and the number at its end; null for unknown ones."""
    stem = F.regexp_replace(filename, r"\.[^.]*$", "")
    name = F.trim(F.regexp_replace(stem, r"\d+$", ""))
    return F.when((name != "") & ~F.lower(name).isin(*NO_AUTHOR), name)


def file_number(filename: Column) -> Column:
    """The digits at the end of a file's stem, as text; null for none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(filename, r"\.[^.]*$", ""), r"(\d+)$", 1), F.lit(""))


def firm_key(name: Column) -> Column:
    """A firm's name in lower case, without a leading "the" and legal endings."""
    bare = F.regexp_replace(F.lower(F.trim(F.coalesce(name, F.lit("")))), "^the ", "")
    for ending in FIRM_ENDINGS:
        bare = F.when(F.endswith(bare, F.lit(ending)), F.substring(bare, F.lit(1), F.length(bare) - len(ending))).otherwise(bare)
    return F.trim(bare)


def safe_name(text: Column, otherwise: Column) -> Column:
    """A file name: other characters than letters, digits, dot, underscore and hyphen as one underscore, at most 80."""
    made = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(F.substring(made, 1, 80), F.lit("")), otherwise)
