"""Text columns: cleaning, tokens, name extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# ASCII blanks, the separators 28 to 31, next line and every Unicode separator
BLANK = r"\s\x1C-\x1F\x{85}\p{Z}"


def clean_text(col: Column) -> Column:
    """Keep ASCII letters, digits and blanks of any kind; squeeze and trim blanks.

    The POSIX class is ASCII here and matches several times faster than a-zA-Z0-9.
    """
    kept = F.regexp_replace(col, rf"[^\p{{Alnum}}{BLANK}]+", "")
    return F.array_join(F.filter(F.split(kept, rf"[{BLANK}]+"), lambda w: w != ""), " ")


def tokenize_ws(col: Column) -> Column:
    return F.filter(F.split(F.lower(col), rf"[{BLANK}]+"), lambda t: t != "")


def tokenize_alpha(col: Column) -> Column:
    """Lower-cased whole words made of a-z only."""
    words = F.split(F.lower(col), r"[^\p{L}\p{N}_]+")
    return F.filter(words, lambda t: t.rlike(r"^[a-z]+$"))


def template_vars(col: Column) -> Column:
    """Sorted distinct names used as {{ name }}."""
    return F.array_sort(
        F.array_distinct(F.regexp_extract_all(col, F.lit(r"\{\{\s*(\w+)\s*\}\}"), F.lit(1)))
    )


def normalize_string(col: Column) -> Column:
    return F.lower(F.trim(col))
