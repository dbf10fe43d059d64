"""Vendor size descriptions: a plain string, or an array whose second entry counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.texts import not_blank, scalar


def second_entry(text: Column) -> Column:
    """The second entry of an array-valued description, NULL for a plain string."""
    return F.when(text.startswith("["), F.get(F.from_json(text, "array<string>"), F.lit(1)))


def plain_text(path: str) -> Column:
    """The description when it is a plain string, NULL for an array."""
    return scalar(path)


def size_fallback(second: Column, plain: Column) -> Column:
    """The trimmed second entry, else the trimmed plain string."""
    return F.coalesce(not_blank(second), F.trim(plain))


def cut_suffix(second: Column, plain: Column) -> Column:
    """The cut letter in brackets, such as ``(R)`` for "0X REGULAR".

    Arrays use the first letter of the second entry's last word; plain strings
    the first letter after their first blank; else the word NULL stands in.
    """
    last_word = F.substring_index(F.trim(second), " ", -1)
    trimmed = F.trim(plain)
    after_blank = F.ltrim(
        F.substring(trimmed, F.locate(" ", trimmed) + 1, F.length(trimmed))
    )
    rest = F.when(trimmed.contains(" "), after_blank)
    letter = F.coalesce(
        F.nullif(F.upper(F.left(last_word, F.lit(1))), F.lit("")),
        F.nullif(F.upper(F.left(rest, F.lit(1))), F.lit("")),
        F.lit("NULL"),
    )
    return F.concat(F.lit("("), letter, F.lit(")"))
