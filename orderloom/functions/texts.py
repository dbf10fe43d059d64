"""Column functions for values that arrive as JSON text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once; inside a lambda every use of it is."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def is_container(text: Column) -> Column:
    """The text may be a JSON array or object: it begins like one.

    A plain string may begin so too. What is read with ``objects`` is NULL then.
    """
    return F.coalesce(text.startswith("[") | text.startswith("{"), F.lit(False))


def container(text: Column) -> Column:
    """The text when it may be an array or an object, else NULL."""
    return F.when(is_container(text), text)


def _listed(text: Column) -> Column:
    """The text of an array; a lone object is one element."""
    return F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).when(
        is_container(text), text
    )


def _mended(text: Column) -> Column:
    """The text of an array with null for every element that is not an object.

    The kinds come from the variants of the elements, because a quoted string
    can hold the text of an object. They are missing only where a key repeats
    inside an element; then the text decides.
    """
    listed = _listed(text)
    kinds = F.coalesce(
        F.from_json(listed, "array<variant>"), F.expr("cast(array() as array<variant>)")
    )

    def told(element: Column, kind: Column) -> Column:
        by_text = element.startswith("{") & F.try_parse_json(element).isNotNull()
        is_object = F.coalesce(F.schema_of_variant(kind).startswith("OBJECT"), by_text)
        return F.when(is_object, element).otherwise(F.lit("null"))

    elements = F.zip_with(F.from_json(listed, "array<string>"), kinds, told)
    return F.concat(F.lit("["), F.array_join(elements, ","), F.lit("]"))


def objects(text: Column, element: str) -> Column:
    """The elements of an array of objects, a lone object as one element.

    An element that is not an object is NULL and keeps its place; text that is
    no array or object gives NULL. One such element makes Spark's reader return
    NULL for all of them, so those few arrays are read a second time, mended.
    """
    kind = f"array<{element}>"
    return F.coalesce(F.from_json(_listed(text), kind), F.from_json(_mended(text), kind))


def has_gap(listed: Column) -> Column:
    """Whether ``objects`` left an element out."""
    return F.coalesce(F.exists(listed, lambda x: x.isNull()), F.lit(False))


def scalar(text: Column | str) -> Column:
    """The text at a column path unless it is a JSON array or object.

    A plain string may start with a bracket too, so only those few are parsed.
    """
    if isinstance(text, str):
        return F.expr(
            f"if((startswith({text}, '[') or startswith({text}, '{{')) "
            f"and try_parse_json({text}) is not null, null, {text})"
        )
    held = is_container(text) & F.try_parse_json(text).isNotNull()
    return F.when(held, F.lit(None)).otherwise(text)


def not_blank(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def safe_int(text: Column) -> Column:
    """Whole-number text to int; blank, decimal or other text gives NULL."""
    return text.try_cast("int")


def safe_decimal(text: Column) -> Column:
    """Number text to decimal(18,2), rounded half up; blank or bad gives NULL."""
    return text.try_cast("decimal(18,2)")


def decimal_text_int(text: Column) -> Column:
    """Quantities sent as decimal text: "238.0" is 238, fractions are cut off."""
    return text.try_cast("double").try_cast("int")


def compact_date(text: Column) -> Column:
    """A yyyymmdd date, NULL when it is not one."""
    return F.try_to_date(text, "yyyyMMdd")
