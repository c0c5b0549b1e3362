"""Access to fields of raw feed records held as VARIANT.

Feeds are read without inferring a schema: a field that changes its type must become an invalid
record, not a changed column.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse(text: Column) -> Column:
    """JSON text as VARIANT, NULL when it is not JSON as a whole.

    The parser stops behind the first value, so the text is read as a list, which must have one element.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    # Both uses of the elements are always evaluated, so Spark parses the text once; a path that a list does not have
    # would cost more than reading the list.
    found = F.try_variant_get(listed, "$", "array<variant>")
    return F.get(found, F.when(F.size(found) == 1, F.lit(0)))


def child(record: Column, name: str) -> Column:
    """Field as VARIANT; SQL NULL when the key is missing, variant null when its value is null."""
    return F.try_variant_get(record, f"$.{name}", "variant")


def children(record: Column, names: tuple[str, ...]) -> dict[str, Column]:
    """``child`` of each name, all from one walk over the record instead of a search for each."""
    fields = F.try_variant_get(record, "$", "struct<" + ",".join(f"`{name}`:variant" for name in names) + ">")
    return {name: fields[name] for name in names}


def text(record: Column, name: str) -> Column:
    """Field as text (numbers and booleans too, lists and objects as JSON); NULL for missing and null."""
    return F.try_variant_get(record, f"$.{name}", "string")


def elements(record: Column, name: str) -> Column:
    """Field as a list of VARIANT; NULL when it is not a list."""
    return F.try_variant_get(record, f"$.{name}", "array<variant>")


def has_key(record: Column, name: str) -> Column:
    """True when the key occurs, whatever its value."""
    return child(record, name).isNotNull()


def is_object(record: Column) -> Column:
    return F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))


def kind_of(record: Column, name: str) -> Column:
    """SQL type name of a field's value, ``VOID`` for null, NULL for a missing key."""
    return F.schema_of_variant(child(record, name))


def only_string(record: Column, name: str) -> Column:
    """Field as text only if its value is a string."""
    return F.when(kind_of(record, name) == "STRING", text(record, name))


def is_given(kind: Column, text: Column) -> Column:
    """Given at all: neither missing, null, '', zero of any number type, false nor an empty list or object.

    ``kind`` is the SQL type name, ``text`` the value as text (lists and objects as JSON).
    """
    number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    given = (
        F.when(kind == "VOID", False)
        .when(kind == "STRING", text != "")
        .when(kind == "BOOLEAN", text == "true")
        .when(number, F.coalesce(text.try_cast("double") != 0, F.lit(True)))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), ~text.isin("[]", "{}"))
        .otherwise(kind.isNotNull())
    )
    return F.coalesce(given, F.lit(False))


def truthy(record: Column, name: str) -> Column:
    """Whether a field of the record is given, in the sense of ``is_given``."""
    return is_given(kind_of(record, name), text(record, name))


def has_value(record: Column, name: str) -> Column:
    """Present for coverage: neither missing, null nor the empty string; an empty list counts."""
    return holds_value(child(record, name))


def holds_value(value: Column) -> Column:
    """``has_value`` of a field that was taken out of its record."""
    kind = F.schema_of_variant(value)
    empty = (kind == "STRING") & (F.try_variant_get(value, "$", "string") == "")
    return F.coalesce((kind != "VOID") & ~empty, F.lit(False))
