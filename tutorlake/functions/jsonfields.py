"""Field access in semi-structured documents held as VARIANT."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tutorlake.functions.clean import strip


def accept_repeated_keys(spark: SparkSession) -> None:
    """Documents that repeat a key are read, with the key's last value, instead of counting as broken."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def path(*keys: str) -> str:
    """JSON path of nested keys; keys may hold blanks."""
    return "$" + "".join(f'["{key}"]' for key in keys)


def text_at(doc: Column, *keys: str) -> Column:
    """Value as text, NULL when the key is missing or null."""
    return F.try_variant_get(doc, path(*keys), "string")


def typed_at(doc: Column, kind: str, *keys: str) -> Column:
    return F.try_variant_get(doc, path(*keys), kind)


def node_at(doc: Column, *keys: str) -> Column:
    """Sub-document; SQL NULL only when the key is missing."""
    return F.try_variant_get(doc, path(*keys), "variant")


def is_present(doc: Column, *keys: str) -> Column:
    """Key exists, a null value included."""
    return node_at(doc, *keys).isNotNull()


def is_object(doc: Column) -> Column:
    return F.try_variant_get(doc, "$", "map<string,variant>").isNotNull()


def is_array(doc: Column) -> Column:
    return F.try_variant_get(doc, "$", "array<variant>").isNotNull()


def is_string(doc: Column) -> Column:
    return F.to_json(doc).startswith('"')


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    The optimizer copies a projected expression into every filter and column
    that uses it; for parsed documents that multiplies the parsing.  It does not
    look through a generator, so the values pass through one.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def text_or_falsy(doc: Column, *keys: str) -> Column:
    """Value as text, NULL when missing, null, empty, zero or false.

    Text ``'0'`` counts as a value, the number 0 does not.
    """
    return _unless_falsy(text_at(doc, *keys), node_at(doc, *keys))


def _unless_falsy(text: Column, node: Column) -> Column:
    # Only where the text reads zero or false does it matter whether it was written as a text; most begin otherwise.
    zero = text.rlike(r"^(-?0+(\.0+)?([eE].*)?|false)$")
    return F.when(text.isNull() | ((text >= "1") & (text < "f")), text).when(~zero, F.nullif(text, F.lit(""))).when(is_string(node), text)


def texts_of(doc: Column) -> Column:
    """All fields of an object as text by name, read in one go; NULL for what is no object."""
    return F.try_variant_get(doc, "$", "map<string,string>")


def first_truthy(doc: Column, *names: str, texts: Column | None = None) -> Column:
    """First truthy value among alternate names of one field, else whatever the last name holds.

    ``texts`` is the document's ``texts_of``, where many fields are read.
    """
    *others, last = names
    if texts is None:
        return F.coalesce(*[text_or_falsy(doc, name) for name in others], text_at(doc, last))
    return F.coalesce(*[_unless_falsy(texts[name], node_at(doc, name)) for name in others], texts[last])


def first_present(doc: Column, *names: str) -> Column:
    """First non-null value among alternate names of one field."""
    return F.coalesce(*[text_at(doc, name) for name in names])


def field_lookup(doc: Column, names: Sequence[str]) -> Column:
    """Custom field held either in an object or in a list of name/value entries.

    Object: first non-null of ``names``, case-sensitive.  List: the first entry
    whose display or internal name matches, whatever its case and outer blanks.
    """
    wanted = sorted({name.strip().lower() for name in names})

    def matches(entry: Column) -> Column:
        keys = [F.lower(strip(text_at(entry, key))) for key in ("field_display_name", "field_name")]
        return F.coalesce(keys[0].isin(wanted), F.lit(False)) | F.coalesce(keys[1].isin(wanted), F.lit(False))

    entries = F.filter(F.try_variant_get(doc, "$", "array<variant>"), matches)
    return F.coalesce(first_present(doc, *names), text_at(F.get(entries, F.lit(0)), "field_value"))


# Names under which the custom fields arrive.
LOCATION_ALIASES = {
    "city": ("city", "City"),
    "state": ("state", "State"),
    "address": ("address", "Address"),
    "pincode": ("pincode", "Pincode", "pin code"),
}
PARENT_ALIASES = {
    "parent_name": ("parent_name", "Parent Name"),
    "parent_email": ("parent_email", "Parent Email"),
    "parent_contact": ("parent_contact", "Parent Phone"),
}
