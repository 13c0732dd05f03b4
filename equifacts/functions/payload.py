"""Reading of JSON payloads. Variants stay inside the functions that parse them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from equifacts.functions.text import clean_text, parse_number


def parse(body: Column) -> Column:
    return F.try_parse_json(body)


def kind(v: Column) -> Column:
    """Type name of a variant; VOID for a JSON null, NULL for no value."""
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return F.coalesce(kind(v).startswith("OBJECT"), F.lit(False))


def items(v: Column, path: str = "$") -> Column:
    """Elements of a JSON array as an array of variants, NULL when it is no array."""
    return F.try_variant_get(v, path, "array<variant>")


def child(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def key_path(key: str) -> str:
    """Path of one object key, also for keys with dots, spaces or slashes."""
    return f"$['{key}']"


def raw_text(v: Column, path: str) -> Column:
    """Scalar at ``path`` as text; NULL for objects and arrays."""
    return scalar_only(F.try_variant_get(v, path, "string"), v, path)


def scalar_only(found: Column, v: Column, path: str) -> Column:
    """``found`` unless it prints an object or array. Only texts that look like one are
    looked up a second time."""
    return F.when(~F.left(found, F.lit(1)).isin("{", "["), found).when(
        kind(child(v, path)) == "STRING", found)


def text(v: Column, path: str) -> Column:
    return clean_text(raw_text(v, path))


def truth(v: Column, path: str) -> Column:
    """1 and 0 for a JSON true and false, NULL for anything else."""
    return F.when(kind(child(v, path)) == "BOOLEAN", F.try_variant_get(v, path, "double"))


def number(v: Column, path: str) -> Column:
    """Number at ``path``: numbers pass, true and false count 1 and 0, texts are parsed."""
    return F.coalesce(truth(v, path), parse_number(raw_text(v, path)))
