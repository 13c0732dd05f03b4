"""HTML entities decoded by built-in functions, as the standard library decodes them.

A text is cut around what looks like an entity. A number is a code point; a name is looked up whole,
then by its longest prefix among the names that need no semicolon.
"""

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
REPLACEMENT = "�"
LAST_POINT = 0x10FFFF

# The names come from the standard library. Those without a semicolon mean the same with one.
SHORT = {name: text for name, text in html5.items() if not name.endswith(";")}
LONG = {name: text for name, text in html5.items() if name.endswith(";") and name[:-1] not in SHORT}
# The longest first, so that the first that fits is the longest.
PREFIX = "^&(" + "|".join(sorted(SHORT, key=lambda n: (-len(n), n))) + ")"


def _windows(point: int) -> str:
    """What a number between 128 and 159 means: the character that Windows has there, if any."""
    try:
        return bytes([point]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(point)


MEANT = {0: REPLACEMENT, 13: "\r", **{p: _windows(p) for p in range(0x80, 0xA0)}}


def _table(pairs: dict[str, str]) -> Column:
    """A constant map; it is folded once, as the query is planned."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _point(entity: Column) -> Column:
    """The code point of a numeric entity; one beyond the last where there are too many digits."""
    hexadecimal = entity.rlike("^&#[xX]")
    digits = F.regexp_extract(entity, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    number = F.when(hexadecimal, F.conv(F.when(digits == "", "0").otherwise(digits), 16, 10)).otherwise(
        F.when(digits == "", "0").otherwise(digits)).try_cast("long")
    return F.when(F.length(digits) > 8, F.lit(LAST_POINT + 1)).otherwise(number)


def _character(point: Column) -> Column:
    """The character of a code point; none for control characters and non-characters."""
    none = (
        point.between(1, 8) | (point == 11) | point.between(14, 31) | (point == 127)
        | point.between(0xFDD0, 0xFDEF) | (point.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    plain = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    meant = F.create_map(*[F.lit(x) for pair in MEANT.items() for x in pair])
    return (
        F.when(point.isin(list(MEANT)), meant[point.cast("int")])
        .when(point.between(0xD800, 0xDFFF) | (point > LAST_POINT), REPLACEMENT)
        .when(none, "").otherwise(plain))


def _named(entity: Column) -> Column:
    name = F.regexp_replace(F.substring(entity, 2, 40), ";$", "")
    short, long = _table(SHORT), _table(LONG)

    def by_prefix(prefix: Column) -> Column:
        rest = F.substring(entity, F.length(prefix) + 2, F.length(entity))
        return F.when(prefix != "", F.concat(F.try_element_at(short, prefix), rest)).otherwise(entity)

    return F.coalesce(
        F.try_element_at(short, name), F.try_element_at(long, F.substring(entity, 2, 40)),
        _let(F.regexp_extract(entity, PREFIX, 1), by_prefix))


def decoded(entity: Column) -> Column:
    """The text that one entity stands for; the entity itself if it has no meaning."""
    return F.when(entity.startswith("&#"), _let(_point(entity), _character)).otherwise(_named(entity))


def unescape(c: Column) -> Column:
    """The text with its entities decoded; texts without an ampersand are not touched."""
    def joined(found: Column) -> Column:
        between = F.split(c, ENTITY)
        pieces = F.zip_with(between, found, lambda text, entity: F.concat(
            text, F.when(entity.isNull(), "").otherwise(decoded(entity))))
        return F.array_join(pieces, "")

    return F.when(c.contains("&"), _let(F.regexp_extract_all(c, F.lit(f"({ENTITY})"), 1), joined)).otherwise(c)
