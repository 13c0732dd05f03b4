"""Cleaning of scraped text, numbers, period labels and stamps as Column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equifacts.functions.entities import unescape

# Texts that mean "no value", besides the empty one.
PLACEHOLDERS = r"^(-|--|N\.A\.|NA|null|None)$"
# Currency and unit marks that are not part of a number.
NUMBER_MARKS = r"[,%₹]|(?iu:rs|cr)\.?"
# Month abbreviations; the position is the month number.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
# Fixed value: shape of a period label such as "Mar '26" or "December 2025".
PERIOD_LABEL = r"(?U)^([A-Za-z]{3})\w*\s*'?([0-9]{2,4})$"

# White space as Unicode has it, and the four separators. Spelled out, because the Unicode
# mode of the regex engine is much slower.
SPACE = (
    r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def unescape_each(c: Column) -> Column:
    """``unescape`` for an array of texts."""
    return F.transform(c, unescape)


def unescape_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: unescape(F.col(n)) for n in names})


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{SPACE}+$", "")


def normalise(c: Column) -> Column:
    """Collapse white space, trim, and turn placeholders into NULL."""
    text = F.trim(F.regexp_replace(c, rf"{SPACE}+", " "))
    return F.nullif(F.regexp_replace(text, PLACEHOLDERS, ""), F.lit(""))


def clean_text(c: Column) -> Column:
    return normalise(unescape(c))


def to_number(c: Column) -> Column:
    """Number in a decoded text ("Rs. 1,234.50 Cr"), NULL when it holds none.

    A placeholder holds none either. The pattern keeps out spellings that only a cast would
    accept (``1d``, ``nan``).
    """
    digits = F.regexp_replace(c, f"{SPACE}|{NUMBER_MARKS}", "")
    return F.regexp_extract(digits, DECIMAL, 0).try_cast("double")


def parse_number(c: Column) -> Column:
    return to_number(unescape(c))


def first_number(*cols: Column) -> Column:
    return F.coalesce(*[parse_number(c) for c in cols])


def first_text(*cols: Column) -> Column:
    """First text that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def in_list(c: Column, values: list[str]) -> Column:
    """Case-insensitive membership of the trimmed text; NULL and empty are no members."""
    wanted = sorted({v.lower() for v in values})
    return F.coalesce(F.lower(strip(c)).isin(wanted) & (c != ""), F.lit(False))


def period_year(label: Column) -> Column:
    """Year of a period label, two digits meaning 20xx, 0 when it is no label."""
    year = F.regexp_extract(strip(label), PERIOD_LABEL, 2).try_cast("int")
    return F.coalesce(F.when(year < 100, year + 2000).otherwise(year), F.lit(0))


def period_month(label: Column) -> Column:
    """Month of a period label, 0 for an unknown month name."""
    name = F.lower(F.regexp_extract(strip(label), PERIOD_LABEL, 1))
    found = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name).cast("int")
    return F.coalesce(found, F.lit(0))


def parse_stamp(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss"))


def stamp_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def age_days(stamp: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(stamp)) / F.lit(86400e6)


def display_tokens(display: Column) -> Column:
    """Comma-separated parts of a candidate's display text; span tags split too."""
    parts = F.split(F.regexp_replace(display, "</?span>", ","), ",")
    return F.transform(parts, strip)


def url_part(c: Column) -> Column:
    """Percent-encode one URL part: space as %20, and slash and tilde left as they are."""
    encoded = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    encoded = F.replace(encoded, F.lit("%2F"), F.lit("/"))
    encoded = F.replace(encoded, F.lit("*"), F.lit("%2A"))
    return F.replace(encoded, F.lit("%7E"), F.lit("~"))
