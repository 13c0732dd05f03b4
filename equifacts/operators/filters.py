"""Selection of the rows a run works on."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.functions.text import in_list


def requested_symbols(requests: DataFrame, text: str, key: str) -> DataFrame:
    """One row per symbol of the comma-separated requests, trimmed and in capitals."""
    symbol = F.explode(F.split(F.upper(F.col(text)), ",")).alias(key)
    return requests.select(symbol).select(F.trim(key).alias(key)).where(
        F.col(key) != "").distinct()


def in_sector(df: DataFrame, industry: str, industries: list[str], members: str,
              whole_sector: list[str]) -> DataFrame:
    """Rows that belong to an index of one sector only, or whose industry is listed.

    ``whole_sector`` are keys of the registry, so the list is as short as that.
    """
    member = F.arrays_overlap(F.col(members), F.array(*[F.lit(k) for k in whole_sector])) \
        if whole_sector else F.lit(False)
    return df.where(F.coalesce(member, F.lit(False)) | in_list(F.col(industry), industries))


def in_vendor_sector(df: DataFrame, sector: str, sectors: list[str]) -> DataFrame:
    return df.where(in_list(F.col(sector), sectors))


def only_symbols(df: DataFrame, key: str, symbols: list[str] | DataFrame | None) -> DataFrame:
    """Rows of the requested symbols, given as a list in any case or as a table of them.

    An empty list means all rows; a table is joined, however long it is.
    """
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select(key), key, "left_semi")
    return df.where(F.col(key).isin([s.upper() for s in symbols])) if symbols else df


def in_scope(df: DataFrame, scope: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the scope table; an empty scope gives an empty result."""
    return df.join(scope.select(key), key, "left_semi")


def first_by(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """Rows in key order, the first ``n`` of them when given."""
    ordered = df.orderBy(key)
    return ordered if n is None else ordered.limit(n)
