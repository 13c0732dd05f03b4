"""The companies a run works on."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.operators.filters import first_by, in_sector, only_symbols
from equifacts.operators.merge import merge_by_key

# Industries and vendor sectors that count as the wanted sector.
INDUSTRIES = ["Information Technology"]
VENDOR_SECTORS = ["Software & IT Services", "IT Services & Consulting"]

ORDER = ["index_rank", "block_start", "row_pos"]


def merged_constituents(constituents: DataFrame) -> DataFrame:
    return merge_by_key(
        constituents, "nse_symbol", ["company_name", "nse_industry", "isin"], "index_key", ORDER)


def discover(constituents: DataFrame, whole_sector: list[str],
             industries: list[str] = INDUSTRIES, symbols: list[str] | None = None,
             limit: int | None = None) -> DataFrame:
    """Merged constituents of the sector, restricted to the requested symbols. The first
    ``limit`` by symbol when a limit is given; unordered otherwise."""
    merged = merged_constituents(constituents)
    kept = only_symbols(
        in_sector(merged, "nse_industry", industries, "index_keys", whole_sector),
        "nse_symbol", symbols)
    return kept if limit is None else first_by(kept, "nse_symbol", limit)


def listing(universe: DataFrame) -> DataFrame:
    """The universe with its index keys, by symbol."""
    return universe.select(
        "nse_symbol", "company_name", F.array_join("index_keys", ", ").alias("index_keys"),
    ).orderBy("nse_symbol")
