"""Matching of companies to the candidates a fuzzy search returned for them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.functions.text import display_tokens


def resolve(companies: DataFrame, candidates: DataFrame, key: str = "nse_symbol",
            isin: str = "isin") -> DataFrame:
    """The identity of each company that has one, from candidates keyed by the symbol that
    was asked for."""
    return pick_identity(candidates.join(companies.select(key, isin), key), key, isin)


def pick_identity(asked: DataFrame, key: str = "nse_symbol", isin: str = "isin") -> DataFrame:
    """One identity per key out of candidates that carry the company's ISIN.

    The first candidate whose display text holds the ISIN decides, even when its identity
    turns out incomplete; without one, the first complete candidate that shows the exact
    symbol. One candidate per key and task survives before the shuffle.
    """
    by_isin = (F.col(isin) != "") & F.contains(F.col("display"), F.col(isin))
    complete = F.col("sc_id").isNotNull() & F.col("link").isNotNull()
    by_symbol = F.array_contains(display_tokens(F.col("display")), F.col(key)) & complete
    tier = F.when(by_isin, 1).when(by_symbol, 2)
    hits = asked.withColumn("_tier", tier).where(F.col("_tier").isNotNull())
    best = hits.groupBy(key).agg(F.min_by(
        F.struct("sc_id", "link", "name", "sector"), F.struct("_tier", "pos")).alias("_hit"))
    found = best.where(F.col("_hit.sc_id").isNotNull() & F.col("_hit.link").isNotNull())
    return found.select(
        key,
        F.col("_hit.sc_id").alias("mc_sc_id"),
        F.col("_hit.link").alias("mc_url"),
        F.coalesce("_hit.name", key).alias("identity_name"),
        F.col("_hit.sector").alias("identity_sector"))
