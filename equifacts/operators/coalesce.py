"""One record out of several sources by precedence."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.functions.text import first_text


def join_sources(base: DataFrame, sources: list[DataFrame], key: str) -> DataFrame:
    """Left join of sources that are unique by key."""
    for source in sources:
        base = base.join(source, key, "left")
    return base


def by_precedence(df: DataFrame, key: str, rules: dict[str, list[str]]) -> DataFrame:
    """Each field from the first of its columns that is filled."""
    return df.select(
        key, *[first_text(*[F.col(c) for c in cols]).alias(f) for f, cols in rules.items()])


# Source columns of each profile field, the first filled one wins.
PROFILE_RULES = {
    "company_name": ["feed_name", "identity_name", "company_name"],
    "bse_symbol": ["page_bse_symbol", "feed_bse_symbol"],
    "isin": ["page_isin", "feed_isin", "isin"],
    "mc_sc_id": ["mc_sc_id"],
    "mc_url": ["mc_url"],
    "sector": ["feed_sector", "identity_sector"],
    "industry": ["feed_industry", "nse_industry"],
    "business_summary": ["business_summary"],
    "products_services": ["products_services"],
    "major_clients": ["major_clients"],
    "order_book": ["order_book"],
    "website": ["website"],
    "email": ["email"],
    "address": ["address"],
    "phone": ["phone"],
    "registrar": ["registrar"],
    "management": ["management"],
}
