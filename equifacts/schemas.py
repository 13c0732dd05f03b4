"""Table layouts. Value columns are derived from the layout, so a new field is
added here and in its extractor only."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Field names of the stored tables.
PROFILE_FIELDS = [
    "company_name", "bse_symbol", "isin", "mc_sc_id", "mc_url", "sector", "industry",
    "business_summary", "products_services", "major_clients", "order_book", "website",
    "email", "address", "phone", "registrar", "management", "listed_indices",
]
PRICE_FIELDS = [
    "capitalisation_cr", "price", "pe", "pb", "industry_pe", "dividend_yield", "book_value",
    "eps_ttm", "face_value", "week52_high", "week52_low", "shares_outstanding",
]
PERIOD_FIELDS = [
    "revenue", "other_income", "total_income", "expenditure", "interest", "tax",
    "net_profit", "basic_eps",
]
# Profile fields listed in the missing-field report, in this order.
REPORTED_FIELDS = [
    "business_summary", "website", "products_services", "major_clients", "order_book",
    "bse_symbol",
]


def _struct(strings=(), doubles=(), longs=(), stamps=()):
    kinds = [(strings, StringType()), (doubles, DoubleType()), (longs, LongType()),
             (stamps, TimestampType())]
    return StructType([StructField(n, t) for names, t in kinds for n in names])


TABLES = {
    "companies": _struct(
        ["nse_symbol", *PROFILE_FIELDS],
        stamps=["static_updated_at", "dynamic_updated_at", "created_at", "updated_at"]),
    "company_indices": _struct(["nse_symbol", "index_key", "index_name"], stamps=["updated_at"]),
    "price_snapshot": _struct(["nse_symbol"], PRICE_FIELDS, stamps=["updated_at"]),
    "period_results": _struct(
        ["nse_symbol", "period_type", "period_label"], PERIOD_FIELDS, stamps=["updated_at"]),
    "shareholding": _struct(
        ["nse_symbol", "category"], ["percent"], ["pos"], stamps=["updated_at"]),
    "scrape_runs": _struct(
        ["run_id", "notes"],
        longs=["indices_fetched", "constituents_seen", "it_companies", "companies_scraped",
               "companies_failed", "requests_made"],
        stamps=["started_at", "finished_at"]),
    "scrape_errors": _struct(
        ["run_id", "nse_symbol", "company_name", "stage", "message"],
        stamps=["occurred_at"]),
    "ledger": _struct(["run_id", "nse_symbol"], longs=["version"]),
}

KEYS = {
    "companies": ["nse_symbol"],
    "company_indices": ["nse_symbol", "index_key"],
    "price_snapshot": ["nse_symbol"],
    "period_results": ["nse_symbol", "period_type", "period_label"],
    "shareholding": ["nse_symbol", "category"],
}

LANDING = _struct(["symbol", "error", "body"], stamps=["fetched_at"]).add("status", IntegerType())
LANDED_RESULTS = StructType(LANDING.fields + [StructField("kind", StringType())])
CONSTITUENT_CSV = _struct(["Company Name", "Industry", "Symbol", "Series", "ISIN Code"])
