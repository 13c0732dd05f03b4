"""Report tables. Headers are the printed ones; every report is a DataFrame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.functions.sentences import shorten
from equifacts.functions.text import stamp_text
from equifacts.operators.filters import in_scope
from equifacts.operators.latest import latest_period, latest_periods, order_periods, with_period
from equifacts.operators.merge import member_names
from equifacts.operators.quality import errors_and_missing
from equifacts.schemas import PRICE_FIELDS, PERIOD_FIELDS
from equifacts.session import stage

# Printed headers and the column behind each.
COMPANY_LIST = {
    "Company Name": "company_name", "NSE Symbol": "nse_symbol", "BSE Symbol": "bse_symbol",
    "ISIN": "isin", "Sector": "sector", "Industry": "industry",
    "Capitalisation (Rs Cr)": "capitalisation_cr", "NSE Indices": "indices", "Vendor URL": "mc_url",
}
COMPANY_PROFILE = {
    "Company Name": "company_name", "NSE Symbol": "nse_symbol", "Sector": "sector",
    "Industry": "industry", "Business Summary": "business_summary", "Website": "website",
    "Email": "email", "Phone": "phone", "Address": "address", "Registrar": "registrar",
    "Management": "management", "Static Updated (UTC)": "static_updated_at",
    "Dynamic Updated (UTC)": "dynamic_updated_at",
}
FINANCIAL_DATA = {
    "Company Name": "company_name", "NSE Symbol": "nse_symbol",
    "Capitalisation (Rs Cr)": "capitalisation_cr", "Price": "price", "P/E": "pe", "P/B": "pb",
    "Industry P/E": "industry_pe", "Dividend Yield %": "dividend_yield",
    "Book Value": "book_value", "EPS (TTM)": "eps_ttm", "Face Value": "face_value",
    "52W High": "week52_high", "52W Low": "week52_low", "Latest FY": "period_label",
    "FY Revenue (Rs Cr)": "revenue", "FY Net Profit (Rs Cr)": "net_profit",
}
PERIODS = {
    "Company Name": "company_name", "NSE Symbol": "nse_symbol", "Period": "period_label",
    "Revenue (Rs Cr)": "revenue", "Other Income (Rs Cr)": "other_income",
    "Total Income (Rs Cr)": "total_income", "Expenditure (Rs Cr)": "expenditure",
    "Interest (Rs Cr)": "interest", "Tax (Rs Cr)": "tax", "Net Profit (Rs Cr)": "net_profit",
    "Basic EPS": "basic_eps",
}
HOLDINGS = {
    "Company Name": "company_name", "NSE Symbol": "nse_symbol", "Category": "category",
    "Holding %": "percent", "Updated (UTC)": "updated_at",
}
ERRORS = {
    "NSE Symbol": "nse_symbol", "Company Name": "company_name", "Stage": "stage",
    "Error": "message", "Occurred At": "occurred_at",
}
FACETS = {
    "Products & Services": ("products_services", "Products & Services"),
    "Clients": ("major_clients", "Major Clients"),
    "Order Book": ("order_book", "Order Book"),
}
QUARTERS_SHOWN = 3


def printed(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Columns under their printed headers; stamps become text."""
    stamps = {f.name for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.select(*[
        (stamp_text(F.col(c)) if c in stamps else F.col(c)).alias(h) for h, c in headers.items()])


def companies_with_prices(companies: DataFrame, prices: DataFrame, scope: DataFrame,
                          fields: list[str] = PRICE_FIELDS) -> DataFrame:
    """Every company of the scope with its price columns, when it has any."""
    return in_scope(companies, scope, "nse_symbol").join(
        prices.select("nse_symbol", *fields), "nse_symbol", "left")


def with_indices(companies: DataFrame, memberships: DataFrame, key: str = "nse_symbol",
                 name: str = "index_name") -> DataFrame:
    """Add the joined index names, "" for a company in none."""
    names = member_names(memberships, key, name)
    return companies.join(names, key, "left").withColumn(
        "indices", F.coalesce(F.array_join("names", ", "), F.lit(""))).drop("names")


def by_name(df: DataFrame) -> DataFrame:
    return df.orderBy(F.asc_nulls_first("company_name"), "nse_symbol")


def company_list(view: DataFrame, memberships: DataFrame) -> DataFrame:
    return printed(by_name(with_indices(view, memberships)), COMPANY_LIST)


def company_profile(view: DataFrame) -> DataFrame:
    return printed(by_name(view), COMPANY_PROFILE)


def financial_data(view: DataFrame, annual: DataFrame) -> DataFrame:
    """Price columns with the newest annual row."""
    newest = latest_period(annual, "nse_symbol", ["revenue", "net_profit"])
    return printed(by_name(view.join(newest, "nse_symbol", "left")), FINANCIAL_DATA)


def of_company(rows: DataFrame, companies: DataFrame, scope: DataFrame) -> DataFrame:
    """Rows of the companies in scope with the company name."""
    names = in_scope(companies, scope, "nse_symbol").select("nse_symbol", "company_name")
    return rows.join(names, "nse_symbol")


def quarterly_rows(periods: DataFrame, companies: DataFrame, scope: DataFrame,
                   n: int = QUARTERS_SHOWN) -> DataFrame:
    newest = latest_periods(periods.where(F.col("period_type") == "Q"), ["nse_symbol"], n)
    return order_periods(of_company(newest, companies, scope), "company_name", "nse_symbol")


def annual_rows(periods: DataFrame, companies: DataFrame, scope: DataFrame) -> DataFrame:
    """All annual rows, newest first per company."""
    annual = with_period(periods.where(F.col("period_type") == "Y"))
    return order_periods(of_company(annual, companies, scope), "company_name", "nse_symbol")


def period_report(rows: DataFrame) -> DataFrame:
    return printed(rows, PERIODS)


def holding_rows(holdings: DataFrame, companies: DataFrame, scope: DataFrame) -> DataFrame:
    return of_company(holdings, companies, scope).orderBy(
        F.asc_nulls_first("company_name"), "nse_symbol", "pos")


def facet_report(view: DataFrame, facet: str, label: str, length: int | None = None) -> DataFrame:
    """Companies with the facet, cut to ``length`` if given, or one row saying that there is none."""
    filled = view.where(F.col(facet).isNotNull() & (F.col(facet) != ""))
    if length is not None:
        filled = filled.withColumn(facet, shorten(F.col(facet), length))
    headers = {"Company Name": "company_name", "NSE Symbol": "nse_symbol", label: facet}
    return or_placeholder(
        printed(by_name(filled), headers), printed(filled, headers),
        f"No {label.lower()} information found in company profiles")


def or_placeholder(rows: DataFrame, unordered: DataFrame, text: str) -> DataFrame:
    """``rows``, or one row with ``text`` in the first column when there are none.

    Whether there are any is asked of the ``unordered`` rows, which stops at the first.
    """
    first, *others = rows.schema
    none = unordered.limit(1).agg(F.count(F.lit(1)).alias("_n")).where("_n = 0").select(
        F.lit(text).cast(first.dataType).alias(first.name),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in others])
    return rows.unionByName(none)


def error_report(errors: DataFrame, missing: DataFrame) -> DataFrame:
    rows = errors_and_missing(errors, missing).orderBy("part", "occurred_at", "nse_symbol", "stage")
    return printed(rows, ERRORS)


def report_bundle(companies: DataFrame, prices: DataFrame, memberships: DataFrame,
                  periods: DataFrame, holdings: DataFrame, scope: DataFrame,
                  errors: DataFrame, missing: DataFrame, summary: DataFrame,
                  facet_length: int | None = None) -> dict[str, DataFrame]:
    """The ten tables of a run by sheet name."""
    # Six sheets read this join.
    view = stage(companies_with_prices(companies, prices, scope), "report-view")
    in_run = in_scope(memberships, scope, "nse_symbol")
    annual = in_scope(periods.where(F.col("period_type") == "Y"), scope, "nse_symbol")
    sheets = {
        "Company List": company_list(view, in_run),
        "Company Profile": company_profile(view),
        "Financial Data": financial_data(view, annual),
        "Quarterly Results": period_report(quarterly_rows(periods, companies, scope)),
        "Shareholding": printed(holding_rows(holdings, companies, scope), HOLDINGS),
    }
    for sheet, (facet, label) in FACETS.items():
        sheets[sheet] = facet_report(view, facet, label, facet_length)
    sheets["Errors & Skipped"] = error_report(errors, missing)
    sheets["Execution Summary"] = summary
    return sheets


def csv_tables(companies: DataFrame, prices: DataFrame, periods: DataFrame,
               holdings: DataFrame, scope: DataFrame) -> dict[str, DataFrame]:
    """The four tables of the plain CSV export."""
    keys = ["nse_symbol", "company_name", "period_label", *PERIOD_FIELDS, "updated_at"]
    return {
        "companies": by_name(companies_with_prices(companies, prices, scope)).drop(
            "created_at", "updated_at"),
        "quarterly_results": quarterly_rows(periods, companies, scope).select(*keys),
        "annual_results": annual_rows(periods, companies, scope).select(*keys),
        "shareholding": holding_rows(holdings, companies, scope).select(
            "nse_symbol", "company_name", "category", "percent", "updated_at"),
    }
