"""Report tables, stored tables, CSV files, streaming and the whole run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from equifacts.bindings.catalog import Data, query
from equifacts.bindings.feeds import json_object, result_bodies
from equifacts.bindings.pages import company_pages
from equifacts.bindings.periods import period_rows
from equifacts.bindings.universe import INDICES, constituents, registry
from equifacts.bindings.upserts import (
    FIELDS,
    RUN_TS,
    STAMP_SQL,
    UPSERT_SQL,
    incoming_companies,
    stored_companies,
)
from equifacts.functions.text import stamp_text
from equifacts.operators.merge import explode_members
from equifacts.operators.quality import union_all
from equifacts.plans import reports
from equifacts.plans.company_batch import Landed, run_batch, run_reports
from equifacts.plans.universe import merged_constituents
from equifacts.schemas import PRICE_FIELDS, PROFILE_FIELDS
from equifacts.session import scratch_path
from equifacts.sources.registry import index_registry
from equifacts.sources.tables import Tables, write_csv
from equifacts.streaming.landed import landed_stream, upsert_landed

TS = "2026-07-04 10:30:00"


def padded(df: DataFrame, names: list[str], kind: str) -> DataFrame:
    """Add the table columns that the given data has nothing for, as NULL."""
    return df.withColumns({
        n: F.lit(None).cast(kind) for n in names if n not in df.columns})


def companies(d: Data) -> DataFrame:
    rows = d.customer.select(
        F.col("c_custkey").alias("nse_symbol"),
        F.when(F.col("c_nationkey") != 0, F.col("c_name")).alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
        F.concat(F.lit("N"), "c_nationkey").alias("industry"),
        F.concat(F.lit("http://x/"), "c_custkey").alias("mc_url"),
        F.concat(F.lit("B"), "c_custkey").alias("bse_symbol"),
        F.when(F.col("c_nationkey") > 2, F.concat(F.lit("IN"), "c_custkey")).alias("isin"),
        F.when(F.col("c_nationkey") > 3, F.concat(F.lit("http://w/"), "c_custkey")).alias("website"),
        F.concat("c_custkey", F.lit("@x.example")).alias("email"),
        F.concat(F.lit("020-"), "c_custkey").alias("phone"),
        F.concat("c_mktsegment", F.lit(", "), "c_name").alias("address"),
        F.lower("c_mktsegment").alias("registrar"),
        F.concat("c_name", F.lit(" (CEO)")).alias("management"),
        F.when(F.col("c_acctbal") >= 0, F.concat_ws(" ", "c_name", "c_mktsegment")).alias("business_summary"),
        F.lit(TS).cast("timestamp").alias("static_updated_at"),
        F.when(F.col("c_nationkey") > 5, F.lit(TS).cast("timestamp")).alias("dynamic_updated_at"))
    return padded(rows, PROFILE_FIELDS, "string")


def prices(d: Data) -> DataFrame:
    """Extremes of a customer's orders as its price columns."""
    year, month, day = F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate")
    found = {
        "capitalisation_cr": F.max("o_totalprice"), "price": F.min("o_totalprice"),
        "pe": F.max("o_orderkey"), "pb": F.min("o_orderkey"), "industry_pe": F.count(F.lit(1)),
        "dividend_yield": F.max(year), "book_value": F.min(year), "eps_ttm": F.max(month),
        "face_value": F.min(month), "week52_high": F.max(day), "week52_low": F.min(day),
        "shares_outstanding": F.max(F.length("o_orderpriority"))}
    return d.orders.where("o_orderstatus <> 'P'").groupBy(F.col("o_custkey").alias("nse_symbol")).agg(
        *[found[n].cast("double").alias(n) for n in PRICE_FIELDS])


def scope(d: Data) -> DataFrame:
    """Customers with an urgent order."""
    return d.orders.where("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("nse_symbol")).distinct()


def view(d: Data) -> DataFrame:
    return reports.companies_with_prices(companies(d), prices(d), scope(d))


def typed_periods(d: Data) -> DataFrame:
    """Customer months; those of finished revenue are both annual and quarterly rows."""
    revenue = F.col("revenue")
    rows = period_rows(d).drop("priority").withColumns({
        "other_income": revenue * 2, "total_income": revenue * 4, "expenditure": revenue / 2,
        "interest": revenue / 4, "tax": revenue / 8, "net_profit": -revenue,
        "basic_eps": F.col("nse_symbol").cast("double")})
    return rows.withColumn("period_type", F.explode(F.array(F.lit("Q"), F.lit("Y"))))


def memberships(d: Data) -> DataFrame:
    bridge = explode_members(merged_constituents(constituents(d)), "nse_symbol", registry(d))
    return bridge.withColumn("nse_symbol", F.col("nse_symbol").cast("long"))


VIEW_SQL = """
scope AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'),
prices AS (
  SELECT o_custkey AS k, max(o_totalprice) AS cap, min(o_totalprice) AS price,
    max(o_orderkey)::DOUBLE AS pe, min(o_orderkey)::DOUBLE AS pb, count(*)::DOUBLE AS n_orders,
    max(year(o_orderdate))::DOUBLE AS y1, min(year(o_orderdate))::DOUBLE AS y0,
    max(month(o_orderdate))::DOUBLE AS m1, min(month(o_orderdate))::DOUBLE AS m0,
    max(day(o_orderdate))::DOUBLE AS d1, min(day(o_orderdate))::DOUBLE AS d0
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
firms AS (
  SELECT c_custkey AS k, CASE WHEN c_nationkey <> 0 THEN c_name END AS name, c_mktsegment,
    'N' || c_nationkey AS industry, c_acctbal, c_name, c_nationkey
  FROM customer WHERE c_custkey IN (SELECT k FROM scope))"""
NAMES_SQL = """
listed AS (
  SELECT o_custkey AS k, string_agg(name, ', ' ORDER BY name) AS names FROM (
    SELECT DISTINCT o_custkey, CASE o_orderpriority WHEN '3-MEDIUM' THEN 'Medium Fifty'
      WHEN '1-URGENT' THEN 'Urgent' WHEN '5-LOW' THEN 'Low Cap' WHEN '2-HIGH' THEN 'High Cap'
      ELSE 'Rest' END AS name
    FROM orders WHERE o_totalprice >= 2000) GROUP BY 1)"""
PERIOD_SQL = """
  revenue AS "Revenue (Rs Cr)", revenue * 2 AS "Other Income (Rs Cr)",
  revenue * 4 AS "Total Income (Rs Cr)", revenue / 2 AS "Expenditure (Rs Cr)",
  revenue / 4 AS "Interest (Rs Cr)", revenue / 8 AS "Tax (Rs Cr)",
  -revenue AS "Net Profit (Rs Cr)", k::DOUBLE AS "Basic EPS"
"""
MONTHS_SQL = """
months AS (
  SELECT o_custkey AS k, strftime(min(o_orderdate), '%b %Y') AS label,
    row_number() OVER (PARTITION BY o_custkey
      ORDER BY year(o_orderdate) DESC, month(o_orderdate) DESC) AS n,
    last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS revenue
  FROM orders WHERE o_orderstatus <> 'P'
  GROUP BY o_custkey, year(o_orderdate), month(o_orderdate))"""


@query(f"""WITH {VIEW_SQL}, {NAMES_SQL}
SELECT name AS "Company Name", k AS "NSE Symbol", 'B' || k AS "BSE Symbol",
  CASE WHEN c_nationkey > 2 THEN 'IN' || k END AS "ISIN", c_mktsegment AS "Sector", industry AS "Industry",
  cap AS "Capitalisation (Rs Cr)", coalesce(names, '') AS "NSE Indices", 'http://x/' || k AS "Vendor URL"
FROM firms LEFT JOIN prices USING (k) LEFT JOIN listed USING (k)""")
def company_list(d: Data) -> DataFrame:
    in_run = reports.in_scope(memberships(d), scope(d), "nse_symbol")
    return reports.company_list(view(d), in_run)


@query(f"""WITH {VIEW_SQL}
SELECT name AS "Company Name", k AS "NSE Symbol", c_mktsegment AS "Sector",
  industry AS "Industry",
  CASE WHEN c_acctbal >= 0 THEN c_name || ' ' || c_mktsegment END AS "Business Summary",
  CASE WHEN c_nationkey > 3 THEN 'http://w/' || k END AS "Website", k || '@x.example' AS "Email",
  '020-' || k AS "Phone", c_mktsegment || ', ' || c_name AS "Address",
  lower(c_mktsegment) AS "Registrar", c_name || ' (CEO)' AS "Management",
  '{TS}' AS "Static Updated (UTC)",
  CASE WHEN c_nationkey > 5 THEN '{TS}' END AS "Dynamic Updated (UTC)"
FROM firms""")
def company_profile(d: Data) -> DataFrame:
    return reports.company_profile(view(d))


@query(f"""WITH {VIEW_SQL}, {MONTHS_SQL}
SELECT name AS "Company Name", k AS "NSE Symbol", cap AS "Capitalisation (Rs Cr)", price AS "Price",
  pe AS "P/E", pb AS "P/B", n_orders AS "Industry P/E", y1 AS "Dividend Yield %",
  y0 AS "Book Value", m1 AS "EPS (TTM)", m0 AS "Face Value", d1 AS "52W High", d0 AS "52W Low",
  label AS "Latest FY", revenue AS "FY Revenue (Rs Cr)", -revenue AS "FY Net Profit (Rs Cr)"
FROM firms LEFT JOIN prices USING (k)
LEFT JOIN (SELECT * FROM months WHERE n = 1) USING (k)""")
def financial_data(d: Data) -> DataFrame:
    annual = reports.in_scope(typed_periods(d).where("period_type = 'Y'"), scope(d), "nse_symbol")
    return reports.financial_data(view(d), annual)


@query(f"""WITH {VIEW_SQL}, {MONTHS_SQL}
SELECT name AS "Company Name", k AS "NSE Symbol", label AS "Period", {PERIOD_SQL}
FROM firms JOIN months USING (k) WHERE n <= 3""")
def quarterly_report(d: Data) -> DataFrame:
    rows = reports.quarterly_rows(typed_periods(d), companies(d), scope(d))
    return reports.period_report(rows)


@query(f"""WITH {VIEW_SQL}, {MONTHS_SQL}
SELECT name AS "Company Name", k AS "NSE Symbol", label AS "Period", {PERIOD_SQL}
FROM firms JOIN months USING (k)""")
def annual_report(d: Data) -> DataFrame:
    rows = reports.annual_rows(typed_periods(d), companies(d), scope(d))
    return reports.period_report(rows)


@query(f"""WITH {VIEW_SQL}
SELECT name AS "Company Name", k AS "NSE Symbol", o_orderpriority AS "Category",
  max(o_totalprice) AS "Holding %", '{TS}' AS "Updated (UTC)"
FROM firms JOIN orders ON o_custkey = k GROUP BY ALL""")
def shareholding_report(d: Data) -> DataFrame:
    return reports.printed(
        reports.holding_rows(holdings(d), companies(d), scope(d)), reports.HOLDINGS)


def holdings(d: Data) -> DataFrame:
    """The largest order of each priority as a customer's holdings."""
    rows = d.orders.groupBy(
        F.col("o_custkey").alias("nse_symbol"), F.col("o_orderpriority").alias("category")).agg(
        F.max("o_totalprice").alias("percent"), F.min("o_orderkey").alias("pos"))
    return rows.withColumn("updated_at", F.lit(TS).cast("timestamp"))


@query(f"""WITH {VIEW_SQL}, {MONTHS_SQL}
SELECT 'companies' AS csv_table, k AS nse_symbol, name AS company_name, 'B' || k AS label,
  price AS amount, NULL::VARCHAR AS updated_at
FROM firms LEFT JOIN prices USING (k)
UNION ALL SELECT 'quarterly_results', k, name, label, revenue, '{TS}'
FROM firms JOIN months USING (k) WHERE n <= 3
UNION ALL SELECT 'annual_results', k, name, label, revenue, '{TS}' FROM firms JOIN months USING (k)
UNION ALL SELECT 'shareholding', k, name, o_orderpriority, max(o_totalprice), '{TS}'
FROM firms JOIN orders ON o_custkey = k GROUP BY ALL""")
def csv_tables(d: Data) -> DataFrame:
    """The four tables of the CSV export, written and read back."""
    periods = typed_periods(d).withColumn("updated_at", F.lit(TS).cast("timestamp"))
    stamped = companies(d).withColumns({
        s: F.lit(TS).cast("timestamp") for s in ("created_at", "updated_at")})
    tables = reports.csv_tables(stamped, prices(d), periods, holdings(d), scope(d))
    folder = scratch_path(d.spark, "csv")
    label = {"companies": "bse_symbol", "shareholding": "category"}
    amount = {"companies": "price", "shareholding": "percent"}
    back = []
    for name in write_csv(tables, folder):
        rows = d.spark.read.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
        stamp = F.col("updated_at") if "updated_at" in rows.columns else F.lit(None).cast("string")
        back.append(rows.select(
            F.lit(name).alias("csv_table"), F.col("nse_symbol").cast("long").alias("nse_symbol"),
            "company_name", F.col(label.get(name, "period_label")).alias("label"),
            F.col(amount.get(name, "revenue")).cast("double").alias("amount"),
            stamp.alias("updated_at")))
    return union_all(back)


@query("""
SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' AS quoted, c_acctbal FROM customer""")
def csv_round_trip(d: Data) -> DataFrame:
    """Written as CSV and read back; a table without rows leaves no file."""
    rows = d.customer.select(
        "c_custkey", F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("quoted"),
        "c_acctbal")
    folder = scratch_path(d.spark, "csv")
    written = write_csv({"customers": rows, "none": rows.where("c_custkey < 0")}, folder)
    return d.spark.read.schema(rows.schema).option("header", True).option("escape", '"').csv(
        [f"{folder}/{name}" for name in written])


STORED = StructType().add("nse_symbol", "long").add("company_name", "string").add(
    "sector", "string").add("balance", "double").add("updated_at", "timestamp")


@query(f"""WITH {UPSERT_SQL}
SELECT nse_symbol, company_name, sector, balance, {STAMP_SQL},
  CASE WHEN op IN ('insert', 'update') THEN op END AS op
FROM result""")
def stored_upsert(d: Data) -> DataFrame:
    """The upsert through stored tables: create, publish twice, read state and change log."""
    tables = Tables(
        d.spark, scratch_path(d.spark, "tables"), buckets=16,
        layouts={"firms": STORED}, keys={"firms": ["nse_symbol"]})
    tables.create()
    first = stored_companies(d)
    tables.publish("firms", first, 1, tables.touched("firms", first))
    tables.apply({"firms": tables.upserted(
        "firms", incoming_companies(d), FIELDS, RUN_TS, stamps={"updated_at": "on_change"})})
    state = tables.read("firms").withColumn("updated_at", stamp_text(F.col("updated_at")))
    return state.join(tables.changes("firms", 2).drop("changed"), "nse_symbol", "left")


EVENT = StructType().add("event_id", "long").add("ts", "timestamp_ntz").add(
    "user_id", "long").add("event_type", "string").add("value", "double").add("props", "string")
USER = StructType().add("user_id", "long").add("event_type", "string").add("value", "double").add(
    "updated_at", "timestamp")


@query("""
SELECT user_id, last(event_type ORDER BY ts, event_id) AS event_type,
  last(value ORDER BY ts, event_id) FILTER (WHERE event_type <> 'error') AS value
FROM events GROUP BY user_id""")
def landed_increment(d: Data) -> DataFrame:
    """Landed event files taken in by a stream, started twice; the second finds nothing new."""
    root = scratch_path(d.spark, "stream")
    tables = Tables(d.spark, f"{root}/tables", buckets=16, layouts={"users": USER},
                    keys={"users": ["user_id"]})
    tables.create()

    def prepare(batch: DataFrame) -> DataFrame:
        return batch.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))

    for _ in range(2):
        # A glob, because a stream reads folders and the given table is one file.
        stream = landed_stream(d.spark, f"{d.folder}/event[s].parquet", EVENT)
        taken = upsert_landed(
            stream, tables, "users", ["event_type", "value"], ["ts", "event_id"],
            f"{root}/checkpoint", prepare)
        taken.awaitTermination()
    return tables.read("users").drop("updated_at")


def landed_tables(d: Data) -> Landed:
    """Payloads of a crawl, derived from customers and their orders."""
    key = F.col("c_custkey").cast("string")
    at = F.lit(TS).cast("timestamp").alias("fetched_at")
    none = F.lit(None).cast("string")

    def landed(rows: DataFrame, body, error=none) -> DataFrame:
        return rows.select(
            key.alias("symbol"), error.alias("error"), body.alias("body"), at, F.lit(200).alias("status"))

    entry = json_object(
        sc_id=F.concat(F.lit("S"), key),
        link_src=F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("http://x/"), key)),
        name=F.col("c_name"), sc_sector=F.col("c_mktsegment"),
        pdt_dis_nm=F.concat(F.lit("N&nbsp;<span>X, "), key, F.lit(", 5</span>")))
    price = F.to_json(F.struct(F.struct(
        F.col("c_acctbal").alias("MKTCAP"),
        F.when(F.col("c_nationkey") > 20, F.col("c_mktsegment")).alias("main_sector")).alias("data")))
    bodies = result_bodies(d).select(
        F.col("o_custkey").cast("string").alias("symbol"), none.alias("error"), "body", at,
        F.lit(200).alias("status"), F.lit("yearly").alias("kind"))
    # Joined before their pages are made, so that no page is shuffled for it.
    paged = d.customer.join(d.customer.select("c_custkey"), "c_custkey")
    return Landed(
        constituents(d),
        landed(d.customer, F.concat(F.lit("[3,"), entry, F.lit("]"))),
        landed(d.customer, price, F.when(F.col("c_nationkey") == 6, "HTTP 503")),
        bodies, landed(company_pages(d, paged), F.col("body")))


@query("""
WITH seen AS (
  SELECT o_custkey, min((list_position(['3-MEDIUM','1-URGENT','5-LOW','2-HIGH','4-NOT SPECIFIED'],
      o_orderpriority), o_orderkey)) AS first_row,
    bool_or(o_orderpriority = '1-URGENT') AS urgent,
    string_agg(DISTINCT CASE o_orderpriority WHEN '3-MEDIUM' THEN 'Medium Fifty'
      WHEN '1-URGENT' THEN 'Urgent' WHEN '5-LOW' THEN 'Low Cap' WHEN '2-HIGH' THEN 'High Cap'
      ELSE 'Rest' END, ', ') AS names
  FROM orders WHERE o_totalprice >= 2000 GROUP BY 1),
good AS (
  SELECT c.*, array_to_string(list_sort(string_split(names, ', ')), ', ') AS names,
    o.o_orderstatus, CASE WHEN o.o_orderpriority <> '5-LOW' THEN 'IN' || o.o_orderkey END AS isin
  FROM seen s JOIN customer c ON c_custkey = s.o_custkey
  JOIN orders o ON o.o_orderkey = s.first_row[2]
  WHERE (urgent OR o.o_orderstatus = 'F') AND c_acctbal >= 0 AND c_nationkey <> 6)
SELECT c_name AS "Company Name", CAST(c_custkey AS VARCHAR) AS "NSE Symbol",
  CASE WHEN c_nationkey <> 2 THEN CAST(c_custkey AS VARCHAR) END AS "BSE Symbol",
  CASE WHEN c_nationkey <> 2 THEN 'IN' || c_custkey ELSE isin END AS "ISIN",
  c_mktsegment AS "Sector", CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS "Industry",
  c_acctbal AS "Capitalisation (Rs Cr)", names AS "NSE Indices", 'http://x/' || c_custkey AS "Vendor URL"
FROM good""")
def full_run(d: Data) -> DataFrame:
    """A whole run from landed payloads to the company list."""
    tables = Tables(d.spark, scratch_path(d.spark, "run"), buckets=16)
    result = run_batch(
        tables, landed_tables(d), index_registry(d.spark, indices=INDICES), "r1", TS, TS,
        industries=["F"])
    return run_reports(tables, result)["Company List"]
