"""Files in and out, run records, the order of reports, shortened facets, whole feeds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.bindings.catalog import Data, query
from equifacts.bindings.pages import PARTS_SQL, SPACES, TOPICS, _topic_sql
from equifacts.bindings.reports import (
    MONTHS_SQL, NAMES_SQL, TS, VIEW_SQL, companies, holdings, landed_tables, memberships, scope, typed_periods, view)
from equifacts.bindings.runs import GATED_SQL, gated
from equifacts.bindings.universe import INDICES, RANK_SQL
from equifacts.functions.sentences import with_topics
from equifacts.operators.merge import merge_by_key
from equifacts.operators.position import numbered
from equifacts.operators.quality import union_all
from equifacts.plans import reports
from equifacts.plans.company_batch import UNACCOUNTED, run_batch, unaccounted
from equifacts.session import scratch_path, stage
from equifacts.sources.commits import listed_files
from equifacts.sources.constituents import read_constituents
from equifacts.sources.feeds import price_rows, result_rows
from equifacts.sources.registry import REGISTRY, index_registry
from equifacts.sources.tables import Tables, write_reports


@query(f"""
WITH seen AS (
  SELECT CAST(o_custkey AS VARCHAR) AS nse_symbol, o_orderpriority AS index_key, {RANK_SQL} AS rank
  FROM orders WHERE o_totalprice >= 2000)
SELECT nse_symbol, string_agg(index_key, ',' ORDER BY rank) AS index_keys
FROM (SELECT DISTINCT * FROM seen) GROUP BY nse_symbol""")
def constituent_files(d: Data) -> DataFrame:
    """Orders written as the constituent files of their priority, and read back as landed ones."""
    folder = scratch_path(d.spark, "constituents")
    files = []
    for rank, (key, name, _, whole) in enumerate(INDICES):
        rows = d.orders.where(F.col("o_orderpriority") == key).select(
            F.when(F.col("o_totalprice") < 2000, "--").otherwise(
                F.concat(F.lit("Order &amp; \""), "o_orderkey", F.lit("\", Ltd"))).alias("Company Name"),
            F.col("o_orderstatus").alias("Industry"), F.col("o_custkey").alias("Symbol"), F.lit("EQ").alias("Series"),
            F.concat(F.lit("IN"), "o_orderkey").alias("ISIN Code"))
        rows.write.option("header", True).option("escape", '"').csv(f"{folder}/{rank}")
        files += [(key, name, f, whole, rank) for f in listed_files(d.spark, f"{folder}/{rank}") if f.endswith(".csv")]
    landed = read_constituents(
        d.spark, [f"{folder}/{rank}" for rank in range(len(INDICES))], d.spark.createDataFrame(files, REGISTRY))
    merged = merge_by_key(landed, "nse_symbol", ["nse_symbol"], "index_key", ["index_rank"])
    return merged.select(landed.nse_symbol, F.array_join("index_keys", ",").alias("index_keys"))


@query(f"""WITH {VIEW_SQL}, {NAMES_SQL}, {MONTHS_SQL}
SELECT 'company_list' AS report, CAST(k AS VARCHAR) AS nse_symbol, name AS company_name, coalesce(names, '') AS detail
FROM firms LEFT JOIN listed USING (k)
UNION ALL SELECT 'quarterly_results', CAST(k AS VARCHAR), name, label FROM firms JOIN months USING (k) WHERE n <= 3
UNION ALL SELECT DISTINCT 'shareholding', CAST(k AS VARCHAR), name, o_orderpriority
FROM firms JOIN orders ON o_custkey = k""")
def report_files(d: Data) -> DataFrame:
    """Three reports of a run, written by report and run and read back."""
    sheets = {
        "Company List": reports.company_list(
            view(d), reports.in_scope(memberships(d), scope(d), "nse_symbol")),
        "Quarterly Results": reports.period_report(reports.quarterly_rows(typed_periods(d), companies(d), scope(d))),
        "Shareholding": reports.printed(reports.holding_rows(holdings(d), companies(d), scope(d)), reports.HOLDINGS)}
    detail = {"Company List": "NSE Indices", "Quarterly Results": "Period", "Shareholding": "Category"}
    folder = scratch_path(d.spark, "reports")
    write_reports(sheets, folder, "r1")
    back = []
    for sheet, column in detail.items():
        slug = sheet.lower().replace(" ", "_")
        rows = d.spark.read.parquet(f"{folder}/report={slug}/run_id=r1")
        back.append(rows.select(
            F.lit(slug).alias("report"), F.col("NSE Symbol").cast("string").alias("nse_symbol"),
            F.col("Company Name").alias("company_name"), F.col(column).alias("detail")))
    return union_all(back)


@query("""
WITH seen AS (
  SELECT o_custkey, min((list_position(['3-MEDIUM','1-URGENT','5-LOW','2-HIGH','4-NOT SPECIFIED'],
      o_orderpriority), o_orderkey)) AS first_row, bool_or(o_orderpriority = '1-URGENT') AS urgent
  FROM orders WHERE o_totalprice >= 2000 GROUP BY 1),
universe AS (
  SELECT c_custkey, c_acctbal >= 0 AS resolved, c_acctbal >= 0 AND c_nationkey <> 6 AS good
  FROM seen s JOIN customer c ON c_custkey = s.o_custkey JOIN orders o ON o.o_orderkey = s.first_row[2]
  WHERE urgent OR o.o_orderstatus = 'F')
SELECT 'error' AS record, CAST(c_custkey AS VARCHAR) AS nse_symbol, 'resolve' AS stage,
  'No vendor match for symbol/ISIN' AS note FROM universe WHERE NOT resolved
UNION ALL SELECT 'error', CAST(c_custkey AS VARCHAR), 'pricefeed', 'HTTP 503' FROM universe WHERE resolved AND NOT good
UNION ALL SELECT 'error', CAST(c_custkey AS VARCHAR), 'quarterly', 'No response landed' FROM universe WHERE good
UNION ALL SELECT 'ledger', CAST(c_custkey AS VARCHAR), NULL, '1' FROM universe WHERE good
UNION ALL SELECT 'run', NULL, 'completed', count(*) FILTER (good) || ' of ' || count(*) FROM universe""")
def run_records(d: Data) -> DataFrame:
    """What a whole run leaves in its record tables: errors, ledger and the run itself."""
    tables = Tables(d.spark, scratch_path(d.spark, "records"), buckets=16)
    run_batch(tables, landed_tables(d), index_registry(d.spark, indices=INDICES), "r1", TS, TS, industries=["F"])
    none = F.lit(None).cast("string")
    return union_all([
        tables.read("scrape_errors").select(
            F.lit("error").alias("record"), "nse_symbol", "stage", F.col("message").alias("note")),
        tables.read("ledger").select(
            F.lit("ledger").alias("record"), "nse_symbol", none.alias("stage"), F.col("version").cast("string").alias("note")),
        tables.read("scrape_runs").select(
            F.lit("run").alias("record"), none.alias("nse_symbol"), F.col("notes").alias("stage"),
            F.concat("companies_scraped", F.lit(" of "), "it_companies").alias("note"))])


@query(f"""WITH {VIEW_SQL}, {MONTHS_SQL}, {GATED_SQL},
held AS (
  SELECT name, k, o_orderpriority, min(o_orderkey) AS pos FROM firms JOIN orders ON o_custkey = k GROUP BY ALL)
SELECT 'companies' AS report, row_number() OVER (ORDER BY name NULLS FIRST, k) AS position,
  CAST(k AS VARCHAR) AS nse_symbol, NULL AS detail FROM firms
UNION ALL SELECT 'quarters', row_number() OVER (ORDER BY coalesce(nullif(name, ''), CAST(k AS VARCHAR)), k, n),
  CAST(k AS VARCHAR), label FROM firms JOIN months USING (k) WHERE n <= 3
UNION ALL SELECT 'holdings', row_number() OVER (ORDER BY name NULLS FIRST, k, pos), CAST(k AS VARCHAR), o_orderpriority
FROM held
UNION ALL SELECT 'errors', row_number() OVER (ORDER BY CAST(nse_symbol AS VARCHAR), stage), CAST(nse_symbol AS VARCHAR), stage
FROM errors""")
def report_order(d: Data) -> DataFrame:
    """Where each row stands in four sorted reports."""
    good, errors = gated(d)
    none = errors.limit(0).select("nse_symbol", F.array().cast("array<string>").alias("fields"))
    text = F.col("nse_symbol").cast("string")
    sorted_rows = {
        "companies": (reports.company_profile(view(d)), "NSE Symbol", None),
        "quarters": (reports.period_report(
            reports.quarterly_rows(typed_periods(d), companies(d), scope(d))), "NSE Symbol", "Period"),
        "holdings": (reports.printed(
            reports.holding_rows(holdings(d), companies(d), scope(d)), reports.HOLDINGS), "NSE Symbol", "Category"),
        "errors": (reports.error_report(
            errors.withColumn("nse_symbol", text), none.withColumn("nse_symbol", text)), "NSE Symbol", "Stage")}
    return union_all([
        numbered(rows).select(
            F.lit(name).alias("report"), "position", F.col(key).cast("string").alias("nse_symbol"),
            (F.col(detail) if detail else F.lit(None).cast("string")).alias("detail"))
        for name, (rows, key, detail) in sorted_rows.items()])


SHOWN = 60


@query(rf"""
WITH {PARTS_SQL}, topics AS (
  SELECT doc_id, {_topic_sql(TOPICS["rare"])} AS rare FROM split)
SELECT source AS "Company Name", CAST(doc_id AS VARCHAR) AS "NSE Symbol",
  CASE WHEN length(rare) > {SHOWN} THEN regexp_replace(left(rare, {SHOWN - 3}), '{SPACES}+$', '') || '...' ELSE rare END
    AS "Facet"
FROM topics JOIN documents USING (doc_id) WHERE rare IS NOT NULL""")
def facet_short(d: Data) -> DataFrame:
    """The facet report with texts cut to a length."""
    named = d.documents.select(
        F.col("source").alias("company_name"), F.col("doc_id").cast("string").alias("nse_symbol"), "text")
    found = stage(with_topics(named, "text", {"rare": TOPICS["rare"]}).drop("text"), "facet")
    return reports.facet_report(found, "rare", "Facet", SHOWN)


@query(f"""
WITH fed AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'),
failed AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT CAST(c_custkey AS VARCHAR) AS nse_symbol, c_name AS company_name, 'unexpected' AS stage, '{UNACCOUNTED}' AS message
FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM fed) AND c_custkey NOT IN (SELECT o_custkey FROM failed)""")
def unaccounted_companies(d: Data) -> DataFrame:
    """Customers that neither finished nor failed for a known reason."""
    def keys(rows):
        return rows.select(F.col("o_custkey").cast("string").alias("nse_symbol")).distinct()

    todo = d.customer.select(F.col("c_custkey").cast("string").alias("nse_symbol"), F.col("c_name").alias("company_name"))
    rows = unaccounted(
        todo, keys(d.orders.where("o_orderstatus = 'F'")), keys(d.orders.where("o_orderpriority = '1-URGENT'")), TS)
    return rows.drop("occurred_at")


PRICES = {
    "capitalisation_cr": ("MKTCAP", "p_retailprice"), "price": ("pricecurrent", "p_partkey + 1"),
    "pe": ("PE", "p_partkey + 2"), "pb": ("PB", "p_partkey + 3"), "industry_pe": ("IND_PE", "p_partkey + 4"),
    "dividend_yield": ("DY", "p_partkey + 5"), "book_value": ("BV", "p_partkey + 6"), "eps_ttm": ("SC_TTM", "p_partkey + 7"),
    "face_value": ("FV", "p_size"), "week52_high": ("52H", "p_partkey + 9"), "week52_low": ("52L", "p_partkey + 10"),
    "shares_outstanding": ("SHRS", "p_partkey * 1000"),
}
GAP = "p_size % 12"


@query("SELECT p_partkey, " + ", ".join(
    f"CASE WHEN {GAP} <> {n} THEN CAST({value} AS DOUBLE) END AS {name}" for n, (name, (_, value)) in enumerate(PRICES.items())
) + """, p_brand AS feed_sector, CASE WHEN p_size > 25 THEN p_type ELSE lower(p_type) END AS feed_industry,
  CASE WHEN p_size > 25 THEN p_name ELSE p_brand END AS feed_name, CAST(p_partkey AS VARCHAR) AS feed_bse_symbol,
  'IN' || p_partkey AS feed_isin
FROM part""")
def feed_price_columns(d: Data) -> DataFrame:
    """All price columns and attributes of a feed; each feed lacks one price."""
    data = [F.expr(f"CASE WHEN {GAP} <> {n} THEN CAST({value} AS STRING) END").alias(key)
            for n, (key, value) in enumerate(PRICES.values())]
    more = {
        "main_sector": F.col("p_brand"), "newSubsector": F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(""),
        "SC_SUBSEC": F.lower("p_type"), "SC_FULLNM": F.when(F.col("p_size") > 25, F.col("p_name")).otherwise("--"),
        "company": F.col("p_brand"), "BSEID": F.col("p_partkey"), "isinid": F.concat(F.lit("IN"), "p_partkey")}
    body = F.to_json(F.struct(F.struct(*data, *[c.alias(k) for k, c in more.items()]).alias("data")))
    rows = price_rows(d.part.select("p_partkey", body.alias("body")), ["p_partkey"])
    return rows.drop("feed_state")


@query("""
SELECT o_orderkey, 0 AS pos, strftime(o_orderdate, '%b ''%y') AS period_label,
  CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN o_custkey END AS revenue, CAST(o_custkey + 1 AS DOUBLE) AS other_income,
  CAST(CASE WHEN o_orderstatus = 'P' THEN o_custkey + 2 ELSE o_custkey END AS DOUBLE) AS total_income,
  CAST(o_custkey + 3 AS DOUBLE) AS expenditure, CAST(o_custkey + 4 AS DOUBLE) AS interest, CAST(o_custkey + 5 AS DOUBLE) AS tax,
  CAST(CASE WHEN o_orderstatus = 'O' THEN -o_custkey ELSE o_custkey + 6 END AS DOUBLE) AS net_profit,
  CAST(o_orderkey AS DOUBLE) / 4 AS basic_eps
FROM orders""")
def feed_period_columns(d: Data) -> DataFrame:
    """All measures of a results feed, of which some stand under their second key; a feed an order."""
    key, status = F.col("o_custkey"), F.col("o_orderstatus")
    entry = F.struct(
        F.date_format("o_orderdate", "MMM ''yy").alias("yrc0"),
        F.when(status == "F", F.format_number("o_totalprice", 2)).otherwise("--").alias("Net Sales/Income from operations"),
        (key + 1).alias("Other Income"),
        F.when(status == "P", F.lit("-")).otherwise(key.cast("string")).alias("Total Income From Operations"),
        (key + 2).alias("Total Income"), (key + 3).alias("Total Expenditure"), (key + 4).alias("Interest"),
        (key + 5).alias("Tax"), F.when(status == "O", -key).alias("Net Profit/(Loss) For the Period"),
        (key + 6).alias("P/L After Tax from Ordinary Activities"), (F.col("o_orderkey") / 4).alias("Basic EPS"))
    body = F.to_json(F.struct(F.array(entry).alias("data")))
    return result_rows(d.orders.select("o_orderkey", body.alias("body")), ["o_orderkey"]).withColumn(
        "pos", F.col("pos").cast("int"))
