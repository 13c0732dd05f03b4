"""Staleness, resume, error accounting, integrity and run counters."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.bindings.catalog import Data, query
from equifacts.functions.text import parse_stamp, stamp_text
from equifacts.operators import quality
from equifacts.operators.refresh import finished, mark_stale, run_scope, unfinished
from equifacts.plans import runs
from equifacts.plans.reports import error_report
from equifacts.session import stage

RUN_TS = "2001-12-31 12:00:00"


@query(f"""
WITH newest AS (SELECT o_custkey, max(o_orderdate) AS stamp FROM orders GROUP BY 1),
aged AS (
  SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_nationkey <> 4
    THEN (epoch_us(TIMESTAMP '{RUN_TS}') - epoch_us(stamp)) / 86400e6 END AS age_days
  FROM customer LEFT JOIN newest ON o_custkey = c_custkey)
SELECT c_custkey, age_days, age_days IS NULL OR age_days >= 365 AS stale FROM aged""")
def stale_set(d: Data) -> DataFrame:
    """Stamps are texts; one nation's are unreadable and overdrawn customers lack the core."""
    newest = d.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("newest"))
    stored = newest.join(d.customer, "c_custkey").select(
        "c_custkey",
        F.when(F.col("c_nationkey") == 4, "not-a-date").otherwise(stamp_text(F.col("newest"))).alias("text"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("core"))
    stamped = stored.withColumn("stamp", parse_stamp(F.col("text")))
    return mark_stale(
        d.customer.select("c_custkey"), stamped, "c_custkey", "stamp", "core", RUN_TS, 365)


def ledger(d: Data) -> DataFrame:
    """A ledger row per order; pending orders have a version that is not read."""
    return d.orders.select(
        F.concat(F.lit("r"), F.year("o_orderdate")).alias("run_id"),
        F.col("o_custkey").alias("nse_symbol"),
        F.when(F.col("o_orderstatus") == "P", 2).otherwise(1).cast("long").alias("version"))


def symbols(d: Data) -> DataFrame:
    return d.customer.select(F.col("c_custkey").alias("nse_symbol"), "c_mktsegment")


@query("""
SELECT c_custkey AS nse_symbol, c_mktsegment FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998 AND o_orderstatus <> 'P')""")
def resume_set(d: Data) -> DataFrame:
    return unfinished(symbols(d), finished(ledger(d), "r1998"), "nse_symbol")


@query("""
SELECT o_custkey AS nse_symbol FROM orders WHERE year(o_orderdate) = 1998 AND o_orderstatus <> 'P'
UNION SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'""")
def run_scopes(d: Data) -> DataFrame:
    succeeded = symbols(d).where("c_mktsegment = 'BUILDING'")
    return run_scope(succeeded, finished(ledger(d), "r1998"), "nse_symbol")


def gated(d: Data) -> tuple[DataFrame, DataFrame]:
    """Good companies and errors. Overdrawn customers do not resolve; those without an open
    order have no price feed. The join is staged, since both results read it."""
    base = d.customer.select(
        F.col("c_custkey").alias("nse_symbol"), F.col("c_name").alias("company_name"),
        "c_nationkey", "c_mktsegment", "c_acctbal")
    resolved, unresolved = quality.split_errors(
        base, "nse_symbol", "resolve",
        F.when(F.col("c_acctbal") < 0, "No vendor match for symbol/ISIN"), RUN_TS, "company_name")
    counts = d.orders.groupBy(F.col("o_custkey").alias("nse_symbol")).agg(
        F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"))
    fed = stage(resolved.join(counts, "nse_symbol", "left"), "fed")
    good, unfed = quality.split_errors(
        fed, "nse_symbol", "pricefeed",
        F.when(F.coalesce("open_orders", F.lit(0)) == 0, "Empty price feed"), RUN_TS)
    return good, unresolved.unionByName(unfed)


GATED_SQL = """
open_orders AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O'),
good AS (
  SELECT * FROM customer
  WHERE c_acctbal >= 0 AND c_custkey IN (SELECT o_custkey FROM open_orders)),
errors AS (
  SELECT c_custkey AS nse_symbol, c_name AS company_name, 'resolve' AS stage,
    'No vendor match for symbol/ISIN' AS message FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT c_custkey, NULL, 'pricefeed', 'Empty price feed' FROM customer
  WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM open_orders))"""


@query(f"""WITH {GATED_SQL}
SELECT nse_symbol, company_name, stage, message, '{RUN_TS}' AS occurred_at FROM errors
UNION ALL SELECT c_custkey, c_name, 'good', NULL, NULL FROM good""")
def error_split(d: Data) -> DataFrame:
    """Every customer once: as an error of its first failing stage, or as good."""
    good, errors = gated(d)
    passed = good.select(
        "nse_symbol", "company_name", F.lit("good").alias("stage"),
        F.lit(None).cast("string").alias("message"), F.lit(None).cast("string").alias("occurred_at"))
    return errors.withColumn("occurred_at", stamp_text(F.col("occurred_at"))).unionByName(passed)


FIELDS = ["sector", "website", "company_name"]
MISSING_SQL = """
missing AS (
  SELECT c_custkey AS nse_symbol, concat_ws(', ',
    CASE WHEN c_nationkey < 10 THEN 'sector' END,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'website' END) AS fields
  FROM good WHERE c_nationkey < 10 OR c_mktsegment = 'BUILDING')"""


def missing(good: DataFrame) -> DataFrame:
    rows = good.withColumns({
        "sector": F.when(F.col("c_nationkey") >= 10, F.col("c_mktsegment")),
        "website": F.when(F.col("c_mktsegment") != "BUILDING", F.lit("w"))})
    return quality.missing_fields(rows, "nse_symbol", FIELDS)


@query(f"""WITH {GATED_SQL}, {MISSING_SQL}
SELECT nse_symbol, fields FROM missing""")
def missing_report(d: Data) -> DataFrame:
    good, _ = gated(d)
    return missing(good).withColumn("fields", F.array_join("fields", ", "))


@query("""
SELECT c_custkey, kind || '_results' AS field
FROM customer, (SELECT unnest(['quarterly', 'yearly']) AS kind)
WHERE (c_custkey, kind) NOT IN (
  SELECT (o_custkey, CASE o_orderstatus WHEN 'F' THEN 'quarterly' ELSE 'yearly' END)
  FROM orders WHERE o_orderstatus <> 'P')""")
def missing_feed_report(d: Data) -> DataFrame:
    rows = d.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return quality.missing_feeds(
        d.customer, rows, "c_custkey", "o_orderstatus",
        {"F": "quarterly_results", "O": "yearly_results"})


@query(f"""WITH {GATED_SQL}, {MISSING_SQL}
SELECT CAST(nse_symbol AS VARCHAR) AS "NSE Symbol", company_name AS "Company Name",
  stage AS "Stage", message AS "Error", '{RUN_TS}' AS "Occurred At" FROM errors
UNION ALL
SELECT CAST(nse_symbol AS VARCHAR), NULL, 'missing-fields', fields, NULL FROM missing""")
def errors_and_missing(d: Data) -> DataFrame:
    good, errors = gated(d)
    text = F.col("nse_symbol").cast("string")
    return error_report(
        errors.withColumn("nse_symbol", text), missing(good).withColumn("nse_symbol", text))


@query("""
SELECT 'lineitem key repeated' AS rule, count(*) AS violations FROM (
  SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'customer key repeated', count(*) FROM (
  SELECT c_custkey FROM customer GROUP BY c_custkey HAVING count(*) > 1)
UNION ALL SELECT 'order total missing', count(*) FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT 'order date missing', count(*) FROM orders WHERE o_orderdate IS NULL
UNION ALL SELECT 'order without customer', count(*) FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
UNION ALL SELECT 'line without order', count(*) FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def integrity_report(d: Data) -> DataFrame:
    """Key, NULL and parent rules; some rows are altered so that there is something to find."""
    orders = d.orders.withColumn(
        "o_totalprice", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")))
    customers = d.customer.where("c_mktsegment <> 'BUILDING'")
    return quality.union_all([
        quality.unique_rule(d.lineitem, ["l_orderkey", "l_linenumber"], "lineitem key repeated"),
        quality.unique_rule(d.customer, ["c_custkey"], "customer key repeated"),
        quality.not_null_rules(orders, {
            "o_totalprice": "order total missing", "o_orderdate": "order date missing"}),
        quality.reference_rule(
            d.orders, "o_custkey", customers, "c_custkey", "order without customer"),
        quality.reference_rule(
            d.lineitem, "l_orderkey", d.orders.where("o_orderstatus <> 'P'"), "o_orderkey",
            "line without order")])


@query(f"""WITH {GATED_SQL}, {MISSING_SQL},
counted AS (
  SELECT (SELECT count(DISTINCT o_orderpriority) FROM orders) AS indices,
    (SELECT count(DISTINCT o_custkey) FROM orders) AS seen,
    (SELECT count(*) FROM customer) AS universe, (SELECT count(*) FROM good) AS good,
    (SELECT count(*) FROM errors) AS errors, (SELECT count(*) FROM missing) AS missing,
    (SELECT count(*) FROM orders) AS requests,
    (SELECT count(*) FROM good WHERE c_mktsegment = 'BUILDING') AS stale)
SELECT unnest([
  {{'line': 1, 'Metric': 'Run started', 'Value': '2001-12-31 11:30:15'}},
  {{'line': 2, 'Metric': 'Run finished', 'Value': '2001-12-31 12:00:00'}},
  {{'line': 3, 'Metric': 'Duration (seconds)', 'Value': '1785.0'}},
  {{'line': 4, 'Metric': 'Indices fetched', 'Value': indices::VARCHAR}},
  {{'line': 5, 'Metric': 'Constituents seen (all sectors)', 'Value': seen::VARCHAR}},
  {{'line': 6, 'Metric': 'IT companies identified', 'Value': universe::VARCHAR}},
  {{'line': 7, 'Metric': 'Companies scraped successfully', 'Value': good::VARCHAR}},
  {{'line': 8, 'Metric': 'Static profiles refreshed', 'Value': stale::VARCHAR}},
  {{'line': 9, 'Metric': 'Static cache hits (skipped)', 'Value': (good - stale)::VARCHAR}},
  {{'line': 10, 'Metric': 'Companies failed', 'Value': errors::VARCHAR}},
  {{'line': 11, 'Metric': 'HTTP requests made', 'Value': requests::VARCHAR}},
  {{'line': 12, 'Metric': 'Errors recorded', 'Value': errors::VARCHAR}},
  {{'line': 13, 'Metric': 'Companies with missing fields', 'Value': missing::VARCHAR}}
], recursive := true) FROM counted""")
def run_summary(d: Data) -> DataFrame:
    good, errors = gated(d)
    stale = F.col("c_mktsegment") == "BUILDING"
    run = runs.run_counters([
        runs.counters(d.orders, requests_made=F.count(F.lit(1))),
        runs.rows_in(d.orders.select("o_orderpriority").distinct(), "indices_fetched"),
        runs.rows_in(d.orders.select("o_custkey").distinct(), "constituents_seen"),
        runs.rows_in(d.customer, "it_companies"),
        runs.counters(
            good, companies_scraped=F.count(F.lit(1)), static_refreshed=F.count_if(stale),
            static_cache_hits=F.count_if(~stale)),
        runs.counters(
            errors, companies_failed=F.count(F.lit(1)), errors_recorded=F.count(F.lit(1))),
        runs.rows_in(missing(good), "companies_missing_fields")])
    return runs.execution_summary(runs.with_times(run, "2001-12-31 11:30:15", RUN_TS))


@query("""
SELECT count(*) FILTER (WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) = 0
    AND count(*) > 0 AS failed,
  strftime(max(o_orderdate), 'r%Y-%m-%d') AS run_id
FROM orders""")
def run_verdict(d: Data) -> DataFrame:
    """Verdict over order outcomes, and the newest run id among equal start times."""
    joined = d.orders.join(
        d.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"), F.lit(1).alias("ok")),
        "o_custkey", "left")
    run = joined.agg(
        F.count("ok").alias("companies_scraped"),
        F.count_if(F.col("ok").isNull()).alias("companies_failed"))
    verdict = runs.with_times(run, RUN_TS, RUN_TS).select("failed", F.lit(1).alias("one"))
    stored = d.orders.select(
        F.lit(RUN_TS).cast("timestamp").alias("started_at"),
        F.date_format("o_orderdate", "'r'yyyy-MM-dd").alias("run_id"))
    newest = runs.latest_run(stored, RUN_TS).withColumn("one", F.lit(1))
    return verdict.unionByName(newest, allowMissingColumns=True).groupBy("one").agg(
        F.max("failed").alias("failed"), F.max("run_id").alias("run_id")).drop("one")
