"""Cleaning, feed decoding and entity resolution on payloads derived from the tables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equifacts.bindings.catalog import Data, query
from equifacts.functions import payload
from equifacts.functions.text import clean_text, first_number, parse_number
from equifacts.operators.refresh import mark_stale, unfinished
from equifacts.operators.resolve import resolve
from equifacts.sources.feeds import price_rows, result_rows, suggest_entries
from equifacts.sources.requests import request_manifest, templates

NBSP = " "


@query(r"""
SELECT c_custkey, CASE
    WHEN c_nationkey IN (0, 1, 2) THEN NULL
    WHEN c_nationkey = 3 THEN 'n.a.'
    ELSE c_name || ' & "' || c_mktsegment || '" <b> Ltd' END AS cleaned
FROM customer""")
def clean_names(d: Data) -> DataFrame:
    """Names with entities, runs of white space, and placeholders."""
    noisy = F.concat(
        F.lit(" \t"), F.col("c_name"), F.lit(f"&nbsp;{NBSP} &amp;\n&quot;"),
        F.col("c_mktsegment"), F.lit("&quot;\x1c&lt;b&#62;  Ltd "))
    text = (
        F.when(F.col("c_nationkey") == 0, " -- ").when(F.col("c_nationkey") == 1, "&nbsp;")
        .when(F.col("c_nationkey") == 2, "N.A.").when(F.col("c_nationkey") == 3, "n.a.")
        .otherwise(noisy))
    return d.customer.select("c_custkey", clean_text(text).alias("cleaned"))


@query("""
SELECT o_orderkey,
  CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL ELSE o_totalprice END AS parsed,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(o_custkey AS DOUBLE)
       ELSE o_totalprice END AS first_parsed
FROM orders""")
def parse_numbers(d: Data) -> DataFrame:
    """Amounts in the spellings of a scraped page; one priority holds junk."""
    amount = F.format_number("o_totalprice", 2)
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("Rs. "), amount, F.lit(" Cr")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("₹"), amount, F.lit("%")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("&#8377; "), amount))
        .when(F.col("o_orderpriority") == "5-LOW", amount)
        .otherwise(F.concat(amount, F.lit("d"))))
    noisy = d.orders.select("o_orderkey", text.alias("text"), F.col("o_custkey").cast("string").alias("other"))
    return noisy.select(
        "o_orderkey", parse_number(F.col("text")).alias("parsed"),
        first_number(F.col("text"), F.col("other")).alias("first_parsed"))


def json_object(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def price_bodies(d: Data) -> DataFrame:
    """A price feed per part, with numbers, numeric texts, gaps and fallback keys."""
    size = F.col("p_size")
    data = F.struct(
        F.col("p_retailprice").alias("MKTCAP"),
        F.format_number("p_retailprice", 2).alias("pricecurrent"),
        F.when(size > 10, size).alias("PE"),
        F.when(size > 40, F.lit("--")).otherwise(size.cast("string")).alias("52H"),
        (size > 25).alias("FV"),
        F.col("p_brand").alias("main_sector"),
        F.when(size <= 20, F.col("p_type")).alias("newSubsector"),
        F.lower("p_type").alias("SC_SUBSEC"),
        F.lit("").alias("SC_FULLNM"),
        F.concat(F.col("p_name"), F.lit(" &amp; Co")).alias("company"),
        F.col("p_partkey").alias("BSEID"))
    body = (
        F.when(size == 50, F.lit("<html>busy</html>")).when(size == 49, F.lit("[]"))
        .when(size == 48, F.lit('{"data": []}')).when(size == 47, F.lit('{"data": {}}'))
        .otherwise(F.to_json(F.struct(data.alias("data")))))
    return d.part.select("p_partkey", body.alias("body"))


@query("""
SELECT p_partkey, p_size >= 47 AS failed,
  CASE WHEN p_size >= 49 THEN 'invalid' WHEN p_size >= 47 THEN 'empty' ELSE 'ok' END AS feed_state,
  CASE WHEN p_size < 47 THEN p_retailprice END AS capitalisation_cr,
  CASE WHEN p_size < 47 THEN p_retailprice END AS price,
  CASE WHEN p_size < 47 AND p_size > 10 THEN CAST(p_size AS DOUBLE) END AS pe,
  CASE WHEN p_size <= 40 THEN CAST(p_size AS DOUBLE) END AS week52_high,
  CASE WHEN p_size < 47 THEN CASE WHEN p_size > 25 THEN 1.0 ELSE 0.0 END END::DOUBLE AS face_value,
  CASE WHEN p_size < 47 THEN p_brand END AS feed_sector,
  CASE WHEN p_size < 47 THEN
    CASE WHEN p_size <= 20 THEN p_type ELSE lower(p_type) END END AS feed_industry,
  CASE WHEN p_size < 47 THEN p_name || ' & Co' END AS feed_name,
  CASE WHEN p_size < 47 THEN CAST(p_partkey AS VARCHAR) END AS feed_bse_symbol
FROM part""")
def feed_to_prices(d: Data) -> DataFrame:
    rows = price_rows(price_bodies(d), ["p_partkey"])
    return rows.select(
        "p_partkey", (F.col("feed_state") != "ok").alias("failed"), "feed_state",
        "capitalisation_cr", "price", "pe", "week52_high", "face_value", "feed_sector",
        "feed_industry", "feed_name", "feed_bse_symbol")


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events""")
def event_numbers(d: Data) -> DataFrame:
    """One number out of the JSON text of every event."""
    parsed = d.events.select("event_id", payload.parse(F.col("props")).alias("_v"))
    return parsed.select("event_id", payload.number(F.col("_v"), "$.k").alias("k"))


def result_bodies(d: Data) -> DataFrame:
    """A results feed per customer: its orders, the newest first."""
    newest = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey")
    ranked = d.orders.withColumn("n", F.row_number().over(newest))
    amount = F.format_number("o_totalprice", 2)
    row = F.to_json(F.struct(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("yrc0"),
        F.when(F.col("o_orderstatus") == "F", amount).otherwise(F.lit("--"))
        .alias("Net Sales/Income from operations"),
        F.when(F.col("o_orderstatus") == "O", amount).alias("Total Income From Operations"),
        F.col("o_custkey").alias("Tax"),
        F.col("o_totalprice").alias("Interest")))
    entry = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("17")).otherwise(row)
    feeds = ranked.select("o_custkey", "n", entry.alias("entry")).groupBy("o_custkey").agg(
        F.sort_array(F.collect_list(F.struct("n", "entry"))).alias("entries"))
    return feeds.select(
        "o_custkey",
        F.concat(F.lit('{"data":['), F.array_join("entries.entry", ","), F.lit("]}")).alias("body"))


@query("""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n
  FROM orders)
SELECT o_custkey, CAST(n - 1 AS INTEGER) AS pos, CAST(o_orderkey AS VARCHAR) AS period_label,
  o_totalprice AS revenue,
  CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS total_income,
  CAST(o_custkey AS DOUBLE) AS tax, o_totalprice AS interest
FROM ranked
WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') AND o_orderstatus <> 'P'""")
def feed_to_periods(d: Data) -> DataFrame:
    return result_rows(result_bodies(d), ["o_custkey"]).select(
        "o_custkey", "pos", "period_label", "revenue", "total_income", "tax", "interest")


def asked_suppliers(d: Data) -> DataFrame:
    """Suppliers as companies; some have no ISIN."""
    key = F.col("s_suppkey")
    return d.supplier.select(
        F.col("s_name").alias("nse_symbol"), key.alias("s_suppkey"),
        F.when(F.col("s_acctbal") < 0, "").otherwise(
            F.concat(F.lit("IN"), key * 15 + F.col("s_nationkey") % 16, F.lit("X"))).alias("isin"))


def suggest_bodies(d: Data) -> DataFrame:
    """A search answer per supplier: fifteen customers with neighbouring keys."""
    offered = asked_suppliers(d).select(
        "nse_symbol", "s_suppkey", F.posexplode(F.sequence(F.lit(0), F.lit(14))).alias("pos", "step")
    ).withColumn("c_custkey", F.col("s_suppkey") * 15 + F.col("step"))
    both = offered.join(d.customer, "c_custkey")
    token = F.when(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD"), F.col("nse_symbol")).otherwise("OTHER")
    display = F.concat(
        F.col("c_name"), F.lit("&nbsp;<span>IN"), F.col("c_custkey"), F.lit("X, "), token, F.lit(", 5</span>"))
    entry = json_object(
        sc_id=F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("S"), "c_custkey")),
        link_src=F.concat(F.lit("http://x/"), "c_custkey"),
        name=F.col("c_name"), sc_sector=F.col("c_mktsegment"), pdt_dis_nm=display)
    # Fifteen entries per supplier at most, by construction.
    feeds = both.groupBy("nse_symbol").agg(
        F.sort_array(F.collect_list(F.struct("pos", entry.alias("entry")))).alias("entries"))
    return feeds.select(
        "nse_symbol", F.concat(F.lit("["), F.array_join("entries.entry", ","), F.lit("]")).alias("body"))


@query("""
WITH asked AS (
  SELECT s_name, s_suppkey, CASE WHEN s_acctbal < 0 THEN '' ELSE
    'IN' || (s_suppkey * 15 + s_nationkey % 16) || 'X' END AS isin FROM supplier),
offered AS (
  SELECT a.s_name, a.isin, i.step, c.*, 'IN' || c_custkey || 'X' AS own_isin
  FROM asked a, (SELECT unnest(range(15)) AS step) i, customer c
  WHERE c.c_custkey = a.s_suppkey * 15 + i.step),
hits AS (
  SELECT *, CASE WHEN isin <> '' AND own_isin = isin THEN 1
    WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AND c_acctbal >= 0 THEN 2 END AS tier
  FROM offered)
SELECT s_name AS nse_symbol, 'S' || c_custkey AS mc_sc_id, 'http://x/' || c_custkey AS mc_url,
       c_name AS identity_name, c_mktsegment AS identity_sector
FROM (SELECT * FROM hits WHERE tier IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY s_name ORDER BY tier, step) = 1)
WHERE c_acctbal >= 0""")
def resolve_identity(d: Data) -> DataFrame:
    entries = suggest_entries(suggest_bodies(d), ["nse_symbol"])
    return resolve(asked_suppliers(d), entries)


# Neutral hosts; an outside crawler names the real ones.
HOSTS = ("https://suggest", "https://price", "https://results")


@query("""
WITH newest AS (
  SELECT o_custkey, max(o_orderdate) AS newest_at
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
done AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
todo AS (
  SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN 'SC ' || c_custkey END AS sc,
    newest_at IS NULL OR date_diff('day', newest_at, TIMESTAMP '2001-06-01') >= 30 AS stale
  FROM customer LEFT JOIN newest ON c_custkey = o_custkey
  WHERE c_custkey NOT IN (SELECT o_custkey FROM done)),
enc AS (SELECT *, replace(url_encode(c_name), '+', '%20') AS q, replace(sc, ' ', '%20') AS i FROM todo)
SELECT c_custkey, 'resolve' AS stage,
  'https://suggest/mccode/common/autosuggestion_solr.php?classic=true&query=' || q
  || '&type=1&format=json' AS url FROM enc
UNION ALL SELECT c_custkey, 'pricefeed', 'https://price/pricefeed/nse/equitycash/' || i
  FROM enc WHERE sc IS NOT NULL
UNION ALL SELECT c_custkey, kind, 'https://results/jsonapi/stocks/' || kind
  || '_results_responsive?sc_id=' || i || '&type_format=' || kind || '&start=0&limit=8'
  FROM enc, (SELECT unnest(['quarterly', 'yearly']) AS kind) WHERE sc IS NOT NULL
UNION ALL SELECT c_custkey, 'profile', 'http://x/' || c_custkey FROM enc WHERE stale""")
def request_list(d: Data) -> DataFrame:
    """What a crawler has to fetch for the unfinished customers."""
    stored = d.orders.where("o_orderstatus <> 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").cast("timestamp").alias("at")).withColumn("core", F.lit("x"))
    done = d.orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("c_custkey"))
    todo = mark_stale(
        unfinished(d.customer, done, "c_custkey"), stored, "c_custkey", "at", "core",
        "2001-06-01 00:00:00")
    asked = todo.select(
        "c_custkey", "c_name", "stale",
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("SC "), "c_custkey")).alias("sc"),
        F.concat(F.lit("http://x/"), "c_custkey").alias("link"))
    ids = {"resolve": "c_name", "pricefeed": "sc", "quarterly": "sc", "yearly": "sc"}
    return request_manifest(asked, "c_custkey", ids, templates(*HOSTS), "link", "stale")
