"""Merging, membership and sector selection: an order priority plays the index, a customer
the company, an order one constituent row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.bindings.catalog import Data, query
from equifacts.bindings.periods import companies
from equifacts.functions.text import in_list
from equifacts.operators.filters import (
    in_vendor_sector,
    only_symbols,
    requested_symbols,
)
from equifacts.operators.merge import explode_members
from equifacts.operators.quality import unknown_keys
from equifacts.plans.reports import with_indices
from equifacts.plans.universe import discover, listing, merged_constituents
from equifacts.sources.constituents import clean_constituents
from equifacts.sources.registry import index_registry

INDICES = [
    ("3-MEDIUM", "Medium Fifty", "medium.csv", False),
    ("1-URGENT", "Urgent", "urgent.csv", True),
    ("5-LOW", "Low Cap", "low.csv", False),
    ("2-HIGH", "High Cap", "high.csv", False),
    ("4-NOT SPECIFIED", "Rest", "rest.csv", False),
]

RANK_SQL = "list_position(['3-MEDIUM','1-URGENT','5-LOW','2-HIGH','4-NOT SPECIFIED'], o_orderpriority)"
MERGED_SQL = f"""
seen AS (
  SELECT CAST(o_custkey AS VARCHAR) AS nse_symbol, 'Order & ' || o_orderkey AS company_name,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS nse_industry,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'IN' || o_orderkey END AS isin,
         o_orderpriority AS index_key, {RANK_SQL} AS rank, o_orderkey
  FROM orders WHERE o_totalprice >= 2000),
firsts AS (
  SELECT * FROM seen
  QUALIFY row_number() OVER (PARTITION BY nse_symbol ORDER BY rank, o_orderkey) = 1),
members AS (
  SELECT nse_symbol, string_agg(index_key, ',' ORDER BY rank) AS index_keys
  FROM (SELECT DISTINCT nse_symbol, index_key, rank FROM seen) GROUP BY nse_symbol),
merged AS (
  SELECT f.nse_symbol, f.company_name, f.nse_industry, f.isin, m.index_keys
  FROM firsts f JOIN members m USING (nse_symbol))"""


def registry(d: Data, selected: list[str] | None = None) -> DataFrame:
    return index_registry(d.spark, selected, INDICES)


def constituents(d: Data) -> DataFrame:
    rows = d.orders.select(
        F.col("o_custkey").cast("string").alias("Symbol"),
        F.when(F.col("o_totalprice") < 2000, "--").otherwise(
            F.concat(F.lit("  Order &amp;  "), F.col("o_orderkey"))).alias("Company Name"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("Industry"),
        F.when(F.col("o_orderpriority") != "5-LOW",
               F.concat(F.lit("IN"), F.col("o_orderkey"))).alias("ISIN Code"),
        F.col("o_orderpriority").alias("index_key"),
        F.lit(0).cast("long").alias("block_start"), F.col("o_orderkey").alias("row_pos"))
    ranked = rows.join(registry(d).select("index_key", "index_rank"), "index_key")
    return clean_constituents(ranked)


@query(f"WITH {MERGED_SQL} SELECT * FROM merged")
def merge_by_key(d: Data) -> DataFrame:
    merged = merged_constituents(constituents(d))
    return merged.withColumn("index_keys", F.array_join("index_keys", ","))


@query("""
WITH names AS (
  SELECT DISTINCT o_custkey, CASE o_orderpriority WHEN '3-MEDIUM' THEN 'Medium Fifty'
    WHEN '1-URGENT' THEN 'Urgent' WHEN '5-LOW' THEN 'Low Cap' ELSE 'High Cap' END AS index_name
  FROM orders WHERE o_totalprice >= 2000 AND o_orderpriority <> '4-NOT SPECIFIED'),
listed AS (
  SELECT o_custkey, string_agg(index_name, ', ' ORDER BY index_name) AS indices
  FROM names GROUP BY o_custkey)
SELECT CAST(c_custkey AS VARCHAR) AS nse_symbol, c_name AS company_name,
       coalesce(indices, '') AS indices
FROM customer LEFT JOIN listed ON c_custkey = o_custkey""")
def membership_list(d: Data) -> DataFrame:
    """The registry leaves one priority out, so its members are dropped."""
    known = registry(d, ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"])
    bridge = explode_members(merged_constituents(constituents(d)), "nse_symbol", known)
    named = companies(d).withColumn("nse_symbol", F.col("nse_symbol").cast("string"))
    return with_indices(named, bridge)


@query(f"""WITH {MERGED_SQL}
SELECT nse_symbol, company_name, nse_industry, index_keys FROM merged
WHERE nse_industry = 'F' OR list_contains(string_split(index_keys, ','), '1-URGENT')""")
def sector_universe(d: Data) -> DataFrame:
    return discover(constituents(d), ["1-URGENT"], ["f"]).select(
        "nse_symbol", "company_name", "nse_industry",
        F.array_join("index_keys", ",").alias("index_keys"))


@query(f"""WITH {MERGED_SQL}
SELECT nse_symbol, company_name, replace(index_keys, ',', ', ') AS index_keys FROM merged
WHERE nse_industry = 'F' OR list_contains(string_split(index_keys, ','), '1-URGENT')
ORDER BY nse_symbol LIMIT 100""")
def dry_run_listing(d: Data) -> DataFrame:
    """The listing of a run limited to its first companies."""
    return listing(discover(constituents(d), ["1-URGENT"], ["F"], limit=100))


@query("""
SELECT c_custkey, c_mktsegment, c_nationkey IN (3, 5) AS listed FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_mktsegment <> 'MACHINERY'
   OR c_mktsegment = 'MACHINERY' AND c_acctbal >= 0""")
def requested_companies(d: Data) -> DataFrame:
    """Companies of the requested segments, then those of the vendor sector."""
    request = d.spark.createDataFrame([(" building, machinery,",)], "asked string")
    wanted = only_symbols(
        d.customer, "c_mktsegment", requested_symbols(request, "asked", "c_mktsegment"))
    spelled = wanted.withColumn(
        "sector", F.when((F.col("c_mktsegment") == "BUILDING") | (F.col("c_acctbal") >= 0),
                         F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))))
    kept = in_vendor_sector(spelled, "sector", ["Building", "Machinery"])
    return kept.select(
        "c_custkey", "c_mktsegment",
        in_list(F.col("c_nationkey").cast("string"), ["3", "5"]).alias("listed"))


@query("""
SELECT DISTINCT o_orderpriority AS index_key FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""")
def unknown_indices(d: Data) -> DataFrame:
    """Index keys that rows ask for and the registry does not know."""
    asked = d.orders.select(F.col("o_orderpriority").alias("index_key"))
    return unknown_keys(asked, registry(d, ["1-URGENT", "2-HIGH"]), "index_key")
