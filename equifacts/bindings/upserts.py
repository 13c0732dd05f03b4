"""Upserts, replacements and coalescing on altered copies of the tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.bindings.catalog import Data, query
from equifacts.functions.text import stamp_text
from equifacts.operators.coalesce import by_precedence, join_sources
from equifacts.operators.merge import fold_rows
from equifacts.operators.replace import replace_given, replace_processed, without_keys
from equifacts.operators.upsert import (
    change_log,
    rows_of,
    rows_written,
    touch,
    upsert,
    with_stubs,
)

RUN_TS = "2026-07-04 10:30:00"
STORED_TS = "2026-01-01 00:00:00"
FIELDS = ["company_name", "sector", "balance"]


def stored_companies(d: Data) -> DataFrame:
    """Customers as stored companies; overdrawn ones have no sector yet."""
    return d.customer.select(
        F.col("c_custkey").alias("nse_symbol"), F.col("c_name").alias("company_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("sector"),
        F.col("c_acctbal").alias("balance"), F.lit(STORED_TS).cast("timestamp").alias("updated_at"))


def incoming_companies(d: Data) -> DataFrame:
    """Altered copies of all customers but one segment, and suppliers as new companies."""
    nation = F.col("c_nationkey")
    altered = d.customer.where(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("nse_symbol"),
        F.when(nation == 3, F.concat("c_name", F.lit(" Ltd"))).otherwise(F.col("c_name")).alias("company_name"),
        F.when(nation != 5, F.col("c_mktsegment")).alias("sector"),
        F.when(nation == 7, F.col("c_acctbal") + 1).when(nation != 9, F.col("c_acctbal")).alias("balance"))
    new = d.supplier.select(
        (-1 - F.col("s_suppkey")).alias("nse_symbol"), F.col("s_name").alias("company_name"),
        F.lit(None).cast("string").alias("sector"), F.col("s_acctbal").alias("balance"))
    return altered.unionByName(new)


UPSERT_SQL = f"""
stored AS (
  SELECT c_custkey AS nse_symbol, c_name AS company_name,
    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS sector, c_acctbal AS balance FROM customer),
incoming AS (
  SELECT c_custkey AS nse_symbol,
    CASE WHEN c_nationkey = 3 THEN c_name || ' Ltd' ELSE c_name END AS company_name,
    CASE WHEN c_nationkey <> 5 THEN c_mktsegment END AS sector,
    CASE WHEN c_nationkey = 7 THEN c_acctbal + 1 WHEN c_nationkey <> 9 THEN c_acctbal END AS balance
  FROM customer WHERE c_mktsegment <> 'BUILDING'
  UNION ALL
  SELECT -1 - s_suppkey, s_name, NULL, s_acctbal FROM supplier),
joined AS (
  SELECT coalesce(i.nse_symbol, s.nse_symbol) AS nse_symbol, s.nse_symbol IS NULL AS is_new,
    i.nse_symbol IS NOT NULL AS given,
    coalesce(i.company_name, s.company_name) AS company_name,
    coalesce(i.sector, s.sector) AS sector, coalesce(i.balance, s.balance) AS balance,
    i.company_name IS NOT NULL AND i.company_name IS DISTINCT FROM s.company_name AS d_name,
    i.sector IS NOT NULL AND i.sector IS DISTINCT FROM s.sector AS d_sector,
    i.balance IS NOT NULL AND i.balance IS DISTINCT FROM s.balance AS d_balance
  FROM stored s FULL JOIN incoming i ON s.nse_symbol = i.nse_symbol),
result AS (
  SELECT *, CASE WHEN NOT given THEN 'keep' WHEN is_new THEN 'insert'
    WHEN d_name OR d_sector OR d_balance THEN 'update' ELSE 'same' END AS op
  FROM joined)"""
STAMP_SQL = f"CASE WHEN op IN ('insert', 'update') THEN '{RUN_TS}' ELSE '{STORED_TS}' END AS updated_at"
CHANGED_SQL = """concat_ws(',', CASE WHEN d_balance THEN 'balance' END,
  CASE WHEN d_name THEN 'company_name' END, CASE WHEN d_sector THEN 'sector' END)"""


def upserted(d: Data, **how) -> DataFrame:
    return upsert(
        stored_companies(d), incoming_companies(d), ["nse_symbol"], FIELDS, RUN_TS,
        stamps={"updated_at": "on_change"}, **how)


@query(f"""WITH {UPSERT_SQL}
SELECT nse_symbol, company_name, sector, balance, {STAMP_SQL}, op FROM result""")
def upsert_rows(d: Data) -> DataFrame:
    return upserted(d).select(
        "nse_symbol", *FIELDS, stamp_text(F.col("updated_at")).alias("updated_at"),
        F.col("_op").alias("op"))


@query(f"""WITH {UPSERT_SQL}
SELECT nse_symbol, op, {CHANGED_SQL} AS changed FROM result WHERE op IN ('insert', 'update')""")
def upsert_changes(d: Data) -> DataFrame:
    return change_log(upserted(d), ["nse_symbol"]).withColumn("changed", F.array_join("changed", ","))


@query(f"""WITH {UPSERT_SQL}
SELECT op, CASE WHEN op = 'insert' THEN 'balance,company_name,sector' ELSE {CHANGED_SQL} END
  AS changed, count(*) AS n
FROM result WHERE op IN ('insert', 'update') GROUP BY ALL""")
def upsert_prices(d: Data) -> DataFrame:
    """The price form of the upsert: a new row reports every column."""
    log = change_log(upserted(d, insert_reports="all"), ["nse_symbol"])
    return log.groupBy("op", F.array_join("changed", ",").alias("changed")).agg(
        F.count("*").alias("n"))


@query(f"""WITH {UPSERT_SQL}
SELECT count(*) AS rows_written FROM result r JOIN incoming i ON r.nse_symbol = i.nse_symbol
WHERE (i.company_name IS NOT NULL AND i.company_name IS DISTINCT FROM r.company_name)
  OR (i.sector IS NOT NULL AND i.sector IS DISTINCT FROM r.sector)
  OR (i.balance IS NOT NULL AND i.balance IS DISTINCT FROM r.balance)""")
def rerun_no_change(d: Data) -> DataFrame:
    """The same batch a second time writes nothing."""
    again = upsert(
        rows_of(upserted(d)), incoming_companies(d), ["nse_symbol"], FIELDS, RUN_TS,
        stamps={"updated_at": "on_change"})
    return rows_written(again)


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
MEASURES = ["revenue", "discount", "tax"]


def line_rows(d: Data) -> DataFrame:
    """Line items as period rows, with gaps where discount or tax is zero."""
    return d.lineitem.select(
        *LINE_KEY, *LINE_ORDER, "l_returnflag", F.col("l_extendedprice").alias("revenue"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("discount"),
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("tax"))


@query("""
WITH old AS (
  SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS revenue,
    max(CASE WHEN l_discount <> 0 THEN l_discount END) AS discount,
    max(CASE WHEN l_tax <> 0 THEN l_tax END) AS tax
  FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL),
new AS (
  SELECT l_orderkey, l_linenumber,
    last(l_extendedprice ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS revenue,
    last(l_discount ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice)
      FILTER (WHERE l_discount <> 0) AS discount,
    last(l_tax ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice)
      FILTER (WHERE l_tax <> 0) AS tax
  FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL)
SELECT coalesce(n.l_orderkey, o.l_orderkey) AS l_orderkey,
  coalesce(n.l_linenumber, o.l_linenumber) AS l_linenumber,
  coalesce(n.revenue, o.revenue) AS revenue, coalesce(n.discount, o.discount) AS discount,
  coalesce(n.tax, o.tax) AS tax,
  CASE WHEN n.l_orderkey IS NULL THEN 'keep' WHEN o.l_orderkey IS NULL THEN 'insert'
    WHEN n.revenue IS DISTINCT FROM o.revenue
      OR (n.discount IS NOT NULL AND n.discount IS DISTINCT FROM o.discount)
      OR (n.tax IS NOT NULL AND n.tax IS DISTINCT FROM o.tax) THEN 'update'
    ELSE 'same' END AS op
FROM old o FULL JOIN new n
  ON o.l_orderkey = n.l_orderkey AND o.l_linenumber = n.l_linenumber""")
def upsert_periods(d: Data) -> DataFrame:
    """Composite key; the batch repeats keys and is folded first."""
    rows = line_rows(d)
    stored = rows.where(F.col("l_returnflag") == "N").groupBy(*LINE_KEY).agg(
        *[F.max(m).alias(m) for m in MEASURES])
    batch = rows.where(F.col("l_returnflag") != "N")
    result = upsert(stored, batch, LINE_KEY, MEASURES, RUN_TS, order=LINE_ORDER)
    return result.select(*LINE_KEY, *MEASURES, F.col("_op").alias("op"))


@query("""
SELECT l_orderkey, l_linenumber,
  last(l_extendedprice ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS revenue,
  last(l_discount ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice)
    FILTER (WHERE l_discount <> 0) AS discount,
  last(l_tax ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice)
    FILTER (WHERE l_tax <> 0) AS tax
FROM lineitem GROUP BY ALL""")
def fold_duplicates(d: Data) -> DataFrame:
    return fold_rows(line_rows(d), LINE_KEY, MEASURES, LINE_ORDER)


LINES = [*LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice"]


@query(f"""
SELECT {", ".join(LINES)} FROM lineitem WHERE l_linestatus = 'O'
UNION ALL
SELECT {", ".join(LINES)} FROM lineitem WHERE l_linestatus = 'F'
  AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O')""")
def replace_keep(d: Data) -> DataFrame:
    """Orders with open lines keep only those; the others keep their finished lines."""
    lines = d.lineitem.select(*LINES, "l_linestatus")
    stored = lines.where("l_linestatus = 'F'").drop("l_linestatus")
    return replace_given(stored, lines.where("l_linestatus = 'O'").drop("l_linestatus"), "l_orderkey")


@query(f"""
WITH done AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
SELECT {", ".join(LINES)} FROM lineitem
WHERE (l_orderkey IN (SELECT o_orderkey FROM done)) = (l_linestatus = 'O')""")
def replace_clear(d: Data) -> DataFrame:
    """Processed orders get their open lines, or none; the others keep the finished ones."""
    lines = d.lineitem.select(*LINES, "l_linestatus")
    processed = d.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    incoming = lines.where("l_linestatus = 'O'").drop("l_linestatus").join(
        processed, "l_orderkey", "left_semi")
    stored = lines.where("l_linestatus = 'F'").drop("l_linestatus")
    return replace_processed(stored, incoming, processed, "l_orderkey")


@query(f"""
SELECT {", ".join(LINES)} FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def cascade_delete(d: Data) -> DataFrame:
    removed = d.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return without_keys(d.lineitem.select(*LINES), removed, "l_orderkey")


@query(f"""
WITH children AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN -1 - o_custkey ELSE o_custkey END AS k,
    o_orderstatus FROM orders),
parents AS (
  SELECT c_custkey AS nse_symbol, c_name AS company_name, '{STORED_TS}' AS stamp FROM customer
  UNION ALL
  SELECT DISTINCT k, NULL, '{RUN_TS}' FROM children WHERE k NOT IN (SELECT c_custkey FROM customer))
SELECT nse_symbol, company_name,
  CASE WHEN nse_symbol IN (SELECT k FROM children WHERE o_orderstatus = 'P') THEN '{RUN_TS}'
    ELSE stamp END AS updated_at
FROM parents""")
def touch_stub(d: Data) -> DataFrame:
    """Stub companies for orders without a customer, then stamps of the processed ones."""
    children = d.orders.select(
        F.when(F.col("o_orderpriority") == "5-LOW", -1 - F.col("o_custkey"))
        .otherwise(F.col("o_custkey")).alias("nse_symbol"), "o_orderstatus")
    parents = stored_companies(d).select("nse_symbol", "company_name", "updated_at")
    complete = with_stubs(parents, children, "nse_symbol", ["updated_at"], RUN_TS)
    processed = children.where("o_orderstatus = 'P'")
    touched = touch(complete, processed, "nse_symbol", ["updated_at"], RUN_TS)
    return touched.withColumn("updated_at", stamp_text(F.col("updated_at")))


RULES = {
    "company_name": ["page_name", "feed_name", "c_name"],
    "sector": ["feed_sector", "page_sector"],
    "industry": ["page_sector", "feed_sector", "c_mktsegment"],
}


@query("""
SELECT c_custkey,
  coalesce(CASE WHEN c_nationkey > 12 THEN n_name END, nullif(s.feed_name, ''), c_name) AS company_name,
  coalesce(CASE WHEN s_acctbal >= 0 THEN 'S' || s_nationkey END, 'R' || n_regionkey) AS sector,
  'R' || n_regionkey AS industry
FROM customer
LEFT JOIN (SELECT *, CASE WHEN s_acctbal < 5000 THEN '' ELSE s_name END AS feed_name FROM supplier) s
  ON s_suppkey = c_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey""")
def profile_coalesce(d: Data) -> DataFrame:
    """Nation as the page, supplier as the feed, customer as the index row."""
    feed = d.supplier.select(
        F.col("s_suppkey").alias("c_custkey"),
        F.when(F.col("s_acctbal") < 5000, "").otherwise(F.col("s_name")).alias("feed_name"),
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("S"), "s_nationkey")).alias("feed_sector"))
    page = d.nation.select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.when(F.col("n_nationkey") > 12, F.col("n_name")).otherwise("").alias("page_name"),
        F.concat(F.lit("R"), "n_regionkey").alias("page_sector"))
    joined = join_sources(d.customer, [feed], "c_custkey").join(page, "c_nationkey", "left")
    return by_precedence(joined, "c_custkey", RULES)
