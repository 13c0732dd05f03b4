"""Newest periods per company: orders are the period rows, customers the companies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.bindings.catalog import Data, query
from equifacts.functions.text import period_month, period_year
from equifacts.operators.latest import latest_period, latest_periods, order_periods, with_period
from equifacts.operators.merge import fold_rows
from equifacts.sources.feeds import keep_filled

# Revenue is empty in pending orders, so the fold has NULLs to skip.
FOLDED_SQL = """
folded AS (
  SELECT o_custkey AS nse_symbol, year(o_orderdate) AS y, month(o_orderdate) AS m,
         strftime(min(o_orderdate), '%b %Y') AS period_label,
         last(o_totalprice ORDER BY o_orderdate, o_orderkey)
           FILTER (WHERE o_orderstatus <> 'P') AS revenue,
         last(o_orderpriority ORDER BY o_orderdate, o_orderkey) AS priority
  FROM orders GROUP BY ALL
),
filled AS (SELECT * FROM folded WHERE revenue IS NOT NULL)"""


def companies(d: Data) -> DataFrame:
    return d.customer.select(
        F.col("c_custkey").alias("nse_symbol"), F.col("c_name").alias("company_name"))


def period_rows(d: Data) -> DataFrame:
    """One row per customer and month; later orders win column by column."""
    rows = d.orders.select(
        F.col("o_custkey").alias("nse_symbol"),
        F.date_format("o_orderdate", "MMM yyyy").alias("period_label"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("revenue"),
        F.col("o_orderpriority").alias("priority"),
        "o_orderdate", "o_orderkey")
    folded = fold_rows(
        rows, ["nse_symbol", "period_label"], ["revenue", "priority"],
        ["o_orderdate", "o_orderkey"])
    return keep_filled(folded, ["revenue"])


@query(f"""
WITH {FOLDED_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY nse_symbol ORDER BY y DESC, m DESC) AS period_rank
  FROM filled)
SELECT nse_symbol, c_name AS company_name, period_label, revenue, priority,
       CAST(period_rank AS INTEGER) AS period_rank
FROM ranked JOIN customer ON c_custkey = nse_symbol WHERE period_rank <= 3""")
def latest_n_periods(d: Data) -> DataFrame:
    newest = latest_periods(period_rows(d), ["nse_symbol"], 3)
    named = newest.join(companies(d), "nse_symbol")
    return order_periods(named, "company_name", "nse_symbol").select(
        "nse_symbol", "company_name", "period_label", "revenue", "priority", "period_rank")


@query(f"""
WITH {FOLDED_SQL},
newest AS (
  SELECT * FROM filled
  QUALIFY row_number() OVER (PARTITION BY nse_symbol ORDER BY y DESC, m DESC) = 1)
SELECT c_custkey AS nse_symbol, c_name AS company_name, period_label, revenue, priority
FROM customer LEFT JOIN newest ON c_custkey = nse_symbol""")
def latest_period_join(d: Data) -> DataFrame:
    newest = latest_period(period_rows(d), "nse_symbol", ["revenue", "priority"])
    return companies(d).join(newest, "nse_symbol", "left")


@query(f"""
WITH {FOLDED_SQL}
SELECT nse_symbol, c_name AS company_name, period_label, CAST(y AS INTEGER) AS period_year,
       CAST(m AS INTEGER) AS period_month, revenue
FROM filled JOIN customer ON c_custkey = nse_symbol""")
def annual_all(d: Data) -> DataFrame:
    rows = with_period(period_rows(d)).join(companies(d), "nse_symbol")
    return order_periods(rows, "company_name", "nse_symbol").select(
        "nse_symbol", "company_name", "period_label", F.col("_year").alias("period_year"),
        F.col("_month").alias("period_month"), "revenue")


@query(r"""
SELECT o_orderkey, CASE o_orderpriority
    WHEN '1-URGENT' THEN strftime(o_orderdate, '%b ''%y')
    WHEN '2-HIGH' THEN strftime(o_orderdate, '%b %Y')
    WHEN '3-MEDIUM' THEN strftime(o_orderdate, ' %B%y ')
    WHEN '5-LOW' THEN strftime(o_orderdate, 'Foo ''%y')
    ELSE '???' END AS period_label,
  CAST(CASE WHEN o_orderpriority = '2-HIGH' THEN year(o_orderdate)
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 0
    ELSE 2000 + year(o_orderdate) % 100 END AS INTEGER) AS period_year,
  CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN month(o_orderdate)
    ELSE 0 END AS INTEGER) AS period_month
FROM orders""")
def period_key(d: Data) -> DataFrame:
    """Labels in the spellings that occur, and some that are no labels."""
    spelled = {
        "1-URGENT": F.date_format("o_orderdate", "MMM ''yy"),
        "2-HIGH": F.date_format("o_orderdate", "MMM yyyy"),
        "3-MEDIUM": F.date_format("o_orderdate", " MMMMyy "),
        "5-LOW": F.date_format("o_orderdate", "'Foo '''yy"),
    }
    label = F.lit("???")
    for priority, text in spelled.items():
        label = F.when(F.col("o_orderpriority") == priority, text).otherwise(label)
    labels = d.orders.select("o_orderkey", label.alias("period_label"))
    return labels.select(
        "o_orderkey", "period_label",
        period_year(F.col("period_label")).alias("period_year"),
        period_month(F.col("period_label")).alias("period_month"))
