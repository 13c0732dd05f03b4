"""Stored tables: resumed stages, changes without writes, several tables at once, rules, states."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from equifacts.bindings.catalog import Data, query
from equifacts.bindings.periods import FOLDED_SQL
from equifacts.bindings.upserts import (
    FIELDS, RUN_TS, STAMP_SQL, STORED_TS, UPSERT_SQL, incoming_companies, stored_companies)
from equifacts.functions.text import stamp_text
from equifacts.operators.latest import merge_latest
from equifacts.operators.quality import Rule
from equifacts.plans.progress import Progress
from equifacts.session import scratch_path
from equifacts.sources.commits import listed_files
from equifacts.sources.tables import Tables
from equifacts.streaming.landed import land, landed_stream

FIRMS = StructType().add("nse_symbol", "long").add("company_name", "string").add("sector", "string").add(
    "balance", "double").add("updated_at", "timestamp")
PERIODS = StructType().add("nse_symbol", "long").add("period_label", "string").add("revenue", "double").add(
    "priority", "string")
HOLDINGS = StructType().add("nse_symbol", "long").add("category", "string").add("percent", "double").add(
    "updated_at", "timestamp")
LAYOUTS = {"firms": FIRMS, "periods": PERIODS, "holdings": HOLDINGS}
KEYS = {"firms": ["nse_symbol"], "periods": ["nse_symbol", "period_label"], "holdings": ["nse_symbol", "category"]}


def store(d: Data, name: str, **how) -> Tables:
    tables = Tables(d.spark, scratch_path(d.spark, name), buckets=16, layouts=LAYOUTS, keys=KEYS, **how)
    tables.create()
    return tables


@query("""
SELECT c_custkey, count(o_orderkey) AS n_orders,
  CASE WHEN c_custkey % 8 < 2 THEN 1 ELSE 2 END AS attempt
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def resume_midway(d: Data) -> DataFrame:
    """Orders counted in four waves of buckets; the first attempt ends in the second wave."""
    root = scratch_path(d.spark, "resumed")
    bucket = F.col("c_custkey") % 8

    def attempt(number: int, waves: int) -> DataFrame:
        built = []

        def count(rows: DataFrame) -> DataFrame:
            if len(built) == waves:
                raise InterruptedError
            built.append(number)
            counts = d.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
            return rows.join(counts, "c_custkey", "left").fillna(0, ["n_orders"]).withColumn(
                "attempt", F.lit(number))

        progress = Progress(d.spark, root, "r1", buckets=8, waves=4)
        return progress.stage("counted", d.customer.select("c_custkey"), "c_custkey", count, bucket)

    try:
        return attempt(1, waves=1)
    except InterruptedError:
        return attempt(2, waves=4)


@query(f"""WITH {UPSERT_SQL}
SELECT nse_symbol, company_name, sector, balance, {STAMP_SQL}, 0 AS new_files, 0 AS new_commits FROM result""")
def rerun_no_write(d: Data) -> DataFrame:
    """The same batch upserted twice into stored tables, later the second time."""
    tables = store(d, "rerun")
    first = stored_companies(d)
    tables.publish("firms", first, 1, tables.touched("firms", first))

    def apply(run_ts):
        tables.apply({"firms": tables.upserted(
            "firms", incoming_companies(d), FIELDS, run_ts, stamps={"updated_at": "on_change"})})
        return len(listed_files(d.spark, f"{tables.path('firms')}/data")), tables.log.state().commit

    files, commits = apply(RUN_TS)
    files_after, commits_after = apply("2027-01-01 00:00:00")
    return tables.read("firms").withColumns({
        "updated_at": stamp_text(F.col("updated_at")), "new_files": F.lit(files_after - files),
        "new_commits": F.lit(commits_after - commits)})


@query(f"""WITH {FOLDED_SQL}
SELECT 'firms' AS name, o_custkey AS nse_symbol, NULL AS label, max(o_totalprice) AS value
FROM orders GROUP BY o_custkey
UNION ALL SELECT 'periods', nse_symbol, period_label, revenue FROM folded
UNION ALL SELECT 'holdings', o_custkey, o_orderpriority, CAST(count(*) AS DOUBLE)
FROM orders GROUP BY o_custkey, o_orderpriority""")
def landed_companies(d: Data) -> DataFrame:
    """A stream of orders that feeds companies, their periods and their holdings, in one commit."""
    tables = store(d, "landed")

    def plan(batch: DataFrame) -> dict[str, DataFrame]:
        key = F.col("o_custkey").alias("nse_symbol")
        firms = batch.groupBy(key).agg(F.max("o_totalprice").alias("balance")).withColumns({
            c: F.lit(None).cast("string") for c in ("company_name", "sector")})
        periods = batch.select(
            key, F.date_format("o_orderdate", "MMM yyyy").alias("period_label"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("revenue"),
            F.col("o_orderpriority").alias("priority"), "o_orderdate", "o_orderkey")
        holdings = batch.groupBy(key, F.col("o_orderpriority").alias("category")).agg(
            F.count("*").cast("double").alias("percent")).withColumn("updated_at", F.lit(RUN_TS).cast("timestamp"))
        return {
            "firms": tables.upserted("firms", firms, FIELDS, RUN_TS, stamps={"updated_at": "on_change"}),
            "periods": tables.upserted(
                "periods", periods, ["revenue", "priority"], RUN_TS, order=["o_orderdate", "o_orderkey"]),
            "holdings": tables.replaced("holdings", holdings)}

    for _ in range(2):
        # A glob, because a stream reads folders and the given table is one file.
        stream = landed_stream(d.spark, f"{d.folder}/order[s].parquet", d.orders.schema)
        land(stream, tables, plan, f"{tables.root}/checkpoint").awaitTermination()
    return all_rows(tables)


def all_rows(tables: Tables) -> DataFrame:
    """The keys of every table, with one value each."""
    none = F.lit(None).cast("string").alias("label")
    firms = tables.read("firms").select(
        F.lit("firms").alias("name"), "nse_symbol", none, F.col("balance").alias("value"))
    periods = tables.read("periods").select(F.lit("periods"), "nse_symbol", "period_label", "revenue")
    holdings = tables.read("holdings").select(F.lit("holdings"), "nse_symbol", "category", "percent")
    return firms.union(periods).union(holdings)


def filled(d: Data, name: str, **how) -> Tables:
    """A store with all customers as companies, and their orders as periods and holdings."""
    tables = store(d, name, **how)
    stamp = F.lit(STORED_TS).cast("timestamp").alias("updated_at")
    tables.apply(changes_of(d, tables, stamp))
    return tables


def changes_of(d: Data, tables: Tables, stamp) -> dict[str, DataFrame]:
    key = F.col("o_custkey").alias("nse_symbol")
    periods = d.orders.select(
        key, F.date_format("o_orderdate", "MMM yyyy").alias("period_label"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("revenue"),
        F.col("o_orderpriority").alias("priority"), "o_orderdate", "o_orderkey")
    holdings = d.orders.groupBy(key, F.col("o_orderpriority").alias("category")).agg(
        F.count("*").cast("double").alias("percent")).withColumn("updated_at", stamp)
    return {
        "firms": tables.upserted("firms", stored_companies(d), FIELDS, STORED_TS, stamps={"updated_at": "on_change"}),
        "periods": tables.upserted(
            "periods", periods, ["revenue", "priority"], STORED_TS, order=["o_orderdate", "o_orderkey"]),
        "holdings": tables.replaced("holdings", holdings)}


@query(f"""WITH {FOLDED_SQL},
kept AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
SELECT 'firms' AS name, c_custkey AS nse_symbol, NULL AS label, c_acctbal AS value
FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 'periods', nse_symbol, period_label, revenue FROM folded
WHERE nse_symbol IN (SELECT c_custkey FROM kept)
UNION ALL SELECT 'holdings', o_custkey, o_orderpriority, CAST(count(*) AS DOUBLE)
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM kept) GROUP BY o_custkey, o_orderpriority""")
def cascade_stored(d: Data) -> DataFrame:
    """Companies removed from their table and, in the same commit, from their children's."""
    tables = filled(d, "cascade")
    gone = d.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("nse_symbol"))
    tables.remove(gone, "nse_symbol")
    return all_rows(tables)


RULES = [
    Rule("balance below zero", "firms", holds="balance >= 0"),
    Rule("no sector", "firms", holds="sector IS NOT NULL"),
    Rule("period without company", "periods", key="nse_symbol", parent="firms", parent_key="nse_symbol"),
    Rule("no revenue", "periods", holds="revenue IS NOT NULL"),
    Rule("holding without company", "holdings", key="nse_symbol", parent="firms", parent_key="nse_symbol"),
]


@query(f"""WITH {FOLDED_SQL},
good AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0),
held AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)
SELECT 'firms' AS name, 'kept' AS rule, count(*) AS n FROM good
UNION ALL SELECT 'firms', 'balance below zero', count(*) FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'firms', 'no sector', count(*) FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'periods', 'kept', count(*) FROM folded
WHERE revenue IS NOT NULL AND nse_symbol IN (SELECT c_custkey FROM good)
UNION ALL SELECT 'periods', 'period without company', count(*) FROM folded
WHERE nse_symbol NOT IN (SELECT c_custkey FROM good)
UNION ALL SELECT 'periods', 'no revenue', count(*) FROM folded WHERE revenue IS NULL
UNION ALL SELECT 'holdings', 'kept', count(*) FROM held WHERE o_custkey IN (SELECT c_custkey FROM good)
UNION ALL SELECT 'holdings', 'holding without company', count(*) FROM held
WHERE o_custkey NOT IN (SELECT c_custkey FROM good)""")
def quarantined(d: Data) -> DataFrame:
    """Rows kept in each table, and those that a rule sent to the quarantine, by rule."""
    tables = filled(d, "quarantine", rules=RULES)
    kept = all_rows(tables).select("name", F.lit("kept").alias("rule"))
    return kept.union(tables.quarantine().select("name", "rule")).groupBy("name", "rule").agg(
        F.count("*").alias("n"))


@query("""
WITH folded AS (
  SELECT o_custkey AS nse_symbol, year(o_orderdate) AS y, month(o_orderdate) AS m,
    strftime(min(o_orderdate), '%b %Y') AS period_label,
    last(o_totalprice ORDER BY o_orderkey % 4, o_orderdate, o_orderkey)
      FILTER (WHERE o_orderstatus <> 'P') AS revenue,
    last(o_orderpriority ORDER BY o_orderkey % 4, o_orderdate, o_orderkey) AS priority
  FROM orders GROUP BY ALL)
SELECT nse_symbol, period_label, revenue, priority FROM folded
QUALIFY row_number() OVER (PARTITION BY nse_symbol ORDER BY y DESC, m DESC) <= 3""")
def latest_kept(d: Data) -> DataFrame:
    """The newest three periods of each customer, kept up to date over four batches of orders.

    Batches take turns by key, so periods come late and are restated.
    """
    tables = store(d, "latest")
    rows = d.orders.select(
        F.col("o_custkey").alias("nse_symbol"), F.date_format("o_orderdate", "MMM yyyy").alias("period_label"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("revenue"),
        F.col("o_orderpriority").alias("priority"), "o_orderdate", "o_orderkey")
    for turn in range(4):
        batch = rows.where(F.col("o_orderkey") % 4 == turn)
        state = tables.read("periods", tables.touched("periods", batch))
        newest = merge_latest(
            state, batch, ["nse_symbol"], 3, ["revenue", "priority"], ["o_orderdate", "o_orderkey"])
        tables.apply({"periods": tables.replaced("periods", newest, batch.select("nse_symbol"))})
    return tables.read("periods")
