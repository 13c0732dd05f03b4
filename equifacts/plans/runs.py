"""Counters and verdict of a run."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equifacts.functions.text import stamp_text
from equifacts.operators.quality import union_all
from equifacts.schemas import TABLES

# Lines of the run summary, in print order.
SUMMARY_LINES = {
    "started_at": "Run started",
    "finished_at": "Run finished",
    "duration_seconds": "Duration (seconds)",
    "indices_fetched": "Indices fetched",
    "constituents_seen": "Constituents seen (all sectors)",
    "it_companies": "IT companies identified",
    "companies_scraped": "Companies scraped successfully",
    "static_refreshed": "Static profiles refreshed",
    "static_cache_hits": "Static cache hits (skipped)",
    "companies_failed": "Companies failed",
    "requests_made": "HTTP requests made",
    "errors_recorded": "Errors recorded",
    "companies_missing_fields": "Companies with missing fields",
}


def counters(df: DataFrame, **aggregates: Column) -> DataFrame:
    """(counter, value) rows of several aggregates taken in one pass over ``df``."""
    row = df.agg(*[F.coalesce(a, F.lit(0)).cast("long").alias(n) for n, a in aggregates.items()])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("counter"), F.col(n).alias("value")) for n in aggregates])))


def rows_in(df: DataFrame, name: str) -> DataFrame:
    return counters(df, **{name: F.count(F.lit(1))})


def run_counters(parts: list[DataFrame]) -> DataFrame:
    """One row with a column per counter, out of (counter, value) rows."""
    rows = union_all(parts)
    names = [n for n in SUMMARY_LINES if n not in ("started_at", "finished_at", "duration_seconds")]
    return rows.agg(*[
        F.coalesce(F.max(F.when(F.col("counter") == n, F.col("value"))), F.lit(0)).alias(n)
        for n in names])


def with_times(counters: DataFrame, started_at, finished_at) -> DataFrame:
    timed = counters.withColumns({
        "started_at": F.lit(started_at).cast("timestamp"),
        "finished_at": F.lit(finished_at).cast("timestamp")})
    seconds = (F.unix_micros("finished_at") - F.unix_micros("started_at")) / F.lit(1e6)
    return timed.withColumn("duration_seconds", F.bround(seconds, 1)).withColumn(
        "failed", (F.col("companies_scraped") == 0) & (F.col("companies_failed") > 0))


def started_record(spark: SparkSession, started_at) -> DataFrame:
    """The record of a run that has begun: its start, and nothing else yet."""
    return spark.range(1).select(*[
        F.lit(started_at if f.name == "started_at" else None).cast(f.dataType).alias(f.name)
        for f in TABLES["scrape_runs"] if f.name != "run_id"])


def execution_summary(run: DataFrame) -> DataFrame:
    """Metric and value, one line per metric."""
    shown = {n: F.col(n).cast("string") for n in SUMMARY_LINES}
    shown["started_at"] = stamp_text(F.col("started_at"))
    shown["finished_at"] = stamp_text(F.col("finished_at"))
    lines = [
        F.struct(F.lit(i).alias("line"), F.lit(title).alias("Metric"), shown[n].alias("Value"))
        for i, (n, title) in enumerate(SUMMARY_LINES.items(), start=1)]
    return run.select(F.inline(F.array(*lines))).orderBy("line")


def latest_run(runs: DataFrame, started_at) -> DataFrame:
    return runs.where(F.col("started_at") == F.lit(started_at).cast("timestamp")).agg(
        F.max("run_id").alias("run_id"))
