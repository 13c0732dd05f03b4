"""What is due: stale profiles, unfinished companies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.functions.text import age_days

# Days a profile stays fresh; version of the ledger rows.
TTL_DAYS = 30
LEDGER_VERSION = 1


def with_age(universe: DataFrame, stored: DataFrame, key: str, stamp: str, core: str,
             run_ts) -> DataFrame:
    """Add ``age_days`` since the last refresh: NULL when never fetched, when the core field
    is missing, or when the stamp is unreadable. ``stored`` is unique by key."""
    known = stored.where(F.col(core).isNotNull()).select(
        key, age_days(F.col(stamp), F.lit(run_ts).cast("timestamp")).alias("age_days"))
    return universe.join(known, key, "left")


def mark_stale(universe: DataFrame, stored: DataFrame, key: str, stamp: str, core: str,
               run_ts, ttl_days: float = TTL_DAYS) -> DataFrame:
    aged = with_age(universe, stored, key, stamp, core, run_ts)
    return aged.withColumn(
        "stale", F.col("age_days").isNull() | (F.col("age_days") >= ttl_days))


def finished(ledger: DataFrame, run_id: str | None = None, fresh: bool = False,
             version: int = LEDGER_VERSION) -> DataFrame:
    """Keys the ledger records as done; none for a fresh start or another version."""
    rows = ledger.where(F.col("version") == version)
    if run_id is not None:
        rows = rows.where(F.col("run_id") == run_id)
    if fresh:
        rows = rows.where(F.lit(False))
    return rows


def unfinished(universe: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return universe.join(done.select(key).distinct(), key, "left_anti")


def run_scope(succeeded: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Keys reported by a run: those just finished and those finished before."""
    return succeeded.select(key).union(done.select(key)).distinct()
