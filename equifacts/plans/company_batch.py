"""One run over the landed tables: discovery to stored tables, errors and reports.

All companies are processed at once by joins on the symbol. Frames that several steps read
are staged in the shared scratch folder, which also cuts their lineage.
"""

import dataclasses
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equifacts.functions import payload
from equifacts.functions.sentences import with_topics
from equifacts.operators import quality
from equifacts.operators.coalesce import PROFILE_RULES, by_precedence, join_sources
from equifacts.operators.merge import explode_members
from equifacts.operators.refresh import (
    LEDGER_VERSION,
    TTL_DAYS,
    finished,
    mark_stale,
    run_scope,
    unfinished,
)
from equifacts.operators.resolve import pick_identity
from equifacts.plans import reports, runs
from equifacts.plans.progress import Progress
from equifacts.plans.universe import INDUSTRIES, discover
from equifacts.schemas import PRICE_FIELDS, PERIOD_FIELDS, PROFILE_FIELDS, REPORTED_FIELDS
from equifacts.session import stage
from equifacts.sources.feeds import (
    RESULT_KINDS,
    feed_entries,
    price_rows,
    suggest_entries,
    typed_results,
)
from equifacts.sources.pages import extract_pages, holding_rows, holdings_json
from equifacts.sources.tables import Tables

NO_MATCH = "No vendor match for symbol/ISIN"
EMPTY_FEED = "Empty price feed"
NOT_LANDED = "No response landed"
BAD_PAYLOAD = "Payload is not a JSON object"
UNACCOUNTED = "Neither finished nor failed for a known reason"
# Stamps of the companies table and when each is set.
COMPANY_STAMPS = {
    "static_updated_at": "page_read", "dynamic_updated_at": "refreshed",
    "created_at": "created", "updated_at": "always",
}


@dataclass
class Landed:
    constituents: DataFrame
    suggest: DataFrame
    pricefeed: DataFrame
    results: DataFrame
    pages: DataFrame


@dataclass
class RunResult:
    universe: DataFrame
    scope: DataFrame
    errors: DataFrame
    missing: DataFrame
    run: DataFrame
    written: dict[str, int]


def landed_between(landed: Landed, since=None, until=None) -> Landed:
    """The responses that landed from ``since`` on and before ``until``.

    Tables kept in folders by day, as a column ``landed_on``, are read for these days only.
    """
    def cut(rows: DataFrame) -> DataFrame:
        fetched, by_day = F.col("fetched_at"), "landed_on" in rows.columns
        if since is not None:
            first = F.lit(since).cast("timestamp")
            rows = rows.where(fetched >= first)
            rows = rows.where(F.col("landed_on") >= first.cast("date")) if by_day else rows
        if until is not None:
            last = F.lit(until).cast("timestamp")
            rows = rows.where(fetched < last)
            rows = rows.where(F.col("landed_on") <= last.cast("date")) if by_day else rows
        return rows

    return dataclasses.replace(landed, **{
        n: cut(getattr(landed, n)) for n in ("suggest", "pricefeed", "results", "pages")})


def newest_response(landed: DataFrame, keys: list[str]) -> DataFrame:
    """The newest landed row per key; of equally new ones, bodies are told apart by their hash.

    A later join on the same key needs no further shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(F.desc("fetched_at"), "error", F.xxhash64("body"))
    return landed.withColumn("_n", F.row_number().over(window)).where(
        F.col("_n") == 1).drop("_n")


def landed_state(rows: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Join the landed response of each row and name what is wrong with it."""
    # Only the wanted keys go on: bodies of the others are dropped before the ranking.
    named = landed.withColumnRenamed("symbol", "nse_symbol").join(
        rows.select(*keys), keys, "left_semi")
    response = newest_response(named, keys).select(
        *keys, "body", "error", F.lit(True).alias("_in"))
    reason = F.when(F.col("_in").isNull(), NOT_LANDED).otherwise(F.col("error"))
    return rows.join(response, keys, "left").withColumn("reason", reason).drop("_in", "error")


def resolve_stage(todo: DataFrame, suggest: DataFrame, run_ts,
                  progress: Progress) -> tuple[DataFrame, DataFrame]:
    """Resolved companies, and an error row for each of the others."""
    def build(rows: DataFrame) -> DataFrame:
        seen = landed_state(rows, suggest, ["nse_symbol"])
        bad = F.when(F.col("reason").isNull() & payload.parse(F.col("body")).isNull(),
                     "Payload is not JSON")
        checked = stage(seen.withColumn("reason", F.coalesce("reason", bad)), "suggest")
        identities = pick_identity(
            suggest_entries(checked.where(F.col("reason").isNull()), ["nse_symbol", "isin"]))
        return checked.drop("body").join(identities, "nse_symbol", "left").withColumn(
            "reason", F.coalesce("reason", F.when(F.col("mc_sc_id").isNull(), F.lit(NO_MATCH))))

    good, errors = quality.split_errors(
        progress.stage("resolved", todo, "nse_symbol", build), "nse_symbol", "resolve", F.col("reason"),
        run_ts, "company_name")
    return good.drop("reason"), errors


def price_stage(resolved: DataFrame, pricefeed: DataFrame, run_ts,
                progress: Progress) -> tuple[DataFrame, DataFrame]:
    """Resolved companies with a filled price feed, and an error row for the others."""
    def build(rows: DataFrame) -> DataFrame:
        seen = landed_state(rows, pricefeed, ["nse_symbol"])
        priced = price_rows(seen, [c for c in seen.columns if c != "body"])
        return priced.withColumn("reason", F.coalesce("reason", F.when(
            F.col("feed_state") == "invalid", BAD_PAYLOAD).when(F.col("feed_state") == "empty", EMPTY_FEED)))

    good, errors = quality.split_errors(
        progress.stage("priced", resolved, "nse_symbol", build), "nse_symbol", "pricefeed", F.col("reason"), run_ts)
    return good.drop("reason", "feed_state"), errors


def results_stage(good: DataFrame, results: DataFrame, run_ts,
                  progress: Progress) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Period rows of both kinds, missing-feed names, and non-fatal errors."""
    def build(rows: DataFrame) -> DataFrame:
        # One pass over the feeds; states and period rows are read from the small extract.
        wanted = rows.select(
            "nse_symbol", F.explode(F.array(*[F.lit(k) for k in RESULT_KINDS])).alias("kind"))
        seen = landed_state(wanted, results, ["nse_symbol", "kind"])
        return feed_entries(seen, ["nse_symbol", "kind", "reason"])

    extract = progress.stage("results", good, "nse_symbol", build).withColumn(
        "reason", F.coalesce("reason", F.when(~F.col("readable"), BAD_PAYLOAD)))
    states = extract.where(F.coalesce("pos", F.lit(0)) == 0).select("nse_symbol", "kind", "reason")
    rows = typed_results(extract.where(F.col("reason").isNull()))
    errors = quality.union_all([
        quality.error_rows(states.where(F.col("kind") == k), "nse_symbol", k,
                           F.col("reason"), run_ts) for k in RESULT_KINDS]
        + [unsupported_kinds(good, results, run_ts)])
    # A feed that could not be read is an error, not a missing field.
    absent = quality.missing_feeds(
        good, rows, "nse_symbol", "period_type",
        {t: f"{k}_results" for k, t in RESULT_KINDS.items()})
    failed = states.where(F.col("reason").isNotNull()).select(
        "nse_symbol", F.concat("kind", F.lit("_results")).alias("field"))
    return rows, absent.join(failed, ["nse_symbol", "field"], "left_anti"), errors


def unsupported_kinds(good: DataFrame, results: DataFrame, run_ts) -> DataFrame:
    """Error rows for landed results of a kind that is not read."""
    other = results.withColumnRenamed("symbol", "nse_symbol").where(
        ~F.col("kind").isin(list(RESULT_KINDS))).select("nse_symbol", "kind").distinct()
    reason = F.concat(F.lit("Unsupported results kind: "), F.col("kind"))
    rows = quality.error_rows(
        other.join(good.select("nse_symbol"), "nse_symbol", "left_semi"), "nse_symbol", "",
        reason, run_ts)
    return rows.withColumn("stage", F.regexp_extract("message", ": (.*)$", 1))


def page_stage(good: DataFrame, pages: DataFrame, stored: DataFrame, run_ts, ttl_days: float,
               progress: Progress) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Freshness of every company, fields and holdings of the stale ones' pages, errors."""
    def build(rows: DataFrame) -> DataFrame:
        # One pass over the pages; what the later steps read is the small extract.
        marked = mark_stale(rows, stored, "nse_symbol", "static_updated_at", "business_summary", run_ts, ttl_days)
        due = stage(marked, "freshness")
        seen = landed_state(due.where("stale").select("nse_symbol"), pages, ["nse_symbol"])
        with_holdings = seen.withColumn("holdings", holdings_json(F.col("body")))
        fields = extract_pages(with_holdings, ["nse_symbol", "reason", "holdings"]).withColumnsRenamed(
            {"bse_symbol": "page_bse_symbol", "isin": "page_isin"})
        read = with_topics(fields, "business_summary")
        return due.select("nse_symbol", "age_days", "stale").join(read, "nse_symbol", "left")

    known = progress.stage("pages", good.select("nse_symbol"), "nse_symbol", build)
    marked = known.select("nse_symbol", "age_days", "stale")
    extract = known.where("stale").drop("age_days", "stale")
    errors = quality.error_rows(extract, "nse_symbol", "profile", F.col("reason"), run_ts)
    readable = extract.where(F.col("reason").isNull()).drop("reason")
    holdings = holding_rows(readable, ["nse_symbol"], "holdings")
    return marked, readable.drop("holdings"), holdings, errors


def run_batch(tables: Tables, landed: Landed, registry: DataFrame, run_id: str, started_at,
              run_ts, symbols: list[str] | None = None, limit: int | None = None,
              industries: list[str] = INDUSTRIES, ttl_days: float = TTL_DAYS,
              fresh: bool = False, since=None, until=None,
              stamps: dict[str, str] = COMPANY_STAMPS, waves: int = 1) -> RunResult:
    """Process everything that is due and publish it as the next version of each table.

    Only responses that landed from ``since`` to ``until`` belong to the run; all of them if
    neither is given. ``stamps`` says when each stamp of the companies table is set.

    A record of the run stands from its start on and ends as ``completed`` or ``interrupted``.
    The ledger is written last and every record is replaced by run, so a run repeated under
    its id after a failure leaves the same tables and records as one that never failed. Each stage
    is built in so many ``waves`` of buckets; a repeated run builds the waves that are not listed.
    """
    tables.create()
    started = runs.started_record(registry.sparkSession, started_at)
    tables.replace_run("scrape_runs", run_id, started)
    try:
        return process(tables, landed_between(landed, since, until), registry, run_id, started_at,
                       run_ts, symbols, limit, industries, ttl_days, fresh, stamps, waves)
    except BaseException:
        tables.replace_run(
            "scrape_runs", run_id, started.withColumn("notes", F.lit("interrupted")))
        raise


def process(tables: Tables, landed: Landed, registry: DataFrame, run_id: str, started_at, run_ts,
            symbols, limit, industries, ttl_days, fresh, stamps, waves) -> RunResult:
    """The run between its start and its end record."""
    whole_sector = [r.index_key for r in registry.where("whole_sector").collect()]
    universe = stage(discover(
        landed.constituents, whole_sector, industries, symbols, limit), "universe")
    done = stage(finished(tables.read("ledger"), run_id, fresh).select("nse_symbol"), "done")
    todo = unfinished(universe, done, "nse_symbol")

    progress = Progress(tables.spark, tables.root, run_id, tables.buckets, waves, fresh)
    resolved, resolve_errors = resolve_stage(todo, landed.suggest, run_ts, progress)
    good, price_errors = price_stage(resolved, landed.pricefeed, run_ts, progress)
    periods, absent, result_errors = results_stage(good, landed.results, run_ts, progress)
    marked, pages, holdings, page_errors = page_stage(
        good, landed.pages, tables.read("companies"), run_ts, ttl_days, progress)
    failures = quality.union_all([resolve_errors, price_errors])
    unexpected = unaccounted(todo, good, failures, run_ts)

    read = pages.withColumn("page_read", F.lit(True))
    profiles = stage(
        by_precedence(
            join_sources(good, [read.drop("page_read")], "nse_symbol"), "nse_symbol",
            PROFILE_RULES).join(read.select("nse_symbol", "page_read"), "nse_symbol", "left"),
        "profiles")
    batch = profiles.withColumn("listed_indices", F.lit(None).cast("string")).withColumn(
        "refreshed", F.lit(True))
    memberships = explode_members(good, "nse_symbol", registry)

    written = publish_batch(tables, batch, good, periods, holdings, memberships, run_ts, stamps)

    # What an earlier attempt noted about companies that it finished still holds.
    earlier = tables.read("scrape_errors").where(F.col("run_id") == run_id).drop("run_id").join(
        done, "nse_symbol", "left_semi")
    errors = stage(quality.union_all(
        [failures, result_errors, page_errors, unexpected, earlier]), "errors")
    missing = stage(missing_report(profiles, absent), "missing")
    scope = run_scope(good, done.join(universe, "nse_symbol", "left_semi"), "nse_symbol")
    run = runs.with_times(runs.run_counters([
        runs.rows_in(registry, "indices_fetched"),
        runs.rows_in(seen_symbols(landed.constituents), "constituents_seen"),
        runs.rows_in(universe, "it_companies"),
        runs.rows_in(good, "companies_scraped"),
        runs.rows_in(failures.unionByName(unexpected).select("nse_symbol").distinct(),
                     "companies_failed"),
        runs.counters(
            marked, static_refreshed=F.count_if("stale"), static_cache_hits=F.count_if(~F.col("stale"))),
        runs.rows_in(requests_landed(landed, todo, resolved, marked), "requests_made"),
        runs.rows_in(errors, "errors_recorded"),
        runs.rows_in(missing, "companies_missing_fields"),
    ]), started_at, run_ts)
    run = stage(run, "run")
    tables.replace_run("scrape_errors", run_id, errors)
    tables.replace_run("scrape_runs", run_id, run.withColumn("notes", F.lit("completed")))
    tables.replace_run("ledger", run_id, run_scope(good, done, "nse_symbol").withColumn(
        "version", F.lit(LEDGER_VERSION).cast("long")))
    return RunResult(universe, stage(scope, "scope"), errors, missing, run, written)


def unaccounted(todo: DataFrame, good: DataFrame, failures: DataFrame, run_ts) -> DataFrame:
    """An error row for each company that is neither good nor failed for a known reason."""
    known = good.select("nse_symbol").union(failures.select("nse_symbol"))
    return quality.error_rows(
        todo.join(known, "nse_symbol", "left_anti"), "nse_symbol", "unexpected",
        F.lit(UNACCOUNTED), run_ts, "company_name")


def publish_batch(tables: Tables, batch, good, periods, holdings, memberships,
                  run_ts, stamps=COMPANY_STAMPS) -> dict[str, int]:
    """Upsert or replace in each table, in one commit; gives the version of each.

    A table that nothing changes is not written.
    """
    def stamped(rows):
        return rows.withColumn("updated_at", F.lit(run_ts).cast("timestamp"))

    on_change = {"updated_at": "on_change"}
    return tables.apply({
        "companies": tables.upserted("companies", batch, PROFILE_FIELDS, run_ts, stamps=stamps),
        "price_snapshot": tables.upserted(
            "price_snapshot", good.select("nse_symbol", *PRICE_FIELDS), PRICE_FIELDS, run_ts,
            insert_reports="all", stamps=on_change),
        "period_results": tables.upserted(
            "period_results", periods, PERIOD_FIELDS, run_ts, order=["pos"], stamps=on_change),
        "company_indices": tables.replaced("company_indices", stamped(memberships), good),
        "shareholding": tables.replaced("shareholding", stamped(holdings)),
    })


def seen_symbols(constituents: DataFrame) -> DataFrame:
    return constituents.select("nse_symbol").distinct()


def missing_report(profiles: DataFrame, absent: DataFrame) -> DataFrame:
    """Missing fields per company: absent feeds first, then profile fields as declared."""
    order = [f"{k}_results" for k in RESULT_KINDS] + REPORTED_FIELDS
    fields = quality.missing_fields(profiles, "nse_symbol", REPORTED_FIELDS).select(
        "nse_symbol", F.explode("fields").alias("field"))
    place = F.array_position(F.array(*[F.lit(f) for f in order]), F.col("field"))
    # A company has at most as many rows here as there are declared fields.
    listed = absent.unionByName(fields).groupBy("nse_symbol").agg(
        F.array_sort(F.collect_list(F.struct(place.alias("p"), "field"))).alias("_f"))
    return listed.select("nse_symbol", F.col("_f.field").alias("fields"))


def requests_landed(landed: Landed, todo: DataFrame, resolved: DataFrame,
                    marked: DataFrame) -> DataFrame:
    """Landed responses that belong to this run."""
    def of(frame, keys):
        return frame.select(F.col("symbol").alias("nse_symbol")).join(
            keys.select("nse_symbol"), "nse_symbol", "left_semi")
    return quality.union_all([
        of(landed.suggest, todo), of(landed.pricefeed, resolved), of(landed.results, marked),
        of(landed.pages, marked.where("stale"))])


def run_reports(tables: Tables, result: RunResult) -> dict[str, DataFrame]:
    return reports.report_bundle(
        tables.read("companies"), tables.read("price_snapshot"), tables.read("company_indices"),
        tables.read("period_results"), tables.read("shareholding"), result.scope,
        result.errors, result.missing, runs.execution_summary(result.run))
