"""A whole run over landed tables, and the stored tables it leaves behind."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from equifacts.plans import reports, runs
from equifacts.plans.company_batch import (
    Landed, landed_between, run_batch, run_reports, unaccounted)
from equifacts.schemas import LANDED_RESULTS, LANDING, TABLES
from equifacts.sources.constituents import read_constituents
from equifacts.sources.registry import index_registry
from equifacts.sources.tables import Tables, write_csv, write_reports
from tests.test_extract import PAGE

T0 = datetime(2026, 7, 4, 10, 0)
KEYS = ["nifty_it", "nifty_midcap_150"]
CSV = {
    "ind_niftyitlist.csv": [
        "Tata Consultancy,Information Technology,TCS,EQ,INE1",
        "Infosys &amp; Co,Information Technology,INFY,EQ,INE2",
        "No Symbol,Information Technology,-,EQ,INE3"],
    "ind_niftymidcap150list.csv": [
        "TCS Ltd,Other,TCS,EQ,INE9", "Coforge,Information Technology,COFORGE,EQ,INE4",
        '"Steel, Inc",Metals,STEEL,EQ,INE5', "Ghost,Information Technology,GHOST,EQ,INE6",
        "Blank,Information Technology,BLANK,EQ,INE7"],
}


def suggest(symbol, isin, **extra):
    return json.dumps([
        {"sc_id": "ZZ", "link_src": "http://z", "pdt_dis_nm": "Other<span>INE0, OTHER</span>"},
        {"sc_id": f"{symbol}1", "link_src": f"http://x/{symbol}", "name": f"{symbol} Ltd",
         "sc_sector": "Sector", "pdt_dis_nm": f"N&nbsp;<span>{isin}, {symbol}, 5</span>", **extra}])


def results(*rows):
    return json.dumps({"data": [
        {"yrc0": label, "Net Sales/Income from operations": revenue, "Basic EPS": eps}
        for label, revenue, eps in rows]})


def price(**data):
    return json.dumps({"data": data})


SUGGEST = [("TCS", None, suggest("TCS", "INE1")), ("INFY", None, suggest("INFY", "INE2")),
           ("COFORGE", None, suggest("COFORGE", "INE4")), ("GHOST", None, "[]"),
           ("BLANK", None, suggest("BLANK", "INE7"))]
PRICES = [("TCS", None, price(MKTCAP=100.5, PE="12", SC_FULLNM="TCS Full", isinid="INE777Z01029")),
          ("INFY", None, price(MKTCAP="50", BSEID="500209", main_sector="IT")),
          ("COFORGE", "HTTP 503", None), ("BLANK", None, price())]
QUARTERS = results(("Mar '26", "10", "1"), ("Dec '25", "9", "1"), ("Sep '25", "8", "1"),
                   ("Jun '25", "7", "--"), ("Mar '26", "11", None))
RESULTS = [("TCS", "quarterly", None, QUARTERS), ("TCS", "yearly", None, results(("Mar '25", "40", "4"))),
           ("INFY", "quarterly", None, results()), ("INFY", "yearly", "timeout", None),
           ("INFY", "monthly", None, "{}"), ("STEEL", "monthly", None, "{}")]
PAGES = [("TCS", None, PAGE), ("INFY", "HTTP 404", None)]


def landing(spark, rows, schema=LANDING):
    records = [{"symbol": r[0], "error": r[-2], "body": r[-1], "fetched_at": T0, "status": 200,
                **({"kind": r[1]} if len(r) == 4 else {})} for r in rows]
    return spark.createDataFrame(records, schema)


@pytest.fixture(scope="module")
def constituents(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    for name, lines in CSV.items():
        (folder / name).write_text(
            "\ufeffCompany Name,Industry,Symbol,Series,ISIN Code\n" + "\n".join(lines) + "\n")
    return read_constituents(spark, str(folder), index_registry(spark, KEYS))


@pytest.fixture(scope="module")
def landed(spark, constituents):
    return Landed(
        constituents, landing(spark, SUGGEST), landing(spark, PRICES),
        landing(spark, RESULTS, LANDED_RESULTS), landing(spark, PAGES))


@pytest.fixture(scope="module")
def ran(spark, landed, tmp_path_factory):
    tables = Tables(spark, str(tmp_path_factory.mktemp("tables")), buckets=4)
    result = run_batch(tables, landed, index_registry(spark, KEYS), "r1", T0, datetime(2026, 7, 4, 10, 6, 3))
    return tables, result


def test_constituent_scan(constituents):
    rows = constituents.orderBy("index_rank", "block_start", "row_pos").collect()
    assert [r.nse_symbol for r in rows] == ["TCS", "INFY", "TCS", "COFORGE", "STEEL", "GHOST", "BLANK"]
    assert [r.company_name for r in rows][:2] == ["Tata Consultancy", "Infosys & Co"]


def test_companies(ran):
    tables, result = ran
    rows = {r.nse_symbol: r for r in tables.read("companies").collect()}
    assert set(rows) == {"TCS", "INFY"}
    tcs, infy = rows["TCS"], rows["INFY"]
    assert (tcs.company_name, infy.company_name) == ("TCS Full", "INFY Ltd")
    assert (tcs.isin, tcs.bse_symbol) == ("INE777Z01029", "531987")
    assert (infy.isin, infy.bse_symbol, infy.sector) == ("INE2", "500209", "IT")
    assert tcs.products_services.startswith("Zelkova Systems runs a billing")
    assert tcs.static_updated_at is not None and infy.static_updated_at is None
    assert infy.dynamic_updated_at == tcs.updated_at == tcs.created_at
    assert tcs.industry == "Information Technology" and tcs.listed_indices is None
    assert {r.nse_symbol for r in result.scope.collect()} == {"TCS", "INFY"}
    log = {r.nse_symbol: r for r in tables.changes("companies", 1).collect()}
    assert log["INFY"].op == "insert" and "website" not in log["INFY"].changed


def test_satellites(ran):
    tables, _ = ran
    periods = {(r.period_type, r.period_label): r for r in tables.read("period_results").collect()}
    assert len(periods) == 5 and periods["Q", "Mar '26"].revenue == 11.0
    assert periods["Q", "Mar '26"].basic_eps == 1.0
    prices = {r.nse_symbol: r.capitalisation_cr for r in tables.read("price_snapshot").collect()}
    assert prices == {"TCS": 100.5, "INFY": 50.0}
    holdings = tables.read("shareholding").orderBy("pos").collect()
    assert [r.category for r in holdings] == ["Promoter", "FII", "Flag", "Others"]
    index = sorted((r.nse_symbol, r.index_name) for r in tables.read("company_indices").collect())
    assert index == [("INFY", "Nifty IT"), ("TCS", "Nifty IT"), ("TCS", "Nifty Midcap 150")]


def test_errors_and_counters(ran):
    tables, result = ran
    errors = {(r.nse_symbol, r.stage): (r.company_name, r.message) for r in result.errors.collect()}
    assert errors == {
        ("GHOST", "resolve"): ("Ghost", "No vendor match for symbol/ISIN"),
        ("COFORGE", "pricefeed"): (None, "HTTP 503"), ("BLANK", "pricefeed"): (None, "Empty price feed"),
        ("INFY", "yearly"): (None, "timeout"),
        ("INFY", "monthly"): (None, "Unsupported results kind: monthly"), ("INFY", "profile"): (None, "HTTP 404")}
    missing = {r.nse_symbol: r.fields for r in result.missing.collect()}
    assert missing == {
        "INFY": ["quarterly_results", "business_summary", "website", "products_services",
                 "major_clients", "order_book"],
        "TCS": ["order_book"]}
    run = result.run.first()
    assert (run.indices_fetched, run.constituents_seen, run.it_companies) == (2, 6, 5)
    assert (run.companies_scraped, run.companies_failed) == (2, 3)
    assert (run.static_refreshed, run.static_cache_hits, run.requests_made) == (2, 0, 16)
    assert (run.errors_recorded, run.companies_missing_fields, run.failed) == (6, 2, False)
    assert tables.read("scrape_errors").count() == 6 and tables.read("scrape_runs").count() == 1


def test_reports(spark, ran, tmp_path):
    tables, result = ran
    sheets = run_reports(tables, result)
    assert len(sheets) == 10
    listed = [r.asDict() for r in sheets["Company List"].collect()]
    assert [(r["NSE Symbol"], r["NSE Indices"]) for r in listed] == [
        ("INFY", "Nifty IT"), ("TCS", "Nifty IT, Nifty Midcap 150")]
    money = {r["NSE Symbol"]: (r["Latest FY"], r["FY Revenue (Rs Cr)"]) for r in sheets["Financial Data"].collect()}
    assert money == {"TCS": ("Mar '25", 40.0), "INFY": (None, None)}
    assert [r["Period"] for r in sheets["Quarterly Results"].collect()] == ["Mar '26", "Dec '25", "Sep '25"]
    assert [tuple(r) for r in sheets["Order Book"].collect()] == [
        ("No order book information found in company profiles", None, None)]
    assert sheets["Products & Services"].first()["NSE Symbol"] == "TCS"
    assert [r["Category"] for r in sheets["Shareholding"].collect()][0] == "Promoter"
    assert sheets["Errors & Skipped"].count() == 8
    summary = {r.Metric: r.Value for r in sheets["Execution Summary"].collect()}
    assert summary["Run started"] == "2026-07-04 10:00:00"
    assert summary["Duration (seconds)"] == "363.0" and len(summary) == 13
    widths = {"Company List": 9, "Company Profile": 13, "Financial Data": 16,
              "Quarterly Results": 11, "Shareholding": 5, "Errors & Skipped": 5}
    assert {n: len(sheets[n].columns) for n in widths} == widths
    write_reports(sheets, str(tmp_path / "out"), "r1", "csv")
    assert (tmp_path / "out" / "report=order_book" / "run_id=r1").is_dir()
    csv = reports.csv_tables(
        tables.read("companies"), tables.read("price_snapshot"), tables.read("period_results"),
        tables.read("shareholding").limit(0), result.scope)
    assert write_csv(csv, str(tmp_path / "csv")) == ["companies", "quarterly_results", "annual_results"]
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv/companies"))
    assert back.count() == 2 and back.columns[:2] == ["nse_symbol", "company_name"]


def test_second_run_changes_nothing(spark, landed, ran):
    tables, first = ran
    before = {n: sorted(map(str, tables.read(n).drop("updated_at", "dynamic_updated_at").collect()))
              for n in ("companies", "price_snapshot", "period_results", "shareholding", "company_indices")}
    again = run_batch(tables, landed, index_registry(spark, KEYS), "r2", T0, datetime(2026, 7, 5))
    for name in ("companies", "price_snapshot", "period_results"):
        assert tables.changes(name, again.written[name]).count() == 0
    after = {n: sorted(map(str, tables.read(n).drop("updated_at", "dynamic_updated_at").collect()))
             for n in before}
    assert after == before
    run = again.run.first()
    assert (run.static_refreshed, run.static_cache_hits) == (1, 1)
    stamps = {r.nse_symbol: r.updated_at for r in tables.read("price_snapshot").collect()}
    assert set(stamps.values()) == {datetime(2026, 7, 4, 10, 6, 3)}


def test_resumed_run_skips_finished(spark, landed, ran):
    tables, _ = ran
    resumed = run_batch(tables, landed, index_registry(spark, KEYS), "r1", T0, datetime(2026, 7, 5))
    assert resumed.run.first().companies_scraped == 0
    assert {r.nse_symbol for r in resumed.scope.collect()} == {"TCS", "INFY"}
    of_r1 = F.col("run_id") == "r1"
    assert tables.read("scrape_errors").where(of_r1).count() == 6
    assert tables.read("ledger").where(of_r1).count() == 2
    assert tables.read("scrape_runs").where(of_r1).count() == 1
    assert runs.latest_run(tables.read("scrape_runs"), T0).first().run_id == "r2"


class Failing(Tables):
    """Tables whose owner fails after so many writes."""

    def __init__(self, *how, writes, **more):
        super().__init__(*how, **more)
        self.writes = writes

    def count(self):
        self.writes -= 1
        if self.writes == 0:
            raise InterruptedError

    def publish(self, *how, **more):
        super().publish(*how, **more)
        self.count()

    def replace_run(self, name, *how):
        super().replace_run(name, *how)
        if name != "scrape_runs":
            self.count()


def test_run_repeated_after_failures(spark, landed, tmp_path):
    """After the third publish, then after all five and the errors."""
    root, at = str(tmp_path), datetime(2026, 7, 4, 10, 6, 3)
    for writes in (3, 6):
        failing = Failing(spark, root, buckets=4, writes=writes)
        with pytest.raises(InterruptedError):
            run_batch(failing, landed, index_registry(spark, KEYS), "r:1", T0, at)
        record = failing.read("scrape_runs").collect()
        assert [(r.run_id, r.notes, r.started_at, r.finished_at) for r in record] == [
            ("r:1", "interrupted", T0, None)]
        assert failing.read("ledger").count() == 0
    tables = Tables(spark, root, buckets=4)
    run_batch(tables, landed, index_registry(spark, KEYS), "r:1", T0, at)
    record = tables.read("scrape_runs").collect()
    assert [(r.notes, r.companies_scraped, r.companies_failed, r.finished_at) for r in record] == [
        ("completed", 2, 3, at)]
    assert tables.read("scrape_errors").count() == 6
    assert sorted(r.nse_symbol for r in tables.read("ledger").collect()) == ["INFY", "TCS"]
    rows = tables.read("companies").collect()
    assert {(r.created_at, r.updated_at) for r in rows} == {(at, at)} and len(rows) == 2
    assert tables.read("period_results").count() == 5


def test_run_reads_its_own_landing_only(spark, landed, tmp_path):
    """Two landings by day; the second run must not see what only the first one fetched."""
    days = [datetime(2026, 7, 4, 10), datetime(2026, 7, 6, 9)]

    def by_day(rows, *second):
        parts = [rows.withColumn("fetched_at", F.lit(days[0]).cast("timestamp"))]
        parts += [p.withColumn("fetched_at", F.lit(days[1]).cast("timestamp")) for p in second]
        folder = str(tmp_path / f"landed-{len(list(tmp_path.iterdir()))}")
        for part in parts:
            part.withColumn("landed_on", F.to_date("fetched_at")).write.mode(
                "append").partitionBy("landed_on").parquet(folder)
        return spark.read.parquet(folder)

    tcs = [f.where("symbol = 'TCS'") for f in (landed.suggest, landed.pricefeed, landed.results)]
    both = Landed(landed.constituents, by_day(landed.suggest, tcs[0]),
                  by_day(landed.pricefeed, tcs[1]), by_day(landed.results, tcs[2]), by_day(landed.pages))
    tables = Tables(spark, str(tmp_path / "tables"), buckets=4)
    result = run_batch(
        tables, both, index_registry(spark, KEYS), "r1", days[1], days[1],
        since=datetime(2026, 7, 5), until=datetime(2026, 7, 7), stamps={"updated_at": "always"})
    run = result.run.first()
    assert (run.companies_scraped, run.companies_failed, run.requests_made) == (1, 4, 4)
    errors = {(r.nse_symbol, r.stage): r.message for r in result.errors.collect()}
    assert errors["INFY", "resolve"] == errors["TCS", "profile"] == "No response landed"
    assert [r.created_at for r in tables.read("companies").collect()] == [None]
    cut = landed_between(both, datetime(2026, 7, 5), datetime(2026, 7, 7)).results
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landed_on" in plan
    assert cut.select("landed_on").distinct().collect() == [(date(2026, 7, 6),)]


def test_company_without_outcome_is_listed(spark):
    todo = spark.createDataFrame([("A", "a"), ("B", "b"), ("C", "c")], "nse_symbol string, company_name string")
    rows = unaccounted(todo, todo.where("nse_symbol = 'A'"), todo.where("nse_symbol = 'B'"), T0).collect()
    assert [(r.nse_symbol, r.company_name, r.stage) for r in rows] == [("C", "c", "unexpected")]


def test_create_is_idempotent(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), buckets=2)
    tables.create()
    tables.create()
    for name, layout in TABLES.items():
        assert tables.read(name).count() == 0
        assert tables.read(name).columns == layout.fieldNames()


def test_publish_rewrites_touched_buckets_only(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), buckets=8)
    tables.create()
    layout = TABLES["company_indices"]

    def rows(*keys):
        return spark.createDataFrame([(k, "i", k, T0) for k in keys], layout)

    first = rows(*"ABCDEFGH")
    tables.publish("company_indices", first, 1, tables.touched("company_indices", first))
    second = rows("A")
    touched = tables.touched("company_indices", second)
    stored = tables.read("company_indices", touched)
    changed = stored.withColumn("index_name", F.lit("new"))
    tables.publish("company_indices", changed, 2, touched)
    tables.publish("company_indices", changed.limit(0), 2, touched)
    names = {r.nse_symbol: r.index_name for r in tables.read("company_indices").collect()}
    assert len(names) == 8 and names["A"] == "new" and "new" != names[next(
        k for k in names if k not in {r.nse_symbol for r in stored.collect()})]


def test_a_run_goes_on_after_its_last_finished_stage(spark, landed, tmp_path, monkeypatch):
    """It ends while results are read; repeated, it reads no search answer and no price again."""
    from equifacts.plans import company_batch
    tables, at = Tables(spark, str(tmp_path), buckets=4), datetime(2026, 7, 4, 10, 6, 3)
    asked, ends = [], ["once"]

    def fails(name, real):
        def run(*how, **more):
            asked.append(name)
            if name == "feed_entries" and asked.count(name) == 2 and ends:
                ends.clear()
                raise InterruptedError
            return real(*how, **more)
        return run

    for name in ("suggest_entries", "price_rows", "feed_entries"):
        monkeypatch.setattr(company_batch, name, fails(name, getattr(company_batch, name)))
    with pytest.raises(InterruptedError):
        run_batch(tables, landed, index_registry(spark, KEYS), "r1", T0, at, waves=2)
    assert asked == ["suggest_entries"] * 2 + ["price_rows"] * 2 + ["feed_entries"] * 2
    asked.clear()
    result = run_batch(tables, landed, index_registry(spark, KEYS), "r1", T0, at, waves=2)
    assert asked == ["feed_entries"] * 2  # what was left, in two waves again
    assert result.run.first().companies_scraped == 2 and result.errors.count() == 6
    assert tables.read("period_results").count() == 5
