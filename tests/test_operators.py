from datetime import datetime

import pytest
from pyspark.sql import functions as F

from equifacts.operators import filters, latest, merge, quality, refresh, replace
from equifacts.operators import resolve as resolving
from equifacts.operators import upsert as ups
from equifacts.plans import reports
from equifacts.plans.universe import discover, listing
from equifacts.sources.registry import index_registry
from equifacts.sources.requests import index_requests, request_manifest, templates

TS = "2026-07-04 10:30:00"
NOW = datetime(2026, 7, 4, 10, 30)


def test_registry(spark):
    rows = index_registry(spark).collect()
    assert len(rows) == 6 and [r.index_key for r in rows if r.whole_sector] == ["nifty_it"]
    chosen = index_registry(spark, ["nifty_midcap_150", "nifty_it"]).orderBy("index_rank")
    assert [r.index_key for r in chosen.collect()] == ["nifty_midcap_150", "nifty_it"]
    with pytest.raises(KeyError):
        index_registry(spark, ["nifty_it", "nope"])


CONSTITUENTS = [
    ("nifty_it", 0, 0, "TCS", "Tata Consultancy", "IT", "INE1"),
    ("nifty_it", 0, 1, "INFY", "Infosys", "", ""),
    ("nifty_midcap_150", 1, 0, "TCS", "TCS Ltd", "Other", "INE9"),
    ("nifty_midcap_150", 1, 1, "COFORGE", "Coforge", " information technology", "INE2"),
    ("nifty_midcap_150", 1, 2, "TCS", "TCS again", "Other", "INE9"),
    ("nifty_smallcap_250", 2, 0, "STEEL", "Steel Co", "Metals", ""),
    ("nifty_smallcap_250", 2, 1, "TCS", "TCS", "IT", ""),
]


@pytest.fixture
def constituents(spark):
    return spark.createDataFrame(
        CONSTITUENTS,
        "index_key string, index_rank int, row_pos long, nse_symbol string, "
        "company_name string, nse_industry string, isin string"
    ).withColumn("block_start", F.lit(0).cast("long"))


def test_universe(constituents):
    rows = discover(constituents, ["nifty_it"]).orderBy("nse_symbol").collect()
    assert [r.nse_symbol for r in rows] == ["COFORGE", "INFY", "TCS"]
    tcs = rows[2]
    assert (tcs.company_name, tcs.isin) == ("Tata Consultancy", "INE1")
    assert tcs.index_keys == ["nifty_it", "nifty_midcap_150", "nifty_smallcap_250"]
    limited = discover(constituents, ["nifty_it"], limit=2)
    assert [r.index_keys for r in listing(limited).collect()] == ["nifty_midcap_150", "nifty_it"]
    request = constituents.sparkSession.createDataFrame([(" tcs, ,steel",), (None,)], "asked string")
    wanted = filters.requested_symbols(request, "asked", "nse_symbol")
    assert sorted(r.nse_symbol for r in wanted.collect()) == ["STEEL", "TCS"]
    for symbols in (wanted, ["tcs", "steel"]):
        got = discover(constituents, ["nifty_it"], symbols=symbols).collect()
        assert [r.nse_symbol for r in got] == ["TCS"]


def test_members(spark, constituents):
    merged = discover(constituents, ["nifty_it"])
    bridge = merge.explode_members(merged, "nse_symbol", index_registry(spark, ["nifty_it", "nifty_smallcap_250"]))
    names = merge.member_names(bridge.union(bridge), "nse_symbol", "index_name")
    assert {r.nse_symbol: r.names for r in names.collect()} == {
        "TCS": ["Nifty IT", "Nifty Smallcap 250"], "INFY": ["Nifty IT"]}
    companies = spark.createDataFrame([("TCS",), ("X",)], "nse_symbol string")
    listed = {r.nse_symbol: r.indices for r in reports.with_indices(companies, bridge).collect()}
    assert listed == {"TCS": "Nifty IT, Nifty Smallcap 250", "X": ""}


def candidate(pos, display, sc_id="id", link="url", name=None):
    return ("COFORGE", pos, sc_id, link, name, "IT", display)


@pytest.mark.parametrize("isin, rows, expected", [
    ("INE5", [candidate(0, "n<span>X, COFORGE, 1</span>", "t"), candidate(1, "n<span>INE5, Y</span>", "i")], "i"),
    ("INE5", [candidate(0, "Bharat Forge<span>INE1, BHARATFORG</span>"), candidate(1, "n<span>X, COFORGE, 1</span>", "t")], "t"),
    ("", [candidate(0, "n<span>INE5, Y</span>", "i"), candidate(1, "n<span>X, COFORGE, 1</span>", "t")], "t"),
    ("INE5", [candidate(0, "n<span>INE5, Y</span>", None), candidate(1, "n<span>X, COFORGE, 1</span>", "t")], None),
    ("INE5", [candidate(0, "n<span>X, COFORGE</span>", "a", None), candidate(1, "n<span>X, COFORGE</span>", "b")], "b"),
    ("INE5", [candidate(0, "Bharat Forge<span>INE1, BHARATFORG</span>")], None),
])
def test_resolve(spark, isin, rows, expected):
    companies = spark.createDataFrame([("COFORGE", isin)], "nse_symbol string, isin string")
    entries = spark.createDataFrame(
        rows, "nse_symbol string, pos int, sc_id string, link string, name string, "
        "sector string, display string")
    got = resolving.resolve(companies, entries).collect()
    assert [r.mc_sc_id for r in got] == ([expected] if expected else [])
    assert all(r.identity_name == "COFORGE" for r in got)


def test_fold_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, 5.0, "x"), ("a", 2, 1.0, None), ("a", 3, None, None), ("b", 1, None, None)],
        "k string, pos int, v double, s string")
    rows = merge.fold_rows(df, ["k"], ["v", "s"], ["pos"]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("a", 1.0, "x"), ("b", None, None)]


@pytest.fixture
def old(spark):
    return spark.createDataFrame(
        [("A", "Old", "w", 1.0, datetime(2026, 1, 1)), ("B", "Bee", None, None, datetime(2026, 1, 1)),
         ("C", "Cee", "c", 3.0, datetime(2026, 1, 1))],
        "k string, name string, web string, n double, updated_at timestamp")


def apply(old, rows, **how):
    new = old.sparkSession.createDataFrame(rows, "k string, name string, web string, n double, pos int")
    how.setdefault("stamps", {"updated_at": "on_change"})
    return ups.upsert(old, new, ["k"], ["name", "web", "n"], TS, order=["pos"], **how)


def test_upsert(old):
    result = apply(old, [
        ("A", "New", None, 1.0, 0), ("B", "Bee", None, None, 0), ("D", "Dee", None, 4.0, 0),
        (None, "no key", None, None, 0)])
    rows = {r.k: r for r in result.collect()}
    assert set(rows) == {"A", "B", "C", "D"}
    assert (rows["A"].name, rows["A"].web, rows["A"].n) == ("New", "w", 1.0)
    assert (rows["A"]._op, rows["A"]._changed, rows["A"].updated_at) == ("update", ["name"], NOW)
    assert (rows["B"]._op, rows["B"]._changed, rows["B"].updated_at) == (
        "same", [], datetime(2026, 1, 1))
    assert (rows["C"]._op, rows["C"].updated_at) == ("keep", datetime(2026, 1, 1))
    assert (rows["D"]._op, rows["D"]._changed, rows["D"].web) == ("insert", ["n", "name"], None)
    assert ups.rows_written(result).first().rows_written == 2
    log = {r.k: r.changed for r in ups.change_log(result, ["k"]).collect()}
    assert log == {"A": ["name"], "D": ["n", "name"]}


def test_upsert_reports_all_columns_of_an_insert(old):
    result = apply(old, [("D", None, None, 4.0, 0)], insert_reports="all")
    assert ups.change_log(result, ["k"]).first().changed == ["n", "name", "web"]


def test_upsert_is_idempotent(old):
    rows = [("A", "x", None, 2.0, 0), ("A", None, "z", None, 1), ("E", None, None, None, 0)]
    first = apply(old, rows)
    assert {(r.k, r.name, r.web, r.n) for r in first.collect()} >= {("A", "x", "z", 2.0)}
    again = apply(ups.rows_of(first), rows)
    assert ups.change_log(again, ["k"]).count() == 0
    assert again.groupBy("k").count().where("count > 1").count() == 0


def test_upsert_stamp_flags(spark, old):
    new = spark.createDataFrame(
        [("A", "Old", None), ("B", "Bee", True)], "k string, name string, read boolean")
    result = ups.upsert(old, new, ["k"], ["name"], TS, stamps={"updated_at": "read"})
    stamps = {r.k: r.updated_at for r in result.collect()}
    assert stamps == {"A": datetime(2026, 1, 1), "B": NOW, "C": datetime(2026, 1, 1)}


def test_touch_and_stubs(spark, old):
    done = spark.createDataFrame([("A",), ("A",)], "k string")
    touched = {r.k: r.updated_at for r in ups.touch(old, done, "k", ["updated_at"], TS).collect()}
    assert touched == {"A": NOW, "B": datetime(2026, 1, 1), "C": datetime(2026, 1, 1)}
    children = spark.createDataFrame([("A", 1), ("Z", 1), ("Z", 2), (None, 1)], "k string, x int")
    rows = {r.k: (r.name, r.updated_at) for r in ups.with_stubs(
        old, children, "k", ["updated_at"], TS).collect()}
    assert set(rows) == {"A", "B", "C", "Z"} and rows["Z"] == (None, NOW)


def test_replace(spark):
    kind = "k string, c string, p double"
    stored = spark.createDataFrame([("A", "x", 1.0), ("A", "y", 2.0), ("B", "x", 3.0), ("C", "x", 4.0)], kind)
    given = spark.createDataFrame([("A", "x", 70.0)], kind)
    kept = sorted(tuple(r) for r in replace.replace_given(stored, given, "k").collect())
    assert kept == [("A", "x", 70.0), ("B", "x", 3.0), ("C", "x", 4.0)]
    processed = spark.createDataFrame([("A",), ("B",)], "k string")
    cleared = sorted(tuple(r) for r in replace.replace_processed(stored, given, processed, "k").collect())
    assert cleared == [("A", "x", 70.0), ("C", "x", 4.0)]


LABELS = ["Dec '24", "Mar '26", "Sep '25", "Dec '25", "???", "Jun '26"]


def test_latest_periods(spark):
    df = spark.createDataFrame(
        [(k, label, float(i)) for k in "AB" for i, label in enumerate(LABELS[: 6 if k == "A" else 5])],
        "k string, period_label string, v double")
    ranked = latest.latest_periods(df, ["k"], 3)
    assert "WindowGroupLimit" in ranked._jdf.queryExecution().executedPlan().toString()
    rows = ranked.orderBy("k", "period_rank").collect()
    assert [r.period_label for r in rows] == [
        "Jun '26", "Mar '26", "Dec '25", "Mar '26", "Dec '25", "Sep '25"]
    newest = {r.k: (r.period_label, r.v) for r in latest.latest_period(df, "k", ["v"]).collect()}
    assert newest == {"A": ("Jun '26", 5.0), "B": ("Mar '26", 1.0)}
    named = df.withColumn("name", F.when(F.col("k") == "A", "Zed").otherwise(""))
    ordered = latest.order_periods(latest.with_period(named), "name", "k").collect()
    assert [r.k for r in ordered] == ["B"] * 5 + ["A"] * 6 and ordered[0].period_label == "Mar '26"


def test_stale(spark):
    universe = spark.createDataFrame([(k,) for k in "ABCDE"], "k string")
    stored = spark.createDataFrame(
        [("A", datetime(2026, 7, 4), "s"), ("B", datetime(2026, 6, 4, 10, 30), "s"),
         ("C", datetime(2026, 7, 4), None), ("D", None, "s")],
        "k string, at timestamp, core string")
    rows = refresh.mark_stale(universe, stored, "k", "at", "core", TS).orderBy("k").collect()
    assert [r.stale for r in rows] == [False, True, True, True, True]
    assert rows[1].age_days == 30.0


def test_resume(spark):
    universe = spark.createDataFrame([(k,) for k in "ABC"], "nse_symbol string")
    ledger = spark.createDataFrame(
        [("r1", "A", 1), ("r1", "B", 2), ("r0", "C", 1)], "run_id string, nse_symbol string, version long")
    done = refresh.finished(ledger, "r1")
    left = refresh.unfinished(universe, done, "nse_symbol").collect()
    assert sorted(r.nse_symbol for r in left) == ["B", "C"]
    assert refresh.unfinished(universe, refresh.finished(ledger, "r1", fresh=True), "nse_symbol").count() == 3
    scope = refresh.run_scope(universe.where("nse_symbol <> 'A'"), done, "nse_symbol")
    assert scope.count() == 3
    assert filters.in_scope(universe, scope.limit(0), "nse_symbol").count() == 0


def test_quality(spark):
    df = spark.createDataFrame([("A", None, "x"), ("B", "y", "x"), ("C", None, None)], "k string, p string, q string")
    missing = {r.k: r.fields for r in quality.missing_fields(df, "k", ["q", "p"]).collect()}
    assert missing == {"A": ["p"], "C": ["q", "p"]}
    good, errors = quality.split_errors(df, "k", "resolve", F.when(F.col("p").isNull(), "no p"), TS, "q")
    assert good.count() + errors.count() == 3
    assert {tuple(r) for r in errors.collect()} == {
        ("A", "x", "resolve", "no p", NOW), ("C", None, "resolve", "no p", NOW)}
    feeds = spark.createDataFrame([("A", "Q"), ("A", "Y"), ("B", "Y")], "k string, t string")
    absent = quality.missing_feeds(df, feeds, "k", "t", {"Q": "quarterly", "Y": "yearly"})
    assert sorted(tuple(r) for r in absent.collect()) == [
        ("B", "quarterly"), ("C", "quarterly"), ("C", "yearly")]
    listed = reports.error_report(
        errors, quality.missing_fields(df, "k", ["p", "q"]).withColumnRenamed("k", "nse_symbol"))
    assert [(r["NSE Symbol"], r["Stage"], r["Error"]) for r in listed.collect()] == [
        ("A", "resolve", "no p"), ("C", "resolve", "no p"),
        ("A", "missing-fields", "p"), ("C", "missing-fields", "p, q")]


def test_integrity(spark):
    parent = spark.createDataFrame([("A",), ("A",), ("B",)], "k string")
    child = spark.createDataFrame([("A", 1), ("Z", 2), ("Z", 3), (None, 4)], "k string, v int")
    rules = quality.union_all([
        quality.unique_rule(parent, ["k"], "unique"),
        quality.not_null_rules(child, {"k": "key", "v": "value"}),
        quality.reference_rule(child, "k", parent, "k", "parent")])
    assert {r.rule: r.violations for r in rules.collect()} == {
        "unique": 1, "key": 1, "value": 0, "parent": 2}
    assert [r.k for r in quality.unknown_keys(child.dropna(), parent, "k").collect()] == ["Z"]


def test_placeholder(spark):
    df = spark.createDataFrame([("A", 1)], "name string, x int")
    assert [tuple(r) for r in reports.or_placeholder(df, df, "none").collect()] == [("A", 1)]
    none = df.where("x > 1")
    empty = reports.or_placeholder(none, none, "none")
    assert [tuple(r) for r in empty.collect()] == [("none", None)]
    assert "Join" not in empty._jdf.queryExecution().executedPlan().toString()


def test_requests(spark):
    universe = spark.createDataFrame(
        [("M&M", "MM 01", "http://x/p", True), ("TCS", None, "http://x/t", False)],
        "nse_symbol string, sc string, link string, stale boolean")
    stages = templates("https://s", "https://p", "https://r")
    ids = {"resolve": "nse_symbol", "pricefeed": "sc", "quarterly": "sc", "yearly": "sc"}
    rows = {(r.nse_symbol, r.stage): r.url for r in request_manifest(
        universe, "nse_symbol", ids, stages, "link", "stale").collect()}
    assert len(rows) == 6
    assert rows["M&M", "pricefeed"] == "https://p/pricefeed/nse/equitycash/MM%2001"
    assert "query=M%26M&" in rows["M&M", "resolve"] and rows["M&M", "profile"] == "http://x/p"
    assert rows["M&M", "yearly"].endswith("sc_id=MM%2001&type_format=yearly&start=0&limit=8")
    urls = index_requests(index_registry(spark, ["nifty_it"]), "https://a/").collect()
    assert urls[0].url == "https://a/ind_niftyitlist.csv"
