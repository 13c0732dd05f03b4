"""Stored tables: one commit over several tables, plans, the log at length, rules and removal."""

import shutil
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from equifacts.bindings.store import FIRMS, HOLDINGS, KEYS, LAYOUTS, PERIODS
from equifacts.operators.latest import latest_periods, merge_latest
from equifacts.operators.merge import fold_rows
from equifacts.operators.quality import Rule
from equifacts.operators.upsert import upsert
from equifacts.plans.progress import Progress
from equifacts.sources.commits import CommitLog, Conflict
from equifacts.sources.tables import Tables
from equifacts.streaming.landed import land, landed_stream

T0, T1 = datetime(2026, 7, 4), datetime(2026, 7, 5)
FEED = "nse_symbol long, company_name string, balance double, period_label string, revenue double, at long"


def store(spark, root, cls=Tables, **how):
    tables = cls(spark, str(root), buckets=8, layouts=LAYOUTS, keys=KEYS, **how)
    tables.create()
    return tables


def firms(spark, *rows):
    return spark.createDataFrame([(k, n, s, b, T0) for k, n, s, b in rows], FIRMS)


def files(root):
    return {str(f) for f in Path(root).rglob("*.parquet") if "/data/" in str(f) or "/log/" in str(f)}


def names(tables):
    return {r.nse_symbol: r.company_name for r in tables.read("firms").collect()}


def changed(tables, rows, run_ts=T1):
    return {"firms": tables.upserted(
        "firms", rows, ["company_name", "sector", "balance"], run_ts, stamps={"updated_at": "on_change"})}


def test_unchanged_rows_write_nothing(spark, tmp_path):
    tables = store(spark, tmp_path)
    rows = firms(spark, *[(k, f"n{k}", None, 1.0) for k in range(40)])
    assert tables.apply(changed(tables, rows)) == {"firms": 1}
    before = files(tmp_path)
    assert tables.apply(changed(tables, rows, datetime(2027, 1, 1))) == {"firms": 2}
    assert files(tmp_path) == before and tables.changes("firms", 2).count() == 0
    tables.apply(changed(tables, firms(spark, (3, "new", None, None), (4, "n4", None, 1.0))))
    data = [f for f in files(tmp_path) - before if "/data/" in f]
    assert len(data) == 1 and "version=2" in data[0]  # one bucket of eight
    assert names(tables) == {**{k: f"n{k}" for k in range(40)}, 3: "new"}
    assert [(r.nse_symbol, r.op, r.changed) for r in tables.changes("firms", 2).collect()] == [
        (3, "update", ["company_name"])]


def test_stored_side_is_not_shuffled(spark, tmp_path):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = store(spark, tmp_path)
        stamp = F.lit(T0).cast("timestamp")
        holdings = spark.range(100).select(
            (F.col("id") % 30).alias("nse_symbol"), F.concat(F.lit("c"), F.col("id")).alias("category"),
            F.lit(1.0).alias("percent"), stamp.alias("updated_at"))
        tables.apply({"holdings": tables.replaced("holdings", holdings)})
        with tables.aligned("holdings") as stored:
            for result in (
                    upsert(stored, holdings, KEYS["holdings"], ["percent"], T1, stamps={"updated_at": "on_change"}),
                    tables._merged("holdings", stored, holdings.withColumns({
                        "_op": F.lit("update"), "_changed": F.array().cast("array<string>")}))):
                text = result._jdf.queryExecution().executedPlan().toString()
                assert "Bucketed: true" in text and text.count("Exchange") == 1 and "FullOuter" in text
                assert result.count() == 100
        assert tables.read("holdings").count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


class Stopping(Tables):
    """Stops between the tables of a commit."""

    left = 1

    def publish(self, *how, **more):
        if self.left == 0:
            raise InterruptedError
        self.left -= 1
        super().publish(*how, **more)


def feed_plan(tables):
    def plan(batch):
        holdings = batch.groupBy("nse_symbol", F.col("period_label").alias("category")).agg(
            F.sum("revenue").alias("percent")).withColumn("updated_at", F.lit(T0).cast("timestamp"))
        rows = batch.withColumn("sector", F.lit(None).cast("string"))
        return {
            "firms": tables.upserted("firms", rows, ["company_name", "sector", "balance"], T0, order=["at"],
                                     stamps={"updated_at": "on_change"}),
            "periods": tables.upserted("periods", rows.withColumn("priority", F.lit("p")), ["revenue", "priority"],
                                       T0, order=["at"]),
            "holdings": tables.replaced("holdings", holdings)}
    return plan


def test_a_stream_stopped_between_tables(spark, tmp_path):
    def content(tables):
        return {n: sorted(map(str, tables.read(n).collect())) for n in LAYOUTS}

    def run(tables, landing, checkpoint):
        query = land(landed_stream(spark, str(landing), FEED, files_per_batch=1), tables, feed_plan(tables), str(checkpoint))
        try:
            query.awaitTermination(120)
        except Exception:
            pass
        return query.exception()

    landing = tmp_path / "landing"
    for at in range(3):
        spark.createDataFrame(
            [(k, f"n{k}-{at}", float(at), f"Mar '2{at + k % 2}", 1.0 + at, at) for k in range(at, 12)], FEED
        ).coalesce(1).write.mode("append").parquet(str(landing))
    whole = store(spark, tmp_path / "whole")
    assert run(whole, landing, tmp_path / "c0") is None
    want = content(whole)
    assert {n: len(r) for n, r in want.items()}["firms"] == 12

    stopping = store(spark, tmp_path / "stopped", Stopping)
    stopping.left = 4  # the second micro-batch has written one of its three tables
    assert run(stopping, landing, tmp_path / "c1") is not None
    half = content(stopping)
    assert half != want and stopping.log.state().commit == 0
    again = store(spark, tmp_path / "stopped")
    assert run(again, landing, tmp_path / "c1") is None
    assert content(again) == want
    commits = again.log.state().commit
    # The commit of the last epoch is lost: it runs again and finds itself listed.
    shutil.copytree(tmp_path / "c1", tmp_path / "c2", ignore=shutil.ignore_patterns("commits"))
    assert run(again, landing, tmp_path / "c2") is None
    assert content(again) == want and again.log.state().commit == commits


def test_log_reads_one_segment(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), every=4)
    for k in range(11):
        assert log.append([("t", k % 3, k), ("u", 0, k)], k - 1, f"w{k % 2}", k) == k
    state = log.state()
    assert log.segments() == [0, 1, 2] and state.segment == 2 and state.commit == 10
    assert state.versions == {"t": {0: 9, 1: 10, 2: 8}, "u": {0: 10}} and state.epochs == {"w0": 10, "w1": 9}
    _, rows = log.newest()
    assert len(rows.inputFiles()) == 3  # commits 8, 9 and 10, whatever came before
    # A segment that was begun and not committed is passed over.
    (tmp_path / "log" / "segment=3" / "_temporary").mkdir(parents=True)
    assert log.state() == state
    with pytest.raises(Conflict):
        log.append([("t", 0, 99)], 9)


def test_rules_hold_at_publish(spark, tmp_path):
    rules = [
        Rule("negative", "firms", holds="balance >= 0"),
        Rule("orphan", "periods", key="nse_symbol", parent="firms", parent_key="nse_symbol"),
        Rule("late", "periods", holds="revenue < 100")]
    tables = store(spark, tmp_path, rules=rules)

    def periods(*rows):
        frame = spark.createDataFrame([(k, f"Mar '{y}", r, "p") for k, y, r in rows], PERIODS)
        return tables.upserted("periods", frame, ["revenue", "priority"], T0)

    tables.apply({"periods": periods((1, 20, 5.0), (2, 20, 500.0), (3, 20, 7.0), (3, 21, None)),
                  **changed(tables, firms(spark, (1, "a", None, 1.0), (2, "b", None, -1.0), (3, "c", None, 0.0)))})
    assert set(names(tables)) == {1, 3}
    assert {(r.nse_symbol, r.period_label) for r in tables.read("periods").collect()} == {(1, "Mar '20"), (3, "Mar '20")}
    bad = sorted((r["name"], r.rule, r.key, r.commit) for r in tables.quarantine().collect())
    assert bad == [
        ("firms", "negative", '{"nse_symbol":2}', 0),
        ("periods", "late", '{"nse_symbol":2,"period_label":"Mar \'20"}', 0),
        ("periods", "late", '{"nse_symbol":3,"period_label":"Mar \'21"}', 0),
        ("periods", "orphan", '{"nse_symbol":2,"period_label":"Mar \'20"}', 0)]
    # A stored parent counts, one removed in the same commit does not.
    tables.apply({"periods": periods((1, 22, 1.0), (3, 22, 1.0)),
                  "firms": tables.removed("firms", spark.createDataFrame([(3,)], "nse_symbol long"), "nse_symbol")})
    assert [(r.rule, r.commit) for r in tables.quarantine().collect() if r.commit] == [("orphan", 1)]
    assert set(names(tables)) == {1}


def test_removal_reaches_all_tables(spark, tmp_path):
    tables = store(spark, tmp_path)
    holdings = spark.createDataFrame([(k % 10, f"c{k}", 1.0, T0) for k in range(30)], HOLDINGS)
    periods = spark.createDataFrame([(k % 12, f"Mar '{20 + k % 3}", 1.0, "p") for k in range(36)], PERIODS)
    tables.apply({**changed(tables, firms(spark, *[(k, f"n{k}", None, 1.0) for k in range(10)])),
                  "holdings": tables.replaced("holdings", holdings),
                  "periods": tables.upserted("periods", periods, ["revenue", "priority"], T0)})
    gone = spark.createDataFrame([(2,), (5,), (99,)], "nse_symbol long")
    versions = tables.remove(gone, "nse_symbol")
    for name in LAYOUTS:
        left = {r.nse_symbol for r in tables.read(name).collect()}
        assert left == set(range(12 if name == "periods" else 10)) - {2, 5}
        assert {(r.nse_symbol, r.op) for r in tables.changes(name, versions[name]).collect()} == {
            (2, "delete"), (5, "delete")}
    before = files(tmp_path)
    tables.remove(gone, "nse_symbol")
    assert files(tmp_path) == before
    tables.apply(changed(tables, firms(spark, (2, "back", None, 1.0))))
    assert names(tables)[2] == "back" and len(names(tables)) == 9


def test_replacement_of_a_snapshot(spark, tmp_path):
    tables = store(spark, tmp_path)

    def replace(rows, processed=None):
        frame = spark.createDataFrame([(k, c, p, T0) for k, c, p in rows], HOLDINGS)
        keys = None if processed is None else spark.createDataFrame([(k,) for k in processed], "nse_symbol long")
        tables.apply({"holdings": tables.replaced("holdings", frame, keys)})
        return sorted((r.nse_symbol, r.category, r.percent) for r in tables.read("holdings").collect())

    assert replace([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)]) == [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)]
    assert replace([(1, "a", 9.0)]) == [(1, "a", 9.0), (2, "a", 3.0)]  # 2 has none and stays
    assert replace([(1, "a", 9.0)], [1, 2]) == [(1, "a", 9.0)]  # 2 was processed and has none
    before = files(tmp_path)
    assert replace([(1, "a", 9.0)], [1, 2, 3]) == [(1, "a", 9.0)] and files(tmp_path) == before


@pytest.mark.parametrize("seed", [1, 2])
def test_newest_periods_kept_up_to_date(spark, seed):
    import random
    rng = random.Random(seed)
    rows = [(rng.randrange(6), f"{rng.choice(['Mar', 'Jun', 'Sep'])} '{rng.randrange(10, 30)}",
             rng.choice([None, 1.0, 2.0, 3.0]), rng.choice([None, "x", "y"]), k) for k in range(240)]
    schema = "nse_symbol long, period_label string, revenue double, priority string, at long"
    values, state, n = ["revenue", "priority"], None, 3
    for at in range(0, len(rows), 60):
        batch = spark.createDataFrame(rows[at:at + 60], schema)
        if state is None:
            state = batch.limit(0).drop("at")
        newest = merge_latest(state, batch, ["nse_symbol"], n, values, ["at"])
        kept = state.join(batch.select("nse_symbol").distinct(), "nse_symbol", "left_anti")
        state = spark.createDataFrame(kept.unionByName(newest).collect(), state.schema)
        seen = spark.createDataFrame(rows[:at + 60], schema)
        whole = latest_periods(fold_rows(seen, ["nse_symbol", "period_label"], values, ["at"]), ["nse_symbol"], n)
        assert sorted(map(str, state.collect())) == sorted(map(str, whole.select(*state.columns).collect()))


def test_progress_builds_only_what_is_left(spark, tmp_path):
    source = spark.range(100).select(F.col("id").alias("k"))
    built = []

    def build(fails_after):
        def run(rows):
            if len(built) == fails_after:
                raise InterruptedError
            built.append(sorted(r.k for r in rows.collect()))
            return rows.withColumn("wave", F.lit(len(built)))
        return run

    def progress(**how):
        return Progress(spark, str(tmp_path), "r:1", buckets=8, waves=4, **how)

    with pytest.raises(InterruptedError):
        progress().stage("s", source, "k", build(2))
    first = [k for wave in built for k in wave]
    done = progress().stage("s", source, "k", build(99))
    assert sorted(k for wave in built for k in wave) == list(range(100))  # nothing twice
    assert sorted(r.k for r in done.where("wave <= 2").collect()) == sorted(first)
    n = len(built)
    assert progress().stage("s", source.where("k < 50"), "k", build(n)).count() == 50 and len(built) == n
    assert progress().stage("t", source, "k", lambda rows: rows).count() == 100
    assert progress(fresh=True).stage("s", source, "k", build(99)).count() == 100 and len(built) == n + 4
