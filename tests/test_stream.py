import shutil
from datetime import datetime

from equifacts.operators.upsert import upsert
from equifacts.sources.tables import Tables
from equifacts.streaming.landed import landed_stream, upsert_landed

ROW = "nse_symbol string, capitalisation_cr double, price double, fetched_at timestamp"


def test_each_landed_file_is_taken_once(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    tables = Tables(spark, root, buckets=4)
    tables.create()

    def land(rows):
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(landing)

    def run():
        stream = landed_stream(spark, landing, ROW, files_per_batch=1)
        query = upsert_landed(
            stream, tables, "price_snapshot", ["capitalisation_cr", "price"], ["fetched_at"],
            str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
        assert query.exception() is None
        return {r.nse_symbol: (r.capitalisation_cr, r.price) for r in tables.read("price_snapshot").collect()}

    land([("A", 1.0, 2.0, datetime(2026, 1, 1)), ("A", None, 3.0, datetime(2026, 1, 2))])
    assert run() == {"A": (1.0, 3.0)}
    land([("A", 5.0, None, datetime(2026, 1, 3)), ("B", 7.0, None, datetime(2026, 1, 3))])
    assert run() == {"A": (5.0, 3.0), "B": (7.0, None)}
    version = max(tables._versions("price_snapshot").values())
    assert run() == {"A": (5.0, 3.0), "B": (7.0, None)}
    assert max(tables._versions("price_snapshot").values()) == version


def test_a_stream_adds_to_what_others_published(spark, tmp_path):
    """A table that a batch wrote, a second stream, a new checkpoint and a replayed epoch."""
    tables = Tables(spark, str(tmp_path / "tables"), buckets=4)
    tables.create()
    first = spark.createDataFrame([("A", 1.0, 1.0, datetime(2026, 1, 1))], ROW)
    touched = tables.touched("price_snapshot", first)
    values = ["capitalisation_cr", "price"]
    tables.publish("price_snapshot", upsert(
        tables.read("price_snapshot"), first, ["nse_symbol"], values, datetime(2026, 1, 1),
        stamps={"updated_at": "on_change"}), 1, touched)

    def run(landing, checkpoint):
        stream = landed_stream(spark, str(tmp_path / landing), ROW)
        query = upsert_landed(
            stream, tables, "price_snapshot", values, ["fetched_at"], str(tmp_path / checkpoint))
        query.awaitTermination(120)
        assert query.exception() is None
        return {r.nse_symbol: r.price for r in tables.read("price_snapshot").collect()}

    def land(landing, *rows):
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(str(tmp_path / landing))

    land("one", ("A", None, 2.0, datetime(2026, 1, 2)), ("B", None, 3.0, datetime(2026, 1, 2)))
    assert run("one", "c1") == {"A": 2.0, "B": 3.0}
    land("two", ("C", None, 4.0, datetime(2026, 1, 3)))
    assert run("two", "c2") == {"A": 2.0, "B": 3.0, "C": 4.0}
    land("one", ("A", None, 5.0, datetime(2026, 1, 4)))
    assert run("one", "c3")["A"] == 5.0
    version = tables.next_version("price_snapshot")
    # The commit of the last epoch is lost: the epoch runs again and finds itself listed.
    shutil.copytree(tmp_path / "c3", tmp_path / "c4", ignore=shutil.ignore_patterns("commits"))
    assert run("one", "c4")["A"] == 5.0
    assert tables.next_version("price_snapshot") == version
