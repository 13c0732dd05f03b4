"""One key holds a third of all rows: results against brute force, and plans that reduce
the key before it is shuffled."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from equifacts.operators import latest, merge, quality, replace, upsert

ROWS = 60_000
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


@pytest.fixture(scope="module")
def hot(spark):
    i = F.col("id")
    return spark.range(ROWS).select(
        F.when(i % 3 == 0, 0).otherwise(i % 997).alias("k"),
        F.concat(F.array(*[F.lit(m) for m in MONTHS])[F.pmod(F.hash("id"), F.lit(12))],
                 F.lit(" "), (1990 + (i * 7) % 40).cast("string")).alias("period_label"),
        F.when(F.hash("id") % 5 != 0, (i * 31 % 1009).cast("double")).alias("v"),
        F.when(F.hash("id") % 4 != 0, F.concat(F.lit("s"), i % 13)).alias("s"),
        F.concat(F.lit("m"), i * 17 % 6).alias("member"), (i * 17 % 6).cast("int").alias("rank"),
        i.alias("pos")).repartition(8).persist()


@pytest.fixture(scope="module")
def frame(hot):
    return hot.toPandas().sort_values("pos")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(got: pd.DataFrame, want: pd.DataFrame, keys):
    got = got.sort_values(keys).reset_index(drop=True)[list(want.columns)]
    want = want.sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_fold(hot, frame):
    folded = merge.fold_rows(hot, ["k", "period_label"], ["v", "s"], ["pos"])
    assert "partial_max_by" in plan(folded)
    want = frame.groupby(["k", "period_label"], as_index=False)[["v", "s"]].last()
    got = folded.toPandas().where(lambda x: x.notna(), None)
    same(got, want.where(want.notna(), None), ["k", "period_label"])


def test_merge(hot, frame):
    merged = merge.merge_by_key(hot, "k", ["s", "v"], "member", ["rank", "pos"])
    assert plan(merged).count("partial_min_by") == 2
    first = frame.sort_values(["rank", "pos"]).groupby("k").head(1)[["k", "s", "v"]]
    members = frame.sort_values(["rank", "pos"]).groupby("k").member.unique().map(list)
    got = merged.toPandas()
    assert got.set_index("k").index_keys.map(list).to_dict() == members.to_dict()
    nulls = first.where(first.notna(), None)
    same(got.where(got.notna(), None), nulls, ["k"])


def test_latest(hot, frame):
    folded = merge.fold_rows(hot, ["k", "period_label"], ["v"], ["pos"])
    ranked = latest.latest_periods(folded, ["k"], 3)
    assert plan(ranked).count("WindowGroupLimit") == 2
    dated = frame.assign(
        y=frame.period_label.str[-4:].astype(int), m=frame.period_label.str[:3].map(MONTHS.index))
    want = (dated.drop_duplicates(["k", "y", "m"]).sort_values(["y", "m"], ascending=False)
            .groupby("k").head(3)[["k", "period_label"]])
    same(ranked.toPandas(), want, ["k", "period_label"])


def test_upsert_and_replace(spark, hot, frame):
    old = hot.where("pos % 2 = 0").groupBy("k").agg(F.max("v").alias("v"))
    result = upsert.upsert(old, hot.where("pos % 2 = 1"), ["k"], ["v"], "2026-01-01", order=["pos"])
    assert plan(result).count("Exchange hashpartitioning") <= 2
    even = frame[frame.pos % 2 == 0].groupby("k").v.max()
    odd = frame[frame.pos % 2 == 1].groupby("k").v.last()
    want = odd.combine_first(even).reset_index()
    same(result.select("k", "v").toPandas(), want, ["k"])

    incoming = hot.where("k % 2 = 0 AND pos % 5 = 0").select("k", "pos")
    kept = replace.replace_given(hot.select("k", "pos"), incoming, "k")
    replaced = set(frame[(frame.k % 2 == 0) & (frame.pos % 5 == 0)].k)
    want = frame[~frame.k.isin(replaced) | ((frame.k % 2 == 0) & (frame.pos % 5 == 0))][["k", "pos"]]
    same(kept.toPandas(), want, ["pos"])


def test_reference_rule_meets_one_row_per_key(spark, hot, frame):
    parent = spark.createDataFrame([(0,)], "k long")
    rule = quality.reference_rule(hot, "k", parent, "k", "r")
    assert rule.first().violations == int((frame.k != 0).sum())
