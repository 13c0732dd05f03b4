"""Cut points against the table of blocks, exact draws, and many sources."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from equifacts.llm import mixing
from tests.llm.test_operators import WORD, bag, docs, empty, given_docs, rows_of  # noqa: F401


def test_cut_points_take_what_the_table_of_blocks_takes(given_docs, docs):
    both = given_docs.select("doc_id", "text", "source").unionByName(docs.select("doc_id", "text", "source"))
    frame = both.unionByName(both.where("doc_id % 3 = 0"))  # repeated rows
    drawn, _ = mixing.mix(mixing.measured(frame, 32), shards=5, block_words=32)
    want = Counter()
    for r in drawn.collect():
        want[r.shard, r.words] += 1
    got = Counter()
    parts = mixing.mixed(frame, shards=5, block_words=32).rdd.glom().collect()
    each = len(parts) // 5
    for k, rows in enumerate(parts):
        for r in rows:
            got[k // each, len(WORD.findall(r.text))] += 1
    assert got == want


def test_equal_rows_are_taken_in_part(spark):
    frame = rows_of(spark, [(1, "a b c d", "en", "x")] * 30 + [(2, "e f", "en", "y")] * 40)
    report = mixing.report(frame, block_words=2).collect()
    out = mixing.mixed(frame, block_words=2).collect()
    words = Counter()
    for r in out:
        words[r.source] += len(r.text.split())
    for source, doc_id in (("x", 1), ("y", 2)):
        assert words[source] == sum(r.taken for r in report if r.doc_id == doc_id)


def chances(good, total, drawn):
    def log_choose(n, k):
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    low, high = max(0, drawn - total + good), min(good, drawn)
    return {k: math.exp(log_choose(good, k) + log_choose(total - good, drawn - k) - log_choose(total, drawn))
            for k in range(low, high + 1)}


@pytest.mark.parametrize("good, total, drawn", [(30, 100, 40), (80, 100, 70), (5, 60, 50), (300, 1000, 500), (9, 10, 5)])
@pytest.mark.parametrize("spread", [-1.0, 500.0])
def test_draws_follow_the_distribution(spark, monkeypatch, good, total, drawn, spread):
    monkeypatch.setattr(mixing, "INVERTED_SPREAD", spread)  # -1: by rejection only
    n = 20_000
    got = Counter(r.k for r in spark.range(n).select(mixing.hypergeometric(
        F.lit(good), F.lit(total), F.lit(drawn), [F.lit(7), F.col("id")]).alias("k")).collect())
    want = chances(good, total, drawn)
    assert set(got) <= set(want)
    square = sum((got[k] - n * p) ** 2 / (n * p) for k, p in want.items() if n * p >= 5)
    free = sum(n * p >= 5 for p in want.values())
    assert square < free + 5 * math.sqrt(2 * free)


def test_wide_draws(spark):
    good, total, drawn = 3 * 10**9, 10**10, 4 * 10**9
    rows = [r.k for r in spark.range(4000).select(mixing.hypergeometric(
        F.lit(good), F.lit(total), F.lit(drawn), [F.lit(1), F.col("id")]).alias("k")).collect()]
    mean = drawn * good / total
    spread = math.sqrt(mean * (1 - good / total) * (total - drawn) / (total - 1))
    assert abs(sum(rows) / len(rows) - mean) < 4 * spread / math.sqrt(len(rows))
    assert 0.94 < math.sqrt(sum((k - mean) ** 2 for k in rows) / len(rows)) / spread < 1.06


def test_groups_of_sources_share_a_draw(spark):
    quotas = {k: 5 + 3 * (k % 7) for k in range(23)}
    frame = spark.createDataFrame(list(quotas.items()), "rank long, quota long")
    totals = [0] * 6
    for r in mixing.split_tree(frame, 6, group=4).collect():
        ends = [*r.starts[1:], quotas[r["rank"]]]
        assert r.starts[0] == 0 and all(b >= a for a, b in zip(r.starts, ends))
        for k, (a, b) in enumerate(zip(r.starts, ends)):
            totals[k] += b - a
    assert sum(totals) == sum(quotas.values()) and max(totals) - min(totals) <= 3


def test_a_hundred_thousand_sources(spark):
    n = 100_000
    frame = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("host"), F.lpad("id", 6, "0")).alias("source"),
        F.when(F.col("id") % 2 == 0, "a b c").otherwise("a b c d e f g").alias("text"))
    drawn, aims = mixing.mix(mixing.measured(frame), shards=4)
    size, target, ranks = aims.agg(F.sum("source_size"), F.sum("target"), F.count_distinct("rank")).first()
    assert ranks == n and size == 5 * n and target == pytest.approx(1.5 * size)
    shares = [tuple(r) for r in drawn.groupBy("shard").agg(F.count("*"), F.sum("words")).collect()]
    blocks = [b for _, b, _ in shares]
    assert len(blocks) == 4 and max(blocks) - min(blocks) <= 3
    assert abs(sum(w for _, _, w in shares) - target) < n


def test_ranks_by_code_point(spark):
    names = ["b", None, "a", "é", "Z", "𝒳", ""]
    frame = rows_of(spark, [(k, "w " * (k + 1), "en", s) for k, s in enumerate(names)])
    aims = mixing.targets(mixing.measured(frame)).collect()
    order = sorted([n for n in names if n is not None]) + [None]
    assert {r.source: r["rank"] for r in aims} == {s: k for k, s in enumerate(order)}


def test_empty(empty):
    assert mixing.mixed(empty).collect() == [] and mixing.report(empty).collect() == []
