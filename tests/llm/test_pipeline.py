"""The stages in sequence, each judged on what it was given."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from equifacts.llm import jaccard_join, mixing, packing, quality_rules
from equifacts.session import stage
from tests.llm.test_operators import LONG, WORD, alike, both, counted, rows_of

NAMES = ["quality rules", "near duplicates", "personal data", "mixing", "packing"]


def prose(k, n=40):
    """Words of a text's own; no two texts share a run of them."""
    return " ".join(hashlib.md5(f"{k}-{i}".encode()).hexdigest()[:6].translate(str.maketrans("0123456789", "ghijklmnop"))
                    for i in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, prose(k), "en", f"s{k % 3}") for k in range(30)]
    rows += [(100 + k, prose(k) + f" tail{k}", "en", "s0") for k in range(4)]  # near copies
    rows += [(200, None, None, None), (201, "", "en", "s1"), (202, "too short", "en", "s1"),
             (203, " ".join(["go"] * 60), "en", "s1"), (204, LONG, "en", None),
             (None, prose(900), "en", "s2"), (205, prose(901) + " mail a.b@c.example now", "en", None)]
    rows += [rows[3]] * 5  # repeated rows
    return rows_of(spark, rows).repartition(3)


def test_each_stage_keeps_its_promise(spark, odd):
    docs = odd
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    for name, function in corpus_pipeline.STAGES:
        out = stage(function(spark, docs, ""), f"test-{name.replace(' ', '-')}")
        given, left = both(docs), both(out) if "text" in out.columns else None
        if name != "packing":
            assert out.columns == docs.columns
        if name == "quality rules":
            bad = {t for _, t in given if counted(t)[-1]}
            assert not bad & {t for _, t in left} and {i for i, _ in left} >= {*range(30), 204, 205, None}
        if name == "near duplicates":
            assert len(left) == len(set(left)) and {t for _, t in left} <= {t for _, t in given}
            texts = [t for _, t in left]
            assert not any(alike(a, b) for k, a in enumerate(texts) for b in texts[:k])
            assert all(any(alike(t, kept) for kept in texts) for _, t in given)
        if name == "personal data":
            assert sorted(str(i) for i, _ in left) == sorted(str(i) for i, _ in given)
            assert not any("a.b@c.example" in t for _, t in left)
            assert {i: t for i, t in left if i != 205} == {i: t for i, t in given if i != 205}
        if name == "mixing":
            words, taken = Counter(), Counter()
            for r in docs.collect():
                words[r.source] += len(WORD.findall(r.text))
            for r in out.collect():
                taken[r.source] += len(WORD.findall(r.text))
            aims = {r.source: r.target for r in mixing.targets(mixing.measured(docs)).collect()}
            assert all(abs(taken[s] - aims[s]) <= 1 and aims[s] <= 2 * words[s] + 1e-6 for s in words)
        if name == "packing":
            assert sum(r.n_words for r in out.collect()) == sum(len(WORD.findall(t)) for _, t in given)
            assert all(r.bin_words <= packing.CAPACITY for r in out.collect() if r.n_words)
        docs = out


def test_clashing_columns_and_empty_tables(spark, odd):
    clashing = odd.selectExpr(
        "doc_id", "text", "lang", "source", "n_chars", "1 as row", "'x' as text_key", "2 as root", "3 as key", "4 as words",
        "5 as rank", "6 as node", "7 as kept")
    for frame in (clashing, clashing.limit(0)):
        docs = frame
        for _, function in corpus_pipeline.STAGES[:-1]:
            docs = stage(function(spark, docs, ""), "test-clash")
            assert docs.columns == frame.columns
        rows = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
        assert bool(rows) == (frame is clashing)


def test_whole_table(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    good = quality_rules.keep_good(docs).count()
    classes = jaccard_join.keep_first(quality_rules.keep_good(docs)).count()
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert 0 < classes < good < docs.count() and len({r.doc_id for r in rows}) <= classes
