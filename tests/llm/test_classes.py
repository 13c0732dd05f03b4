"""Classes without counted links are those of the full join; packing keeps them apart on odd rows."""

import random
from collections import Counter

import numpy as np
import pytest

from equifacts.llm import jaccard_join, packing
from tests.llm.test_operators import alike, both, brute_classes, docs, empty, given_docs, rows_of  # noqa: F401


def partition(rows, texts):
    """Ids by class, as sets of the classes' members."""
    found = {}
    joined = rows.join(texts.select("text_key", "root"), "text_key").collect()
    for r in joined:
        found.setdefault(r.root, []).append(str(r.doc_id))
    return Counter(tuple(sorted(m)) for m in found.values())


@pytest.mark.parametrize("seed, similarity", [(1, 0.8), (2, 0.8), (3, 0.5), (4, 0.9)])
def test_stars_leave_no_link_out(seed, similarity):
    rng = random.Random(seed)
    sets = []
    for _ in range(8):  # chains that drift away from their pivots
        grams = list(range(rng.randrange(1000), rng.randrange(1000, 1060)))
        for _ in range(rng.randrange(1, 14)):
            sets.append(np.unique(np.array(grams)))
            grams = [rng.randrange(2000) if rng.random() < 0.07 else g for g in grams]
    rng.shuffle(sets)
    n = len(sets)

    def linked(a, b):
        common = len(np.intersect1d(sets[a], sets[b]))
        return common >= similarity * (len(sets[a]) + len(sets[b]) - common) - 1e-9

    root = list(range(n))
    for a in range(n):
        for b in range(a):
            if linked(a, b) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    got, pivot, distance = jaccard_join.stars(sets, similarity)
    groups = {}
    for a in range(n):
        groups.setdefault(root[a], set()).add(got[a])
    assert all(len(g) == 1 for g in groups.values()) and len(set(got)) == len(groups)
    assert all(got[p] == got[k] for k, p in enumerate(pivot)) and max(distance) <= 1 - similarity + 1e-9


@pytest.mark.parametrize("table", ["docs", "given_docs"])
def test_classes_equal_those_of_the_full_join(request, table):
    frame = request.getfixturevalue(table)
    assert partition(*jaccard_join.class_roots(frame)) == partition(*jaccard_join.classes(frame))


@pytest.mark.parametrize("block", [3, 7, 20])
def test_small_blocks_lose_no_class(spark, monkeypatch, block):
    rng = random.Random(block)
    texts = []
    for family in range(3):  # chains of texts: neighbours are alike, ends are not
        words = [f"f{family}w{k}" for k in range(160)]
        for n in range(14):
            texts.append((len(texts), " ".join(words), "en", "a"))
            at = rng.randrange(150)
            words[at:at + 4] = [f"x{family}n{n}k{k}" for k in range(4)]
    rng.shuffle(texts)
    frame = rows_of(spark, texts)
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", block)
    rows, found = jaccard_join.class_roots(frame)
    got = {r.doc_id: r.root for r in rows.join(found.select("text_key", "root"), "text_key").collect()}
    want = {}
    pairs = both(frame)
    for i, low, _ in brute_classes(pairs):
        want.setdefault(low, set()).add(i)
    assert Counter(Counter(got.values()).values()) == Counter(len(m) for m in want.values())
    assert all(len({got[i] for i in m}) == 1 for m in want.values())


def test_odd_rows_apart(docs, empty, spark):
    rows = packing.pack_apart(docs, capacity=500, shard_docs=4).collect()
    want = Counter()
    for i, text in both(docs):
        want[i] += len(text.split())
    sizes = Counter()
    for r in rows:
        sizes[r.doc_id] += r.n_words
    assert sizes == want and all((r.bin_id is None) == (r.n_words == 0) for r in rows)
    text = {i: t for i, t in both(docs)}
    bins = {}
    for r in rows:
        if r.n_words:
            bins.setdefault(r.bin_id, []).append(r.doc_id)
    for held in bins.values():
        assert not any(alike(text[a], text[b]) for k, a in enumerate(held) for b in held[:k])
    assert packing.pack_apart(empty).collect() == []


def test_repeated_rows_spread_over_shards(spark):
    frame = rows_of(spark, [(1, "the same five words here", "en", "a")] * 200 + [(2, "other words", "en", "b")])
    rows = packing.pack_documents(frame, shard_docs=20).collect()
    assert len(rows) == 201
    shards = Counter(r.bin_id >> packing.SHARD_BITS for r in rows)
    assert len(shards) > 6 and max(shards.values()) < 60
