"""SimHash near-duplicates against brute force."""

import random
import re

import pytest
import xxhash

from equifacts.llm import simhash
from equifacts.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, low int, fp string"


def brute_print(text):
    text = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = min(3, len(words))
    shingles = [" ".join(words[k:k + n]) for k in range(len(words) - n + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Component number of each fingerprint by a search over all pairs."""
    found, todo = {}, set(prints)
    while todo:
        queue, seen = [todo.pop()], []
        while queue:
            at = queue.pop()
            seen.append(at)
            near = {p for p in todo if (p ^ at).bit_count() <= 2}
            todo -= near
            queue += near
        found.update(dict.fromkeys(seen, min(seen)))
    return found


def expected(rows):
    prints = [brute_print(t) for _, t in rows]
    component = brute_components(prints)
    lowest = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            lowest[component[p]] = min(i, lowest.get(component[p], i))
    return sorted(((i, f"{p:016x}", lowest.get(component[p])) for (i, _), p in zip(rows, prints, strict=True)), key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    frame = QUERIES["op11_simhash"](spark, "/root/testdata/sf0.001")
    assert got(frame) == expected([tuple(r) for r in rows])


def test_odd_rows(spark):
    rng = random.Random(3)
    long = " ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(150_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\f\r "), (4, "One"), (5, "one"), (6, "one TWO"), (7, "a b c"),
        (8, "A  b\nc"), (None, "a b c"), (None, "alone and without an id here"), (8, "A  b\nc"),
        (9, "Éé ÉÉ 𝒳 x y z"), (10, "a b c"), (11, long), (12, long + " more"), (13, "x\x00y z w")]
    frame = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], SCHEMA).repartition(3)
    assert got(simhash.near_duplicates(frame)) == expected(rows)


def test_empty_table(spark):
    frame = simhash.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert frame.columns == ["doc_id", "fingerprint", "component_id"] and got(frame) == []


@pytest.mark.parametrize("bucket", [8, 64, 256])
def test_crowded_buckets_lose_no_link(spark, bucket):
    rng = random.Random(bucket)
    prints = {0, 2**64 - 1, 3}
    for _ in range(4):  # chains and balls round a centre, each in the same few blocks
        centre = rng.getrandbits(64)
        prints.add(centre)
        prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
        for _ in range(60):
            centre ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            prints.add(centre)
    signed = {p - 2**64 if p >> 63 else p for p in prints}
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {tuple(r) for r in simhash.links(frame, bucket=bucket).collect()}
    assert found == {(a, b) for a in signed for b in signed
                     if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}


def test_close_pairs_share_a_mask():
    rng = random.Random(5)
    masks = simhash.block_masks(2**64 - 1, 0, 2, 4)
    assert len(masks) == 6 and all(m.bit_count() == 32 for m in masks)
    for _ in range(300):
        bits = (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        assert any(bits & m == 0 for m in masks)
        mask = rng.choice([m for m in masks if bits & m == 0])
        finer = simhash.block_masks((2**64 - 1) & ~mask, mask, 2, 3)
        assert any(bits & m == 0 for m in finer)
