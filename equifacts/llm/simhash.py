"""SimHash near-duplicates by pigeonhole blocks.

A text's fingerprint is the bitwise majority of the hashes of its word shingles. Fingerprints
are made distinct and cut into four blocks of 16 bits; two that differ in at most two bits agree
in two blocks at least, so the join is on every choice of two blocks, and a pair counts when its
Hamming distance, taken on the whole fingerprints, is small enough. Where more fingerprints than
``BUCKET`` agree in the same bits, their other bits are cut into blocks once more, and so on: the
bits left hold at most ``2**8`` fingerprints in the end, so no bucket outgrows ``BUCKET`` however
many fingerprints are alike, and no pair is lost. A fingerprint has at most 2,080 others within
two bits, so the links grow with the fingerprints, not with their square.

Defined cases: a null text counts as empty; a text without words has fingerprint zero and is
linked like any other; a text of fewer words than a shingle is one shingle of all its words.
Rows with null ids take part; a component is named by its smallest id, null if it has none.
Repeated rows and copies share a fingerprint, each keeps its row. An empty table gives an empty
result. Further columns do not take part.
"""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equifacts.llm.graph import components
from equifacts.session import stage

SHINGLE = 3
DISTANCE = 2
SEED = 42
BITS = 64
BUCKET = 256
_CHUNK = 1 << 16


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of the lower-cased text's words, joined by one space."""
    # Bytes' lower() and split() know ASCII letters and ASCII white space only.
    words = text.lower().split()
    joined = b" ".join(words)
    size = min(size, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist(), strict=True)),
        np.uint64, len(starts))


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Bits set in more than half of the text's shingle hashes; zero without words."""
    if not text or not text.strip():
        return 0
    hashes = shingle_hashes(text, size)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at:at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` of each row; ``fp`` is the fingerprint as a signed number."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def read(batches):
        for batch in batches:
            prints = np.fromiter(
                (fingerprint(t, size) for t in batch.column("text").to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"doc_id {kind}, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def block_masks(free: int, kept: int, distance: int, blocks: int) -> list[int]:
    """Masks that keep the bits ``kept`` and each choice of all but ``distance`` of the blocks
    that the bits ``free`` are cut into."""
    bits = [1 << b for b in range(BITS) if free >> b & 1]
    cut = [sum(part.tolist()) if len(part) else 0 for part in (
        np.array(bits[k * len(bits) // blocks:(k + 1) * len(bits) // blocks], object) for k in range(blocks))]
    return [kept | sum(choice) for choice in itertools.combinations(cut, blocks - distance)]


def _finer(mask: Column, masks: set[int], distance: int) -> Column:
    """The masks that come after ``mask``, which is one of ``masks``."""
    everything = (1 << BITS) - 1
    after = F.create_map(*itertools.chain.from_iterable(
        (F.lit(_signed(m)), F.array(*[F.lit(_signed(n)) for n in block_masks(
            everything & ~m, m, distance, distance + 1)])) for m in sorted(masks)))
    return after[mask]


def links(prints: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET, blocks: int = 4) -> DataFrame:
    """``(u, v)``: pairs of distinct fingerprints that differ in few enough bits, ``u < v``.

    ``prints`` holds each fingerprint once, in ``fp``.
    """
    everything = (1 << BITS) - 1
    masks = set(block_masks(everything, 0, distance, blocks))
    found = None
    dealt = prints.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in sorted(masks)])).alias("mask"))
    while True:
        keyed = dealt.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = stage(
            keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-buckets")
        # Masks whose free bits hold no more than a bucket need no further cut.
        final = [_signed(m) for m in masks if 2 ** (BITS - m.bit_count()) <= bucket]
        large = (F.col("n") > bucket) & ~F.col("mask").isin(final) if final else F.col("n") > bucket
        members = stage(keyed.join(sizes, ["mask", "key"]).select(
            "mask", "key", "fp", large.alias("large")), "simhash-members")
        small = members.where("not large").select("mask", "key", "fp")
        other = small.withColumnRenamed("fp", "other")
        pairs = small.join(other, ["mask", "key"]).where(
            (F.col("fp") < F.col("other"))
            & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance)).select(
            F.col("fp").alias("u"), F.col("other").alias("v"))
        found = pairs if found is None else found.union(pairs)
        rest = members.where("large")
        now = {r.mask & everything for r in rest.select("mask").distinct().collect()}
        if not now:
            return found
        dealt = rest.select("fp", F.explode(_finer(F.col("mask"), now, distance)).alias("mask")).distinct()
        masks = {n for m in now for n in block_masks(everything & ~m, m, distance, distance + 1)}


def near_duplicates(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE,
                    bucket: int = BUCKET) -> DataFrame:
    """A row for each document: its fingerprint in hexadecimal, and its component's smallest id."""
    rows = stage(fingerprints(docs, size), "simhash-rows")
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-prints")
    roots = components(links(prints.select("fp"), distance, bucket))
    linked = stage(prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    names = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    known = stage(linked.join(names, "root").select("fp", "component_id"), "simhash-known")
    return rows.join(known, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
