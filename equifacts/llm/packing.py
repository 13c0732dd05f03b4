"""Conflict-constrained best-fit packing of documents into bins of fixed size.

A bin holds at most one piece of each source and one of each cluster of copies. Documents are
dealt to shards of bounded size by hash, so that hot sources and copies spread evenly; within
a shard pieces go in, largest first. Open bins stand in order of what room they have left and
carry bitmaps of their sources and clusters. The search starts at the first bin with room and
goes on to its successors until a compatible one is found: the tightest there is.

Defined cases: a document longer than a bin is cut into full pieces and a rest; a document
without words keeps a row without a bin; null sources are one source; a null text counts as
empty; repeated rows are copies of each other; an empty table gives an empty result; further
columns do not take part.
"""

import math
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equifacts.llm.common import text_of, words_of
from equifacts.llm.jaccard_join import class_roots, text_key
from equifacts.session import stage

CAPACITY = 2048
SHARD_DOCS = 4096
SHARD_BITS = 32

RESULT = ("doc_id long, piece long, first_word long, n_words long, bin_id long, slot long, "
          "bin_words long")


def best_fit(pieces, capacity: int) -> tuple[list, list]:
    """The bin of each piece ``(size, source, cluster)``, in order, and each bin's words.

    ``room`` holds ``(room left, bin)`` of the bins that still have room, in order.
    """
    room, sources, clusters, used, chosen = [], [], [], [], []
    bits: dict = {}
    for size, source, cluster in pieces:
        source_bit = 1 << bits.setdefault(("source", source), len(bits))
        cluster_bit = 1 << bits.setdefault(("cluster", cluster), len(bits))
        at = bisect_left(room, (size, -1))
        while at < len(room):
            which = room[at][1]
            if not (sources[which] & source_bit or clusters[which] & cluster_bit):
                break
            at += 1
        if at < len(room):
            left = room.pop(at)[0] - size
        else:
            which, left = len(used), capacity - size
            sources.append(0)
            clusters.append(0)
            used.append(0)
        sources[which] |= source_bit
        clusters[which] |= cluster_bit
        used[which] += size
        if left:
            insort(room, (left, which))
        chosen.append(which)
    return chosen, used


def _pack(capacity: int):
    def pack(key: tuple, docs: pd.DataFrame) -> pd.DataFrame:
        out = []
        for n_words, doc_id, source, cluster in zip(
                docs["n_words"], docs["doc_id"], docs["source"], docs["cluster"], strict=True):
            for piece, first in enumerate(range(0, max(n_words, 1), capacity)):
                out.append((min(capacity, n_words - first), doc_id, piece, first, source, cluster))
        # Equal rows are interchangeable; everything else has a fixed order.
        out.sort(key=lambda p: (-p[0], str(p[1]), p[5], str(p[4]), p[2]))
        full = [p for p in out if p[0]]
        chosen, used = best_fit([(p[0], p[4], p[5]) for p in full], capacity)
        slots = [0] * len(used)
        rows = []
        for piece, which in zip(full, chosen, strict=True):
            rows.append((piece[1], piece[2], piece[3], piece[0], (key[0] << SHARD_BITS) + which,
                         slots[which], used[which]))
            slots[which] += 1
        rows += [(p[1], 0, 0, 0, None, None, None) for p in out if not p[0]]
        names = [c.split()[0] for c in RESULT.split(", ")]
        return pd.DataFrame(rows, columns=names).astype("Int64")
    return pack


def _sized(docs: DataFrame, cluster: Column) -> DataFrame:
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), cluster.cast("string").alias("cluster"),
        F.size(words_of(text_of())).cast("long").alias("n_words"))


def _packed(sized: DataFrame, capacity: int, shard_docs: int) -> DataFrame:
    """Rows of ``_sized``, dealt to shards by a hash and packed there.

    Repeated rows are counted and numbered, so that they spread over shards like any others.
    """
    counted = stage(
        sized.groupBy("doc_id", "source", "cluster", "n_words").agg(F.count("*").alias("n")), "pack-sizes")
    total = counted.agg(F.sum("n")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_docs))
    # In two steps: numbers of a row repeated very often are never one array.
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / shard_docs))))
    first = F.col("run") * shard_docs
    rows = runs.withColumn("nth", F.explode(F.sequence(first, F.least(first + shard_docs, "n") - 1)))
    spread = F.xxhash64("doc_id", "cluster", "nth")
    return rows.withColumn("shard", F.pmod(spread, F.lit(shards))).select(
        "shard", "doc_id", "source", "cluster", "n_words").groupBy("shard").applyInPandas(_pack(capacity), RESULT)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS,
                   cluster: Column | None = None) -> DataFrame:
    """A row for each piece of a document: its bin, its place there, and the bin's words.

    ``cluster`` tells which documents are copies of each other; equal words if not given.
    """
    if cluster is None:
        cluster = F.xxhash64(words_of(text_of()))
    return _packed(_sized(docs, cluster), capacity, shard_docs)


def pack_apart(docs: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """``pack_documents`` with near copies kept apart: a cluster is a class of near copies.

    A class is named by its smallest text key, so that bins do not depend on how texts were
    numbered.
    """
    _, texts = class_roots(docs)
    names = texts.groupBy("root").agg(F.min("text_key").alias("class_key"))
    known = stage(texts.join(names, "root").select(
        F.hex("text_key").alias("cluster"), F.hex("class_key").alias("class")), "pack-classes")
    # Words are counted before the join, so texts stay where they are.
    sized = _sized(docs, F.hex(text_key(text_of()))).join(known, "cluster").select(
        "doc_id", "source", F.col("class").alias("cluster"), "n_words")
    return _packed(sized, capacity, shard_docs)
