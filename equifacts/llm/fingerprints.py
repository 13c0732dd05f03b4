"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points has a rolling hash; of every ``WINDOW`` consecutive hashes
the smallest is kept, the rightmost one of equals, with its position. Two texts that share a
run of at least ``WINDOW + GRAM - 1`` code points (21) share a kept hash.

Defined cases: a null text counts as empty; an empty text has an empty fingerprint; a text
shorter than a gram is one gram; texts of fewer grams than a window keep one hash; two empty
fingerprints are alike (1), an empty and another are not (0). Documents stand in the order of
id, then text; null ids come last; equal ids are neighbours; the last document's next is the
first. An empty table gives an empty result. Further columns do not take part.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equifacts.llm.common import partitions, text_of

GRAM = 10
WINDOW = 12
EDITED_PART = 4

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LAST = np.uint64(0xFFFFFFFF)


class Winnower:
    """Fingerprints of texts; keeps the powers that the rolling hash needs."""

    def __init__(self, gram: int = GRAM, window: int = WINDOW):
        self.gram, self.window = gram, window
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, b % 2**64, np.uint64))))
                for b in (_BASE, pow(_BASE, -1, 2**64)))

    def hashes(self, text: str) -> np.ndarray:
        """The 32-bit hash of the run at each position."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(codes)
        if not n:
            return np.zeros(0, np.uint64)
        gram = min(self.gram, n)
        self._grow(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        found = (sums[gram:] - sums[:n - gram + 1]) * self.down[:n - gram + 1]
        found = (found ^ (found >> np.uint64(32))) * _MIX
        return (found ^ (found >> np.uint64(29))) * _MIX >> np.uint64(32)

    def select(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The kept hashes and their positions, in order of position."""
        found = self.hashes(text)
        n = len(found)
        if not n:
            return found, found
        # Of equal hashes the later position makes the smaller key.
        keys = (found << np.uint64(32)) | (_LAST - np.arange(n, dtype=np.uint64))
        if n <= self.window:
            kept = keys.min(keepdims=True)
        else:
            w = self.window
            padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
            padded[:n] = keys
            blocks = padded.reshape(-1, w)
            ahead = np.minimum.accumulate(blocks, axis=1).ravel()
            behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
            low = np.minimum(behind[:n - w + 1], ahead[w - 1:n])
            kept = low[np.concatenate(([True], low[1:] != low[:-1]))]
        return kept >> np.uint64(32), _LAST - (kept & _LAST)


def printed(kept: tuple[np.ndarray, np.ndarray]) -> str:
    """``hash:position`` of each kept hash."""
    return " ".join(f"{h:08x}:{p}" for h, p in zip(*(x.tolist() for x in kept), strict=True))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes, each sorted and without repeats."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``(doc_id, hashes, positions)`` of each row: the kept hashes and where they stand."""
    def work(batches):
        winnower = Winnower(gram, window)
        for batch in batches:
            kept = [winnower.select(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "hashes": [k[0].astype(np.int64) for k in kept],
                "positions": [k[1].astype(np.int64) for k in kept]})

    return docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text")).mapInPandas(
        work, "doc_id string, hashes array<long>, positions array<long>").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def _bucket(bounds: list[int]) -> Column:
    """How many of the sorted bounds a document's id has reached; null ids have reached all."""
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def reached(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids, side="right"))

    return reached(F.coalesce(F.col("doc_id"), F.lit(np.iinfo(np.int64).max)))


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows dealt to buckets of neighbouring ids; each bucket's last rows are ``guests``.

    A guest is the row that the document order has next after a bucket: the first of the next
    one, or, after the last, the first of all. Bounds and first ids are one a bucket; the
    buckets' first ids are broadcast, so the plan does not grow with them.
    """
    spark = docs.sparkSession
    shares = [k / buckets for k in range(1, buckets)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else []
    bounds = sorted({int(b) for b in bounds or []})
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    dealt = ids.withColumn("bucket", _bucket(bounds))
    firsts = dealt.groupBy("bucket").agg(F.min("doc_id").alias("first")).orderBy("bucket").collect()
    # A bucket of null ids only has no smallest id; then all its rows are offered.
    homes = spark.createDataFrame(
        [(row["bucket"], row["first"], firsts[at - 1]["bucket"]) for at, row in enumerate(firsts)],
        "first_of int, first long, home int")
    first = (F.col("bucket") == F.col("first_of")) & F.col("doc_id").eqNullSafe(F.col("first"))
    offered = dealt.join(F.broadcast(homes), first, "left")
    places = F.array(F.struct("bucket", F.lit(False).alias("guest")), F.when(
        F.col("home").isNotNull(), F.struct(F.col("home").alias("bucket"), F.lit(True).alias("guest"))))
    return offered.select("doc_id", "text", F.explode(F.array_compact(places)).alias("place")).select(
        "doc_id", "text", "place.bucket", "place.guest")


def _compare(gram: int, window: int):
    def compare(batches):
        winnower = Winnower(gram, window)

        def known(row):
            kept = winnower.select(row.text)
            return row, kept, np.unique(kept[0])

        def pair(one, other):
            (row, kept, own), (following, _, theirs) = one, other
            text = row.text
            part = len(text) // EDITED_PART
            edited = text[:len(text) - part] + following.text[:part]
            changed = winnower.select(edited)
            return (row.doc_id, len(text),
                    hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                    printed(kept), printed(changed),
                    likeness(own, np.unique(changed[0])), likeness(own, theirs))

        open_row, closed = None, None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.guest and row.bucket == closed:
                    continue  # of several rows with the first id, one is next
                now = known(row)
                if open_row is not None:
                    out.append(pair(open_row, now))
                open_row, closed = (None, row.bucket) if row.guest else (now, closed)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in REPORT.split(", ")])
    return compare


REPORT = ("doc_id string, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def report(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """A row for each document: its fingerprint, its edited text's, and how alike they are.

    The edited text ends in the beginning of the next document's.
    """
    parts = 2 * partitions(docs.sparkSession)
    ordered = with_next(docs, parts).repartition(parts, "bucket").sortWithinPartitions(
        "bucket", "guest", F.col("doc_id").asc_nulls_last(), "text")
    return ordered.select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", "bucket", "guest").mapInPandas(
        _compare(gram, window), REPORT).withColumn("doc_id", F.col("doc_id").cast("long"))
