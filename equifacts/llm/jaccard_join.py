"""N-gram Jaccard self-join of texts by MinHash banding, with exact checks.

Equal texts are first reduced to one row. Each text gets a MinHash signature, cut into bands;
texts that agree in a band are candidates. Candidates are put together by component, and each
component's texts are compared on their full n-gram sets, in blocks of bounded size when the
component is large. Only counts and the links that keep a class together leave a block,
never its pairs.

Defined cases: a null text counts as empty. A text of fewer words than an n-gram is a single
gram of all its words. A text without words is like its copies only. Rows with null ids
take part; a class's id is its smallest id, null if it has none. Repeated rows are copies.
An empty table gives an empty result. Further columns do not take part.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equifacts.llm.common import text_of
from equifacts.llm.graph import components
from equifacts.session import stage

WORDS_IN_GRAM = 5
SIMILARITY = 0.8
RECALL = 0.9995
HASHES = 128
BLOCK_TEXTS = 1000
BLOCK_GRAMS = 1_000_000
SEED = 20240

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def bands_for(similarity: float, recall: float, hashes: int) -> tuple[int, int]:
    """Bands and rows a band: the most selective bands that reach the recall.

    A pair of the given similarity shares a band with probability ``1 - (1 - s**r)**b``; of all
    ``r`` for which ``b * r <= hashes`` reaches the recall, the largest is taken, then the
    fewest bands that suffice.
    """
    for rows in range(hashes, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands * rows <= hashes:
            return bands, rows
    raise ValueError("no banding of so few hashes reaches the recall")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of the rolling base and of its inverse, as long as the longest text so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, b, np.uint64))))
                for b in (_BASE, _BASE_INVERSE))


def grams_of(text: str, size: int, powers: _Powers) -> np.ndarray:
    """Hashes of the text's n-grams of words, in their order."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64)
    powers.grow(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[:len(data)], out=sums[1:])
    words = _mixed((sums[end] - sums[start]) * powers.down[start])
    size = min(size, len(words))
    n = len(words) - size + 1
    grams = np.zeros(n, np.uint64)
    for k in range(size):
        grams = grams * _BASE + words[k:n + k]
    return _mixed(grams + np.uint64(size))


def _signature(grams: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 1024):
        part = grams[at:at + 1024, None] * factors + offsets
        np.minimum(low, part.min(axis=0), out=low)
    return low


def _sketcher(size: int, bands: int, rows: int):
    def sketch(batches):
        draw = np.random.default_rng(SEED)
        factors = draw.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        offsets = draw.integers(0, 2**63, bands * rows, dtype=np.uint64)
        weights = draw.integers(1, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        salt = np.arange(bands, dtype=np.uint64) * _BASE
        powers = _Powers()
        for batch in batches:
            counts, found = [], []
            for text in batch["text"]:
                grams = grams_of(text, size, powers)
                counts.append(len(grams))
                if len(grams):
                    low = _signature(grams, factors, offsets).reshape(bands, rows)
                    found.append(_mixed((low * weights).sum(axis=1, dtype=np.uint64) + salt).view(np.int64))
                else:
                    found.append(np.zeros(0, np.int64))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "text_key": batch["text_key"],
                "n_grams": counts, "bands": found})
    return sketch


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def sketches(docs: DataFrame, size=WORDS_IN_GRAM, similarity=SIMILARITY, recall=RECALL,
             hashes=HASHES) -> DataFrame:
    """``(doc_id, text_key, n_grams, bands)`` of each row."""
    bands, rows = bands_for(similarity, recall, hashes)
    # Ids of a table without numbers as ids would not survive pandas when null.
    source = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text")).select(
        "doc_id", "text", text_key(F.col("text")).alias("text_key"))
    return source.mapInPandas(
        _sketcher(size, bands, rows),
        "doc_id string, text_key binary, n_grams long, bands array<long>").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def distinct_texts(sketched: DataFrame) -> DataFrame:
    """One row a text: an exact number for it, its smallest id and its copies."""
    return stage(
        sketched.groupBy("text_key").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"),
            F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "jaccard-texts")


def candidate_components(texts: DataFrame) -> DataFrame:
    """``(node, root)`` of the texts that share a band with another."""
    members = texts.select("node", F.explode("bands").alias("band"))
    shared = stage(
        members.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("v"))
        .where("n > 1").select("band", "v"), "jaccard-bands")
    edges = members.join(shared, "band").select(F.col("node").alias("u"), "v")
    return components(edges)


def _with_blocks(members: DataFrame) -> DataFrame:
    """Members with the number of blocks of their component; a small component is one block."""
    sizes = stage(
        members.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_grams").alias("grams"))
        .select("root", F.ceil(F.greatest(
            F.col("n") / BLOCK_TEXTS, F.col("grams") / BLOCK_GRAMS)).cast("int").alias("blocks"))
        .where("blocks > 1"), "jaccard-sizes")
    return members.join(sizes, "root", "left").fillna(1, ["blocks"])


def _dealt(members: DataFrame) -> DataFrame:
    """Members dealt to pairs of blocks."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (
        members.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}))


def _alike(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Matrix of the pairs of sets that reach the similarity."""
    sizes = np.array([len(s) for s in sets], np.float64)
    rows = np.repeat(np.arange(len(sets)), sizes.astype(int))
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count[column] > 1
    rows, column = rows[often], np.unique(column[often], return_inverse=True)[1]
    common = np.zeros((len(sets), len(sets)))
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    wide = max(1, 4_000_000 // len(sets))
    for at in range(0, (column[-1] + 1) if len(column) else 0, wide):
        a, b = np.searchsorted(column, (at, at + wide))
        part = np.zeros((len(sets), wide), np.float32)
        part[rows[a:b], column[a:b] - at] = 1
        common += part @ part.T
    return common >= similarity * (sizes[:, None] + sizes - common) - 1e-9


def _checker(size: int, similarity: float):
    def check(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        block = block.drop_duplicates("node").sort_values("node")
        powers = _Powers()
        alike = _alike([np.unique(grams_of(t, size, powers)) for t in block["text"]], similarity)
        own = block["own"].to_numpy()
        counted = alike & ((own[:, None] != own) if i != j else True)
        np.fill_diagonal(counted, False)
        nodes = block["node"].to_numpy()
        root = np.arange(len(nodes))
        while True:  # the smallest row that links reach, a step at a time
            reach = np.where(counted, root, len(nodes)).min(axis=1, initial=len(nodes))
            now = np.minimum(root, reach)
            now = now[now]
            if (now == root).all():
                break
            root = now
        links = counted @ block["copies"].to_numpy(np.int64)
        return pd.DataFrame({"node": nodes, "low": nodes[root], "links": links})
    return check


def _candidates(docs: DataFrame, size, similarity, recall, hashes) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' text keys, the distinct texts, and the candidates among these, each once, with
    their texts, the smallest node of their component and its number of blocks."""
    sketched = stage(sketches(docs, size, similarity, recall, hashes), "jaccard-sketches")
    texts = distinct_texts(sketched)
    plain = texts.drop("bands")
    found = _with_blocks(stage(plain.join(candidate_components(texts), "node"), "jaccard-candidates"))
    # The smallest id and the key lead to one row of each candidate text, or to equal ones.
    row = F.coalesce(F.col("doc_id"), F.xxhash64("text_key"))
    wanted = found.select(
        "node", "root", "copies", "n_grams", "blocks", row.alias("row"), "text_key").hint("shuffle_hash")
    full = docs.select("doc_id", text_of().alias("text")).withColumn(
        "text_key", text_key(F.col("text"))).select(
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text_key")).alias("row"),
        "text_key", "text")
    once = full.join(wanted, ["row", "text_key"]).dropDuplicates(["row", "text_key"])
    return sketched.select("doc_id", "text_key"), plain, once.drop("row", "text_key")


def classes(docs: DataFrame, size=WORDS_IN_GRAM, similarity=SIMILARITY, recall=RECALL,
            hashes=HASHES) -> tuple[DataFrame, DataFrame]:
    """The rows' text keys, and a class and its links for each distinct text.

    The second frame holds ``text_key, node, doc_id`` (the text's smallest), ``copies``,
    ``root`` (the class, by its smallest node), ``links`` (documents with another text that
    reach the similarity).
    """
    rows, plain, found = _candidates(docs, size, similarity, recall, hashes)
    checked = stage(
        _dealt(found)
        .select("root", "i", "j", "own", "node", "copies", "text")
        .groupBy("root", "i", "j")
        .applyInPandas(_checker(size, similarity), "node long, low long, links long"),
        "jaccard-checked")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("node").alias("u"), F.col("low").alias("v")))
    linked = plain.join(links, "node", "left").join(roots, "node", "left").select(
        "text_key", "node", "doc_id", "copies",
        F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    return rows, stage(linked, "jaccard-classes")


class _Sets:
    """Gram sets side by side, to count what one has in common with each."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        grams, self.column = np.unique(np.concatenate(sets), return_inverse=True)
        self.flags = np.zeros(len(grams), np.int64)

    def likeness(self, k: int) -> np.ndarray:
        own = self.column[self.starts[k]:self.starts[k] + self.sizes[k]]
        self.flags[own] = 1
        common = np.add.reduceat(self.flags[self.column], self.starts)
        self.flags[own] = 0
        return common / (self.sizes[k] + self.sizes - common)


class _Union:
    def __init__(self, n: int):
        self.root = np.arange(n)

    def of(self, k: int) -> int:
        while self.root[k] != k:
            self.root[k] = k = self.root[self.root[k]]
        return int(k)

    def join(self, members) -> None:
        tops = {self.of(m) for m in members}
        self.root[list(tops)] = min(tops)


def stars(sets: list[np.ndarray], similarity: float) -> tuple[list[int], list[int], np.ndarray]:
    """The class of each set, the pivot it was put with, and its distance from that.

    A set is compared with all others when it is the first that no pivot reached, and a pivot then
    takes what it reaches. Jaccard distance keeps the triangle inequality, so another set can reach
    one of the pivot's only if it lies within the pivot's radius and one link's length; such sets
    are compared with all others too, unless they share the pivot's class already. No link between
    two classes is left out.
    """
    table, union, reach = _Sets(sets), _Union(len(sets)), 1 - similarity + 1e-9
    pivot, distance = np.full(len(sets), -1), np.zeros(len(sets))
    near = []
    for k in range(len(sets)):
        if pivot[k] < 0:
            away = 1 - table.likeness(k)
            linked = away <= reach
            new = linked & (pivot < 0)
            pivot[new], distance[new] = k, away[new]
            union.join([k, *np.flatnonzero(linked)])
            doubtful = ~linked & (away <= reach + away[new].max(initial=0.0))
            near += [(k, other) for other in np.flatnonzero(doubtful)]
    compared = set(np.unique(pivot).tolist())
    for k, other in near:
        if other not in compared and union.of(k) != union.of(other):
            compared.add(other)
            union.join([other, *np.flatnonzero(1 - table.likeness(other) <= reach)])
    return [union.of(k) for k in range(len(sets))], pivot.tolist(), distance


def _gram_sets(texts, size: int) -> list[np.ndarray]:
    powers = _Powers()
    return [np.unique(grams_of(t, size, powers)) for t in texts]


def _block_classes(size: int, similarity: float):
    def check(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("node", ignore_index=True)
        root, _, _ = stars(_gram_sets(block["text"], size), similarity)
        nodes = block["node"].to_numpy()
        return pd.DataFrame({"node": nodes, "low": nodes[root], "blocks": block["blocks"]})
    return check


def class_roots(docs: DataFrame, size=WORDS_IN_GRAM, similarity=SIMILARITY, recall=RECALL,
                hashes=HASHES) -> tuple[DataFrame, DataFrame]:
    """The rows' text keys, and ``text_key, node, doc_id, copies, root`` of each distinct text.

    The classes are those of ``classes``; links are not counted, so not all pairs are compared. Each
    pair of a large component's blocks finds its classes apart; what these share is put together.
    """
    rows, plain, found = _candidates(docs, size, similarity, recall, hashes)
    local = stage(
        _dealt(found).select("root", "i", "j", "node", "blocks", "text").groupBy("root", "i", "j").applyInPandas(
            _block_classes(size, similarity), "node long, low long, blocks int"), "jaccard-local")
    roots = local.where("blocks = 1").select("node", F.col("low").alias("root"))
    met = local.where("blocks > 1").select(F.col("node").alias("u"), F.col("low").alias("v"))
    if not met.isEmpty():
        roots = roots.union(components(met).select("node", "root"))
    return rows, stage(plain.join(roots, "node", "left").select(
        "text_key", "node", "doc_id", "copies", F.coalesce("root", "node").alias("root")), "jaccard-roots")


def join_report(docs: DataFrame, **options) -> DataFrame:
    """A row for each document: its class, and how many other documents it is linked to."""
    rows, texts = classes(docs, **options)
    ids = stage(texts.groupBy("root").agg(F.min("doc_id").alias("class_id")), "jaccard-ids")
    known = stage(
        texts.join(ids, "root").select(
            "text_key", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links")),
        "jaccard-known")
    return rows.join(known, "text_key").select("doc_id", "class_id", "n_links")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, that of the smallest id, with all its columns."""
    _, texts = class_roots(docs, **options)
    first = texts.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "node", "text_key")).alias("f")).select(
        F.coalesce("f.doc_id", F.xxhash64("f.text_key")).alias("row"), "f.text_key")
    key = text_key(text_of())
    keyed = docs.select(
        F.struct("*").alias("kept"), key.alias("text_key"),
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(key)).alias("row"))
    return keyed.join(first.hint("shuffle_hash"), ["row", "text_key"]).dropDuplicates(
        ["row", "text_key"]).select("kept.*")
