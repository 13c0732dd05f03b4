"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Built-in functions only. A document's words are cut into blocks. Each source's blocks stand in
a random but fixed order; the source's target decides how many whole rounds of that order and
how much of a last round the mix takes. These exact quotas of blocks are split over the output
shards by a binary tree: at each node the left half's share of every source is drawn from the
multivariate hypergeometric distribution, first between groups of ``GROUP`` sources, then in each
group one source after the other. Draws are exact at every size: a narrow distribution is inverted,
a wide one drawn by rejection. A shard then takes its own stretch of each source's order, so no two
shards share a block, and a hash gives the order within the shard. The mix is written shard by
shard, a row for each block; the report tells the words that each shard takes of a document.

Where a stretch begins is a place in the order of a hash, so a few cut points a source tell every
block where it goes: documents meet these, not a table of blocks, and only blocks are shuffled.

Defined cases: null text counts as empty; null sources are one source, the last; a document
without words takes no part and takes 0; repeated rows are each their own document; an empty
table gives an empty result; further columns do not take part. Draws depend on the rows and
the seed only.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equifacts.llm.common import GAP, let, partitions, text_of, words_of
from equifacts.session import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 256
SHARDS = 16
SEED = 11
BUCKET_BLOCKS = 50_000
GROUP = 1024
INVERTED_SPREAD = 500.0
TRIES = 64
# Width and offset of the table mountain hat over a unimodal distribution.
HAT_WIDTH, HAT_OFFSET = 2 * math.sqrt(2 / math.e), 3 - 2 * math.sqrt(3 / math.e)


def _ranked(found: DataFrame) -> DataFrame:
    """Sources with their place by code point, null last, counted over ranges of them."""
    order = F.col("source").asc_nulls_last()
    placed = stage(
        found.repartitionByRange(order).sortWithinPartitions(order)
        .withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("at", 33)
    # A row for each range, of which there are as many as shuffle partitions at most.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return placed.withColumn("part", part).join(ranges, "part").withColumn(
        "rank", (F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")).drop(
        "part", "first", "at")


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """``(source, rank, source_size, n_blocks, target)`` by the sources' weights.

    A source's fair amount is its weight times the level at which all targets add up. Sources that
    it would take beyond their limit stop there and raise the level for the others, until none is
    above; each round is one aggregate over the sources.
    """
    found = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum("n_blocks").alias("n_blocks"))
    ranked = stage(_ranked(found).withColumn(
        "weight", F.get(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights)).cast("int")).cast("double")
    ).withColumn("limit", F.col("source_size") * float(repeats)), "mix-ranked")
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level, stopped = (total or 0) * float(share) / (weight or 1.0), 0
    while True:
        over = F.col("limit") < F.col("weight") * level
        n, held, free = ranked.agg(
            F.count_if(over), F.sum(F.when(over, F.col("limit"))), F.sum(F.when(~over, F.col("weight")))).first()
        if n == stopped or not free:
            break
        level, stopped = (total * float(share) - held) / free, n
    return ranked.select(
        "source", "rank", "source_size", "n_blocks", F.least("limit", level * F.col("weight")).alias("target"))


def _uniform(*parts) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(2**53)


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function at ``x >= 1``, by its series at ``x + 8``."""
    def series(z: Column) -> Column:
        return ((z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z)
                - 1 / (360 * z * z * z))

    down = sum((F.log(x + k) for k in range(8)), F.lit(0.0))
    return series(x + 8) - down


def _log_choose(n: Column, k: Column) -> Column:
    return _log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0)


def _rejection(p: Column, key: list[Column]) -> Column:
    """A draw by rejection from a table mountain hat over the distribution; null where ``TRIES``
    pairs of numbers fail, of which each does with a chance below a half."""
    small, large = F.least(p["g"], p["t"] - p["g"]), F.greatest(p["g"], p["t"] - p["g"])
    few = F.least(p["d"], p["t"] - p["d"])

    def draw(q: Column) -> Column:
        def weight(k: Column) -> Column:
            return (_log_gamma(k + 1.0) + _log_gamma(q["small"] - k + 1.0) + _log_gamma(q["few"] - k + 1.0)
                    + _log_gamma(q["large"] - q["few"] + k + 1.0))

        top = F.floor((q["few"] + 1) * (q["small"] + 1) / (p["t"] + 2)).cast("double")
        width = HAT_WIDTH * F.sqrt(p["spread"] * p["spread"] + 0.5) + HAT_OFFSET
        centre = q["few"] * q["small"] / p["t"] + 0.5

        def attempt(acc: Column, n: Column) -> Column:
            x, y = _uniform(*key, F.lit("x"), n), _uniform(*key, F.lit("y"), n)

            def judged(c: Column) -> Column:
                k = F.floor(c["at"]).cast("double")
                inside = (k >= 0) & (k <= F.least(q["small"], q["few"]))
                return F.when(inside, F.when(2 * F.log(c["x"]) <= c["peak"] - weight(k), k))

            tried = let(F.struct((centre + width * (y - 0.5) / x).alias("at"), x.alias("x"),
                                 weight(top).alias("peak")), judged)
            return F.coalesce(acc, tried)

        found = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("double"), attempt)

        def mirrored(k: Column) -> Column:  # back from the smaller kind and the smaller draw
            kind = F.when(p["g"] > p["t"] - p["g"], q["few"] - k).otherwise(k)
            return F.when(q["few"] < p["d"], p["g"] - kind).otherwise(kind)

        return let(found, mirrored)

    return let(F.struct(small.alias("small"), large.alias("large"), few.alias("few")), draw)


def hypergeometric(good: Column, total: Column, drawn: Column, key: list[Column]) -> Column:
    """How many of ``drawn`` out of ``total`` are among its ``good`` ones; ``key`` gives the chance.

    Up to a spread of ``INVERTED_SPREAD`` the distribution function is inverted, over ten spreads
    round the mean; beyond it rejection draws from the same distribution in a few steps. Both are
    exact but for the rounding of doubles.
    """
    g, t, d = (c.cast("double") for c in (good, total, drawn))
    low, high = F.greatest(F.lit(0.0), d - (t - g)), F.least(g, d)
    mean = d * g / F.greatest(t, F.lit(1.0))
    spread = F.sqrt(F.greatest(F.lit(0.0), mean * (1 - g / F.greatest(t, F.lit(1.0))) * (t - d)
                               / F.greatest(t - 1, F.lit(1.0))))

    def draw(p: Column) -> Column:
        first = F.greatest(p["low"], F.floor(p["mean"] - 10 * p["spread"] - 10).cast("double"))
        last = F.least(p["high"], F.ceil(p["mean"] + 10 * p["spread"] + 10).cast("double"))

        def odds(k: Column) -> Column:  # of k + 1 against k
            return ((p["g"] - k) * (p["d"] - k)
                    / ((k + 1) * (p["t"] - p["g"] - p["d"] + k + 1)))

        start = F.exp(_log_choose(p["g"], first) + _log_choose(p["t"] - p["g"], p["d"] - first)
                      - _log_choose(p["t"], p["d"]))
        steps = F.sequence(F.lit(0), (last - first).cast("int"))
        walked = F.aggregate(
            steps,
            F.struct(first.alias("k"), start.alias("p"), F.lit(0.0).alias("sum"), first.alias("at")),
            lambda acc, _: F.struct(
                (acc["k"] + 1).alias("k"), (acc["p"] * odds(acc["k"])).alias("p"),
                (acc["sum"] + acc["p"]).alias("sum"),
                F.when(acc["sum"] < p["u"], acc["k"]).otherwise(acc["at"]).alias("at")),
            lambda acc: acc["at"])
        quick = F.when(p["spread"] > INVERTED_SPREAD, _rejection(p, key))
        return F.when(p["low"] >= p["high"], p["low"]).otherwise(F.coalesce(quick, walked)).cast("long")

    return let(F.struct(
        g.alias("g"), t.alias("t"), d.alias("d"), low.alias("low"), high.alias("high"),
        mean.alias("mean"), spread.alias("spread"), _uniform(*key).alias("u")), draw)


def _shared(quotas: Column, drawn: Column, key) -> Column:
    """How many of ``drawn`` blocks each of several quotas gives: one draw after the other.

    ``key`` tells the key of the draw for the quota at a place.
    """
    start = F.struct(
        F.aggregate(quotas, F.lit(0).cast("long"), lambda acc, x: acc + x).alias("total"),
        drawn.cast("long").alias("drawn"), F.array().cast("array<long>").alias("left"))

    def take(acc: Column, x: Column) -> Column:
        return let(hypergeometric(x, acc["total"], acc["drawn"], key(F.size(acc["left"]))), lambda n: F.struct(
            (acc["total"] - x).alias("total"), (acc["drawn"] - n).alias("drawn"),
            F.concat(acc["left"], F.array(n)).alias("left")))

    return F.aggregate(quotas, start, take, lambda acc: acc["left"])


def split_tree(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED, group: int = GROUP) -> DataFrame:
    """``(rank, starts)``: where each shard's stretch of a source's order begins.

    ``quotas`` holds ``rank`` and ``quota`` of each source, from rank 0 on. A node's draw is split
    between groups of sources first, of which there are ``group`` too for a million sources, and then
    within each group by a task of its own.
    """
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("rank", "quota"))), lambda s: s["quota"])
    node = quotas.groupBy(F.floor(F.col("rank") / group).cast("long").alias("group")).agg(in_order.alias("q"))
    node = node.select("group", F.lit(0).alias("first"), F.lit(shards).alias("count"), "q")
    for _ in range(math.ceil(math.log2(shards))):
        half = (F.col("count") / 2).cast("int")
        node = stage(node.withColumn(
            "total", F.aggregate("q", F.lit(0).cast("long"), lambda acc, x: acc + x)), "mix-nodes")
        totals = node.groupBy("first", "count").agg(F.sort_array(
            F.collect_list(F.struct("group", "total"))).alias("groups"))
        wanted = F.floor(F.aggregate("groups.total", F.lit(0).cast("long"), lambda acc, x: acc + x)
                         * half / F.col("count"))
        dealt = totals.select("first", F.explode(F.arrays_zip(
            F.col("groups.group").alias("group"),
            _shared(F.col("groups.total"), wanted, lambda at: [
                F.lit(seed), F.lit("group"), F.col("first"), F.col("count"), at]).alias("drawn"))).alias("g"))
        own = node.join(dealt.select("first", "g.group", "g.drawn"), ["first", "group"])
        left = _shared(F.col("q"), F.col("drawn"), lambda at: [
            F.lit(seed), F.col("first"), F.col("count"), (F.col("group") * group + at).cast("int")])
        split = own.withColumn("left", F.when(half > 0, left))
        halves = F.array(
            F.struct("group", "first", half.alias("count"), F.col("left").alias("q")),
            F.struct("group", (F.col("first") + half).alias("first"), (F.col("count") - half).alias("count"),
                     F.zip_with("q", "left", lambda a, b: a - b).alias("q")))
        whole = F.array(F.struct("group", "first", "count", "q"))
        node = split.select(F.explode(F.when(half > 0, halves).otherwise(whole)).alias("n")).select("n.*")
    parts = node.select("group", "first", F.posexplode("q").alias("at", "quota")).select(
        (F.col("group") * group + F.col("at")).alias("rank"), "first", "quota")
    before = Window.partitionBy("rank").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("start", F.coalesce(F.sum("quota").over(before), F.lit(0))).groupBy(
        "rank").agg(F.transform(F.sort_array(F.collect_list(F.struct("first", "start"))),
                                lambda s: s["start"]).alias("starts"))


def measured(docs: DataFrame, block_words: int = BLOCK_WORDS, numbered: bool = False) -> DataFrame:
    """``(row, doc_id, source, key, size, n_blocks)`` of each row, written once.

    Rows get a number as they are written, or bring their own in a column ``row``.
    """
    sized = docs.select(
        *(["row"] if numbered else []), "doc_id", "source",
        F.xxhash64("doc_id", text_of()).alias("key"),
        F.size(words_of(text_of())).cast("long").alias("size")).withColumn(
        "n_blocks", F.ceil(F.col("size") / block_words).cast("long"))
    if not numbered:
        sized = sized.withColumn("row", F.monotonically_increasing_id())
    return stage(sized, "mix-sizes")


def _hash(key: Column, block: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), key, block)


def _standing(block_hash: Column, key: Column, block: Column, row: Column) -> Column:
    """What orders a source's blocks: the hash as an unsigned number, then what tells equal ones apart."""
    unsigned = block_hash.bitwiseXOR(F.lit(-(1 << 63)))
    return F.struct(unsigned.alias("hash"), key.alias("key"), block.alias("block"), row.alias("row"))


def _slot(block_hash: Column, times: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed + 2), block_hash, times)


def _plan(sizes: DataFrame, shards, block_words, seed, weights, share, repeats) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The blocks with their places in their source's order and how often they are taken, the
    sources' targets, and where each shard begins."""
    aims = stage(targets(sizes, weights, share, repeats), "mix-targets")
    total = aims.agg(F.sum("n_blocks")).first()[0] or 0
    bits = max(4, math.ceil(math.log2(max(1, total / BUCKET_BLOCKS))) + 1)
    ranks = aims.select("source", "rank")
    same = F.col("s.source").eqNullSafe(F.col("r.source"))
    blocks = sizes.where("size > 0").alias("s").join(ranks.alias("r"), same).select(
        "s.row", "s.key", "s.size", "r.rank",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("s.n_blocks") - 1)).alias("block")).select(
        "row", "rank", "key", "block",
        F.least(F.lit(block_words), F.col("size") - F.col("block") * block_words).alias("words"),
        _hash(F.col("key"), F.col("block"), seed).alias("hash")).withColumn(
        "bucket", F.shiftrightunsigned("hash", 64 - bits))
    # Places in a source's order are sums over its buckets and within its own bucket, so the
    # rows of a large source are never in one task.
    through = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = stage(
        blocks.groupBy("rank", "bucket").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
        .select("rank", "bucket", F.coalesce(F.sum("n").over(through), F.lit(0)).alias("n_before"),
                F.coalesce(F.sum("w").over(through), F.lit(0)).alias("w_before")), "mix-buckets")
    within = Window.partitionBy("rank", "bucket").orderBy("hash", "key", "block", "row")
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("n_in", F.row_number().over(within) - 1).withColumn(
        "w_in", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    aim = F.round("target").cast("long")
    whole = F.floor(aim / F.greatest("source_size", F.lit(1))).cast("long")
    rest = aim - whole * F.col("source_size")
    taken = stage(
        placed.join(buckets, ["rank", "bucket"])
        .join(aims.select("rank", "n_blocks", whole.alias("whole"), rest.alias("rest")), "rank")
        .select("row", "rank", "hash", "key", "block", "words", "whole", "n_blocks",
                (F.col("n_before") + F.col("n_in")).alias("place"),
                F.least("words", F.greatest(
                    F.lit(0), F.col("rest") - F.col("w_before") - F.col("w_in"))).alias("extra")),
        "mix-places")
    quotas = aims.select("rank").join(
        taken.groupBy("rank").agg(F.sum(
            F.col("whole") + (F.col("extra") > 0).cast("int")).alias("quota")), "rank", "left"
    ).select("rank", F.coalesce("quota", F.lit(0)).alias("quota"))
    return taken, aims, stage(split_tree(quotas, shards, seed), "mix-shards")


def mix(sizes: DataFrame, shards=SHARDS, block_words=BLOCK_WORDS, seed=SEED, weights=WEIGHTS,
        share=SHARE, repeats=REPEATS) -> tuple[DataFrame, DataFrame]:
    """The blocks that the mix takes, and the sources' targets.

    A row ``(row, round, block, words, shard, slot)`` is one taking of one block; sorting a
    shard by ``slot`` shuffles it. Only a source's last block can be taken in part.
    """
    taken, aims, starts = _plan(sizes, shards, block_words, seed, weights, share, repeats)
    rounds = F.col("whole") + (F.col("extra") > 0).cast("int")
    drawn = taken.where(rounds > 0).withColumn(
        "round", F.explode(F.sequence(F.lit(0).cast("long"), rounds - 1))).withColumn(
        "words", F.when(F.col("round") < F.col("whole"), F.col("words")).otherwise(F.col("extra")))
    place = F.col("place") + F.col("round") * F.col("n_blocks")
    shard = F.size(F.filter("starts", lambda s: s <= place)) - 1
    return drawn.join(starts, "rank").select(
        "row", "round", "block", "words", shard.alias("shard"),
        _slot(F.col("hash"), F.col("round"), seed).alias("slot")), aims


def cut_points(sizes: DataFrame, shards=SHARDS, block_words=BLOCK_WORDS, seed=SEED, weights=WEIGHTS,
               share=SHARE, repeats=REPEATS) -> DataFrame:
    """``(source, whole, last, words, cuts)``: what tells a source's blocks where they go.

    A block is taken ``whole`` times, and once more up to the standing ``last``, of which block
    ``words`` are taken then. ``cuts`` are the times and standings at which shards begin.
    """
    taken, aims, starts = _plan(sizes, shards, block_words, seed, weights, share, repeats)
    standing = _standing(F.col("hash"), F.col("key"), F.col("block"), F.col("row"))
    ends = taken.groupBy("rank").agg(
        F.max_by(F.struct(standing.alias("last"), F.col("extra").alias("words")),
                 F.when(F.col("extra") > 0, F.col("place"))).alias("end"),
        F.first("whole").alias("whole"))
    begins = starts.join(aims.where("n_blocks > 0").select("rank", "n_blocks"), "rank").select(
        "rank", "n_blocks", F.posexplode("starts").alias("shard", "start")).select(
        "rank", "shard", F.floor(F.col("start") / F.col("n_blocks")).alias("times"),
        (F.col("start") % F.col("n_blocks")).alias("place"))
    met = taken.select("rank", "place", standing.alias("at")).join(begins, ["rank", "place"])
    cuts = met.groupBy("rank").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("shard", "times", "at"))),
        lambda c: F.struct(c["times"], c["at"])).alias("cuts"))
    return stage(aims.select("source", "rank").join(ends, "rank").join(cuts, "rank").select(
        "source", "whole", "end.last", "end.words", "cuts"), "mix-cuts")


def report(docs: DataFrame, **options) -> DataFrame:
    """A row for each document: its size, its source's size and target, the words taken.

    ``shard_0`` and so on tell how many of these words each output shard takes.
    """
    shards = options.get("shards", SHARDS)
    sizes = measured(docs, options.get("block_words", BLOCK_WORDS))
    drawn, aims = mix(sizes, **options)
    dealt = [f"shard_{k}" for k in range(shards)]
    taken = drawn.groupBy("row").agg(F.sum("words").alias("taken"), *(
        F.sum(F.when(F.col("shard") == k, F.col("words"))).alias(name)
        for k, name in enumerate(dealt)))
    return sizes.alias("s").join(
        aims.alias("a"), F.col("s.source").eqNullSafe(F.col("a.source"))).join(
        taken.alias("t"), F.col("s.row") == F.col("t.row"), "left").select(
        "s.doc_id", "s.size", "a.source_size", "a.target",
        *(F.coalesce(f"t.{name}", F.lit(0)).cast("long").alias(name) for name in ["taken", *dealt]))


def _in_shard_order(rows: DataFrame, shards: int) -> DataFrame:
    """The rows by shard, then slot; a shard is one or more partitions that follow each other.

    Slots are hashes, so their upper bits deal a shard's rows evenly to its partitions.
    """
    pieces = math.ceil(partitions(rows.sparkSession) / shards)
    piece = F.shiftright((F.shiftright("slot", 33) + F.lit(2**30)) * pieces, 31)
    return rows.repartitionById(
        pieces * shards, (F.col("shard") * pieces + piece).cast("int")).sortWithinPartitions(
        "shard", "slot", "row", "block", "round")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The blocks of the mix as documents: a row for each taking of a block.

    Rows are partitioned by output shard, and stand in a shard in the order of their slots. A
    block has its document's columns and its own stretch of the text, as it is written there;
    of one taken in part, the first words stay. ``n_chars``, where there is one, is counted anew.
    """
    block_words, seed = options.get("block_words", BLOCK_WORDS), options.get("seed", SEED)
    rows = stage(docs.select(F.struct("*").alias("kept")).withColumn(
        "row", F.monotonically_increasing_id()), "mix-rows")
    sizes = measured(rows.select("row", "kept.doc_id", "kept.source", "kept.text"), block_words, True)
    cuts = cut_points(sizes, **options)
    text = F.col("kept.text")
    run = r"[^\x20\x09-\x0D]++"
    stretches = F.regexp_extract_all(text, F.lit(f"{run}(?:{GAP}{run}){{0,{block_words - 1}}}+"), 0)
    met = rows.join(cuts, F.col("kept.source").eqNullSafe(F.col("source"))).select(
        "row", "kept", F.struct("whole", "last", "words", "cuts").alias("plan"),
        F.xxhash64("kept.doc_id", text_of("kept.text")).alias("key"))

    def first_words(whole: Column, n: Column) -> Column:
        return let(words_of(whole), lambda w: F.when(n >= F.size(w), whole).otherwise(
            F.array_join(F.slice(w, F.lit(1), n.cast("int")), " ")))

    def takings(whole: Column, block: Column, block_hash: Column) -> Column:
        """One entry for each time that a block is taken."""
        plan = F.col("plan")
        own = _standing(block_hash, F.col("key"), block, F.col("row"))

        def entries(at: Column) -> Column:
            more = F.coalesce(at <= plan["last"], F.lit(False)).cast("long")

            def entry(times: Column) -> Column:
                here = F.struct(times, at)
                part = (times == plan["whole"]) & (at == plan["last"])
                return F.struct(
                    times.alias("round"), block.alias("block"),
                    F.when(part, first_words(whole, plan["words"])).otherwise(whole).alias("text"),
                    (F.size(F.filter(plan["cuts"], lambda c: c <= here)) - 1).alias("shard"),
                    _slot(block_hash, times, seed).alias("slot"))

            n = plan["whole"] + more
            return F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), n - 1), entry))

        return let(own, entries)

    pieces = let(stretches, lambda found: let(
        F.when(F.size(found) == 1, F.array(text)).otherwise(found),
        lambda blocks: F.flatten(F.array_compact(F.transform(blocks, lambda whole, n: let(
            n.cast("long"), lambda block: let(
                _hash(F.col("key"), block, seed), lambda h: takings(whole, block, h))))))))
    out = met.select(
        "row", F.col("kept").withField("text", F.lit(None).cast("string")).alias("rest"),
        F.explode(pieces).alias("pick")).select("row", "rest", "pick.*")
    out = _in_shard_order(out, options.get("shards", SHARDS)).select(
        F.col("rest").withField("text", F.col("text")).alias("kept"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.select(F.col("kept").withField(
            "n_chars", F.length("kept.text").cast(kind)).alias("kept"))
    return out.select("kept.*")
