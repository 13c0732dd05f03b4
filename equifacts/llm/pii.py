"""Personal data by bootstrapped contextual extraction, in built-in functions only.

Four kinds are found by fixed patterns and checks; these base spans are the seeds. Every
identifier-like token (a run without white space that has a digit or an at sign, or number
words in a row) stands between a word before it and a word after it, the nearest that are no
identifiers. Each of these words, and both together, is a lexical pattern; the text's edge
is no word, marks are words of their own; patterns and identifiers form a graph over the whole table. Confidence goes
round it: a pattern's is the mean score of its identifiers, drawn to zero while they are few,
and an unseen identifier's score is that of its best pattern. After the rounds, patterns of
high confidence mark the unseen identifiers beside them with kind ``context``.

Defined cases: a null text counts as empty and has no spans; repeated rows are each their own
row; a null id stays null; an empty table gives an empty result; the spans of a row are
ordered by start, then kind as listed. ``mask`` keeps further columns, whatever their names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equifacts.llm.common import let, text_of
from equifacts.session import stage

# Each matches what the stated pattern of its kind matches, without giving
# characters back. Cards and phone numbers that cannot pass for their length still match
# here only if no longer match would have swallowed them.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"

# Neighbouring number words of a line are one token, so that a spaced identifier is whole.
_NUMBER = r"(?=[^0-9\x20\x09-\x0D]*+[0-9])[0-9().+/-]++"
_END = r"(?![^\x20\x09-\x0D])"
TOKEN = (rf"(?<![^\x20\x09-\x0D])(?:{_NUMBER}{_END}(?:[\x20\x09]++{_NUMBER}{_END})*+"
         rf"(?:[\x20\x09]++{_NUMBER}[,;:!?]++{_END})?+"
         r"|(?=[^\x20\x09-\x0D]*[0-9@])[^\x20\x09-\x0D]++)")
CORE = r"[0-9A-Za-z](?:.*[0-9A-Za-z])?"
MIN_DIGITS = 6
GROUP = 256
ROUNDS = 3
# So small that the share of seeds decides, whatever the table's size.
PRIOR = 1.0
DAMPING = 0.5
CONFIDENT = 0.9
# Signs for a side without a word: the text's edge, or more identifiers than are looked past.
EDGE, CROWD = "^", "#"
LOOK_PAST = 4

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]+", "")


def _luhn(match: Column) -> Column:
    """Whether the digits pass: from the right, every second one doubled."""
    def total(digits: Column) -> Column:
        def worth(i: Column) -> Column:
            digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
            twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
            return F.when(i % 2 == 1, twice).otherwise(digit)

        return F.aggregate(
            F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + worth(i))

    return let(_digits(match), lambda d: F.when(
        F.length(d).between(14, 19), total(d) % 10 == 0).otherwise(False))


_ACCEPTED = {
    "email": (EMAIL, "@", lambda m: F.lit(True)),
    "ip": (IP, None, lambda m: m.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")),
    "card": (CARD, None, _luhn),
    "phone": (PHONE, "+", lambda m: F.length(_digits(m)).between(10, 15)),
}


def grouped(values: Column) -> Column:
    """The array in runs of ``GROUP`` entries, so that a walk over many entries stays short."""
    last = F.ceil(F.size(values) / GROUP).cast("int") - 1
    return F.when(F.size(values) <= GROUP, F.array(values)).otherwise(F.transform(
        F.sequence(F.lit(0), last), lambda k: F.slice(values, k * GROUP + 1, F.lit(GROUP))))


def placed(text: Column, pattern: str) -> Column:
    """The pattern's matches as structs ``(start, end, value)``, in code points.

    Starts are sums over the texts between the matches and the matches before: first within
    each group of matches, then over the groups.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern)

    def step(acc: Column, s: Column) -> Column:
        begin = acc["at"] + s["gap"]
        end = begin + F.length(s["value"])
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct(
            begin.alias("start"), end.alias("end"), s["value"].alias("value")))).alias("spans"))

    def within(steps: Column) -> Column:
        return F.aggregate(steps, F.struct(F.lit(0).alias("at"), _none().alias("spans")), step)

    def shifted(groups: Column) -> Column:
        begins = F.aggregate(
            groups, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins")),
            lambda acc, g: F.struct(
                (acc["at"] + g["at"]).alias("at"),
                F.concat(acc["begins"], F.array(acc["at"])).alias("begins")),
            lambda acc: acc["begins"])
        return F.flatten(F.zip_with(groups, begins, lambda g, at: F.transform(
            g["spans"], lambda s: F.struct(
                (s["start"] + at).alias("start"), (s["end"] + at).alias("end"),
                s["value"].alias("value")))))

    def lay(found: Column) -> Column:
        steps = F.zip_with(gaps, found, lambda g, m: F.struct(
            F.length(g).alias("gap"), m.alias("value")))
        real = F.filter(steps, lambda s: s["value"].isNotNull())
        return let(real, lambda r: let(F.transform(grouped(r), within), shifted))

    return let(matches, lay)


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,value:string>>")


def spans_of(text: Column, kind: str) -> Column:
    """The accepted matches of a kind."""
    pattern, mark, accepts = _ACCEPTED[kind]
    found = F.filter(placed(text, pattern), lambda s: accepts(s["value"]))
    possible = F.contains(text, F.lit(mark)) if mark else text.rlike(pattern)
    return F.when(possible, found).otherwise(_none())


def _ranked(kind: str, rank: int) -> Column:
    return F.transform(kind, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
        s["end"].alias("end"), s["value"].alias("value")))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def _base(docs: DataFrame, *carried: str) -> DataFrame:
    """The carried columns, the text and the base spans ``(start, rank, kind, end, value)``."""
    found = docs.select(F.struct(*carried).alias("kept"), text_of().alias("text")).select(
        "kept", "text", *(spans_of(F.col("text"), kind).alias(kind) for kind in KINDS))
    merged = F.concat(*(_ranked(kind, rank) for rank, kind in enumerate(KINDS)))
    return found.select("kept", "text", F.sort_array(merged).alias("spans"))


def _core(token: Column) -> Column:
    """The token from its first to its last letter or digit."""
    return F.regexp_extract(token, CORE, 0)


def _context_word(text: Column, side: str) -> Column:
    """Last or first word of a text, lower-cased, without marks round it; null if it has none.

    A word of marks only stays as it is.
    """
    pattern = r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$" if side == "last" else r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)"
    near = F.substring(text, -80, 80) if side == "last" else F.substring(text, 1, 80)

    def bare(whole: Column) -> Column:
        word = F.regexp_replace(whole, r"^\W+|\W+$", "")
        return F.when(word != "", word).when(whole != "", whole)

    return let(F.lower(F.regexp_extract(near, pattern, 1)), bare)


def _neighbour(words: Column, at: Column, step: int) -> Column:
    """The word nearest to a token, past identifiers that stand between; else a sign."""
    near = [F.get(words, at + k * step) for k in range(LOOK_PAST)]
    end = at + (LOOK_PAST - 1) * step
    edge = (end <= 0) if step < 0 else (end >= F.size(words) - 1)
    return F.coalesce(*near, F.when(edge, F.lit(EDGE)).otherwise(F.lit(CROWD)))


def _identifiers(text: Column, spans: Column) -> Column:
    """Identifier-like tokens with their place, neighbours, and whether a seed lies in them.

    A token counts if it has six digits, in one word or several, or an at sign, or overlaps a
    seed.
    """
    gaps = F.split(text, TOKEN)
    tokens = placed(text, TOKEN)
    groups = let(spans, lambda own: F.transform(grouped(own), lambda g: F.struct(
        F.get(g, F.lit(0))["start"].alias("first"),
        F.array_max(F.transform(g, lambda s: s["end"])).alias("last"), g.alias("spans"))))

    def describe(known: Column) -> Column:
        def one(token: Column, i: Column) -> Column:
            core = _core(token["value"])
            start = token["start"] + F.greatest(F.instr(token["value"], core) - 1, F.lit(0))

            def meets(first: Column, last: Column) -> Column:
                return (first < token["end"]) & (token["start"] < last)

            seed = F.exists(known["groups"], lambda g: meets(g["first"], g["last"]) & F.exists(
                g["spans"], lambda s: meets(s["start"], s["end"])))
            return F.struct(
                start.alias("start"), (start + F.length(core)).alias("end"), core.alias("value"),
                F.coalesce(seed, F.lit(False)).alias("seed"),
                _neighbour(known["lasts"], i, -1).alias("before"),
                _neighbour(known["firsts"], i + 1, 1).alias("after"))

        return F.filter(
            F.transform(tokens, one),
            lambda t: (t["value"] != "") & (t["seed"] | F.contains(t["value"], F.lit("@")) | (
                F.length(_digits(t["value"])) >= MIN_DIGITS)))

    return F.when(text.rlike("[0-9@]"), let(
        let(gaps, lambda g: F.struct(
            F.transform(g, lambda x: _context_word(x, "last")).alias("lasts"),
            F.transform(g, lambda x: _context_word(x, "first")).alias("firsts"),
            groups.alias("groups"))), describe))


def _patterns(token: str = "token") -> Column:
    """The up to three lexical patterns a token stands in; signs alone are none."""
    before, after = F.col(f"{token}.before"), F.col(f"{token}.after")
    worded = [~side.isin(EDGE, CROWD) for side in (before, after)]
    return F.array_compact(F.array(
        F.when(worded[0], F.concat(before, F.lit(" _"))),
        F.when(worded[1], F.concat(F.lit("_ "), after)),
        F.when(worded[0] | worded[1], F.concat(before, F.lit(" _ "), after))))


def induced(edges: DataFrame, rounds: int = ROUNDS, prior: float = PRIOR) -> DataFrame:
    """``(pattern, confidence)`` after scoring the graph of patterns and identifiers.

    ``edges`` holds ``pattern, value, seed`` once for each pair. An identifier's score is 1 if
    it is a seed, else the highest confidence of its patterns in the round before. Identifiers
    that are no seeds count for a part only, so that a pattern cannot raise itself.
    """
    size = edges.groupBy("pattern").agg(
        F.count("*").alias("n"), F.sum(F.col("seed").cast("double")).alias("sum"))
    scored = stage(size.select("pattern", "n", (F.col("sum") / (F.col("n") + prior)).alias("confidence")),
                   "pii-patterns")
    for _ in range(rounds - 1):
        # Only patterns that a seed supports can raise an identifier.
        live = scored.where("confidence > 0").select("pattern", "confidence")
        unseen = stage(
            edges.where("not seed").join(live, "pattern")
            .groupBy("value").agg(F.max("confidence").alias("score")), "pii-identifiers")
        raised = edges.where("not seed").join(unseen, "value").groupBy("pattern").agg(
            F.sum("score").alias("more"))
        seeds = edges.where("seed").groupBy("pattern").agg(F.count("*").alias("base"))
        scored = stage(
            scored.select("pattern", "n").join(raised, "pattern", "left")
            .join(seeds, "pattern", "left").select("pattern", "n", (
                (F.coalesce("base", F.lit(0)) + DAMPING * F.coalesce("more", F.lit(0.0)))
                / (F.col("n") + prior)).alias("confidence")), "pii-patterns")
    return scored.select("pattern", "confidence")


def extract(docs: DataFrame, *carried: str, rounds: int = ROUNDS, prior: float = PRIOR,
            confident: float = CONFIDENT) -> DataFrame:
    """``(kept, spans, all_spans)`` of each row; ``kept`` holds the carried columns.

    Rows are numbered once they are to be written, so a number stays with its row.
    """
    found = _base(docs, *carried).select(
        "kept", "spans", _identifiers(F.col("text"), F.col("spans")).alias("tokens"))
    rows = stage(found.withColumn("row", F.monotonically_increasing_id()), "pii-base")
    return _with_discoveries(rows, rounds, prior, confident)


def _with_discoveries(rows: DataFrame, rounds: int, prior: float, confident: float) -> DataFrame:
    tokens = rows.select("row", F.explode("tokens").alias("token"))
    edges = stage(
        tokens.select(F.explode(_patterns()).alias("pattern"), F.col("token.value").alias("value"),
                      F.col("token.seed").alias("seed"))
        .groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "pii-edges")
    sure = stage(
        induced(edges, rounds, prior).where(F.col("confidence") >= confident), "pii-confident")
    unseen = tokens.where("not token.seed").withColumn("pattern", F.explode(_patterns()))
    marked = stage(
        unseen.join(sure, "pattern").groupBy("row").agg(F.collect_set(F.struct(
            F.col("token.start").alias("start"), F.lit(len(KINDS)).alias("rank"),
            F.lit(CONTEXT).alias("kind"), F.col("token.end").alias("end"),
            F.col("token.value").alias("value"))).alias("more")), "pii-marked")
    return rows.join(marked, "row", "left").select(
        "kept", "spans",
        F.sort_array(F.when(F.col("more").isNull(), F.col("spans")).otherwise(
            F.concat("spans", "more"))).alias("all_spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    """A row for each document: base counts, their digest, and all spans."""
    found = extract(docs, "doc_id", **options)
    return found.select(
        "kept.doc_id", *(_count(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"),
        _joined(F.col("all_spans")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind; overlapping spans become one.

    Each group of spans rewrites its own stretch, from where the groups before it end.
    """
    def step(own: Column, begin: Column, acc: Column, s: Column) -> Column:
        label = F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        kept = F.substring(own, acc["at"] - begin + 1, s["start"] - acc["at"])
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(
                F.concat(acc["out"], kept, label)).alias("out")))

    def stretch(g: Column) -> Column:
        own = F.substring(text, g["begin"] + 1, g["end"] - g["begin"])
        return let(own, lambda o: F.aggregate(
            g["spans"], F.struct(g["begin"].alias("at"), F.lit("").alias("out")),
            lambda acc, s: step(o, g["begin"], acc, s), lambda acc: acc["out"]))

    def reach(g: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(g, lambda s: s["end"])), F.lit(0))

    def written(groups: Column) -> Column:
        ends = F.aggregate(
            groups, F.array(F.lit(0)),
            lambda acc, g: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), reach(g)))))

        def joined(stops: Column) -> Column:
            parts = F.transform(groups, lambda g, k: stretch(F.struct(
                F.get(stops, k).alias("begin"), F.get(stops, k + 1).alias("end"), g.alias("spans"))))
            rest = F.substring(text, F.element_at(stops, -1) + 1, F.length(text))
            return F.concat(F.array_join(parts, ""), rest)

        return let(ends, joined)

    return let(spans, lambda s: let(grouped(s), written))


def mask(docs: DataFrame, **options) -> DataFrame:
    """The documents with their personal data replaced by the names of its kinds.

    ``n_chars``, where there is one, is counted anew.
    """
    found = extract(docs, "*", **options)
    text = masked(F.col("kept.text"), F.col("all_spans"))
    kept = found.select(
        F.when(F.size("all_spans") == 0, F.col("kept")).otherwise(
            F.col("kept").withField("text", text)).alias("kept"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.select(F.col("kept").withField(
            "n_chars", F.length("kept.text").cast(kind)).alias("kept"))
    return kept.select("kept.*")
