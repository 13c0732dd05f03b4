"""Quality rules as a short-circuit cascade, in built-in functions only.

Every rule is a condition on the text that rejects it. On a sample each rule's time and the
share it rejects are measured; the cascade asks the rules in descending order of rejection
per second and stops at the first that rejects. A conjunction does not depend on its order,
so neither does the verdict: only the time does.

Defined cases: a null text counts as empty; an empty text has no words and fails; equal rows
get equal verdicts, each its own row; an empty table gives an empty result; further columns,
whatever their names, do not take part (the filter returns them untouched).
"""

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equifacts.llm.common import GAP, let, text_of, words_of
from equifacts.session import stage

SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SAMPLE_ROWS = 1000
SAMPLE_LENGTH = 50_000
LEAST_SECONDS = 0.001


@dataclass(frozen=True)
class Facts:
    """A text and its words, with what rules ask of them."""

    text: Column
    words: Column

    @property
    def n_words(self) -> Column:
        return F.size(self.words).cast("long")

    @property
    def word_chars(self) -> Column:
        return F.length(F.array_join(self.words, "")).cast("long")

    @property
    def n_symbols(self) -> Column:
        return _without(self.text, SYMBOLS)

    @property
    def lines(self) -> Column:
        return F.filter(F.split(self.text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    @property
    def n_dup_lines(self) -> Column:
        return let(self.lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")

    @property
    def n_repeat_words(self) -> Column:
        """Words in windows of eight that the text holds twice or more, the first included."""
        return let(window_hashes(self.words), _repeats)


class Counted(Facts):
    """Facts that stand as columns already."""

    n_words = property(lambda self: F.col("n_words"))
    word_chars = property(lambda self: F.col("word_chars"))
    n_symbols = property(lambda self: F.col("n_symbols"))
    n_dup_lines = property(lambda self: F.col("n_dup_lines"))
    n_repeat_words = property(lambda self: F.col("n_repeat_words"))


@dataclass(frozen=True)
class Rule:
    """``rejects`` builds, from a text's facts, a condition that is never null."""

    name: str
    rejects: Callable[[Facts], Column]


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def _paired(hashes: Column, step: int) -> Column:
    """Hash of each entry with the one ``step`` places on; the last ``step`` entries go."""
    def pair(h: Column) -> Column:
        size = F.greatest(F.size(h) - step, F.lit(0))
        return F.zip_with(
            F.slice(h, 1, size), F.slice(h, step + 1, size), lambda a, b: F.xxhash64(a, b))

    return let(hashes, pair)


def window_hashes(words: Column) -> Column:
    """One hash for each run of eight words, built from pairs, fours and eights."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for step in (1, 2, 4):
        hashes = _paired(hashes, step)
    return hashes


def _covered(hashes: Column) -> Column:
    """Words under the windows whose hash occurs twice or more."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def reach(sorted_windows: Column) -> Column:
        last = F.size(sorted_windows) - 1

        def hash_at(i: Column) -> Column:
            return F.get(sorted_windows, i)["h"]

        twice = F.filter(
            sorted_windows,
            lambda _, k: ((k > 0) & (hash_at(k) == hash_at(k - 1)))
            | ((k < last) & (hash_at(k) == hash_at(k + 1))))
        return F.sort_array(F.transform(twice, lambda w: w["i"]))

    return F.aggregate(
        let(placed, reach), F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last")),
        lambda acc, p: F.struct(
            (acc["sum"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("sum"),
            p.alias("last")),
        lambda acc: acc["sum"].cast("long"))


def _repeats(hashes: Column) -> Column:
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")) \
        .otherwise(_covered(hashes))


BASE = (
    Rule("too_short", lambda d: d.n_words < MIN_WORDS),
    Rule("repetitive", lambda d: 100 * d.n_repeat_words > MAX_REPEAT_PERCENT * d.n_words))
RULES = (
    *BASE,
    Rule("symbol_heavy", lambda d: 5 * d.n_symbols > d.n_words),
    Rule("shouting", lambda d: 5 * _without(d.text, "[^!]+") > 2 * d.n_words),
    Rule("odd_word_length", lambda d: (d.word_chars < 2 * d.n_words)
         | (d.word_chars > 20 * d.n_words)),
    Rule("same_lines", lambda d: 10 * d.n_dup_lines > 3 * F.size(d.lines)))


def measure(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Seconds and rejected share of each rule on ``sample_rows`` texts of bounded length.

    The sample only orders the rules; every row meets all rules that it needs. Taking rows
    reads no more partitions than it must, and what comes to the driver is bounded by both
    parameters. It is written once, so that a rule's time holds no scan of the whole table.
    A rule runs twice; its faster run counts, less the time of a run that asks nothing.
    """
    text = docs.select(text_of().alias("text"))
    taken = text.where(F.length("text") <= SAMPLE_LENGTH).limit(sample_rows).collect()
    sample = stage(docs.sparkSession.createDataFrame(taken, text.schema), "quality-sample")

    def run(condition: Column) -> tuple[float, float]:
        seconds = []
        for _ in range(2):
            start = time.perf_counter()
            share = sample.agg(F.avg(condition.cast("int"))).first()[0]
            seconds.append(time.perf_counter() - start)
        return min(seconds), share or 0.0

    idle, _ = run(F.length("text") < 0)
    found = {}
    for rule in rules:
        seconds, share = run(rejected(rule))
        found[rule.name] = (max(seconds - idle, LEAST_SECONDS), share)
    return found


def ordered(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejected share per second, the best first; ties by their given order."""
    cost = measure(docs, rules, sample_rows)
    return sorted(rules, key=lambda r: -cost[r.name][1] / cost[r.name][0])


def rejected(rule: Rule, text: Column | None = None) -> Column:
    text = text_of() if text is None else text
    return let(words_of(text), lambda words: rule.rejects(Facts(text, words)))


def first_rejection(rules, facts: Facts) -> Column:
    """Name of the first rule that rejects the text, null if none does.

    Conditions after the first that holds are not evaluated.
    """
    cascade = None
    for rule in rules:
        branch = (rule.rejects(facts), F.lit(rule.name))
        cascade = F.when(*branch) if cascade is None else cascade.when(*branch)
    return cascade


def keep_good(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    cascade = ordered(docs, rules, sample_rows)
    return docs.where(let(
        words_of(text_of()), lambda w: first_rejection(cascade, Facts(text_of(), w))).isNull())


def report(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """A row for each document: what the base rules count, and the cascade's verdict."""
    others = [r for r in ordered(docs, rules, sample_rows) if r not in BASE]
    facts = Facts(F.col("text"), F.col("words"))
    counted = docs.select("doc_id", text_of().alias("text")).withColumn(
        "words", words_of(F.col("text"))).select("doc_id", "text", "words", *(
            getattr(facts, name).alias(name)
            for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))
    known = Counted(F.col("text"), F.col("words"))
    failed = BASE[0].rejects(known) | BASE[1].rejects(known)
    verdict = F.when(F.col("base_failed"), False).otherwise(
        first_rejection(others, known).isNull())
    return counted.withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", verdict.alias("kept"))
