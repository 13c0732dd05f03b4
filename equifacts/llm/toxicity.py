"""Toxicity by a weighted finite-state grammar over clauses.

Words map to classes: insults with a weight each, threats, targets, negations, and words of
reported speech. Small transducers read a clause's classes: negation weakens the insults that
follow it closely, reported speech weakens what follows it, a target strengthens the clause,
and a threat counts once a target follows. They run composed, and what a clause scores is the
sum of what they let through. A document's features are its strongest clauses and their sum;
a logistic curve over them gives the score.

The word lists below are the start of the insult class; the class grows by words that labelled
toxic rows have far more often than others, in any language, with their log-odds as weights.
The curve is fitted on another part of the labelled rows. Labels come from at most
``SAMPLE_ROWS`` rows outside the held-out fold.

Defined cases: a null text counts as empty and scores as a text without any find; rows without
a label teach nothing; with no labels, or labels of one kind only, the start lists and a fixed
curve serve; a null id belongs to the held-out fold and stays null; repeated rows are each
their own row; an empty table gives an empty result; further columns do not take part.
"""

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.llm.common import FOLDS, held_out, text_of

INSULTS = (
    "idiot moron stupid loser scum trash clown pathetic worthless disgusting dumb imbecile fool "
    "jerk creep coward liar filth filthy garbage vermin parasite bastard bitch asshole shit "
    "crap ugly freak retard scumbag lowlife degenerate dimwit halfwit numbskull").split()
THREATS = "kill hurt destroy murder beat stab shoot hang burn crush strangle punch smash".split()
TARGETS = "you your yours yourself u ur he him his she her they them their these those".split()
NEGATIONS = "not no never neither nor without hardly isn aren wasn weren don doesn didn cannot".split()
REPORTS = "said says saying wrote writes called calls claimed claims quoted quote reported".split()

SAMPLE_ROWS = 20_000
LEXICON_WORDS = 5_000
MIN_ROWS = 4
MIN_LOG_ODDS = 3.0
START_WEIGHT = 3.0
THREAT_WEIGHT = 3.0

_WORD = re.compile(r"\w+")
_CLAUSE = re.compile(r"[.!?;:\n]+")
FEATURES = 4


@dataclass(frozen=True)
class Transducer:
    """``arcs`` maps a state and a class to the next state; ``factor`` weighs a state's output.

    A class without an arc from a state goes by the class None, or else keeps the state.
    """

    start: int
    arcs: dict
    factor: dict

    def step(self, state: int, kind: str | None) -> int:
        return self.arcs.get((state, kind), self.arcs.get((state, None), state))


# Negation reaches three words on; reported speech the rest of the clause.
NEGATION = Transducer(
    0, {**{(s, "negation"): 3 for s in range(4)}, **{(s, None): s - 1 for s in (1, 2, 3)}},
    {0: 1.0, 1: 0.4, 2: 0.4, 3: 0.4})
REPORTED = Transducer(0, {(0, "report"): 1}, {0: 1.0, 1: 0.6})
# A threat waits four words for its target, then pays out.
THREAT = Transducer(
    0, {**{(s, "threat"): 4 for s in range(6)}, **{(s, "target"): 5 for s in range(1, 5)},
        **{(s, None): s - 1 for s in (1, 2, 3, 4)}, (5, None): 0},
    {s: 1.0 if s == 5 else 0.0 for s in range(6)})
TARGETED = Transducer(0, {(0, "target"): 1}, {0: 1.0, 1: 1.25})
GRAMMAR = (NEGATION, REPORTED, THREAT, TARGETED)


@dataclass
class Grammar:
    insults: dict
    curve: np.ndarray = field(default_factory=lambda: np.array([-3.0, 1.0, 0.5, 0.1, 0.0]))

    def __post_init__(self):
        self.classes = {
            **{w: "threat" for w in THREATS}, **{w: "negation" for w in NEGATIONS},
            **{w: "report" for w in REPORTS}, **{w: "target" for w in TARGETS},
            **{w: "insult" for w in self.insults}}
        self.marks = set(self.insults) | set(THREATS)

    def clause(self, words: list[str]) -> float:
        """What the composed transducers let through."""
        states = tuple(t.start for t in GRAMMAR)
        total = 0.0
        for word in words:
            kind = self.classes.get(word)
            states = tuple(t.step(s, kind) for t, s in zip(GRAMMAR, states, strict=True))
            passed = NEGATION.factor[states[0]] * REPORTED.factor[states[1]]
            total += passed * THREAT_WEIGHT * THREAT.factor[states[2]]
            if kind == "insult":
                total += passed * self.insults[word]
        return total * TARGETED.factor[states[3]]

    def features(self, text: str) -> np.ndarray:
        """Strongest clause, second, root of the sum, finds among the words."""
        lowered = text.lower()
        words = _WORD.findall(lowered)
        if self.marks.isdisjoint(words):
            return np.zeros(FEATURES)
        scores = sorted((
            self.clause(own) for own in map(_WORD.findall, _CLAUSE.split(lowered))
            if not self.marks.isdisjoint(own)), reverse=True) + [0.0, 0.0]
        total = sum(scores)
        return np.array([scores[0], scores[1], np.sqrt(total), 100 * total / (len(words) + 100)])

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-(self.curve[0] + self.features(text) @ self.curve[1:]))))


def labelled(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(fold, text, toxic)`` of the sampled labelled rows outside the held-out fold.

    The sample is of the smallest hashes of the id. It has at most ``sample_rows`` rows of two
    numbers, so it is broadcast and the texts stay where they are.
    """
    picked = labels.where(~held_out() & F.col("toxic").isNotNull()).select("doc_id", "toxic").orderBy(
        F.xxhash64(F.lit(3), "doc_id"), "doc_id", "toxic").limit(sample_rows)
    picked = picked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    return docs.select("doc_id", text_of().alias("text")).join(F.broadcast(picked), "doc_id").select(
        fold.alias("fold"), "text", "toxic")


def _tally(batches):
    for batch in batches:
        tallies = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            # A document of copied lines says a word once.
            tallies[int(toxic)].update(set(_WORD.findall(text.lower())))
            tallies[int(toxic)][""] += 1
        words = list(tallies[0].keys() | tallies[1].keys())
        yield pd.DataFrame({
            "word": words, "clean": [tallies[0][w] for w in words],
            "toxic": [tallies[1][w] for w in words]}).astype({"clean": int, "toxic": int})


def learned_insults(rows: DataFrame) -> dict[str, float]:
    """Words that toxic rows have far more often, with their log-odds.

    Equal texts count once. The table of words is counted by Spark; at most ``LEXICON_WORDS``
    of them come to the driver.
    """
    texts = rows.groupBy(F.xxhash64("text").alias("key"), F.length("text").alias("n")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    tally = texts.select("text", "toxic").mapInPandas(
        _tally, "word string, clean long, toxic long").groupBy("word").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    whole = tally.where("word = ''").first()
    if whole is None or not whole["clean"] or not whole["toxic"]:
        return {}
    odds = (F.log((F.col("toxic") + 0.5) / (whole["toxic"] + 1.0))
            - F.log((F.col("clean") + 0.5) / (whole["clean"] + 1.0)))
    found = tally.where((F.col("word") != "") & (F.col("toxic") >= MIN_ROWS)).select(
        "word", odds.alias("odds")).where(F.col("odds") >= MIN_LOG_ODDS).orderBy(
        F.desc("odds"), "word").limit(LEXICON_WORDS).collect()
    return {r["word"]: float(r["odds"]) for r in found}


def _fitted(features: np.ndarray, truth: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, held near ``start`` by a small penalty."""
    x = np.column_stack((np.ones(len(features)), features))
    curve = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (truth - p) - 0.1 * (curve - start)
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(curve))
        step = np.linalg.solve(bend, slope)
        curve = curve + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return curve


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Grammar:
    """A grammar whose words are learned on three folds and whose curve on the fourth."""
    rows = labelled(docs, labels, sample_rows)
    start = {w: START_WEIGHT for w in INSULTS}
    grammar = Grammar({**start, **learned_insults(rows.where(F.col("fold") < FOLDS - 1))})
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def measure(batches):
        for batch in batches:
            yield pd.DataFrame({
                "features": [shared.value.features(t) for t in batch["text"]],
                "toxic": batch["toxic"].astype(int)})

    tuning = rows.where(F.col("fold") == FOLDS - 1).mapInPandas(
        measure, "features array<double>, toxic long").collect()
    truth = np.array([r["toxic"] for r in tuning], float)
    if len(truth) and 0 < truth.sum() < len(truth):
        grammar.curve = _fitted(np.array([r["features"] for r in tuning]), truth, grammar.curve)
    return grammar


SCORED = "doc_id string, held_out boolean, score double, predicted int"


def report(docs: DataFrame, labels: DataFrame, grammar: Grammar | None = None) -> DataFrame:
    """A row for each document: its score, and 1 if that reaches a half."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar or train(docs, labels))

    def score(batches):
        for batch in batches:
            found = np.array([shared.value.score(t) for t in batch["text"]])
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": found,
                "predicted": (found >= 0.5).astype(int)})

    return docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), held_out().alias("held_out"),
        text_of().alias("text")).mapInPandas(score, SCORED).withColumn(
        "doc_id", F.col("doc_id").cast("long"))
