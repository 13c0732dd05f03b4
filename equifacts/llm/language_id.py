"""Language identification by interpolated Kneser-Ney models of characters.

A text is lower-cased and read as letters with one space for whatever stands between them.
Each language has a model of four characters, learned on a bounded sample of labelled rows:
the highest order discounts counts, the lower ones count in how many contexts a character
goes on, and all are interpolated. Sorted arrays of hashed n-grams hold, for every language,
the finished log-probability of each n-gram seen in any of them; what no language has seen
backs off. The language of the lowest cross-entropy a character wins. On further labelled rows
the sharpness of the score is fitted, and the cross-entropy beyond which a text is rejected
as none of the languages.

Defined cases: a null text counts as empty; a text without letters is ``und`` with score 0;
rows without a language teach nothing; without any labelled row all texts are ``und``; a
null id belongs to the held-out fold and stays null; repeated rows are each their own row;
further columns do not take part.
"""

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.llm.common import FOLDS, held_out, text_of

ORDER = 4
SAMPLE_DOCS = 1000  # rows a language, for counting
TUNING_DOCS = 300  # rows a language, for the score and the rejection
REJECT_SPREADS = 5.0
UNKNOWN = "und"
SPACE = 32
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BITS = np.uint64(16)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def characters(text: str) -> np.ndarray:
    """Letters and single spaces, with a space before; empty if there is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.uint64)
    after_letter = np.concatenate(([False], letter[:-1]))
    kept = np.where(letter, np.minimum(codes, 0xFFFF), SPACE)[letter | after_letter]
    return np.concatenate((np.full(ORDER - 1, SPACE), kept)).astype(np.uint64)


def packed(chars: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each character, sixteen bits a character."""
    n = len(chars) - ORDER + 1
    grams = np.zeros(max(n, 0), np.uint64)
    for k in range(ORDER):
        grams = (grams << _BITS) | chars[k:n + k]
    return grams


def hashed(grams: np.ndarray) -> np.ndarray:
    """A one-to-one mix of the packed n-grams."""
    grams = (grams ^ (grams >> np.uint64(32))) * _MIX
    grams = (grams ^ (grams >> np.uint64(29))) * _MIX
    return grams ^ (grams >> np.uint64(32))


def _suffix(grams: np.ndarray, order: int) -> np.ndarray:
    return grams & np.uint64((1 << (16 * order)) - 1)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted values in sorted keys, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _discounted(counts: np.ndarray) -> float:
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    return float(once / (once + 2 * twice)) if once else 0.5


@dataclass
class Model:
    """For each order: sorted n-gram hashes with log-probabilities, contexts with back-off."""

    languages: list[str]
    keys: dict
    logs: dict
    contexts: dict
    backoffs: dict
    floor: float
    sharpness: float = 1.0
    limits: np.ndarray | None = None

    def entropies(self, text: str) -> np.ndarray | None:
        """Cross-entropy a character for each language, None without letters."""
        grams = packed(characters(text))
        if not len(grams):
            return None
        n, total = len(grams), np.zeros(len(self.languages))
        for order in range(ORDER, 0, -1):
            grams = _suffix(grams, order) if order < ORDER else grams
            at, known = _find(self.keys[order], hashed(grams))
            total += self.logs[order][at[known]].sum(axis=0, dtype=np.float64)
            grams = grams[~known]
            if not len(grams):
                break
            at, known = _find(self.contexts[order], hashed(grams >> _BITS))
            total += self.backoffs[order][at[known]].sum(axis=0, dtype=np.float64)
        else:
            total += len(grams) * self.floor
        return -total / n

    def judge(self, text: str) -> tuple[str, float, bool]:
        """Language, score, and whether the text is rejected as none of the languages."""
        found = self.entropies(text) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0, True
        best = int(found.argmin())
        odds = np.exp(-self.sharpness * (found - found[best]))
        rejected = self.limits is not None and bool(found[best] > self.limits[best])
        return self.languages[best], float(1 / odds.sum()), rejected


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """A model of the languages' packed n-grams and their counts."""
    languages = sorted(counts)
    alphabet = len(np.unique(np.concatenate(
        [_suffix(g, 1) for g, _ in counts.values()] or [np.zeros(0, np.uint64)]))) + 1
    floor = -float(np.log(alphabet))
    # For each language and order: n-grams (sorted) with their counts or continuations.
    tables = {}
    for name in languages:
        grams, n = counts[name]
        order = np.argsort(grams)
        tables[name, ORDER] = grams[order], n[order].astype(np.float64)
        for k in range(ORDER - 1, 0, -1):
            found, times = np.unique(_suffix(tables[name, k + 1][0], k), return_counts=True)
            tables[name, k] = found, times.astype(np.float64)
    keys, logs, contexts, backoffs = {}, {}, {}, {}
    lower_grams, lower = np.zeros(1, np.uint64), np.full((1, len(languages)), 1 / alphabet)
    for k in range(1, ORDER + 1):
        union = np.unique(np.concatenate([tables[name, k][0] for name in languages]))
        heads = np.unique(union >> _BITS)
        head_of = np.searchsorted(heads, union >> _BITS)
        chance, weight = np.zeros((len(union), len(languages))), np.ones((len(heads), len(languages)))
        for at, name in enumerate(languages):
            grams, n = tables[name, k]
            own, discount = np.zeros(len(union)), _discounted(n)
            own[np.searchsorted(union, grams)] = n
            total = np.bincount(head_of, own, len(heads))
            kinds = np.bincount(head_of, own > 0, len(heads))
            seen = total > 0
            weight[seen, at] = discount * kinds[seen] / total[seen]
            chance[:, at] = np.maximum(own - discount, 0) / np.maximum(total, 1)[head_of]
        tails = np.zeros(len(union), np.int64) if k == 1 else np.searchsorted(
            lower_grams, _suffix(union, k - 1))
        chance += weight[head_of] * lower[tails]
        for table, values, grams, log in ((keys, logs, union, chance), (contexts, backoffs, heads, weight)):
            mixed = hashed(grams)
            order = np.argsort(mixed)
            table[k], values[k] = mixed[order], np.log(log[order]).astype(np.float32)
        lower_grams, lower = union, chance
    return Model(languages, keys, logs, contexts, backoffs, floor)


def _count(batches):
    for batch in batches:
        out = []
        for name, texts in batch.groupby("lang")["text"]:
            grams = [packed(characters(t)) for t in texts]
            found, n = np.unique(np.concatenate(grams), return_counts=True)
            out.append(pd.DataFrame({"lang": name, "gram": found.view(np.int64), "n": n}))
        yield pd.concat(out) if out else pd.DataFrame({"lang": [], "gram": [], "n": []})


def _sample(docs: DataFrame, rows: int, tuning: bool) -> DataFrame:
    """About ``rows`` labelled rows a language, by a hash of the id.

    One training fold is for tuning, the others for counting.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    labelled = docs.where(~held_out() & F.col("lang").isNotNull()).where(
        fold == FOLDS - 1 if tuning else fold < FOLDS - 1).select(
        "doc_id", "lang", text_of().alias("text"))
    sizes = labelled.groupBy("lang").count().collect()
    chosen = F.lit(False)
    for row in sizes:
        part = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1_000_000))
        chosen = chosen | ((F.col("lang") == row["lang"]) & (part < 1_000_000 * rows / row["count"]))
    return labelled.where(chosen)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, tuning_docs: int = TUNING_DOCS) -> Model:
    """A model of the labelled rows outside the held-out fold.

    What comes to the driver is the n-grams of the sample, bounded by ``sample_docs`` rows a
    language, and a few numbers for each tuning row.
    """
    counted = _sample(docs, sample_docs, False).select("lang", "text").mapInPandas(
        _count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")).collect()
    by_language: dict = {}
    for name, gram, n in counted:
        by_language.setdefault(name, []).append((gram, n))
    grams = {name: np.array(rows, np.int64) for name, rows in by_language.items()}
    if not grams:
        return Model([], {}, {}, {}, {}, 0.0)
    model = build({name: (rows[:, 0].view(np.int64).copy().view(np.uint64), rows[:, 1])
                   for name, rows in grams.items()})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        for batch in batches:
            found = [(name, shared.value.entropies(t)) for name, t in zip(
                batch["lang"], batch["text"], strict=True)]
            yield pd.DataFrame([(n, e) for n, e in found if e is not None], columns=["lang", "found"])

    tuned = _sample(docs, tuning_docs, True).select("lang", "text").mapInPandas(
        measure, "lang string, found array<double>").collect()
    return _calibrated(model, [(r["lang"], np.array(r["found"])) for r in tuned])


def _calibrated(model: Model, tuning: list) -> Model:
    """The sharpness of the highest likelihood, and limits some spreads over the mean."""
    place = {name: k for k, name in enumerate(model.languages)}
    tuning = [(place[name], found) for name, found in tuning if name in place]
    if not tuning:
        return model
    truth = np.array([t for t, _ in tuning])
    found = np.stack([f for _, f in tuning])
    best = found.min(axis=1, keepdims=True)

    def likelihood(sharpness):
        scaled = -sharpness * (found - best)
        return (scaled[np.arange(len(truth)), truth] - np.log(np.exp(scaled).sum(axis=1))).mean()

    model.sharpness = float(max((2.0**k for k in range(-2, 7)), key=likelihood))
    model.limits = np.full(len(model.languages), np.inf)
    for k in range(len(model.languages)):
        own = best[(found.argmin(axis=1) == k), 0]
        if len(own) >= 2:
            model.limits[k] = own.mean() + REJECT_SPREADS * own.std() + 0.1
    return model


JUDGED = "doc_id string, held_out boolean, lang_pred string, score double, rejected boolean"


def report(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """A row for each document: predicted language, score, and whether it is rejected."""
    model = model or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        for batch in batches:
            found = [(i, h, *shared.value.judge(t)) for i, h, t in zip(
                batch["doc_id"], batch["held_out"], batch["text"], strict=True)]
            yield pd.DataFrame(found, columns=[c.split()[0] for c in JUDGED.split(", ")])

    return docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), held_out().alias("held_out"),
        text_of().alias("text")).mapInPandas(judge, JUDGED).withColumn(
        "doc_id", F.col("doc_id").cast("long"))
