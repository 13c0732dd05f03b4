"""License scans with ordered signature rules.

Hundreds of patterns, made from the license families, names and forms below, each behind
keywords: one automaton reads the text for all of them, and a pattern is tried only where one
of its keywords begins a word. Rules are in order of priority. Of overlapping finds, one that
lies within the stretch of a find of higher priority is dropped; finds that only overlap in
part stay. Line breaks and tabs count as spaces.

Three fixed phrases are the base; their finds are always kept. Words are runs of the letters
a-z, digits and all non-ASCII characters, after A-Z are lower-cased.

Defined cases: a null text counts as empty; an empty text has no words and no labels; a null id
stays null; repeated rows are each their own row; an empty table gives an empty result;
further columns do not take part.
"""

import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.llm.common import text_of

# Phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_IS_WORD = np.ones(256, bool)
_IS_WORD[:128] = [chr(c).isdigit() or "a" <= chr(c) <= "z" for c in range(128)]
_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Signature:
    """One of ``keywords`` must begin a word of the lower-cased text for ``pattern`` to be tried."""

    label: str
    pattern: str
    keywords: tuple[str, ...]
    weight: float


# Family, names that are licenses only before that word, abbreviations, versions. A family
# whose name holds another's stands before it.
FAMILIES = [
    ("lgpl", ("lesser general public", "library general public"), ("lgpl",), ("2.0", "2.1", "3.0")),
    ("agpl", ("affero general public",), ("agpl",), ("1.0", "3.0")),
    ("gpl", ("general public",), ("gpl",), ("1.0", "2.0", "3.0")),
    ("gfdl", ("free documentation",), ("gfdl", "fdl"), ("1.1", "1.2", "1.3")),
    ("apache", ("apache software", "apache"), (), ("1.0", "1.1", "2.0")),
    ("mpl", ("mozilla public",), ("mpl",), ("1.0", "1.1", "2.0")),
    ("epl", ("eclipse public",), ("epl",), ("1.0", "2.0")),
    ("edl", ("eclipse distribution",), ("edl",), ("1.0",)),
    ("cddl", ("common development and distribution",), ("cddl",), ("1.0", "1.1")),
    ("cpl", ("common public",), ("cpl",), ("1.0",)),
    ("eupl", ("european union public",), ("eupl",), ("1.0", "1.1", "1.2")),
    ("ofl", ("sil open font", "open font"), ("ofl",), ("1.0", "1.1")),
    ("artistic", ("artistic",), (), ("1.0", "2.0")),
    ("bsl", ("boost software",), ("bsl",), ("1.0",)),
    ("osl", ("open software",), ("osl",), ("1.0", "2.0", "2.1", "3.0")),
    ("afl", ("academic free",), ("afl",), ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("zpl", ("zope public",), ("zpl",), ("1.1", "2.0", "2.1")),
    ("python", ("python software foundation", "python"), ("psf",), ("2.0",)),
    ("php", ("php",), (), ("3.0", "3.01")),
    ("ms-pl", ("microsoft public",), ("ms-pl",), ("1.0",)),
    ("ms-rl", ("microsoft reciprocal",), ("ms-rl",), ("1.0",)),
    ("odbl", ("open database",), ("odbl",), ("1.0",)),
    ("odc-by", ("open data commons attribution",), ("odc-by",), ("1.0",)),
    ("cecill", (), ("cecill",), ("1.0", "1.1", "2.0", "2.1")),
    ("apsl", ("apple public source",), ("apsl",), ("1.0", "1.1", "1.2", "2.0")),
    ("lppl", ("latex project public",), ("lppl",), ("1.0", "1.1", "1.2", "1.3")),
    ("upl", ("universal permissive",), ("upl",), ("1.0",)),
    ("qpl", ("q public",), ("qpl",), ("1.0",)),
    ("rpl", ("reciprocal public",), ("rpl",), ("1.1", "1.5")),
    ("sspl", ("server side public",), ("sspl",), ("1.0",)),
    ("busl", ("business source",), ("busl",), ("1.0", "1.1")),
]
# Creative Commons: attributes after "by", or before it, and the versions of the suite.
CC_KINDS = {
    "cc-by-nc-nd": r"(?:by[- ]nc[- ]nd|attribution[- ]noncommercial[- ]noderiv(?:ative)?s)",
    "cc-by-nc-sa": r"(?:by[- ]nc[- ]sa|attribution[- ]noncommercial[- ]sharealike)",
    "cc-by-nc": r"(?:by[- ]nc|attribution[- ]noncommercial)",
    "cc-by-nd": r"(?:by[- ]nd|attribution[- ]noderiv(?:ative)?s)",
    "cc-by-sa": r"(?:by[- ]sa|attribution[- ]sharealike)",
    "cc-by": r"(?:by|attribution)",
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_KEYWORDS = ("cc by", "cc-by", "cc attribution", "cc-attribution", "creative commons", "creative-commons")
# Licenses without versions: label, pattern, keywords.
PLAIN = [
    ("mit", r"\bmit license\b", ("mit",)), ("mit", r"\blicensed under (?:the )?mit\b", ("mit",)),
    ("mit", r"\bpermission is hereby granted, free of charge, to any person obtaining a copy\b", ("permission is hereby",)),
    ("expat", r"\bexpat license\b", ("expat",)), ("x11", r"\bx11 license\b", ("x11",)),
    ("isc", r"\bisc license\b", ("isc",)),
    ("isc", r"\bpermission to use, copy, modify, and(?:/or)? distribute this software for any purpose\b", ("permission to use",)),
    ("bsd", r"\bbsd licen[sc]e\b", ("bsd", "simplified bsd", "new bsd", "modified bsd", "original bsd")), ("bsd-2-clause", r"\b(?:bsd[- ]2[- ]clause|simplified bsd)\b", ("bsd", "simplified bsd", "new bsd", "modified bsd", "original bsd")),
    ("bsd-3-clause", r"\b(?:bsd[- ]3[- ]clause|new bsd|modified bsd)\b", ("bsd", "simplified bsd", "new bsd", "modified bsd", "original bsd")),
    ("bsd-4-clause", r"\b(?:bsd[- ]4[- ]clause|original bsd)\b", ("bsd", "simplified bsd", "new bsd", "modified bsd", "original bsd")), ("0bsd", r"\b(?:0bsd|zero[- ]clause bsd)\b", ("0bsd", "zero")),
    ("bsd", r"\bredistribution and use in source and binary forms, with or without modification\b", ("redistribution and use",)),
    ("unlicense", r"\bthe unlicense\b", ("unlicense",)),
    ("unlicense", r"\bfree and unencumbered software released into the public domain\b", ("free and unencumbered",)),
    ("public-domain", r"\b(?:dedicated to|released into|placed in|in) the public domain\b", ("public domain",)),
    ("cc0", r"\b(?:cc0|cc zero)\b", ("cc0", "cc zero")), ("zlib", r"\bzlib(?:/libpng)? license\b", ("zlib",)),
    ("wtfpl", r"\bwtfpl\b", ("wtfpl",)), ("beerware", r"\bbeer-?ware license\b", ("beerware", "beer-ware")),
    ("ncsa", r"\buniversity of illinois/ncsa open source license\b", ("ncsa",)),
    ("postgresql", r"\bpostgresql licen[sc]e\b", ("postgresql",)), ("openssl", r"\bopenssl license\b", ("openssl",)),
    ("curl", r"\bcurl license\b", ("curl",)), ("vim", r"\bvim license\b", ("vim",)), ("ruby", r"\bruby license\b", ("ruby",)),
    ("proprietary", r"\bproprietary and confidential\b", ("proprietary and",)),
    ("proprietary", r"\bunauthori[sz]ed (?:copying|reproduction|distribution)\b", ("unauthori",)),
    ("copyright", r"(?:\bcopyright|©|\(c\))\s+(?:\(c\)\s*)?(?:19|20)[0-9]{2}\b", ("copyright", "©", "(c)")),
]


def _named(names: tuple, short: tuple, word: str) -> str:
    """A family by name and the word license, or by abbreviation, after which ``word`` may stand."""
    full = [rf"(?:{'|'.join(names)}) licen[sc]e"] if names else []
    brief = [rf"(?:{'|'.join(short)}){word}"] if short else []
    return rf"\b(?:gnu )?(?:{'|'.join(full + brief)})"


def _versioned(family: str, names: tuple, short: tuple, version: str):
    """The forms in which a family names a version, from the surest on."""
    major, minor = version.split(".")
    number = rf"{major}(?:\.{minor})?" if not minor.strip("0") else rf"{major}\.{minor}"
    label, words = f"{family}-{version}", (*names, *short)
    later = r"(?:,? or (?:\(at your option\) )?(?:any )?later(?: version)?)"
    spelt = _named(names, short, "(?: licen[sc]e)?") + (
        rf"[, )]*\(?(?:version |v\.? ?|-)?{number}\)?(?![0-9.]*[0-9])")
    exact = rf"{re.escape(family)}-{re.escape(version)}(?:-only|-or-later|\+)?(?![0-9a-z]|\.[0-9a-z])"
    yield Signature(label, rf"\bspdx-license-identifier: *{exact}", (family,), 1.0)
    yield Signature(label, rf"licenses?/{re.escape(family)}(?:-|/)?v?{number}(?![0-9.]*[0-9])", (family,), 0.8)
    yield Signature(f"{label}-or-later", spelt + later, words, 1.0)
    yield Signature(label, spelt, words, 0.9)
    yield Signature(label, rf"\b{exact}", (family,), 0.8)


@cache
def rules() -> tuple[Signature, ...]:
    """All signatures in order of priority."""
    found = [s for family, names, short, versions in FAMILIES for version in versions
             for s in _versioned(family, names, short, version)]
    for label, kind in CC_KINDS.items():
        for version in CC_VERSIONS:
            number = re.escape(version)
            found.append(Signature(
                f"{label}-{version}", rf"\b(?:cc|creative commons)[- ]{kind}[- ](?:v(?:ersion)? ?)?{number}\b",
                CC_KEYWORDS, 1.0))
            found.append(Signature(
                f"{label}-{version}", rf"creativecommons\.org/licenses/{label[3:]}/{number}\b", ("creativecommons",), 1.0))
        found.append(Signature(
            label, rf"\b(?:cc|creative commons)[- ]{kind}\b(?![- ][a-z]{{2}}\b)", CC_KEYWORDS, 0.8))
    found += [Signature(label, pattern, keys, 0.8) for label, pattern, keys in PLAIN]
    for family, names, short, _ in FAMILIES:
        found.append(Signature(family, _named(names, short, " licen[sc]e") + r"\b", (*names, *short), 0.6))
    return tuple(found)


@cache
def _compiled():
    return tuple((rule, re.compile(rule.pattern)) for rule in rules())


@cache
def _keywords() -> ahocorasick.Automaton:
    """All keywords, each with its length and the ranks of its rules."""
    ranks: dict[str, list[int]] = {}
    for rank, rule in enumerate(rules()):
        for word in rule.keywords:
            ranks.setdefault(word, []).append(rank)
    automaton = ahocorasick.Automaton()
    for word, own in ranks.items():
        automaton.add_word(word, (len(word), own))
    automaton.make_automaton()
    return automaton


def _inside(text: str, at: int) -> bool:
    """Whether a word goes on at this place, rather than begins."""
    return at > 0 and all(c.isalnum() or c == "_" for c in text[at - 1:at + 1])


def _tried(text: str) -> list[int]:
    """Ranks of the rules that have a keyword in the text."""
    found: set[int] = set()
    for last, (length, ranks) in _keywords().iter(text):
        if not found.issuperset(ranks) and not _inside(text, last - length + 1):
            found.update(ranks)
    return sorted(found)


class Stretches:
    """Stretches none of which holds another, in order: their starts and ends both ascend."""

    def __init__(self):
        self.starts, self.ends = [], []

    def add(self, start: int, end: int) -> bool:
        """Take a stretch up unless one that is there holds it."""
        at = bisect_right(self.starts, start)
        if at and self.ends[at - 1] >= end:
            return False
        # Those that the new one holds say nothing more.
        first = at - 1 if at and self.starts[at - 1] == start else at
        last = bisect_right(self.ends, end, lo=first)
        self.starts[first:last], self.ends[first:last] = [start], [end]
        return True


def scan(lowered: str) -> list[tuple[int, int, Signature]]:
    """The finds that stay, by start; a find of equal stretch keeps the earlier rule."""
    for mark in "\n\t\r":
        lowered = lowered.replace(mark, " ")
    kept, reach = [], Stretches()
    for rank in _tried(lowered):
        rule, pattern = _compiled()[rank]
        kept += [(m.start(), m.end(), rule) for m in pattern.finditer(lowered) if reach.add(m.start(), m.end())]
    return sorted(kept, key=lambda f: f[:2])


@cache
def _phrases():
    edge = rf"(?:(?<={_NOT_WORD})|\A)", rf"(?={_NOT_WORD}|\Z)"
    return tuple((label, phrase.split()[0], re.compile(
        edge[0] + f"(?={(_NOT_WORD + '+').join(phrase.split())}{edge[1]})"))
        for phrase, label in BASE.items())


def _word_starts(lowered: str) -> np.ndarray:
    """Code point positions at which words begin."""
    codes = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _IS_WORD[np.minimum(codes, 255)]
    return np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))


def examine(text: str) -> tuple:
    """``(n_words, n_base, first_word, last_word, base_labels, labels, score, finds)``."""
    lowered = text.translate(_LOWER) if not text.isascii() else text.lower()
    starts = _word_starts(lowered)
    places, labels = [], set()
    for label, first, pattern in _phrases():
        if first in lowered and (found := [m.start() for m in pattern.finditer(lowered)]):
            labels.add(label)
            places += found
    words = np.searchsorted(starts, sorted(places))
    finds = scan(lowered)
    everything = labels | {f[2].label for f in finds}
    score = max([0.5] * bool(labels) + [f[2].weight for f in finds], default=0.0)
    return (len(starts), len(places), int(words[0]) if places else None,
            int(words[-1]) if places else None, ",".join(sorted(labels)),
            ",".join(sorted(everything)), score, [(s, e, r.label) for s, e, r in finds])


SCANNED = ("doc_id string, n_words long, n_base long, first_word long, last_word long, "
           "base_labels string, labels string, score double, "
           "finds array<struct<start:long,end:long,label:string>>")


def scan_documents(docs: DataFrame) -> DataFrame:
    """A row for each document: base phrases, labels, score, and where each license stands."""
    def work(batches):
        names = [c.split()[0] for c in SCANNED.split(", ")]
        for batch in batches:
            out = pd.DataFrame([(i, *examine(t)) for i, t in zip(
                batch["doc_id"], batch["text"], strict=True)], columns=names)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text")).mapInPandas(
        work, SCANNED).withColumn("doc_id", F.col("doc_id").cast("long"))


def report(docs: DataFrame) -> DataFrame:
    return scan_documents(docs).drop("finds")
