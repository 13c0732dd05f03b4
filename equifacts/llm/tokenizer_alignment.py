"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded by a byte-level BPE (A, after a space) and a sentence-piece BPE (B, which
puts the space itself). The tokenizers' own spans, A's in characters and B's from the proto in
bytes, are coarse cuts; where tokens share a character, or a character is spelled by byte tokens,
the decoded bytes of the tokens refine them. Byte offsets where tokens of both end cut a text
into groups, and each stretch between two neighbouring cuts of either links one A to one B token.

Neither tokenizer joins text across a single space between two other characters (A's pattern
ends a word there, and no piece of B holds its space mark after another character, which is
checked as the vocabulary is loaded). So texts are cut there and each distinct stretch is encoded
and aligned once a block: equal words cost once, and the whole text is the stretches in a row.

How many documents hold a pair is counted by pair over all documents. Documents are dealt to
blocks of about ``BLOCK_CHARS`` characters with a list of the block's pairs, so that a block asks
for the count of each of its pairs once, however many documents hold it; no vocabulary of pairs is
broadcast or collected.

Defined cases: a null or empty text, or one whose tokens of A or B do not spell its bytes (a text
with the space mark itself), has no tokens, zeros and an empty digest. Strings of special tokens
inside a text are plain text. Rows with null ids and repeated rows are documents of their own. An
empty table gives an empty result. Further columns do not take part.
"""

import hashlib
import itertools
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.session import stage

FOLDER = "/opt/tokenizers"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_CHARS = 2_000_000
CACHE_CHARS = 2_000_000
PACKED, ENCODED_TOGETHER = 512, 32
SPACE_MARK = "▁"
_BREAK = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 ones
    stand for themselves, the others for the characters from 256 on, in their order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def refined(coarse: np.ndarray, sure: np.ndarray, widths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where each token ends, in bytes.

    ``coarse`` are the ends of the tokens' spans, ``sure`` says which of them are cuts: those that no
    later token of the text begins before, or that go beyond the one before. After the last cut, or
    where its text begins (``first``, for each token), the widths of the decoded bytes go on. Spans
    that the widths do not fill are left aside.
    """
    run = np.cumsum(widths)
    token = np.arange(len(coarse))
    cut = np.maximum.accumulate(np.where(sure, token, -1))
    opening = np.concatenate(([True], first[1:] != first[:-1]))[:len(first)]
    head = np.maximum.accumulate(np.where(opening, token, -1))
    decoded = first + run - (run - widths)[head]
    inside = cut >= head
    ends = np.where(inside, coarse[cut] + run - run[cut], decoded)
    return np.where(ends == decoded, ends, decoded)


class _Flat:
    """Values of many stretches in a row."""

    def __init__(self):
        self.parts, self.counts = [], []

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append(values)
        self.counts.append(counts)

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the given stretches in their order, and how many each has."""
        values, counts = np.concatenate(self.parts), np.concatenate(self.counts)
        first = np.cumsum(counts) - counts
        own = counts[which]
        at = np.arange(own.sum()) + np.repeat(first[which] - np.cumsum(own) + own, own)
        return values[at], own


class Aligner:
    """Both tokenizers, and the stretches aligned so far, each under a number.

    Stretches are aligned many at a time, laid one after the other, so that tokens are handled as
    arrays.
    """

    def __init__(self, folder: str = FOLDER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(f"{folder}/{BYTE_FILE}")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECE_FILE}")
        alphabet = byte_alphabet()
        entries = sorted(self.a.get_vocab(True).items(), key=lambda e: e[1])
        self.a_bytes = [bytes(alphabet[c] for c in t) for t, _ in entries]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if [i for _, i in entries] != list(range(len(entries))):
            raise ValueError("ids of the byte-level vocabulary have gaps")
        if any(SPACE_MARK in name.lstrip(SPACE_MARK) for name in names):
            raise ValueError("pieces cross a space: texts cannot be cut there")
        self.b_bytes = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace(SPACE_MARK, " ").encode()
            for i, name in enumerate(names)]
        self.a_widths, self.b_widths = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
        # An id with what follows it: another of its side, the other side or group, another stretch.
        self.a_spelled = np.array([(f"{i},", f"{i}|") for i in range(len(self.a_bytes))], object)
        self.b_spelled = np.array([(f"{i},", f"{i};", f"{i}\n") for i in range(len(names))], object)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.spelled: list[str] = []
        self.tokens: list[np.ndarray] = []  # of A and of B in each stretch
        self.links, self.cuts = _Flat(), _Flat()
        self.chars = 0

    def _learn(self, packs: list[list[str]]) -> list[str]:
        """Align the stretches of each pack, encoded as one text; gives back those of packs that the
        tokens do not spell or cut where the stretches end."""
        joined = [" ".join(pack) for pack in packs]
        encodings = self.a.encode_batch([f" {t}" for t in joined], add_special_tokens=False)
        protos = [p.pieces for p in self.b.encode(joined, return_type="proto", num_threads=1)]
        a_ids, b_ids = [e.ids for e in encodings], [[p.id for p in pieces] for pieces in protos]
        good = [
            k for k, t in enumerate(joined)
            if (data := f" {t}".encode()) == b"".join(map(self.a_bytes.__getitem__, a_ids[k]))
            and data == b"".join(map(self.b_bytes.__getitem__, b_ids[k]))]
        bad = [s for k in set(range(len(packs))) - set(good) for s in packs[k]]
        if not good:
            return bad
        numbers = itertools.chain.from_iterable
        n_a, n_b = (np.array([len(ids[k]) for k in good]) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(numbers(ids[k] for k in good), np.int64, n.sum()) for ids, n in ((a_ids, n_a), (b_ids, n_b)))
        spans = np.fromiter(numbers(numbers(encodings[k].offsets for k in good)), np.int64, 2 * len(a)).reshape(-1, 2)
        piece_ends = np.fromiter((p.end for k in good for p in protos[k]), np.int64, len(b))

        data = np.frombuffer("".join([f" {joined[k]}" for k in good]).encode(), np.uint8)
        byte_of = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # of each character
        lengths = np.array([len(joined[k]) + 1 for k in good])
        first_char = np.cumsum(lengths) - lengths
        first = byte_of[first_char]
        in_a, in_b = np.repeat(np.arange(len(good)), n_a), np.repeat(np.arange(len(good)), n_b)
        starts, ends = (byte_of[first_char[in_a] + spans[:, side]] for side in (0, 1))
        a_ends = refined(ends, np.append(starts[1:] >= ends[:-1], True), self.a_widths[a], first[in_a])
        # B's spans are in bytes and do not count the space it puts first.
        ends = first[in_b] + 1 + piece_ends
        b_ends = refined(ends, ends > np.maximum(np.append(0, ends[:-1]), first[in_b]), self.b_widths[b], first[in_b])

        stretches = [s for k in good for s in packs[k]]
        lengths = np.array([len(s) + 1 for s in stretches])
        closes = byte_of[np.cumsum(lengths)]
        first = np.append(0, closes[:-1])
        if not (np.isin(closes, a_ends).all() and np.isin(closes, b_ends).all()):
            return bad + stretches
        own_a, own_b = np.searchsorted(closes, a_ends), np.searchsorted(closes, b_ends)
        self.known.update({s: len(self.spelled) + n for n, s in enumerate(stretches)})
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        either = np.union1d(a_ends, b_ends)
        at = np.searchsorted(a_ends, either)
        self.links.add(a[at] << 32 | b[np.searchsorted(b_ends, either)], np.bincount(own_a[at], minlength=len(stretches)))
        of_cut = own_a[np.searchsorted(a_ends, cuts)]
        self.cuts.add(cuts - first[of_cut], np.bincount(of_cut, minlength=len(stretches)))
        self.tokens.append(np.stack([np.bincount(own, minlength=len(stretches)) for own in (own_a, own_b)]))
        # Groups in a row, A's ids before B's in each.
        group_a, group_b = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        laid = np.empty(len(a) + len(b), object)
        last_a, last_b = cuts[group_a] == a_ends, cuts[group_b] == b_ends
        last_text = np.append(own_b[1:] != own_b[:-1], True)
        laid[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = self.a_spelled[a, last_a.astype(int)]
        laid[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = self.b_spelled[
            b, last_b.astype(int) + last_text]
        self.spelled += "".join(laid.tolist()).split("\n")[:-1]
        return bad

    def numbers(self, texts: list[str | None]) -> list[list[int]]:
        """Each text's stretches in order, by number; none for a text without tokens."""
        if self.chars > CACHE_CHARS:
            self.forget()
        cut = [_BREAK.split(t) if t else [] for t in texts]
        new = list({s: None for parts in cut for s in parts if s not in self.known})
        # A text's first stretch may begin with white space, its last may end so: these stand alone.
        plain = [s for s in new if s and not s[0].isspace() and not s[-1].isspace() and SPACE_MARK not in s]
        packs = [list(p) for p in itertools.batched(plain, PACKED)]
        if len(plain) < len(new):
            packs += [[s] for s in set(new).difference(plain)]
        for some in itertools.batched(packs, ENCODED_TOGETHER):
            for s in self._learn(list(some)):
                if self._learn([[s]]):
                    self.known[s] = -1
        self.chars += sum(map(len, new))
        known = self.known
        found = [[known[s] for s in parts] for parts in cut]
        return [[] if -1 in numbers else numbers for numbers in found]


@lru_cache(maxsize=1)
def aligner_of(folder: str) -> Aligner:
    """One for each worker process: loading takes a second, and stretches recur in other tasks."""
    return Aligner(folder)


def _chunks(batches):
    """Rows of a batch, in chunks of about ``BLOCK_CHARS`` characters."""
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
        first = chars = 0
        for k, text in enumerate(texts):
            chars += len(text or "")
            if chars >= BLOCK_CHARS or k + 1 == len(texts):
                yield ids.slice(first, k + 1 - first), texts[first:k + 1]
                first, chars = k + 1, 0


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values))


_COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _block(ids: pa.Array, texts: list, name: int, aligner: Aligner) -> pa.RecordBatch:
    """A row for each text of a block: its counts and digest, and its links as places in the
    block's list of pairs, which the first row carries with how many texts hold each."""
    found = aligner.numbers(texts)
    spelled = aligner.spelled
    digests = [hashlib.sha256(";".join([spelled[k] for k in parts]).encode()).hexdigest() if parts else ""
               for parts in found]
    used = np.fromiter(itertools.chain.from_iterable(found), np.int64)
    owner = np.repeat(np.arange(len(texts)), list(map(len, found)))
    totals = [np.zeros(len(texts), np.int64)] * 4
    linked = own = np.zeros(0, np.int64)
    if len(used):
        linked, own = aligner.links.of(used)
        counts = [*np.concatenate(aligner.tokens, axis=1)[:, used], aligner.cuts.of(used)[1], own]
        totals = [np.bincount(owner, n, len(texts)).astype(np.int64) for n in counts]
    pairs, places = np.unique(linked, return_inverse=True)
    document = np.repeat(owner, own)
    width = max(1, len(pairs))
    links, times = np.unique(document * width + places, return_counts=True)
    place = (links % width).astype(np.int32)
    held = np.bincount(place, minlength=len(pairs)).astype(np.int64)
    each = np.bincount(links // width, minlength=len(texts))
    rest = [None] * (len(texts) - 1)
    return pa.RecordBatch.from_arrays(
        [ids, *map(pa.array, totals), pa.array(digests), pa.array([name] * len(texts), pa.int64()),
         _lists(place, each), _lists(times.astype(np.int32), each),
         pa.array([pairs, *rest], pa.list_(pa.int64())), pa.array([held, *rest], pa.list_(pa.int64()))],
        ["doc_id", *(f.split()[0] for f in _COUNTS.split(", ")), "block", "places", "times", "pairs", "held"])


def blocks(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches):
        aligner, task = aligner_of(folder), TaskContext.get().partitionId()
        for n, (ids, texts) in enumerate(_chunks(batches)):
            yield _block(ids, texts, task << 32 | n, aligner)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        read, f"doc_id {kind}, {_COUNTS}, block long, places array<int>, times array<int>, "
              "pairs array<long>, held array<long>")


def pair_counts(dealt: DataFrame) -> DataFrame:
    """``(pair, n, best)``: documents that hold each pair linked, and whether no pair of its A
    token has more."""
    listed = dealt.where(F.col("pairs").isNotNull()).select(
        F.explode(F.arrays_zip("pairs", "held")).alias("p")).select("p.*")
    counted = stage(listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n")), "align-counts")
    token = F.shiftright("pair", 32)
    most = counted.groupBy(token.alias("token")).agg(F.max("n").alias("most"))
    return counted.withColumn("token", token).join(most, "token").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums(dealt: pa.Table, known: pa.Table) -> pa.Table:
    """Each document's sums over its links, from its block's counts."""
    order = np.argsort(known.column("place").to_numpy())
    n, best = (known.column(c).to_numpy()[order] for c in ("n", "best"))
    places = dealt.column("places").combine_chunks()
    times = dealt.column("times").combine_chunks().flatten().to_numpy()
    at, sizes = places.flatten().to_numpy(), np.diff(places.offsets.to_numpy())
    owner = np.repeat(np.arange(len(sizes)), sizes)
    sums = {"n_best": times * best[at], "count_sum": times * n[at]}
    out = dealt.select(["doc_id", *(f.split()[0] for f in _COUNTS.split(", "))])
    for name, values in sums.items():
        total = np.zeros(len(sizes), np.int64)
        np.add.at(total, owner, values.astype(np.int64))
        out = out.append_column(name, pa.array(total))
    return out


def report(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """A row for each document: its tokens, groups and links, how the corpus shares the links,
    and the digest of its groups."""
    dealt = stage(blocks(docs, folder), "align-blocks")
    asked = dealt.where(F.col("pairs").isNotNull()).select(
        F.col("block").alias("asking"), F.posexplode("pairs").alias("place", "pair"))
    known = asked.join(pair_counts(dealt), "pair").select("asking", "place", "n", "best")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.drop("pairs", "held").groupBy("block").cogroup(known.groupBy("asking")).applyInArrow(
        _sums, f"doc_id {kind}, {_COUNTS}, n_best long, count_sum long")


def spans(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """``(doc_id, groups)``: each document's groups, with their bytes in the text after a space and
    the ids of both tokenizers."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    group = pa.struct([("start", pa.int64()), ("end", pa.int64()),
                       ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])

    def laid_out(aligner, parts):
        out, at = [], 0
        if parts:
            ends = iter(aligner.cuts.of(np.array(parts))[0].tolist())
            for number in parts:
                start = at
                for group in aligner.spelled[number].split(";"):
                    a, b = ([int(i) for i in side.split(",")] for side in group.split("|"))
                    end = at + next(ends)
                    out.append({"start": start, "end": end, "a": a, "b": b})
                    start = end
                at = start
        return out

    def read(batches):
        aligner = aligner_of(folder)
        for ids, texts in _chunks(batches):
            found = [laid_out(aligner, parts) for parts in aligner.numbers(texts)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.list_(group))], ["doc_id", "groups"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        read, f"doc_id {kind}, groups array<struct<start: long, end: long, a: array<int>, b: array<int>>>")
