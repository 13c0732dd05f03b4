"""Tokenizer alignment against whole texts encoded at once and compared byte by byte."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import pytest

from equifacts.llm import tokenizer_alignment as alignment
from equifacts.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, pairs int, block string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def brute():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    sentencepiece = pytest.importorskip("sentencepiece")
    tokenizers = pytest.importorskip("tokenizers")
    a = tokenizers.Tokenizer.from_file(f"{alignment.FOLDER}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.FOLDER}/piece_bpe_32k.model")
    printable = [c for c in range(256) if chr(c).isprintable() and c > 32 and c != 0xAD]
    letters = {chr(c): c for c in printable}
    for c in range(256):
        if c not in printable:
            letters[chr(256 + len(letters) - len(printable))] = c

    def b_piece(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def one(text):
        if not text:
            return None
        encoding = a.encode(f" {text}", add_special_tokens=False)
        a_ids, b_ids = encoding.ids, b.encode(text)
        a_bytes = [bytes(letters[c] for c in t) for t in encoding.tokens]
        b_bytes = [b_piece(i) for i in b_ids]
        data = f" {text}".encode()
        if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            return None

        def owners(pieces):
            return [k for k, p in enumerate(pieces) for _ in p]
        owner_a, owner_b = owners(a_bytes), owners(b_bytes)
        links = sorted(set(zip(owner_a, owner_b, strict=True)))
        cuts = [k for k in range(1, len(data) + 1) if k == len(data)
                or (owner_a[k] != owner_a[k - 1] and owner_b[k] != owner_b[k - 1])]
        groups, start = [], 0
        for cut in cuts:
            groups.append((start, cut, [a_ids[k] for k in sorted(set(owner_a[start:cut]))],
                           [b_ids[k] for k in sorted(set(owner_b[start:cut]))]))
            start = cut
        return len(a_ids), len(b_ids), groups, [(a_ids[x], b_ids[y]) for x, y in links]

    def table(rows):
        found = [(i, one(t)) for i, t in rows]
        counts = Counter(p for _, f in found if f for p in set(f[3]))
        most = defaultdict(int)
        for (x, _), n in counts.items():
            most[x] = max(most[x], n)
        out, groups = [], []
        for i, f in found:
            groups.append((i, f[2] if f else []))
            if not f:
                out.append((i, 0, 0, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, cut, links = f
            spelled = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for _, _, x, y in cut)
            out.append((i, n_a, n_b, len(cut), len(links), sum(counts[p] == most[p[0]] for p in links),
                        sum(counts[p] for p in links), hashlib.sha256(spelled.encode()).hexdigest()))
        return sorted(out, key=str), sorted(groups, key=str)
    return table


def got(frame):
    return sorted(map(tuple, frame.select(*COLUMNS).collect()), key=str)


def test_given_documents(spark, brute):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    frame = QUERIES["op13_tokenizer_alignment"](spark, "/root/testdata/sf0.001")
    assert got(frame) == brute([tuple(r) for r in rows])[0]


def odd_rows():
    rng = random.Random(2)
    bits = ["a", " ", " ", "  ", "\n", "\t", " ", "é", "𝒳", "☃", "'s", "12", ".", " ", "\x1c", "\x00", "的", "<s>",
            "﻿", "​", "é", "　", "the", " of", "\u0085", "☃☃", "👩‍👩‍👧"]
    texts = [None, "", " ", "  x", "x ", "\n", "<|endoftext|>", "<s> </s> <unk>", "<0x41> is A", "a▁b",
             "a ▁ b", "▁", "don't  stop\n\nnow ", "word " * 3000, "𝒳" * 2000, "x" * 5000, "\x00"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    return [(k if k % 17 else None, t) for k, t in enumerate(texts)] + [(2, "x "), (2, "x ")]


def test_odd_rows(spark, brute, monkeypatch):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(3)
    counts, groups = brute(rows)
    assert got(alignment.report(frame)) == counts
    found = alignment.spans(frame).collect()
    assert sorted(((r.doc_id, [tuple(g) for g in r.groups]) for r in found), key=str) == groups


def test_block_size_changes_nothing(spark, brute):
    rows = odd_rows()[:60]
    texts = [t for _, t in rows]
    aligner = alignment.Aligner()
    whole = alignment._block(alignment.pa.array(range(60)), texts, 0, aligner)
    alone = [alignment._block(alignment.pa.array([k]), [t], 0, aligner) for k, t in enumerate(texts)]
    for column in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"):
        assert whole.column(column).to_pylist() == [b.column(column)[0].as_py() for b in alone]


def test_spans_refine_by_bytes():
    # Byte tokens before the one that has the character's span, two that share one, and a second text.
    ends = alignment.np.array([3, 3, 3, 3, 7, 10, 10, 12])
    sure = alignment.np.array([True, False, False, False, True, False, True, True])
    widths, first = alignment.np.array([3, 1, 1, 1, 1, 1, 2, 2]), alignment.np.array([0] * 7 + [10])
    assert alignment.refined(ends, sure, widths, first).tolist() == [3, 4, 5, 6, 7, 8, 10, 12]
    # Spans that the bytes do not fill.
    assert alignment.refined(ends[:2] + 1, sure[:2], widths[:2], first[:2]).tolist() == [3, 4]


def test_empty_table(spark):
    frame = alignment.report(spark.createDataFrame([], SCHEMA))
    assert set(frame.columns) == set(COLUMNS) and got(frame) == []
