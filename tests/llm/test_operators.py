"""Each operator against brute force, and on nulls, empty texts, repeats and empty tables."""

import hashlib
import itertools
import random
import re
from collections import Counter

import pytest

from equifacts.llm import (
    fingerprints, graph, jaccard_join, language_id, licenses, mixing, packing, pii, quality_rules, secrets,
    toxicity)
from equifacts.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, size string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977}x{i}" for i in range(9000))
TEXTS = [
    (1, "", "en", "a"), (2, None, None, None), (3, "one two three", "en", "a"),
    (4, "one two three", "en", "a"), (5, LONG, "en", "b"), (6, LONG + " end", "en", "b"),
    (7, "same line here\nsame line here\n\nsame line here", "de", "b"),
    (8, "mail a.b@c.de, then 10.0.0.255 or 10.0.0.256 call +1 (555) 123-4567!", "en", "c"),
    (9, "card 4111 1111 1111 1111 and 4111-1111-1111-1112 x@y a@b.c%d@e.f", "en", "c"),
    (10, "éé CC-BY 𝒳 GNU General Public License v3; All rights\nreserved. cc by", "fr", None),
    (None, "a text without an id", "en", "c"), (12, " ".join(["go"] * 40), "en", "a"),
    (12, " ".join(["go"] * 40), "en", "a"), (13, "11 22 33", None, "a"),
]


def rows_of(spark, texts):
    return spark.createDataFrame(
        [(i, t, g, s, 0, 5, "x") for i, t, g, s in texts], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return rows_of(spark, TEXTS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return rows_of(spark, [])


@pytest.fixture(scope="module")
def given_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def both(frame):
    return [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]


def bag(rows):
    return Counter(map(tuple, rows))


# Quality rules

def counted(text):
    words, seen, lines = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if times[window] > 1:
            covered.update(range(k, k + 8))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines,
            len(covered), failed)


@pytest.mark.parametrize("table", ["docs", "given_docs"])
def test_quality_counts(request, table):
    frame = request.getfixturevalue(table)
    got = quality_rules.report(frame, sample_rows=20).drop("kept").collect()
    assert bag(got) == bag((i, *counted(t)) for i, t in both(frame))


def test_quality_verdict_ignores_the_order_of_rules(docs):
    def kept(rules):
        frame = docs.where(quality_rules.let(
            quality_rules.words_of(quality_rules.text_of()),
            lambda w: quality_rules.first_rejection(
                rules, quality_rules.Facts(quality_rules.text_of(), w))).isNull())
        return bag(r.asDict().values() for r in frame.collect())
    assert kept(quality_rules.RULES) == kept(quality_rules.RULES[::-1])
    assert quality_rules.keep_good(docs).columns == docs.columns


# Jaccard join

def grams(text):
    words = WORD.findall(text)
    n = min(5, len(words))
    return frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1)) if words else frozenset()


def alike(a, b):
    if a == b:
        return True
    x, y = grams(a), grams(b)
    return bool(x and y) and len(x & y) >= 0.8 * len(x | y) - 1e-9


def brute_classes(pairs):
    root = list(range(len(pairs)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k
    links = [0] * len(pairs)
    for a, b in itertools.combinations(range(len(pairs)), 2):
        if alike(pairs[a][1], pairs[b][1]):
            links[a] += 1
            links[b] += 1
            root[max(top(a), top(b))] = min(top(a), top(b))
    members = {}
    for k in range(len(pairs)):
        members.setdefault(top(k), []).append(pairs[k][0])
    first = {k: min((i for i in ids if i is not None), default=None) for k, ids in members.items()}
    return bag((pairs[k][0], first[top(k)], links[k]) for k in range(len(pairs)))


@pytest.mark.parametrize("table", ["docs", "given_docs"])
def test_join_finds_every_link(request, table):
    frame = request.getfixturevalue(table)
    got = bag(jaccard_join.join_report(frame).collect())
    assert got == brute_classes(both(frame))


def test_blocks_lose_no_link(spark, monkeypatch):
    base = [f"w{k}" for k in range(100)]
    texts = [(n, " ".join(base + [f"end{n % 7}", f"last{n}"]), "en", "a") for n in range(60)]
    frame = rows_of(spark, texts)
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", 13)
    assert bag(jaccard_join.join_report(frame).collect()) == brute_classes(both(frame))


def test_one_of_each_class_stays(docs):
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([1, 3, 5, 7, 8, 9, 10, None, 12, 13])


def test_bands_reach_the_recall():
    bands, rows = jaccard_join.bands_for(0.8, 0.999, 128)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.999


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = graph.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in got} == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


# Personal data

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "card":
        twice = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits[::-1])]
        return 14 <= len(digits) <= 19 and sum(twice) % 10 == 0
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    return kind == "email" or 10 <= len(digits) <= 15


def spans(text):
    found = [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for rank, kind in enumerate(KINDS)
             for m in re.finditer(KINDS[kind], text) if passes(kind, m.group())]
    return [s for _, _, s in sorted(found)]


@pytest.mark.parametrize("table", ["docs", "given_docs"])
def test_base_spans(request, table):
    frame = request.getfixturevalue(table)
    want = []
    for i, text in both(frame):
        found = spans(text)
        want.append((i, *(sum(s.startswith(k) for s in found) for k in KINDS),
                     hashlib.sha256(",".join(found).encode()).hexdigest()))
    assert bag(pii.report(frame).drop("spans").collect()) == bag(want)


def test_odd_digit_runs(spark):
    texts = [(k, t, None, None) for k, t in enumerate([
        "1" * 30, "4111111111111111" * 2, "4111 1111 1111 1111 1", "0 4111111111111111", "1.2.3.4.5.6.7.8",
        "0001.2.3.04", "+1234567890 - ", "++1 234 567 8901", "a@b a@b.c. a@b.c-.d", "x@y.z@w.v", "+12" + " 3" * 20])]
    frame = rows_of(spark, texts)
    got = {r.doc_id: r.base_sha256 for r in pii.report(frame).collect()}
    for i, text, *_ in texts:
        assert got[i] == hashlib.sha256(",".join(spans(text)).encode()).hexdigest(), text


def test_context_finds_unseen_identifiers(spark):
    seeds = [f"write to caller u{k}@site.org today please" for k in range(150)]
    texts = [(k, t, None, None) for k, t in enumerate([*seeds, "write to caller ID-99812345 today please",
                                                       "about item 99812346 sold"])]
    got = {r.doc_id: r.spans for r in pii.report(rows_of(spark, texts)).collect()}
    assert got[150] == "context:16:27" and got[151] == ""


def test_context_needs_no_large_table(spark):
    seeds = [f"write to caller u{k}@site.org today please" for k in range(30)]
    seeds += [f"{'abcdefghijkl'[k] * 4} = v{k}@site.org" for k in range(12)]
    more = ["write to caller ID-99812345 today please", "write to caller 5 82 (61) 99 43, today please",
            "write to caller ID-99812345 ID-99812399 today please", "other words end in 99812388",
            "zzzz | 99812377"]
    texts = [(k, t, None, None) for k, t in enumerate([*seeds, *more])]
    got = {r.doc_id: r.spans for r in pii.report(rows_of(spark, texts)).collect()}
    assert [got[42 + k] for k in range(5)] == [
        "context:16:27", "context:16:31", "context:16:27,context:28:39", "", ""]


def test_edges_are_no_context(spark):
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "klmnp"]
    texts = [(k, f"{w} u{k}@site.org", None, None) for k, w in enumerate(words)]
    texts += [(200, "xyz 99812345", None, None)]
    got = {r.doc_id: r.spans for r in pii.report(rows_of(spark, texts)).collect()}
    assert got[200] == "" and got[0] == "email:4:15"


def test_thousands_of_spans_in_one_text(spark):
    piece = "from 10.0.{k}.7 to a{k}@b.de, é +49 151 {k}1234567 or "
    text = "".join(piece.format(k=k % 256) for k in range(2000))
    frame = rows_of(spark, [(1, text, "en", "a")])
    row = pii.report(frame).first()
    assert [row.n_ip, row.n_email, row.n_phone] == [2000, 2000, 2000]
    want = "".join("from <IP> to <EMAIL>, é <PHONE> or " for _ in range(2000))
    assert pii.mask(frame).first().text == want


def test_masking(docs):
    kept = {(r.doc_id, r.text): r for r in pii.mask(docs).collect()}
    texts = {i: t for i, t in kept if i in (2, 8)}
    assert texts[2] is None
    assert texts[8] == "mail <EMAIL>, then <IP> or 10.0.0.256 call <PHONE>!"
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in kept.values())


# Mixing

def test_mix_meets_its_targets(given_docs):
    rows = mixing.report(given_docs).collect()
    source = {r.doc_id: r.source for r in given_docs.select("doc_id", "source").collect()}
    sizes = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        sizes.setdefault(source[r.doc_id], []).append(r)
    names = sorted(sizes)
    weight = {n: (5, 2, 1)[k % 3] for k, n in enumerate(names)}
    total = {n: sum(r["size"] for r in sizes[n]) for n in names}
    target, rest, left = {}, 1.5 * sum(total.values()), set(names)
    while True:
        level = rest / sum(weight[n] for n in left)
        over = {n for n in left if weight[n] * level > 2 * total[n]}
        if not over:
            break
        for n in over:
            target[n] = 2.0 * total[n]
            rest -= target[n]
        left -= over
    target.update({n: weight[n] * level for n in left})
    for n in names:
        assert all(r.target == pytest.approx(target[n]) for r in sizes[n])
        assert {r.source_size for r in sizes[n]} == {total[n]}
        assert abs(sum(r.taken for r in sizes[n]) - target[n]) <= 1
    assert bag(mixing.report(given_docs).collect()) == bag(rows)


def test_shards_share_no_block(docs):
    sizes = mixing.measured(docs, 16)
    drawn, aims = mixing.mix(sizes, shards=4, block_words=16)
    rows = drawn.collect()
    assert len({(r.row, r.round, r.block) for r in rows}) == len(rows)
    assert {r.shard for r in rows} <= set(range(4))
    assert sum(r.words for r in rows) == sum(round(r.target) for r in aims.collect())


def test_hypergeometric_split(spark):
    quotas = [(0, 1000), (1, 300), (2, 7), (3, 0)]
    frame = spark.createDataFrame(quotas, "rank int, quota long")
    totals = [0] * 8
    for r in mixing.split_tree(frame, 8).collect():
        ends = [*r.starts[1:], dict(quotas)[r["rank"]]]
        for k, (a, b) in enumerate(zip(r.starts, ends)):
            assert b >= a
            totals[k] += b - a
    assert sum(totals) == 1307 and max(totals) - min(totals) <= 3
    firsts = []
    for seed in range(40):
        rows = {r["rank"]: r.starts for r in mixing.split_tree(frame, 2, seed).collect()}
        firsts.append(rows[0][1])
    assert 490 < sum(firsts) / 40 < 510 and len(set(firsts)) > 10


def test_mixed_documents(docs):
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    words = sum(len(WORD.findall(r.text or "")) for r in out.collect())
    taken = sum(r.taken for r in mixing.report(docs).collect())
    assert words == taken


def test_report_tells_what_each_shard_takes(given_docs):
    rows = mixing.report(given_docs, shards=4, block_words=16).collect()
    dealt = [[r[f"shard_{k}"] for k in range(4)] for r in rows]
    assert [sum(d) for d in dealt] == [r.taken for r in rows]
    drawn, _ = mixing.mix(mixing.measured(given_docs, 16), shards=4, block_words=16)
    want = Counter()
    for r in drawn.collect():
        want[r.shard] += r.words
    assert [sum(d[k] for d in dealt) for k in range(4)] == [want[k] for k in range(4)]
    assert min(want.values()) > 0


def test_mixed_rows_stand_in_shard_order(docs, spark):
    numbered = [(k, i, t, s) for k, (i, t, _, s) in enumerate(TEXTS)]
    frame = spark.createDataFrame(numbered, "row long, doc_id long, text string, source string")
    drawn, _ = mixing.mix(mixing.measured(frame, 16, True), shards=3, block_words=16)
    want = []
    for r in drawn.collect():
        _, doc_id, text, _ = numbered[r.row]
        words = WORD.findall(text)[16 * r.block:16 * r.block + r.words]
        want.append((r.shard, r.slot, -1 if doc_id is None else doc_id, " ".join(words)))
    out = mixing.mixed(docs, shards=3, block_words=16)
    got = [(-1 if r.doc_id is None else r.doc_id, " ".join(WORD.findall(r.text))) for r in out.collect()]
    assert got == [(i, t) for _, _, i, t in sorted(want)]
    parts = out.rdd.glom().map(len).collect()
    assert len(parts) % 3 == 0 and sum(n > 0 for n in parts) >= 3
    kept = [r.text for r in mixing.mixed(docs).collect() if r.doc_id == 7]
    assert all("\n\n" in t for t in kept if len(t.split()) == 9)


# Packing

def test_best_fit_takes_the_tightest_compatible_bin():
    pieces = [(7, "a", 1), (6, "b", 2), (3, "a", 3), (3, "c", 2), (2, "c", 4), (1, "d", 1)]
    chosen, used = packing.best_fit(pieces, 10)
    open_bins = []
    for (size, source, cluster), which in zip(pieces, chosen):
        fits = [(room, k) for k, (room, held) in enumerate(open_bins) if room >= size and not any(
            s == source or c == cluster for s, c in held)]
        want = min(fits)[1] if fits else len(open_bins)
        assert which == want
        if want == len(open_bins):
            open_bins.append((10, []))
        room, held = open_bins[want]
        open_bins[want] = (room - size, [*held, (source, cluster)])
    assert used == [10 - room for room, _ in open_bins]


@pytest.mark.parametrize("table", ["docs", "given_docs"])
def test_packing_places_every_word_once(request, table):
    frame = request.getfixturevalue(table)
    rows = packing.pack_documents(frame, capacity=500, shard_docs=60).collect()
    sizes = Counter()
    bins = {}
    for r in rows:
        sizes[r.doc_id] += r.n_words
        if r.n_words:
            bins.setdefault(r.bin_id, []).append(r)
        else:
            assert r.bin_id is None
    want = Counter()
    for i, text in both(frame):
        want[i] += len(WORD.findall(text))
    assert sizes == want
    source = {r.doc_id: r.source for r in frame.select("doc_id", "source").collect()}
    for held in bins.values():
        assert sum(r.n_words for r in held) == held[0].bin_words <= 500
        assert sorted(r.slot for r in held) == list(range(len(held)))
        assert len({source[r.doc_id] for r in held}) == len(held)


def test_no_bin_holds_near_copies(spark, tmp_path):
    base = [f"w{k}" for k in range(60)]
    texts = [(n, " ".join([*base, f"end{n}"]), "en", f"s{n}") for n in range(8)]
    texts += [(20 + n, " ".join(f"x{n}y{k}" for k in range(60)), "en", f"t{n}") for n in range(8)]
    rows_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op1_best_fit_packing"](spark, str(tmp_path)).collect()
    assert len(rows) == 16 and sum(r.n_words for r in rows) == 8 * 61 + 8 * 60
    assert len({r.bin_id for r in rows if r.doc_id < 20}) == 8
    assert len({r.bin_id for r in rows if r.doc_id >= 20}) == 1


# Fingerprints

def brute_winnow(text, gram, window):
    hashes = fingerprints.Winnower(gram, window).hashes(text).tolist()
    kept = []
    for k in range(max(1, len(hashes) - window + 1) if hashes else 0):
        part = hashes[k:k + window]
        at = k + max(j for j, h in enumerate(part) if h == min(part))
        if not kept or kept[-1] != (hashes[at], at):
            kept.append((hashes[at], at))
    return kept


@pytest.mark.parametrize("gram, window", [(1, 3), (3, 1), (4, 5), (25, 64)])
def test_winnowing(gram, window):
    winnower = fingerprints.Winnower(gram, window)
    for text in ["", "a", "aaaaaaaaaaaaaaaa", "abcabcabcabd" * 30, LONG[:3000], "é𝒳" * 50]:
        hashes, positions = winnower.select(text)
        assert list(zip(hashes.tolist(), positions.tolist())) == brute_winnow(text, gram, window)
    one, other = "xyz" + LONG[500:700] + "q", LONG[:900]
    assert set(winnower.select(one)[0].tolist()) & set(winnower.select(other)[0].tolist())


@pytest.mark.parametrize("table", ["docs", "given_docs"])
def test_edited_texts(request, table):
    frame = request.getfixturevalue(table)
    pairs = sorted(both(frame), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = []
    for k, (i, text) in enumerate(pairs):
        part, following = len(text) // 4, pairs[(k + 1) % len(pairs)][1]
        edited = text[:len(text) - part] + following[:part]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    rows = fingerprints.report(frame).collect()
    assert bag((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == bag(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    if table == "docs":
        assert next(r for r in rows if r.doc_id == 3).near_next == 1


def test_short_texts_share_hashes_with_their_edits(spark):
    draw = random.Random(8)
    texts = [(k, "".join(draw.choices("abcdefghijklmnop ", k=80)), "en", "a") for k in range(60)]
    rows = fingerprints.report(rows_of(spark, texts)).collect()
    assert all(r.near_edited > 0 for r in rows)
    assert sum(r.near_edited for r in rows) > 0.4 * len(rows)


def test_each_row_has_a_next_one_however_many_buckets(spark):
    ids = [2**53 + 1, 2**53 + 3, 2**53 + 2, -4, None, None, 7, 7]
    frame = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string")
    for buckets in (1, 3, 50):
        rows = fingerprints.with_next(frame, buckets).collect()
        own = [r for r in rows if not r.guest]
        assert bag((r.doc_id, r.text) for r in own) == bag(both(frame))
        order = sorted({(r.bucket, r.doc_id) for r in own}, key=lambda x: (x[1] is None, x[1] or 0))
        assert [b for b, _ in order] == sorted(b for b, _ in order)
        used = sorted({b for b, _ in order})
        for at, home in enumerate(used):
            following = used[(at + 1) % len(used)]
            first = next(i for b, i in order if b == following)
            guests = bag((r.doc_id, r.text) for r in rows if r.guest and r.bucket == home)
            assert guests == bag((r.doc_id, r.text) for r in own if r.bucket == following and r.doc_id == first)


# Licenses

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def phrase_places(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [(k, label) for phrase, label in PHRASES.items() for k in range(len(words))
             if words[k:k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in found]
    return (len(words), len(found), min(places, default=None), max(places, default=None),
            ",".join(sorted({label for _, label in found})))


@pytest.mark.parametrize("table", ["docs", "given_docs"])
def test_base_phrases(request, table):
    frame = request.getfixturevalue(table)
    rows = licenses.report(frame).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert bag(rows.collect()) == bag((i, *phrase_places(t)) for i, t in both(frame))


@pytest.mark.parametrize("text, labels", [
    ("licensed under the apache license, version 2.0.", ["apache-2.0"]),
    ("gnu general public license, version 3 or any later version", ["gpl-3.0-or-later"]),
    ("gnu lesser general public license v2.1", ["lgpl-2.1"]),
    ("licensed under cc by-nc-sa 4.0", ["cc-by-nc-sa-4.0"]),
    ("released under the mit license", ["mit"]), ("a mitten and a licence plate", []),
    ("spdx-license-identifier: mpl-2.0", ["mpl-2.0"]),
    ("gnu lesser general public license v3", ["lgpl-3.0"]),
    ("mozilla public\nlicense 2.0", ["mpl-2.0"]), ("mpl-2.0 or the mit license", ["mpl-2.0", "mit"]),
    ("python 2, php 3 and an apache 2 pilot", []), ("a couple of simple examples, replaced", []),
    ("see licenses/gpl-3.0 or /licenses/by-sa/4.0/", ["gpl-3.0"]),
    ("https://creativecommons.org/licenses/by-sa/4.0/", ["cc-by-sa-4.0"]), ("(c) 2010 me", ["copyright"])])
def test_signatures(text, labels):
    assert len(licenses.rules()) > 200
    assert [rule.label for *_, rule in licenses.scan(text)] == labels


def test_keywords_hide_no_find(given_docs):
    for _, text in both(given_docs):
        lowered = text.lower().replace("\n", " ")
        tried = set(licenses._tried(lowered))
        for rank, rule in enumerate(licenses.rules()):
            assert rank in tried or not re.search(rule.pattern, lowered)


def test_contained_stretches():
    draw = random.Random(4)
    for _ in range(200):
        held, there = licenses.Stretches(), []
        for _ in range(40):
            start = draw.randrange(30)
            end = start + draw.randrange(1, 12)
            assert held.add(start, end) == (not any(a <= start and end <= b for a, b in there))
            there.append((start, end))


def test_many_finds_in_one_text():
    assert len(licenses.scan("licensed under gplv3. " * 50_000)) == 50_000


# Secrets

def test_secret_candidates(given_docs):
    pattern = re.compile(r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z0-9_+/=-]*[0-9])[A-Za-z0-9_+/=-]{16,}")
    want = [(i, m.start(), m.end()) for i, t in both(given_docs) for m in pattern.finditer(t)]
    rows = secrets.scan(given_docs)
    assert bag(rows.select("doc_id", "start", "end").collect()) == bag(want)


def test_forest_tells_secrets_from_other_runs(spark):
    key = [hashlib.sha1(str(k).encode()).hexdigest() for k in range(80)]
    texts = [(k, f'set token = "{key[k]}" now', None, None) for k in range(60)]
    texts += [(100 + k, f"order number {key[k].translate({c: 49 + c % 9 for c in range(97, 103)})} shipped", None, None)
              for k in range(60)]
    texts += [(200, f"commit {key[70]} merged", None, None)]
    got = {r.doc_id: r.is_secret for r in secrets.scan(rows_of(spark, texts)).collect()}
    assert all(got[k] for k in range(60)) and not any(got[100 + k] for k in range(60)) and not got[200]


# Models

def test_languages(given_docs, spark):
    rows = language_id.report(given_docs).collect()
    truth = {r.doc_id: r.lang for r in given_docs.collect()}
    unseen = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and unseen
    assert sum(truth[r.doc_id] == r.lang_pred for r in unseen) >= 0.95 * len(unseen)
    model = language_id.train(given_docs)
    assert model.judge("") == ("und", 0.0, True) and model.judge("12 !? 3")[0] == "und"
    assert model.judge("Ωμέγα και άλφα " * 30)[2]


def test_language_chances_add_up():
    grams = language_id.packed(language_id.characters("banana bandana"))
    found, n = language_id.np.unique(grams, return_counts=True)
    model = language_id.build({"x": (found, n)})
    logs = {int(k): v for k, v in zip(model.keys[4], model.logs[4][:, 0])}
    letters = sorted(set("band "))
    context = language_id.characters("ana")[-3:]
    total = 0.0
    for c in letters:
        chars = language_id.np.append(context, language_id.np.uint64(ord(c)))
        key = language_id.packed(chars)
        at = int(language_id.hashed(key)[0])
        if at in logs:
            total += float(language_id.np.exp(logs[at]))
        else:
            total += float(language_id.np.exp(_backed_off(model, key)))
    assert 0.8 < total <= 1.0 + 1e-6


def _backed_off(model, grams):
    np, log = language_id.np, 0.0
    for order in range(4, 0, -1):
        part = language_id._suffix(grams, order) if order < 4 else grams
        at, known = language_id._find(model.keys[order], language_id.hashed(part))
        if known[0]:
            return log + model.logs[order][at[0], 0]
        at, known = language_id._find(model.contexts[order], language_id.hashed(part >> np.uint64(16)))
        log += model.backoffs[order][at[0], 0] if known[0] else 0.0
    return log + model.floor


def test_toxicity_grammar():
    grammar = toxicity.Grammar({"idiot": 3.0})
    plain = grammar.clause("what an idiot".split())
    assert grammar.clause("you are an idiot".split()) > plain
    assert grammar.clause("not an idiot".split()) < plain
    assert grammar.clause("someone said idiot".split()) < plain
    assert grammar.clause("i will kill you".split()) > 0 == grammar.clause("kill the process".split())
    assert grammar.score("") == grammar.score("a calm text") < 0.5 < grammar.score("you idiot")


def test_toxicity_is_found(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.report(docs, labels).collect() if r.doc_id in truth]
    clean = [r.predicted for r in rows if not truth[r.doc_id]]
    toxic = [r.predicted for r in rows if truth[r.doc_id]]
    assert sum(clean) <= 0.01 * len(clean) and sum(toxic) >= 0.6 * len(toxic)


def test_models_without_labels(docs, empty, spark):
    bare = docs.withColumn("lang", language_id.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.report(bare).collect()} == {"und"}
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.report(docs, none).collect()
    assert len(rows) == len(TEXTS) and {r.predicted for r in rows} == {0}


@pytest.mark.parametrize("run", [
    packing.pack_documents, pii.report, pii.mask, mixing.report, mixing.mixed, quality_rules.report,
    quality_rules.keep_good, jaccard_join.join_report, jaccard_join.keep_first, fingerprints.report,
    fingerprints.fingerprints, licenses.report, language_id.report, secrets.scan])
def test_empty_tables(empty, run):
    assert run(empty).collect() == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
