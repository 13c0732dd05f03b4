"""The decoder against the standard library's."""

import html
import random
from html.entities import html5

from equifacts.functions.entities import unescape


def check(values, texts):
    got = values(unescape, texts)
    wrong = [(t, g, html.unescape(t)) for t, g in zip(texts, got, strict=True) if t is not None and g != html.unescape(t)]
    assert wrong == []


def test_every_name(values):
    names = sorted(html5)
    check(values, [f"&{n}" for n in names] + [f"a &{n}x" for n in names] + [f"&{n.rstrip(';')} b" for n in names]
          + [f"&{n.upper()}&{n}" for n in names])


def test_numbers(values):
    points = [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF,
              0x10000, 0x1FFFE, 0x1F600, 0x10FFFD, 0x10FFFF, 0x110000, 10**9, 10**30]
    check(values, [f(p) for p in points for f in (
        "&#{};".format, "&#{}x".format, "&#x{:x};".format, "&#X{:X} ".format, "&#000{};".format, "&#x0000000000{:x};".format)])


def test_what_is_no_entity(values):
    check(values, ["", "&", "&&", "& amp;", "&;", "&#;", "&#x;", "&#xg;", "a&b", "&ampamp;", "&amp;amp;", "&notit;", "&notin;",
                   "&noti", "x" * 5000 + "&lt;", "&" + "y" * 40 + ";", "&é;", "&lt&gt", "$1 \\ &amp; $", "&\n"])
    assert values(unescape, [None]) == [None]


def test_random_texts(values):
    rng = random.Random(4)
    bits = ["&", "#", "x", "X", ";", "amp", "lt", "not", "in", "nbsp", "38", "3c", "é", " ", "\t", "<", "copy", "0", "frac12", "𝒳"]
    check(values, ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 15))) for _ in range(3000)])
