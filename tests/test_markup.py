"""The container walk against the standard library's parser, on sound and on wrong nesting."""

import random
from html.parser import HTMLParser

import pytest

from equifacts.functions.markup import SILENT, VOID, container_text

RULES = [("id", "info", "class", "one"), ("id", "info", "class", "two")]


class Walk(HTMLParser):
    def __init__(self, rules):
        super().__init__(convert_charrefs=True)
        self.rules = [list(zip(r[::2], r[1::2])) for r in rules]
        self.texts, self.taking = [None] * len(rules), [None] * len(rules)
        self.stack, self.run = [], []

    def flush(self):
        text, self.run = "".join(self.run).strip(), []
        if text and not any(tag in SILENT for tag, _ in self.stack):
            for r, depth in enumerate(self.taking):
                if depth is not None:
                    self.texts[r].append(text)

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag in VOID:
            return
        attrs = dict(attrs)
        done = list(self.stack[-1][1]) if self.stack else [0] * len(self.rules)
        for r, rule in enumerate(self.rules):
            if done[r] < len(rule):
                kind, value = rule[done[r]]
                own = attrs.get(kind) or ""
                if tag == value if kind == "tag" else value in own.split() if kind == "class" else own == value:
                    done[r] += 1
                    if done[r] == len(rule) and self.texts[r] is None:
                        self.texts[r], self.taking[r] = [], len(self.stack)
        self.stack.append((tag, done))

    def handle_endtag(self, tag):
        self.flush()
        at = max((k for k, (t, _) in enumerate(self.stack) if t == tag), default=None)
        if at is not None:
            del self.stack[at:]
            self.taking = [None if d is not None and d >= at else d for d in self.taking]

    def handle_data(self, data):
        self.run.append(data)

    def handle_comment(self, data):
        self.flush()

    def text(self, html):
        self.feed(html)
        self.close()
        self.flush()
        return next((" ".join(t) for t in self.texts if t is not None), None)


def check(values, htmls, rules):
    got = values(lambda c: container_text(c, rules), htmls)
    wrong = [(h, g, w) for h, g in zip(htmls, got, strict=True)
             if g != (w := None if h is None else Walk(rules).text(h))]
    assert wrong == []


def test_written_cases(values):
    box = '<div id="info">{}</div>'
    check(values, [
        None, "", "<", "one", box, box.format('<p class="one">a<b>b</b> c</p> d'), "<p class=one>not enclosed</p>",
        box.format("<p class='x one y'>a</p>"), box.format("<P CLASS=one>a<BR>b<br/>c</P>d"),
        box.format('<p class="two">a</p>'), box.format('<p class="two">a</p><p class="one"></p>'),
        box.format('<p class="one">a<p class="one">b</p>c</p>d'), box.format('<p class="one">a</div>b</p>c'),
        box.format('<p class="one">a</i></b>b'), '<div id="info"><p class="one">never closed &amp; <i>on',
        box.format('<p class="one"><script>if (a < b) "</p>";</script><style>x</style><template>t<b>u</b></template>y</p>'),
        box.format('<p class="one">a<!-- <b> -->b<!doctype x>c<?php x?>d</p>'), box.format('<p title="a > b" class="one">a</p>'),
        '<div class="one"><div id="info">a</div></div>', '<div id="info" class="one">a<div class="one">b</div></div>',
        box.format('<p data-class="one">a</p><p class="one" class="two">b</p>'), box.format('<p class="one">&lt;i&gt; &nbsp;</p>'),
        box.format('<p class="one">a</ p >b</p>'), box.format("<p class=\"one\">3 < 4 and 5 <6</p>"),
    ], RULES)


@pytest.mark.parametrize("seed", [1, 2])
def test_wrong_nesting(values, seed):
    rng = random.Random(seed)
    bits = ['<div id="info">', '<div class="one">', '<p class="two x">', "<p>", "<b>", "<i class=one>", "</div>", "</p>", "</b>",
            "</i>", "<br>", "text", " ", "&amp;", "\n", "<!-- c -->", "<script>x</script>", "<template>", "</template>", "</x>"]
    check(values, ["".join(rng.choice(bits) for _ in range(rng.randrange(2, 40))) for _ in range(1500)], RULES)


def test_long_tags(values):
    body = '<div id="info"><p {} class="one">a</p></div>'
    check(values, [body.format("x=" + "y" * 200_000), body.format(" ".join(f'a{k}="{k}"' for k in range(3000))),
                   "<p>z</p>" * 20_000 + body.format(""), body.format("") + "<b>" * 300], RULES)


def test_given_pages(spark, values):
    htmls = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    check(values, htmls, [("tag", "article")])
    check(values, htmls, [("tag", "body", "tag", "p"), ("tag", "p")])


def test_values_spelled_as_entities_and_deep_wrong_nesting(spark):
    pages = [
        '<div id="info"><p class="x o&#110;e">a<b>b</div>c',
        "<p><i><div id=info><span><u class='two'>x<template>no</template><em>y</p>z",
        '<div id=info><br class=one><p class="one two">k<li>l<li>m</p></div>']
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    found = [r.v for r in rows.select("i", container_text(rows.h, RULES).alias("v")).orderBy("i").collect()]
    assert found == [Walk(RULES).text(p) for p in pages] == ["a b", "x y", "k l m"]
