import itertools
import random
import re
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import dom, extraction
from lumenframe.llm.dom import blocks
from lumenframe.llm.labelled_pages import labelled_pages


class Article(HTMLParser):
    """Text blocks between <article> tags, cut at the tags of its paragraphs and headings."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        self.parts.append("") if tag in ("article", "p", "h1") else self.handle_data(" " if tag == "br" else "")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("article", "p", "h1"):
            self.parts.append("")

    def handle_data(self, data):
        if self.inside:
            self.parts[-1] += data


def test_pages_equal_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extraction.extract(pages).collect()}
    for r in pages.collect():
        p = Article()
        p.feed(r.html)
        lines = [re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ") for x in p.parts]
        want = "\n".join(x for x in lines if x)
        assert (got[r.page_id].url, got[r.page_id].text, got[r.page_id].n_chars) == (r.url, want, len(want))


def test_held_out_labelled_pages():
    field, wrong, n, clean = extraction.default_field(), 0, 0, 0
    pages = labelled_pages(200, seed=77)
    for page in pages:
        found, labels = extraction.marked(page)
        got = field.decode(found)
        wrong += sum(a != b for a, b in zip(labels, got))
        clean += all(a == b for a, b in zip(labels, got))
        n += len(labels)
    assert wrong / n < 0.01 and clean / len(pages) > 0.9


PAGE = """<html><body><header><h1>Site</h1><p>Read it all here.</p></header><div class="cookie-consent"><p>We use cookies, you agree.</p></div>
<div class=sidebar><p>About the author of this site.</p></div><main><h1>A &lt;title&gt;&nbsp;x</h1><p>One&#10; two
 three<b>four</b> <i>five</i>.<p>Second paragraph here<!-- no --> goes on.<script>if (a < b) "</p>"</script><ul><li>item</ul>
<div class="ad"><p>Buy this now, it is good.</p></div></main><section id=comments><p>I liked this very much.</p></section>
<form><p>Leave your address here.</p></form><footer>&copy; 2020 site</footer></body></html>"""


def test_a_page_with_everything():
    got = extraction.main_text(extraction.default_field(), PAGE)
    assert got == "A <title> x\nOne two threefour five.\nSecond paragraph here goes on.\nitem"


def test_viterbi_equals_all_labellings():
    field = extraction.default_field()
    for page in labelled_pages(30, seed=5):
        found = list(blocks(page))[:9]
        gain = [sum(field.weights.get(f, 0.0) for f in extraction.features(b)) for b in found]
        value = lambda p: sum(g for g, y in zip(gain, p) if y) + sum(field.steps[a][b] for a, b in zip(p, p[1:]))
        best = max(map(value, itertools.product((0, 1), repeat=len(found))))
        assert value([int(y) for y in field.decode(found)]) == pytest.approx(best)


def test_training_raises_the_likelihood():
    few = labelled_pages(20, seed=3)
    wrong = lambda f: sum(np.sum(np.array(f.decode(b)) != np.array(y)) for b, y in map(extraction.marked, few))
    assert wrong(extraction.train(few, rounds=60)) < wrong(extraction.train(few, rounds=1))


def test_odd_pages(spark):
    odd = [None, "", "<", "<p", "plain text", "<div " * 3000, "<div>" * 3000 + "x", '<a href="' * 2000, "<!-- never closed", "<script>x", "&amp", "<b></p></div>y", "<article><p>" + "long text here. " * 100_000]
    rows = [(k, None if k % 3 else "u", x) for k, x in enumerate(odd)] + [(None, "u", "<article><p>One. Two.</article>")] * 2
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = extraction.extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert sum(r.text == "One. Two." for r in got) == 2
    assert max(r.n_chars for r in got) == 1_599_999
    assert extraction.extract(df.limit(0)).collect() == []


def test_deep_pages_cost_their_length():
    """Stray end tags below open elements, distinct classes at every level, closings looked for in vain."""
    pages = {
        "stray": lambda n: "<b>x" * n + "</i>" * n,
        "classes": lambda n: "".join(f'<div class="c{k}x">t' for k in range(n)),
        "below a table": lambda n: "<p><table>" + "<div>t" * n,
        "items": lambda n: "<ul>" + "<div><li>t" * n,
        "cells": lambda n: "<table>" + "<section><td>t" * n,
    }
    for make in pages.values():
        took = []
        for n in (8_000, 32_000):
            page = make(n)
            t0 = time.process_time()
            found = list(blocks(page, extraction.stands_for))
            took.append(time.process_time() - t0)
            assert sum(len(b.text) for b in found) == n
        assert took[1] < 8 * took[0] + 0.5 and took[1] < 6


def test_closing_rules_are_those_of_the_walk():
    """Random pages against a plain walk up the stack."""
    rng = random.Random(4)
    tags = ["p", "div", "li", "ul", "td", "tr", "table", "dt", "dd", "dl", "option", "select", "b", "button", "span"]
    for _ in range(300):
        page, stack, want = [], [], []
        for k in range(rng.randrange(40)):
            tag = rng.choice(tags)
            if rng.random() < 0.6:
                page.append(f"<{tag}>")
                for sought, scope in [({"p"}, dom._P_SCOPE)] * (tag in dom.ENDS_P) + ([dom.CLOSES[tag]] if tag in dom.CLOSES else []):
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i] in sought:
                            del stack[i:]
                        if i >= len(stack) or stack[i] in scope:
                            break
                stack.append(tag)
            else:
                page.append(f"</{tag}>")
                if tag in stack:
                    while stack.pop() != tag:
                        pass
            page.append(f"w{k}<svg/>")  # ends the block, opens nothing
            want.append((f"w{k}", frozenset("<" + t for t in stack)))
        assert [(b.text, b.around) for b in blocks("".join(page))] == [w for w in want]
