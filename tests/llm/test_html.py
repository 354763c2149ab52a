import itertools
import time

import numpy as np
import pytest

from sixfold.llm import html

HOSTILE = {
    "odd quotes": '<a "' * 16_000,
    "mixed quotes": "<a '\"<b \"" * 12_000,
    "stray ends": "<span>" * 20_000 + "</b>" * 20_000,
    "ends behind blocks": "<b>" + "<div>" * 20_000 + "</b>" * 20_000,
    "headings": "<span>" * 20_000 + "<h1>" * 20_000,
    "one long name": "<a" * 50_000 + ' "',
    "bodies": "<body class=a>" * 20_000,
    "long reference": "<p>&#" + "9" * 100_000 + ";&#x" + "f" * 100_000,
    "open comments": "<!--" * 50_000,
}


def texts(page):
    return [html.block_text(n) for n in html.describe(html.parse(page))[0] if n.tag == "#run"]


@pytest.mark.parametrize("kind", HOSTILE)
def test_hostile_pages_take_linear_time(kind):
    began = time.process_time()
    texts(HOSTILE[kind])
    assert time.process_time() - began < 3


def test_tags_with_odd_quotes():
    assert texts('<p>a<b title="x>y">c</b>') == ["ac"]
    assert texts('<p>1 < 2 <i>"so"</i> it\'s') == ['1 < 2 "so" it\'s']
    assert texts('<p>a</p><p title="open>b</p>') == ["a", '<p title="open>b']


def test_unseen_inline_elements():
    page = '<p>a <span class="advert">buy <b>now</b></span>b <i style="display: none">x</i>c <u hidden>y</u><a href="/?id=ad" class=share>d</a></p>'
    assert texts(page) == ["a b c d"]


def test_references():
    assert texts("<p>&am<b>p;</b> &lt;b&gt; &#0000000065; &#x0000000041; &#99999999999;") == ["&amp; <b> A A \ufffd"]


def test_decode_is_the_best_of_all_choices():
    rng = np.random.default_rng(3)
    for _ in range(60):
        nodes = [html.Node("body", (), None)]
        for _ in range(rng.integers(1, 8)):
            nodes.append(html.Node("div", (), nodes[rng.integers(len(nodes))]))
        nodes, _ = html.describe(nodes[0])
        number = {id(n): k for k, n in enumerate(nodes)}
        odds = rng.normal(size=len(nodes)).round(3)
        kept = html.decode(nodes, odds)
        score = lambda c: sum(o for o, x in zip(odds[1:], c[1:]) if x)
        allowed = lambda c: all(not c[k] or c[number[id(n.parent)]] for k, n in enumerate(nodes) if n.parent)
        best = max(score(c) for c in itertools.product(*[(True,), *[(False, True)] * (len(nodes) - 1)]) if allowed(c))
        assert allowed(kept) and abs(score(kept) - best) < 1e-9
