"""Inputs on which operators used to do less than the whole job."""

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vocabspark.llm import html_main, katz, pii, suffix_dedup


def test_ip_after_a_very_long_run_of_digits(spark):
    long = "1" * 5000 + ".1.1.1"
    zeros = "0" * 5000 + "7.1.1.1"
    rows = [(1, long), (2, zeros), (3, "on 256.1.1.1 and 0255.0.00.255"), (4, "9" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [tuple(s)[:3] for s in r.spans if s["kind"] == "ip"] for r in pii.spans(docs).collect()}
    assert got == {1: [], 2: [("ip", 0, 5007)], 3: [("ip", 17, 30)], 4: []}
    clean = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert clean[1] == long and clean[2] == "[IP]" and clean[4] == rows[3][1]


def _katz(training, texts):
    """Log10 probabilities of texts under a backoff model of order two, by definition."""
    count = Counter(w for t in training for w in t)
    total, ends = sum(count.values()) + len(training), len(training)
    p0 = min(0.5, max(sum(n == 1 for n in count.values()) / total, 1 / (total + 1)))
    single = Counter(count) + Counter({"</s>": ends})
    p = lambda w: (1 - p0) * single[w] / total if single[w] else p0
    pairs = Counter(pair for t in training for pair in zip(["<s>", *t], [*t, "</s>"]))
    d = katz.discounts(np.array([sum(n == r for n in pairs.values()) for r in range(1, katz.CUT + 2)], float))
    held = Counter(count) + Counter({"<s>": ends})
    after = {}
    for (h, w), n in pairs.items():
        after.setdefault(h, []).append((w, n, (d[n - 1] if n <= katz.CUT else 1.0) * n / (held[h] + 0.5)))
    alpha = {h: (1 - sum(x for *_, x in found)) / (1 - sum(p(w) for w, *_ in found)) for h, found in after.items()}
    seen = {(h, w): x for h, found in after.items() for w, _, x in found}
    one = lambda h, w: np.log10(seen[h, w] if (h, w) in seen else alpha.get(h, 1.0) * p(w))
    return [sum(one(h, w) for h, w in zip(["<s>", *t], [*t, "</s>"])) for t in texts]


@pytest.mark.parametrize("words", [0, 4, 40, 1 << 20])
def test_katz_scores_whatever_the_table_holds(spark, monkeypatch, words):
    monkeypatch.setattr(katz, "TABLE_WORDS", words)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 300)
    rnd = random.Random(4)
    texts = [" ".join(f"w{int(rnd.paretovariate(0.6))}" for _ in range(rnd.randrange(60))) for _ in range(60)] + ["", "new newer", "new newer"]
    rows = [(i, t) for i, t in enumerate(texts)]
    out = katz.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), F.col("doc_id") % 4 != 0).collect()
    split = [re.findall(r"\S+", t) for t in texts]
    want = _katz([t for i, t in enumerate(split) if i % 4], split)
    got = {r.doc_id: r.score for r in out}
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, rel=1e-9)


PROSE = " ".join(["some words of an article that go on for long enough to be prose"] * 3)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class='no-sidebar'><p>one two</p></div>", "one two"),
        ("<div class='has-sidebar content-with-nav header-fixed'><p>one</p><p>two</p></div>", "one\ntwo"),
        ("<article><h2 id='related-work'>Related</h2><h2 id=search>Search</h2><p class=notice id='alert'>text</p></article>", "Related\nSearch\ntext"),
        ("<article><p>a <span class=share>word</span> b</p><ul><li id=comment>x</ul></article>", "a word b\nx"),
        ("<article><p>long</p><section id=reply><p>more</p></section><div id=notice><p>and</p></div></article>", "long\nmore\nand"),
        ("<div class=overlay><div><p>most of the text</p></div></div><p>x</p>", "most of the text"),
        ("<article><p>post</p><div class=comments><p>a much longer reply of a reader</p></div></article>", "post"),
        ("<div><p>post of some words</p><div class='ad x'>buy</div><ul class=menu><li>m</ul></div>", "post of some words"),
        ("<div class=header><p>most of it is here</p><nav>menu</nav><div class=share>s</div></div>", "most of it is here"),
        ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><mspace/><annotation>x=1</annotation></math> holds</p></article>", "so x=1 holds"),
        (f"<div class=a><p>{PROSE}</p></div><div class=b><p>{PROSE[:90]}</p></div><div><a href=x>one</a> <a href=y>two</a></div>", f"{PROSE}\n{PROSE[:90].strip()}"),
        (f"<article><p>{PROSE}</p><div id=comments><p>{PROSE}</p></div></article><section id=comments><p>nice</p></section>", PROSE),
        (f"<div class=cookie-banner>c</div><div class=site-header>s</div><p>{PROSE}</p><ul class='comment-list'><li>{PROSE}</ul>", PROSE),
        (f"<article><div class=entry-header><h1>Title</h1></div><p>{PROSE}</p><div class=post-share>s</div></article>", f"Title\n{PROSE}"),
        ("<article><p><a href=x>only links</a></p></article>", "only links"),
        ("<!-- a --!><p>one</p><!--><p>two</p>", "one\ntwo"),
        ("<article><p>fill in <label>the label</label> now</p></article>", "fill in the label now"),
        ("<article><svg><path d='m'/><text>label</text></svg><p><object>shape</object> <noscript>plain</noscript></p></article>", "label\nshape plain"),
    ],
)
def test_html_keeps_what_only_sounds_like_a_menu(page, text):
    assert html_main.Page(f"<html><body>{page}</body></html>").text(None) == text


@pytest.mark.parametrize(
    "page",
    ["<i>" * 60_000 + "</b>" * 60_000, "<p><div>" + "<i>" * 60_000 + "<h1></h1>" * 40_000, "<div>" * 60_000, "<li>" * 100_000, "<a b='" * 60_000],
)
def test_html_of_hostile_pages_in_linear_time(page):
    begun = time.process_time()
    html_main.Page(page).text(None)
    assert time.process_time() - begun < 10


def _shop_page(rnd, host, n):
    """A page with known article text: sibling containers on some hosts, menus by name, tag or links on all."""
    words = "river stone makes quiet paths along the old green valley where people walk in spring and autumn".split()
    blocks = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(25, 60))) for _ in range(rnd.randrange(2, 6))]
    shown = [f"<p>{b.replace('the', 't&#104;e', 1)}</p>" for b in blocks]
    half = len(blocks) // 2
    body = {
        0: f"<article>{''.join(shown)}</article>",
        1: f"<div class='part{n}'>{''.join(shown[:half])}</div><div class=rest>{''.join(shown[half:])}</div>",
        2: f"<main><div class=story-{n}>{''.join(shown)}</div><div class=newsletter-form>join us</div></main>",
    }[host % 3]
    menu = "<ul>" + "".join(f"<li><a href=/{i}>{rnd.choice(words)}</a></li>" for i in range(8)) + "</ul>"
    page = f"<html><head><title>t</title></head><body><nav>{menu}</nav><div class=site-header>shop</div><div>{menu}</div>{body}"
    return f"{page}<div class=cookie-banner>we use cookies</div><div id=comments><p>{' '.join(words * 3)}</p></div></body></html>", "\n".join(blocks)


@pytest.mark.parametrize("sent", [50_000, 0])
def test_html_of_pages_with_known_text(spark, monkeypatch, sent):
    """Every block of every page, by winners that are sent and by winners that are joined; other columns change nothing."""
    monkeypatch.setattr(html_main, "MAX_SENT_HOSTS", sent)
    rnd = random.Random(8)
    made = [(n, n % 7, *_shop_page(rnd, n % 7, n)) for n in range(140)]
    rows = [(n, f"https://h{host}.example/{n}", page, "x", "y") for n, host, page, _ in made]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string")
    got = {r.page_id: r.text for r in html_main.extract(pages).collect()}
    assert got == {n: text for n, _, _, text in made}


def test_html_by_the_votes_of_a_host(spark):
    """A page whose own best container is a long notice without a name: the host's other pages tell its article."""
    prose = "few words of news"
    usual = f"<html><body><div class=news><p>{prose} {prose}</p></div><div class=box>b</div></body></html>"
    odd = f"<html><body><div class=news><p>{prose}</p></div><div class=box>{'<a href=x>offers</a> today only ' * 2}</div></body></html>"
    assert html_main.Page(odd).text(None) != prose
    pages = spark.createDataFrame([(i, "http://n.example/", usual if i else odd) for i in range(5)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_main.extract(pages).collect()}[0] == prose


def test_katz_sums_of_a_task_meet_before_the_exchange():
    """Parts of one document from several buckets leave a task as one sum."""
    parts = [(np.array([5, -9, 7]), np.array([1, 0, 2]), np.array([-1.0, 0, -0.5]), np.array([-3.0, -1, -2]))] * 4
    rows = katz._summed(parts, 3).to_pylist()
    flat = {k: (n, b, t) for r in rows for k, n, b, t in zip(r["key"], r["known"], r["base"], r["total"])}
    assert sum(len(r["key"]) for r in rows) == 3 and flat == {5: (4, -4.0, -12.0), -9: (0, 0.0, -4.0), 7: (8, -2.0, -8.0)}


def _crowd(docs: int) -> pa.Table:
    """Pieces of a crowded signature: one passage, in documents of their own words before and after."""
    passage = b"the very same passage that a large part of the corpus holds in the middle of its texts"
    pieces = [b"%06d own words" % (7919 * n % 1000000) + passage + b"other %06d" % (104729 * n % 1000000) for n in range(docs)]
    whole = {"shard": [0] * docs, "doc": list(range(docs)), "mark": list(range(docs)), "start": [10] * docs, "crowded": [True] * docs, "piece": pieces}
    return pa.table(whole)


def test_crowded_strings_leave_a_shard_once():
    """However many documents of a shard hold a string, other shards meet its first place alone."""
    told = suffix_dedup._shard(_crowd(40), 50).to_pylist()
    strings = [s for r in told for s in r["strings"] or []]
    assert strings and len(strings) == len(set(strings)) and len(told) <= 2 * 40
    assert {r["doc"] for r in told for s in r["strings"] or [] if b"same passage that a large part of the corpus holds" in s} == {0}


def test_pieces_hold_the_strings_that_took_their_anchors():
    """Every string took one anchor, which lies inside it: pieces are no longer than the strings of their anchors."""
    data = np.frombuffer(random.Random(4).randbytes(3000), np.uint8)
    at, _, _, opens, closes = suffix_dedup.anchors(data, np.array([0, 1000, 3000]))
    assert (closes - opens + 1).sum() == 3000 - 2 * 49
    assert (at >= closes).all() and (at + suffix_dedup.GRAM <= opens + 50).all()
