"""Decontamination, licence scan, quality rules, URL filters and HTML extraction against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import decontaminate, html_extract, license_scan, quality_rules, url_filters
from ledgerlight.llm.components import connected_components
from ledgerlight.llm.storage import Workspace
from texts import Groups, edge_documents, edge_rows, empty_documents, plain, sentence, spaced


def hits(words, items, size=13):
    covered, found = set(), set()
    for item, text in items:
        own = plain(text)
        k = min(size, len(own))
        wanted = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
        for i in range(len(words) - k + 1):
            if own and tuple(words[i : i + k]) in wanted:
                covered.update(range(i, i + k))
                found.add(item)
    return covered, found


@pytest.mark.parametrize("characters", [10**6, 300])
def test_contamination(spark, characters):
    rng = random.Random(3)
    rows = edge_rows()
    passage = " ".join(plain(rows[0][1])[10:40])
    items = [(1, passage.upper()), (2, "One"), (3, None), (4, " .,! "), (5, sentence(rng, 40)), (6, passage), (7, "tick tick"), (8, "Äö... (ü)")]
    items += [(9, " ".join(plain(rows[0][1])[30:45])), (None, "tick")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(edge_documents(spark), benchmark, automaton_characters=characters).collect()
    expected = []
    for i, text, *_ in rows:
        words = plain(text)
        covered, names = hits(words, [x for x in items if x[0] is not None])
        expected.append((i, len(words), len(covered), tuple(sorted(names)), bool(covered) and 20 * len(covered) >= len(words)))
    mine = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["items"])), r["contaminated"]) for r in found]
    assert Counter(mine) == Counter(expected)
    texts = {(i, len(plain(t))): t for i, t, *_ in rows}
    for r in found:
        for s in r["spans"]:
            original = texts[r["doc_id"], r["n_words"]][s["begin"] : s["end"]]
            assert plain(original) == plain(texts[r["doc_id"], r["n_words"]])[s["first"] : s["last"] + 1]


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(edge_documents(spark), none).where("n_hit > 0 OR contaminated").count() == 0
    assert decontaminate.find_contamination(empty_documents(spark), none).count() == 0


def test_licences(spark):
    rng = random.Random(5)
    grant = dict(license_scan.TEMPLATES)["isc"].split()
    texts = [
        "Licensed under CC BY-NC 4.0.", "licensed under the APACHE license, version 2.0", "an mit licensed thing, mit license; MIT License!",
        " ".join([sentence(rng, 9), *grant[:10], "inserted", *grant[10:16], *grant[17:], sentence(rng, 5)]), "Licensed under the terms of trade.",
        " ".join(grant[:8]), None, "", sentence(rng, 5000),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan_licenses(docs).collect()}
    labels = {i: [s["label"] for s in r["spans"]] for i, r in found.items()}
    assert [labels[i] for i in range(9)] == [["cc-by-nc"], ["apache"], [], ["isc"], [], [], [], [], []]
    assert found[0]["spans"][0]["score"] == 1.0
    assert 0.9 < found[3]["spans"][0]["score"] < 1.0
    assert (found[3]["spans"][0]["first"], found[3]["spans"][0]["last"]) == (9, 9 + len(plain(" ".join(grant))) - 1)
    assert [found[2][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")] == [8, 2, 4, 6, ["mit"]]
    assert [found[6][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")] == [0, 0, None, None, []]


def test_licences_of_edge_rows(spark):
    found = license_scan.scan_licenses(edge_documents(spark)).collect()
    assert Counter((r["doc_id"], r["n_words"]) for r in found) == Counter((i, len(plain(t))) for i, t, *_ in edge_rows())
    assert license_scan.scan_licenses(empty_documents(spark)).count() == 0


def counts_of(text):
    text = text or ""
    words = spaced(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {p for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [line for line in text.split("\n") if spaced(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    found = quality_rules.judge(edge_documents(spark), labels, keep_columns=["_quality_text", "odd name"]).collect()
    expected = Counter()
    for i, text, *_ in edge_rows():
        n = counts_of(text)
        expected[i, n, n[0] < 20 or 100 * n[4] > 30 * n[0]] += 1
    mine = Counter((r["doc_id"], tuple(r[f"_quality_{f}"] for f in quality_rules.FEATURES), r["_quality_base_failed"]) for r in found)
    assert mine == expected
    assert all(r["_quality_kept"] != r["_quality_base_failed"] for r in found)
    assert quality_rules.judge(empty_documents(spark), labels).count() == 0


def tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_binomial_tail(spark):
    cases = [(0, 1), (0, 300), (3, 300), (3, 1000), (9, 1000), (0, 0), (5, 5), (40, 9000)]
    rows = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p"))
    for k, n, p in rows.collect():
        assert p == pytest.approx(1.0 if k >= 0.01 * n else tail(k, n, 0.01), rel=1e-9)


def test_cutoffs_follow_the_labels(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1600):
        good = i % 8 != 0
        shout = rng.random() < (0.0 if good else 0.9)
        text = sentence(rng, 40)
        rows.append((i, text.upper() if shout else text, "en" if i % 3 else "fr"))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    features = quality_rules.with_features(docs)
    cutoffs = {r["_quality_cutoff_stratum"]: r for r in quality_rules.choose_cutoffs(features, marks, "doc_id", "lang", "doc_id", "quality", 0.01, 0.05).collect()}
    good = {"en": 0, "fr": 0}
    for (_, _, lang), (_, quality) in zip(rows, labels, strict=True):
        good[lang] += quality
    for lang, n in good.items():
        passes = tail(0, n, 0.01) <= 0.05 / (2 * len(quality_rules.LADDERS))
        assert cutoffs[lang]["_quality_cutoff_upper_rate"] == (0.2 if passes else None)
    judged = quality_rules.judge(docs, marks)
    assert judged.where("NOT _quality_kept").join(marks, "doc_id").where("quality = 1").count() == 0
    assert judged.where("NOT _quality_kept").count() > 0


def test_binomial_tail_of_large_counts(spark):
    """One formula at every size: against sums of logarithms in plain Python."""
    def exact(k, n, p):
        top = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log(1 - p)
        total = term = 1.0
        for i in range(k, 0, -1):
            term *= i / (n - i + 1) * (1 - p) / p
            total += term
        return math.exp(top) * total

    cases = [(950, 100_000), (99_500, 10_000_000), (19_999, 2_030_000), (20_001, 2_030_000), (100, 9_000_000)]
    rows = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p"))
    for k, n, p in rows.collect():
        assert p == pytest.approx(exact(k, n, 0.01), rel=1e-5, abs=1e-300)


def test_steps_bound_the_union_of_all_rules(spark):
    """Against a plain version; rules that each reject a little of the good texts stop together, and copies count once."""
    rng = random.Random(11)
    rules = list(quality_rules.LADDERS)
    rows, labels = [], []
    for i in range(6000):
        rates = [0.0] * len(rules)
        if rng.random() < 0.03:  # every rule rejects half a percent of the good texts, the union three
            rates[rng.randrange(len(rules))] = 30.0
        rows.append((i, "en" if i % 5 else None, i, *rates))
        labels.append((i, int(rng.random() < 0.9)))
    rows += [(10_000 + i, "en", 1, 30.0, *[0.0] * (len(rules) - 1)) for i in range(500)]
    rows[1] = (1, "en", 1, 30.0, *[0.0] * (len(rules) - 1))
    labels += [(10_000 + i, 1) for i in range(500)]
    names = ", ".join(f"_quality_{r} double" for r in rules)
    features = spark.createDataFrame(rows, f"doc_id long, lang string, _quality_text_hash long, {names}")
    marks = spark.createDataFrame(labels, "_label_id long, quality int").where("quality = 1")
    taken = quality_rules._steps_taken(features, marks, "doc_id", "lang", 0.01, 0.05).orderBy("position").collect()
    good = {i for i, q in labels if q}
    for lang in ("en", None):
        steps = [r for r in taken if r.stratum == lang]
        assert [r.position for r in steps] == list(range(1, sum(map(len, quality_rules.LADDERS.values())) + 1))
        pilot = {r.h: r.p for r in features.selectExpr("_quality_text_hash h", "pmod(xxhash64('pilot', _quality_text_hash), 4) = 0 p").collect()}
        texts = {h: rates for i, s, h, *rates in rows if s == lang and i in good and not pilot[h]}
        fallen, still = set(), True
        for r in steps:
            fallen |= {h for h, rates in texts.items() if rates[rules.index(r.rule)] > r.cutoff}
            still = still and (len(fallen) < 0.01 * len(texts) and tail(len(fallen), len(texts), 0.01) <= 0.05 / 2)
            assert (r.n, r.k, r.taken) == (len(texts), len(fallen), still)
        used = {r.rule for r in steps if r.taken}
        assert len(used) < len(rules) and (used or lang is None)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 200)] + [(500, 500), (None, 3)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)] + [(7, 6)]
    groups = Groups()
    for a, b in edges:
        if a is not None and a != b:
            groups.join(a, b)
    found = connected_components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "test"))
    assert {r["node"]: r["component"] for r in found.collect()} == {x: groups.find(x) for x in list(groups.up)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "test")).count() == 0


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("bad.net", "/", "block")]


def link(url):
    return f"<html><head><LINK rel='canonical' href='{url}'></head></html>"


def test_urls_and_aliases(spark):
    pages = [
        (1, "http://a.com/fr/1", ""), (2, "HTTP://X.Example.ORG/es/2?q#f", ""), (3, "https://bad.net/x", ""), (4, "http://alias.net/1", link("https://bad.net/x")),
        (5, "http://alias.net/2", '<meta http-equiv="refresh" content="0; url=/1">'), (6, "http://free.net/", link("http://ok.org/z")),
        (7, "http://torn.net/", link("https://bad.net/y")), (8, "http://torn.net/", link("http://fine.org/")), (9, None, link("https://bad.net/x")),
        (10, "no scheme", None), (11, "http://com/de/", ""), (12, "http://notcom/de/", ""), (13, "http://example.org", ""), (1, "http://a.com/fr/1", ""),
        (14, "http://far.net/b/c", link("d")),
    ]
    table = spark.createDataFrame([(*p, "h", "x") for p in pages], "page_id long, url string, html string, host string, rule string")
    rules = spark.createDataFrame(RULES, url_filters.RULES)
    redirects = spark.createDataFrame([("http://far.net/b/d", "http://alias.net/2"), (None, "http://bad.net/x")], "from_url string, to_url string")
    found = url_filters.judge_urls(table, rules, redirects).collect()
    verdicts = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}
    assert len(found) == len(pages)
    assert verdicts == {
        1: ("a.com", "/fr/1", "com/fr/", "allow"), 2: ("x.example.org", "/es/2", "example.org/es/", "block"), 3: ("bad.net", "/x", "bad.net/", "block"),
        4: ("alias.net", "/1", None, "block"), 5: ("alias.net", "/2", None, "block"), 6: ("free.net", "/", None, "allow"),
        7: ("torn.net", "/", None, "allow"), 8: ("torn.net", "/", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"),
        11: ("com", "/de/", "com/de/", "block"), 12: ("notcom", "/de/", None, "allow"), 13: ("example.org", "", None, "allow"), 14: ("far.net", "/b/c", None, "block"),
    }
    assert url_filters.judge_urls(table.limit(0), rules).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy</div><div class="cookie-notice">Cookies</div><!-- <p>no</p> -->
<article><h1>Head &amp; &lt;line&gt;</h1><p><b>Bold<br><p>First
  part&nbsp;of <i>it</i></p>loose<form><p>Sign up</p></form><aside>Aside</aside><p title="a > b">a < b</p>
<section class="comments"><article class="comment"><p>Nice</p></article></section></article>
<footer>&copy; site</footer></body></html>"""


def test_text_of_one_page(spark):
    pages = [(1, "http://a.net/1", PAGE), (2, "http://a.net/2", None), (3, None, ""), (4, "http://a.net/3", "<p>just <b>text"), (5, "http://a.net/4", "no markup &eacute;"), (1, "http://a.net/1", PAGE)]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, host string")
    found = html_extract.extract_text(table).collect()
    texts = {r["page_id"]: r["text"] for r in found}
    assert len(found) == len(pages)
    assert texts == {1: "Head & <line>\nBold\nFirst part of it\nloose\na < b", 2: "", 3: "", 4: "just text", 5: "no markup é"}
    assert html_extract.extract_text(table.limit(0)).count() == 0


def test_style_tree_finds_what_all_pages_say(spark):
    rng = random.Random(9)
    pages = []
    for i in range(12):
        own = "".join(f"<p>{sentence(rng, 12)}</p>" for _ in range(3))
        pages.append((i, f"http://site.net/{i}", f"<html><body><div class='top'><p>Welcome to the site</p></div><div class='text'>{own}</div><div class='base'><span>{i % 2}</span>All rights</div></body></html>"))
    pages += [(100 + i, "http://site.net/0", pages[0][2]) for i in range(30)]  # copies count once
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    importance = {r["path"]: r["importance"] for r in html_extract.style_tree(table).collect()}
    assert importance["/html/body/div.top/p"] < 0.01 < 0.9 < importance["/html/body/div.text/p"]
    texts = {r["page_id"]: r["text"] for r in html_extract.extract_text(table).collect()}
    for i, _, html in pages:
        assert texts[i].split("\n")[:3] == re.findall(r"<p>([^<]*)</p>", html)[1:]
        assert "Welcome" not in texts[i]


@pytest.mark.parametrize("page", [
    '<body class="no-sidebar" id="menu"><p>Text</p></body>', '<body><main class="with-sidebar menu"><p>Text</p></main></body>',
    '<article class="post category-social tag-ads comments-open"><p>Text</p></article>', '<article class="sponsored"><p>Text</p></article>',
    '<article><div class="entry-header"><h1>Text</h1></div></article>', '<article><div class="header">Text</div></article>',
    '<div class="widget"><article>Text</article></div><nav>Menu</nav>', '<div class="promo"><main>Text</main></div><div>Some longer text beside it</div>',
    '<div class="main share"><p>Text</p><div class="ad-banner">Ad</div></div>',
])
def test_names_alone_do_not_empty_a_page(page):
    assert html_extract.main_text(f"<html>{page}</html>", set()) == "Text"


def test_importance_confirms_names_of_large_branches():
    page = "<html><body><p>Text</p><div class='related'><p>Much more than the text of it</p></div><div class='ad'>Ad</div></body></html>"
    assert html_extract.main_text(page, set()) == "Text\nMuch more than the text of it"
    assert html_extract.main_text(page, {"/html/body/div.related"}) == "Text"
    thread = "<article><p>The text of it</p></article><section class='comments'><article class='comment'><p>Nice</p></article></section>"
    assert html_extract.main_text(thread, set()) == "The text of it"


def test_copies_of_an_article_count_once(spark):
    """Under many urls, each copy with its own number in a comment, a script and an advert."""
    rng = random.Random(13)
    copied = "".join(f"<p>{sentence(rng, 12)}</p>" for _ in range(3))
    pages = []
    for i in range(40):
        body = copied if i < 34 else "".join(f"<p>{sentence(rng, 12)}</p>" for _ in range(3))
        for k, (begin, end) in enumerate([("<article><h2>Summary</h2>", "</article>"), ("<main>", "</main>"), ("<div class='text'>", "</div>")]):
            html = f"<html><body><!-- {i} --><script>track({i})</script><div class='ad'>Ad {i}</div><div class='top'>Welcome</div>{begin}{body}{end}</body></html>"
            pages.append((3 * i + k, f"http://site{k}.net/{i}", html))
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r["pages"] for r in html_extract.style_tree(table).collect()} == {7}
    texts = {r["page_id"]: r["text"] for r in html_extract.extract_text(table).collect()}
    for i, url, html in pages:
        assert texts[i] == "\n".join((["Summary"] if "site0" in url else []) + re.findall(r"<p>([^<]*)</p>", html))


def test_importance_leaves_no_main_content_empty():
    page = "<html><body><div>Top</div><main><p>Text</p></main></body></html>"
    assert html_extract.main_text(page, {"/html/body/main", "/html/body/div"}) == "Text"
    assert html_extract.main_text(page.replace("</main>", "<div>More</div></main>"), {"/html/body/main/div"}) == "Text"
    assert html_extract.main_text(page.replace("main>", "article>"), {"/html/body/article"}) == "Text"


@pytest.mark.parametrize(("page", "text"), [
    ("<body><div id=content><p>long text long text long text long text</p></div><article><h3>Teaser</h3></article>",
     "long text long text long text long text\nTeaser"),
    ("<article><p>We have <math><mi>x</mi><mo>=</mo><mn>1</mn></math> here</p></article>", "We have x=1 here"),
    ("<article><p>See <object>the fallback</object> and <svg><text>label</text></svg></p></article>", "See the fallback and label"),
    ("<article><p>Text</p><div class=related>More</div><div class=comments>No</div><div class=share>this</div></article>", "Text\nMore\nthis"),
    ("<div class=related>Elsewhere, much longer than the text</div><div class=ad>Buy, buy, buy</div><article><p>Text</p></article>", "Text"),
    ("<div class=related>Elsewhere</div><div><p>The text of this page, without an article</p></div>", "The text of this page, without an article"),
])
def test_what_belongs_to_the_article(page, text):
    assert html_extract.main_text(page, set()) == text


def test_deep_and_long_pages_cost_in_proportion_to_their_length():
    import tracemalloc

    for page in ("<body>" + "<div class='c1 x'>a " * 60_000, "<body>" + f"<div class='{'k' * 500_000}'>a", "<p>" + "word " * 200_000):
        tracemalloc.start()
        blocks, shapes = html_extract.page_blocks(page)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert blocks and most < 200 * len(page) + 50_000_000
        assert max(len(b[0]) for b in blocks) <= (html_extract.DEEPEST + 1) * (html_extract.LONGEST_STYLE + 1)
