"""URL filter, chat formatting and HTML extraction."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest

from ludolake.llm import chat, html, urls
from ludolake.llm.common import fold_of
from pyspark.sql import functions as F

# -- urls


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate({c: c + 32 for c in range(65, 91)}), re.match(r"[^?#]*", rest[len(host):])[0]


def plain_rule(host, path, rules):
    best = None
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best or (None, None)


ODD_URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "x://a.com", "x://a.com/", "x://com/en/",
            "x://example.com/en/", "x://xexample.com/en/", "x://a.b.net/es/?q", "x://net/fr/#f", "x://é.com/en", "a://b://c.com/",
            "x://a.com?/en/", "x://host.net#/es/", "x://a.net/es", "x://" + "a" * 9000 + ".org/en/"]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(ODD_URLS)] * 2, "page_id long, url string, html string")
    rows = urls.judge_urls(pages.withColumn("host", F.lit(1)).withColumn("codes", F.lit(1))).collect()
    assert len(rows) == 2 * len(ODD_URLS)
    for r in rows:
        host, path = plain_parts(ODD_URLS[r["page_id"]])
        rule, verdict = plain_rule(host, path, urls.RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block") and (verdict is None or r["verdict"] == verdict)
    assert urls.judge_urls(pages.limit(0)).count() == 0


def plain_model(judged):
    """Log-likelihood difference of a url's codes under both models, in plain Python."""
    base, counts = len(urls.ALPHABET), {True: Counter(), False: Counter()}
    for codes, allowed in judged:
        for i in range(len(codes)):
            full = tuple(([0] * urls.ORDER + codes)[i:i + urls.ORDER + 1])
            for k in range(urls.ORDER + 1):
                counts[allowed][full[urls.ORDER - k:]] += 1
                counts[allowed]["context", full[urls.ORDER - k:-1]] += 1

    def p(c, gram):
        shorter = p(c, gram[1:]) if len(gram) > 1 else 1 / base
        return (c[gram] + urls.STRENGTH * shorter) / (c["context", gram[:-1]] + urls.STRENGTH)

    def score(codes):
        if not codes:
            return 0.0
        padded = [0] * urls.ORDER + codes
        grams = [tuple(padded[i:i + urls.ORDER + 1]) for i in range(len(codes))]
        return sum(math.log(p(counts[True], g) / p(counts[False], g)) for g in grams) / len(codes)

    return score


def test_scores_match_a_plain_model(sample):
    pages = sample("pages")
    rows = urls.judge_urls(pages).collect()
    folds = {r["page_id"]: r["f"] for r in pages.select("page_id", fold_of(F.col("url"), urls.FOLDS).alias("f")).collect()}
    code = {r["page_id"]: [urls.ALPHABET.index("0" if "0" <= c <= "9" else c if c in urls.ALPHABET[1:-1] else "*")
                           for c in (r["url"] or "").lower()] for r in pages.select("page_id", "url").collect()}
    judged = [(r["page_id"], plain_rule(r["host"], r["path"], urls.RULES)[1]) for r in rows]
    score = plain_model([(code[i], v == "allow") for i, v in judged if v and folds[i] != urls.CALIBRATION])
    plain = {r["page_id"]: score(code[r["page_id"]]) for r in rows}
    assert all(abs(plain[r["page_id"]] - r["score"]) < 1e-9 for r in rows)
    held = [(plain[i], v == "allow") for i, v in judged if v and folds[i] == urls.CALIBRATION]
    steps = defaultdict(lambda: [0, 0])
    for s, good in held:
        steps[math.floor(abs(s) * urls.STEP + 0.5) * (1 if s >= 0 else -1)][not good] += 1
    threshold = urls._threshold([(s, *ab) for s, ab in steps.items()])
    for r in rows:
        if r["rule"] is None:
            step = math.floor(abs(plain[r["page_id"]]) * urls.STEP + 0.5) * (1 if plain[r["page_id"]] >= 0 else -1)
            assert r["verdict"] == ("allow" if step >= threshold else "block")


def test_no_python_in_the_plan(sample):
    for frame in (urls.judge_urls(sample("pages")), chat.rotate_perspectives(sample("conversations"))):
        assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", frame._jdf.queryExecution().toString())


# -- chat


@pytest.fixture(scope="module")
def talks(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "Ann", "hi"), (1, 2, "bob ", None), (1, 2, "ann", "again"), (1, 2, "ann", "again"),
            (1, 900, "bob", "bye"), (1, None, "ann", "first"), (2, 0, "system", "alone"), (None, 0, "user", "x"), (None, None, None, ""),
            (3, 0, "", "e"), (3, -5, "user", "n" * 10_000)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_perspectives(talks):
    rows = chat.rotate_perspectives(talks.withColumn("name", F.lit("x")).withColumn("size", F.lit(1)).withColumn("block", F.lit(2))).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["conv_id"], r["perspective"]].append(r)
    assert {p for c, p in by if c == 1} == {"ann", "bob"} and {p for c, p in by if c == 2} == {""}
    assert {p for c, p in by if c is None} == {"user", "unknown"}
    for own in by.values():
        own.sort(key=lambda r: r["position"])
        assert [r["position"] for r in own] == list(range(len(own)))
        end = 0
        for r in own:
            assert r["begin"] == end and r["end"] - r["begin"] == len(r["segment"])
            end = r["end"]
    text = "".join(r["segment"] for r in by[1, "bob"])
    assert text == ("<|user name=ann|>\nfirst<|end|>\n<|system|>\nBe kind.<|end|>\n<|user name=ann|>\nhi<|end|>\n"
                    "<|user name=ann|>\nagain<|end|>\n<|user name=ann|>\nagain<|end|>\n<|assistant|>\n<|end|>\n<|assistant|>\nbye<|end|>\n")
    assert [r["trained"] for r in by[1, "bob"]] == [False] * 5 + [True] * 2
    assert chat.rotate_perspectives(talks.limit(0)).count() == 0


# -- html

PAGE = """<html><head><title>T</title><script>var a = "<p>no</p>"</script></head><body><header><h1>Site</h1><nav><a href=x>Home</a></nav>
</header><div class="cookie-notice">We use cookies &amp; more, accept them all please now</div><div id="main"><div class="post">
<h2>Real title</h2><p>First para with enough words &lt;b&gt; to&nbsp;count.</p><div class="advert">Buy this very good thing right now</div>
<p>Second   para<br>after break and <a href="y>z">a link</a>, more words here.<ul><li>item one is here<li>item number two is here</ul>
<aside>Not this one</aside><p>Last <b>words<p>really the last words of it</div>
<section id="comments"><h3>Comments</h3><p>I think that this is a very nice article, thanks a lot my friend</p></section></div>
<form><label>Name</label><input></form><footer>&copy; all rights reserved</footer></body></html>"""
TEXT = """Real title
First para with enough words <b> to count.
Second para after break and a link, more words here.
item one is here
item number two is here
Last words
really the last words of it"""


def test_main_text_of_a_page(sample):
    weights = html.learn_weights(sample("pages"))
    assert html.main_text(PAGE, weights) == TEXT
    assert all(w < 0 for k, w in weights.items() if k.startswith("t:")) and weights["w:p"] > 0


def test_marked_articles_come_out_whole(sample):
    """Pages of the sample mark their article; its text is what the scan must find."""
    from html import unescape

    pages = sample("pages")
    rows = html.extract_text(pages, html.learn_weights(pages)).collect()
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", source[r["page_id"]], re.S)[1]
        blocks = (" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", article))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_odd_pages(spark):
    odd = [None, "", "   ", "plain words only", "<p>", "<p>unclosed <b>tags <i>here", "</div></p>x", "<!-- open", "<script>open", "a < b > c",
           "<a href='x>" * 200 + "text", "<div>" * 3000 + "deep words" + "</div>" * 3000, "<p>" + "long " * 100_000, "<>< <p>ok &#65; &bogus; &#xZZ;"]
    pages = spark.createDataFrame([(i, None, h) for i, h in enumerate(odd)] * 2, "page_id long, url string, html string").withColumn("text", F.lit("t"))
    rows = {r["page_id"]: r["text"] for r in html.extract_text(pages, html.learn_weights(pages)).collect()}
    assert rows[0] == rows[1] == rows[2] == rows[7] == rows[8] == "" and rows[5] == "unclosed tags here"
    assert len(rows[12].split()) == 100_000 and rows[11] == "deep words" and rows[13].endswith("ok A &bogus; &#xZZ;")
    assert html.extract_text(pages.limit(0), html.learn_weights(pages.limit(0))).count() == 0


LINES = "<p>The first paragraph of a long story about rivers and mountains, told in plain words.</p>"


@pytest.mark.parametrize("page", [
    f'<div class="layout has-sidebar"><article>{LINES}</article></div>',
    f'<div class="no-comments with-menu"><article>{LINES}</article></div>',
    f'<article><p>Some words before the other part of this story here.</p><section id="related-work">{LINES}</section></article>',
    f'<div class="sidebar"><div id="search"><article>{LINES}</article></div></div>',
    f'<form id="form1"><main>{LINES}</main></form>', f'<main class="search">{LINES}</main>',
    f'<div class="banner"><div itemprop="articleBody">{LINES}</div></div>',
    f'<article><header class="entry-header">{LINES}</header></article>'])
def test_articles_are_not_apart(page):
    weights = {k: 1.0 if k.startswith("w:") else -0.2 for k in html.BY_HAND}
    assert "rivers and mountains" in html.main_text(page, weights)
    assert not any(apart for _, words, _, apart, _, _ in html.tokens(page) if words)
    counts = html._count(html.pa.array([page]))
    assert counts["w:p", True] and not counts["w:p", False]


def test_headings_with_ids_made_from_their_text():
    weights = {k: 1.0 if k.startswith("w:") else -0.2 for k in html.BY_HAND}
    page = f'<article><h2 id="menu-planning">Menu planning</h2>{LINES}<h2 id="search">Search</h2>{LINES}</article>'
    assert html.main_text(page, weights).split("\n")[::2] == ["Menu planning", "Search"]


@pytest.mark.parametrize("mark", ['class="ad"', 'class="left-sidebar"', 'class="x comment-list"', 'id="site-header"', 'role="navigation"',
                                  'class="related-posts"', 'class="cookie-banner"', 'hidden', 'style="display: none"'])
def test_boilerplate_is_still_apart(mark):
    """Also where it holds articles of its own beside the page's."""
    weights = {k: 1.0 if k.startswith("w:") else -0.2 for k in html.BY_HAND}
    text = html.main_text(f"<article>{LINES}</article><div {mark}><article><p>Buy a new pair of shoes.</p></article><p>More shoes.</p></div>", weights)
    assert "rivers" in text and "shoes" not in text


PLAIN = {k: 1.0 if k.startswith("w:") else -0.2 for k in html.BY_HAND} | {"w:a": -2.0}


@pytest.mark.parametrize("middle", ["<ul>" + "<li><a href=x>a link of the list</a></li>" * 40 + "</ul>",
                                    "<table>" + "<tr><td>1</td><td>2</td></tr>" * 30 + "</table>", "<br>" * 300])
def test_articles_stay_whole(middle):
    """What scores low inside an article doesn't cut it; what stands outside of it goes."""
    text = html.main_text(f"<p>Site name</p><article><p>The intro of it.</p>{middle}<p>The last words.</p></article><p>Imprint</p>", PLAIN)
    lines = text.split("\n")
    assert lines[0] == "The intro of it." and lines[-1] == "The last words."
    assert lines.count("a link of the list") == middle.count("<li>") and lines.count("2") == middle.count("<tr>")


def test_inner_articles_and_pages_without_any():
    page = f"<main><p>About.</p><article>{LINES}</article><aside>no</aside><article><p>Second.</p></article></main>"
    assert html.main_text(page, PLAIN).split("\n")[1:] == [LINES[3:-4], "Second."]
    assert html.main_text(f"<div>{LINES}</div><a href=x>some link far away</a>", PLAIN) == LINES[3:-4]


@pytest.mark.parametrize("attributes", ['data-role="menu"', 'title="x class=ad y"', "data-class=ad", 'alt="hidden"', "title='role=\"menu\"'"])
def test_marks_inside_other_attributes_are_none(attributes):
    assert html.main_text(f"<p {attributes}>Some words of text.</p>", PLAIN) == "Some words of text."


def test_best_span_against_all_spans():
    import random

    rng = random.Random(4)
    for n in range(60):
        scores = [float(rng.randint(-3, 3)) for _ in range(n)]
        spans = [(b, e) for b in range(n) for e in range(b + 1, n + 1)]
        best = min(spans, key=lambda s: (-sum(scores[slice(*s)]), s[1], s[0]), default=(0, 0))
        assert html.best_span(scores) == (best if spans and sum(scores[slice(*best)]) > 0 else (0, 0))


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "</p>" * 100_000, "<b>" * 100_000 + "<p>" * 100_000, "<li><b>" * 100_000,
                                  "<nav>" * 100_000 + "<article>x" * 100_000, "<p>x</i></p>" * 70_000, "<article>a" * 200_000])
def test_time_is_linear_in_tags(page):
    import time

    begin = time.process_time()
    html.main_text(page, PLAIN)
    assert time.process_time() - begin < 10
