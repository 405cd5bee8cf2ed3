"""The clusters of smoothed ratios choose the text of a page; an independent reading of the given pages agrees."""

import html as entities
import random
import re
import time

import numpy as np
import pytest

from prodmart.llm import html_text
from prodmart.llm.html_text import BETWEEN, CONTENT, OUTSIDE, cluster, main_text, read_page
from prodmart.llm.queries import QUERIES


def plain_article(page):
    """The article of a given page by patterns alone: each has one, of headings and paragraphs, some left open."""
    inner = re.search(r"(?s)<article>(.*)</article>", page)
    blocks = re.split(r"</?(?:h1|p)\b[^>]*>", inner[1]) if inner else []
    texts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_html_query_against_patterns(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()
    got = sorted(tuple(r) for r in QUERIES["op3_html_text"](spark, sf_dir).collect())
    assert got == sorted((p.page_id, p.url, t, len(t)) for p in pages for t in [plain_article(p.html or "")])


def sentence(rng, low, high):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(rng.randrange(low, high))) + "."


def soup(seed):
    """(page, article lines): a page of plain `div`s without a telling name or class, links and short notes around the article."""
    rng = random.Random(seed)
    links = lambda n: "".join(f'<div><a href="/{i}">{sentence(rng, 1, 3)}</a></div>' for i in range(n))
    article = [sentence(rng, 40, 120) for _ in range(rng.randrange(4, 9))]
    for i in range(1, len(article) - 1, 2):  # short lines stand between the long ones
        article.insert(i, sentence(rng, 1, 4))
    body = "".join(f"<div>{x}</div>" for x in article)
    notes = f'<div class="q7"><div>{sentence(rng, 1, 3)}</div><div><a href="/z">x</a> <a href="/y">y</a></div></div>'
    page = f"<html><body><div>{links(6)}</div>{notes}<div>{body}</div><div>{links(5)}</div>{notes}</body></html>"
    return page, article


@pytest.mark.parametrize("seed", range(20))
def test_clusters_alone_find_the_article(seed, monkeypatch):
    """Without `article`, `main` or class words the clusters decide; with them switched off the page comes out whole."""
    page, article = soup(seed)
    assert main_text(page) == "\n".join(article)
    monkeypatch.setattr(html_text, "cluster", lambda p: np.full(len(p.lines), CONTENT))
    everything = main_text(page)
    assert everything != "\n".join(article) and everything.count("\n") > len(article) + 10


def test_given_pages_need_the_clusters(spark, sf_dir, monkeypatch):
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect() if r.html]
    before = [main_text(p) for p in pages]
    monkeypatch.setattr(html_text, "cluster", lambda p: np.full(len(p.lines), CONTENT))
    assert all(main_text(p) != t for p, t in zip(pages, before))


def test_names_only_turn_ratios(monkeypatch):
    """Each kind of line: a marked one counts against itself, a menu without marks goes, one single link stays."""
    long = "word " * 60
    page = (
        '<div class="ad">buy now</div><div><p>%s</p><p><a href="/">one link alone</a></p><p>%s</p><p>short</p></div>'
        '<ul><li><a href="/a">a</a></li><li><a href="/b">b</a></li><li><a href="/c">c</a></li></ul>'
    ) % (long, long)
    lines = read_page(page)
    assert list(cluster(lines)) == [OUTSIDE, CONTENT, BETWEEN, CONTENT, BETWEEN, OUTSIDE, OUTSIDE, OUTSIDE]
    assert main_text(page).split("\n") == [long.strip(), "one link alone", long.strip(), "short"]
    monkeypatch.setattr(html_text, "marked_apart", lambda *_: False)
    assert list(cluster(read_page(page)))[0] != OUTSIDE


@pytest.mark.parametrize("tag", ["div", "font", "p", "ul><li", "article", "a"])
def test_deep_nesting_takes_linear_time(tag):
    n = 40_000
    start = time.perf_counter()
    for page in (f"<{tag}>word " * n, f"<{tag}>" * n + "text" + "</b>" * n, "<font>" * n + f"<{tag}>w" * 1000):
        main_text(page)
    assert time.perf_counter() - start < 60
