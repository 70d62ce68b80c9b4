"""URL rules, Order MinHash and page text against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import html_text, order_minhash, url_rules
from tidegate.llm.queries import RULES

URLS = [
    None, "", "no scheme/net/es/", "http://example.com/en/1", "HTTP://WWW.Example.COM/en/1?x#y", "https://www.example.com/en", "ftp://a.b.net/es/?q",
    "http://net/es/x", "http://xnet/es/x", "http://a.net/fr/", "http://a.net/FR/", "http://com", "http://com/", "http://com?x", "x://a.com/y://b.net/es/",
    "http://example.com#/en/", "://net/fr/z", "http:///es/", "http://ÄB.net/es/\n/x", "http://a..com/",
]


def verdict(url, rules):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
    rest = rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("rules", [RULES, [], [*RULES, ("a.net", "", "allow"), ("b.net", "/e", "allow"), *((f"h{i}.org", f"/{i}", "block") for i in range(300))]])
def test_url_rules(spark, rules):
    urls = [*URLS, *(f"http://x.h{i}.org/{i + i % 2}/z" for i in range(0, 300, 7)), "http://a.net/fr/"]
    pages = spark.createDataFrame([(None if i == 4 else i, u, "c") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    found = url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    got = sorted(map(repr, (tuple(r) for r in found.collect())))
    assert got == sorted(repr((None if i == 4 else i, *verdict(u, rules))) for i, u in enumerate(urls))
    assert url_rules.judge(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def slow_signature(text, k=order_minhash.K, tuples=order_minhash.TUPLES, taken=order_minhash.TAKEN):
    """The same selection, one k-mer at a time."""
    k = min(k, len(text))
    seen, parts = {}, {}
    for i in range(len(text) - k + 1 if text else 0):
        kmer = text[i : i + k]
        hashed = order_minhash._kmers(kmer, k)
        numbered = int(order_minhash._mixed(hashed + np.array([seen.get(kmer, 0)], np.uint64) * order_minhash._A)[0])
        seen[kmer] = seen.get(kmer, 0) + 1
        parts.setdefault(numbered * tuples >> 64, []).append((numbered, i, kmer))
    return {p: tuple(kmer for _, _, kmer in sorted(sorted(rows)[:taken], key=lambda r: r[1])) for p, rows in parts.items()}


def test_signatures_select_the_least_in_text_order():
    rng = random.Random(5)
    texts = ["", "a", "abcdefg", "abab" * 50, *("".join(rng.choice("abcdeé🎉 ") for _ in range(rng.randint(1, 700))) for _ in range(40))]
    seen = {}
    for text in texts:
        slow, fast = slow_signature(text), order_minhash.signature(text)
        assert {i for i in range(order_minhash.TUPLES) if fast[i]} == set(slow)
        for part, kmers in slow.items():
            assert seen.setdefault((part, kmers), fast[part]) == fast[part]
    assert len(set(seen.values())) > 0.99 * len({kmers for _, kmers in seen})


def test_likeness_follows_edits():
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefghij ") for _ in range(3_000))
    sign = order_minhash.signature
    small, large = "X".join(text[i : i + 150] for i in range(0, 3_000, 150)), text[:1_000] + text[::-1][:2_000]
    moved = text[1_500:] + text[:1_500]
    likeness = [order_minhash.likeness(sign(text), sign(t)) for t in (text, small, moved, large)]
    assert likeness[0] == 1 and likeness[0] > likeness[1] > likeness[2] > likeness[3]
    assert order_minhash.likeness(sign(""), sign("")) == 1 and order_minhash.likeness(sign(""), sign("a")) == 0


@pytest.mark.parametrize("ranges", [1, 7])
def test_neighbours(spark, monkeypatch, ranges):
    rows = [(i * 3, None if i % 9 == 0 else f"text {i} " * (i % 5 * 40), "k") for i in range(60)] + [(None, "no id", "k"), (6, "same id", "k")]
    monkeypatch.setattr(order_minhash, "RANGE_ROWS", len(rows) // ranges)
    docs = spark.createDataFrame(rows, "doc_id long, text string, range string").repartition(4)
    order = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for n, (i, text) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        edited = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        a, b, c = map(order_minhash.signature, (text, edited, following))
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), order_minhash.fingerprint(text), order_minhash.fingerprint(edited), order_minhash.likeness(a, b), order_minhash.likeness(a, c)))
    got = [tuple(r) for r in order_minhash.with_neighbours(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert order_minhash.with_neighbours(docs.limit(0)).count() == 0
    assert order_minhash.with_neighbours(docs.where("doc_id = 9")).first().near_next == 1
    assert order_minhash.fingerprinted(docs).where(F.col("range") == "k").count() == len(rows)


PAGES = {
    "plain": ("<html><head><title>T</title></head><body><article><h1>Head</h1><p>One &amp; two<br>three</p></article></body></html>", "Head One & two three"),
    "parts": (
        "<body><nav><ul><li>Menu</nav><header>Top</header><div class='ad'>Buy</div><article><header><h1>H</h1></header><p>a<p>b<div class=\"cookie-banner\">c</div>"
        "<aside>s</aside><form>f<input></form><p>d <b>e</b>f</p><footer>by</footer></article><section id=comments><p>Nice!</section><footer>&copy;</footer>",
        "H a b d ef",
    ),
    "scripts": ("<article>a<script>if (1<2) x('</p>')</script><style>p{}</style><!-- <p>no</p> -->b</article>", "a b"),
    "no article": (
        "<body><div><a href=/>Home</a></div><div>Hi</div>" + "<br>" * 8 + "".join(f"<p>{'Long enough text of a paragraph. ' * 5}</p>" for _ in range(3)) + "<br>" * 8 + "<div>End</div>",
        " ".join(["Long enough text of a paragraph. " * 5] * 3).replace("  ", " ").strip(),
    ),
    "cut off": ("<article><p>text &lt; more</p><p clas", "text < more"),
    "loose": ("<article><p title=\"a > b\" class=it's>1 < 2 & 3&nbsp;&#233;</p></article>", "1 < 2 & 3 é"),
    "open menu": ("<nav><ul><li>x<article><p>body</p></article>", "body"),
    "none": ("", ""),
    "null": (None, ""),
    "only menu": ("<nav>x</nav>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    html, want = PAGES[name]
    assert html_text.main_text(html or "") == want


def test_extract(spark):
    rows = [(None if n == 1 else n, None if n == 2 else "u", html, "t") for n, (html, _) in enumerate(PAGES.values())] * 2
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    want = [(None if n == 1 else n, None if n == 2 else "u", text, len(text)) for n, (_, text) in enumerate(PAGES.values())] * 2
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_long_page_in_linear_time():
    page = "<article>" + "<p class='a'>word <b>x" * 60_000 + "<" * 2_000
    assert html_text.main_text(page).startswith("word x word x")


def test_surge_and_dive():
    assert html_text.between_surges_and_dives([0, 5, 0, 0, 0, 90, 80, 0, 70, 0, 0, 0, 3], False) == [False] * 5 + [True] * 4 + [False] * 4
    assert html_text.between_surges_and_dives([], False) == []


def test_long_block_among_short_ones():
    def text(n, word):
        return (f"{word} " * n)[: n - 1] + "."

    for sizes in ([60, 200, 300, 100_000], [60, 120, 1_500, 1_400], [12, 20, 15, 9, 3_000, 30], [10, 20]):
        blocks = [text(n, f"w{i}") for i, n in enumerate(sizes)]
        inner = "\n".join(f"<p>{b}</p>" for b in blocks[1:])
        page = f"<body><div class=menu><a href=/>Home</a></div><h1>{blocks[0]}</h1>\n{inner}</body>"
        assert html_text.main_text(page) == " ".join(blocks)
        adverts = "<div class=ad>Buy</div><script>x()</script><nav><ul><li>a<li>b</ul></nav>" * 2
        assert html_text.main_text(page.replace("</body>", f"{adverts}<p>Short end.</p></body>")) == " ".join([*blocks, "Short end."])


BODY = "<p>The text of the page.</p>"
COMMENTS = "<ol class=comment-list><li><article class=comment-body><p>A reader says so, at some length, and longer than the page.</p></article></ol>"
MARKED = {
    "layout": (f"<div class='layout has-sidebar'><div class=left-sidebar>x</div><article>{BODY}</article></div>", "The text of the page."),
    "states": ("".join(f"<div class='{c}'><p>{c}</p></div>" for c in ("no-sidebar", "with-banner", "share-enabled")), "no-sidebar with-banner share-enabled"),
    "sections": (f"<article>{BODY}<section class='related-work'><p>a</p></section><div id=search-results>b</div></article>", "The text of the page. a b"),
    "parts": ("<article>a" + "".join(f"<div class='x {c}'>no</div>" for c in ("ad", "ad-slot", "google_ads-2", "cookie-banner", "related-posts", "share-buttons")) + "b</article>", "a b"),
    "around article": (f"<div class=page-sidebar><a href=/><p>no</p></a><article>{BODY}</article>no</div>", "The text of the page."),
    "around main": (f"<div id=widget><a>no<main>{BODY}</main></a></div>{COMMENTS}", "The text of the page."),
    "in main": (f"<main><div class=sidebar><article>{BODY}</article></div>{COMMENTS}</main>", "The text of the page."),
    "comments": (f"<div>{BODY}</div><div class=sidebar><article>Teaser</article></div>{COMMENTS}", "The text of the page."),
    "nothing else": (f"<div class=promo><article>{BODY}</article></div>", "The text of the page."),
    "other article": (f"<article>{BODY}</article><div class=sidebar><article>Teaser</article></div>{COMMENTS}", "The text of the page."),
}


@pytest.mark.parametrize("name", MARKED)
def test_marked_parts(name):
    html, want = MARKED[name]
    assert html_text.main_text(html) == want
