"""The style tree: importances by brute force, what the tree alone removes, and hostile pages."""

import math
import random
import time
from collections import Counter

import pytest

from gondola.llm import html_extract as H

PAGES = "page_id long, url string, html string"


def sites(seed, n=60):
    """Pages whose menus, adverts and footers have no names and differ on every page."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(3, 9)))
    rows, wanted = [], {}
    for k in range(n):
        menu = "".join(f"<li><a href='/{word()}'>{word()}</a></li>" for _ in range(5))
        paragraphs = [" ".join(word() for _ in range(r.randrange(5, 60))) for _ in range(r.randrange(1, 14))]
        title = f"{word()} {word()}"
        article = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
        repeated = "<div><div>Share this page</div></div>"
        page = f"<body><div class=a{k}><ul>{menu}</ul></div><div class=b>{word()} {word()} {word()}</div><div class=c>{article}{repeated}</div><div class=d>{word()} {word()} {word()}</div></body>"
        rows.append((k, "https://h.example/x", page))
        wanted[k] = "\n\n".join([title, *paragraphs])
    return rows, wanted


def test_importances_by_brute_force(spark):
    rows, _ = sites(3, 25)
    rows = rows + rows[:4] + [(99, "https://other.example", rows[0][2]), (100, None, rows[0][2])]  # pages that repeat, and a host with one
    got = {(r["host"], r["path"]): (r["pages"], r["presentation"], r["content"]) for r in H.node_importance(spark.createDataFrame(rows, PAGES).withColumn("host", H.host_of("url"))).collect()}
    shown = {}
    for host, page in {(u.split("/")[2], h) for _, u, h in rows if u}:
        for path, style, content in H.style_rows(page):
            shown.setdefault((host, path), []).append((style, content))
    assert set(got) == set(shown)

    def presentation(seen):
        styles = Counter(s for s, _ in seen)
        return min(1, -sum(n / len(seen) * math.log(n / len(seen)) for n in styles.values()) / math.log(H.STYLES))

    for (host, path), seen in shown.items():
        m, contents = len(seen), Counter(c for _, c in seen)
        c = 1 - sum(n / m * math.log(n, m) for n in contents.values()) if m > 1 else 0.5
        everywhere = [x for (_, other), found in shown.items() if other == path for x in found]
        more = len(everywhere) - m
        w = H.PRIOR_PAGES * more / (more + H.PRIOR_PAGES)
        p = (m * presentation(seen) + w * presentation(everywhere) + (H.PRIOR_PAGES - w) / 2) / (m + H.PRIOR_PAGES)
        assert got[host, path] == pytest.approx((m, p, (m * c + H.PRIOR_COPIES / 2) / (m + H.PRIOR_COPIES)))
    assert any(p < H.LOW < c for _, p, c in got.values()) and any(c < H.LOW for _, _, c in got.values())


@pytest.mark.parametrize("names", [False, True])
def test_the_tree_alone_finds_the_article(spark, names):
    """Menus, adverts and footers of one shape go though each page has its own; a repeated branch inside the article goes too."""
    rows, wanted = sites(4)
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, PAGES), names=names).collect()}
    assert got == wanted
    assert all(H.main_text(page) != wanted[k] for k, _, page in rows)  # names alone have no page right


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_whole_tables(spark, sf):
    """No page loses its article, and the tree alone decides as the names would."""
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    named = {r["page_id"]: H.main_text(r["html"] or "") for r in pages.collect()}
    got = {r["page_id"]: r["text"] for r in H.extract(pages).collect()}
    assert set(got) == set(named) and all(bool(got[k]) == bool(named[k]) for k in named)
    assert sum(got[k] == named[k] for k in named) >= 0.999 * len(named)
    alone = {r["page_id"]: r["text"] for r in H.extract(pages, names=False).collect()}
    assert sum(alone[k] == named[k] for k in named) >= 0.95 * len(named)


@pytest.mark.parametrize("tag", ["article", "div class=text"])
@pytest.mark.parametrize("n", [1, 2, 3, 30])
def test_articles_of_one_shape_stay(spark, tag, n):
    """A host whose articles all have one shape, beside adverts that differ in theirs."""
    advert = lambda k: "".join(f"<i>buy {i}</i>" for i in range(k % 7))
    rows = [(k, "https://same.example/", f"<body><{tag}><h1>Title {k}</h1><p>First of {k}, with quite some words of its own that make a paragraph</p><p>More of {k}, with words as well, for an article is longer than an advert beside it</p></{tag.split()[0]}><div class=x>{advert(k)}</div></body>") for k in range(n)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[k].startswith(f"Title {k}\n\nFirst of {k}, with quite some words of its own that make a paragraph\n\nMore of {k}") for k in range(n))


def test_a_lone_page_is_judged_by_its_positions_elsewhere(spark):
    rows, wanted = sites(6, 80)
    rows = [(k, f"https://h{k // 40}.example/x", page.replace(f"class=a{k}", "class=a")) for k, _, page in rows]
    lone, wanted_lone = sites(7, 1)
    rows.append((1000, "https://lone.example/", lone[0][2].replace("class=a0", "class=a")))
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, PAGES), names=False).collect()}
    assert got[1000].startswith(wanted_lone[0]) and got[1000].removeprefix(wanted_lone[0]) in ("", "\n\nShare this page")
    assert all(got[k] == wanted[k] for k in wanted)


def test_pages_of_one_shape_are_judged_by_content(spark):
    rows = [(k, "http://one.example/", f"<body><div class=a><p>About us</p></div><div class=b><h1>T{k:02}</h1><p>body {k:02}</p></div></body>") for k in range(30)]
    rows += [(50 + k, "http://same.example/", "<body><div><p>the very same page</p></div></body>") for k in range(30)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[k] == f"T{k:02}\n\nbody {k:02}" for k in range(30)) and all(got[50 + k] == "the very same page" for k in range(30))


def test_hostile_pages_take_linear_time():
    n = 200_000
    pages = ["<div>" * n + "x", "<a " * n, "<b>" * (n // 8) + "<p>x</p>" * (n // 8), "<ul>" + "<li><div>" * (n // 8), '<a " ' * n, "<main>" * (n // 4) + "x", "<!-" * n]
    pages.append("<ul>" + "<div>" * (n // 8) + "<li>x</li>" * (n // 8))
    began = time.process_time()
    for page in pages:
        H.main_text(page, frozenset([1]))
        H.style_rows(page)
    assert time.process_time() - began < 60
    assert H.main_text("<div>" * n + "x") == "x"
