"""HTML extraction, archives and vectors against brute force."""

import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm import embedding_join, html_extract, queries, warc

PAGES = "page_id long, url string, html string"


def site(k, body, article=True):
    main = f"<article><h1>Title {k}</h1>{body}</article>" if article else f"<div><h1>Title {k}</h1>{body}</div>"
    return f"<html><head><title>t</title><script>var a='</p>';</script></head><body><div class='x1'><p>Welcome to our site</p></div>{main}<div class='x2'><p>All about us</p><p>Write to us</p></div></body></html>"


def test_main_text():
    page = """<body class="has-sidebar"><header><a>Site</a></header><div class="cookie-notice">We use cookies</div><nav>menu</nav><div id="main-content"><article class="post">
      <header><h1>Title &amp; more</h1></header><p>One<p>Two <b>bold</b>ed<br>line<ul><li>a<li>b</ul><div class="share-buttons">Share</div><blockquote>q</blockquote></article>
      <section class="comments"><article class="comment">nice</article></section></div><aside>side</aside><form>f<input></form><footer>foot</footer><!-- <p>no</p> --></body>"""
    assert html_extract.main_text(page) == "Title & more\n\nOne\n\nTwo bolded line\n\na\n\nb\n\nq"
    for page in ("", "<", "<p", "<b><p></b>", "a < b & c", "<p title='x>", "</p></div>", "&#0;&#x110000;&bogus;", "<script>unclosed", "<div/>x"):
        html_extract.main_text(page), html_extract.style_rows(page)
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert html_extract.main_text(deep) == "x"


def test_style_tree_finds_what_has_no_name(spark, tmp_path):
    rows = [(k, f"https://A.example/p{k}", site(k, f"<p>Body of page {k}, long enough</p><p>More of {k * 7}</p>", article=k % 2 == 0)) for k in range(40)]
    rows += [(100, "https://solo.example/", site(0, "<p>Alone</p>", article=False)), (101, None, None), (102, "not a url", ""), (102, "not a url", "")]
    spark.createDataFrame(rows, PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op3_style_tree_extraction(spark, str(tmp_path)).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    for k in range(40):
        assert text[k] == f"Title {k}\n\nBody of page {k}, long enough\n\nMore of {k * 7}"
    assert text[100].startswith("Welcome to our site") and text[101] == text[102] == ""


def test_near_copies_on_a_host_stay(spark):
    rows = [(k, "https://c.example/", site(k, "".join(f"<p class='par'>Paragraph {i} of a copied article</p>" for i in range(20)) + f"<p>edit {k}</p>")) for k in range(12)]
    got = html_extract.extract(spark.createDataFrame(rows, PAGES).withColumn("text", F.lit("clash"))).collect()
    assert all(r["text"].count("Paragraph") == 20 for r in got)


def test_warc(spark, tmp_path):
    rows = [(k, f"https://a.example/{k % 5} x\r\n", h) for k, h in enumerate(["<p>é</p>", "same", "same", "", None, "a\r\n\r\nb\r\n", "\r\n\r\n", "WARC/1.1\r\nContent-Length: 5\r\n\r\nx", "same\r", "z" * 300_000])]
    rows += [(3, None, "twice"), (3, None, "twice"), (None, "u", "same"), (20, "u1", "tie"), (20, "u2", "tie"), (None, None, "lonely")]
    spark.createDataFrame(rows, PAGES).repartition(2).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((tuple(r) for r in queries.op9_warc_assembly(spark, str(tmp_path)).collect()), key=repr)
    largest = {}
    for page, _, html in rows:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", -1))
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        keeper = largest.get(html or "")
        revisit = keeper is not None and page != keeper
        want.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", keeper if revisit else None))
    assert got == sorted(want, key=repr)


def test_warc_blocks_survive(spark, tmp_path):
    pages = spark.createDataFrame([(1, "https://a.example/", "<p>x\r\n\r\ny</p>"), (2, None, None)], PAGES).withColumn("digest", F.lit("clash"))
    warc.write_archives(pages, f"{tmp_path}/w")
    captures = {r["page_id"]: r for r in warc.assemble(warc.read_records(spark, f"{tmp_path}/w", with_blocks=True)).collect()}
    assert bytes(captures[1]["response"]["block"]).endswith(b"\r\n\r\n<p>x\r\n\r\ny</p>")
    assert bytes(captures[1]["request"]["block"]) == b"GET https://a.example/ HTTP/1.1\r\n\r\n"
    assert captures[2]["response"]["target_uri"] is None and captures[2]["metadata"]["record_type"] == "metadata"
    warc.write_archives(pages.limit(0), f"{tmp_path}/none")
    assert warc.assemble(warc.read_records(spark, f"{tmp_path}/none")).count() == 0


@pytest.mark.parametrize("block_rows", [None, 8192, 60])
def test_embedding_join(spark, block_rows):
    r = np.random.default_rng(5)
    base = r.normal(size=(30, 16))
    x = np.concatenate([base[i % 30] + r.normal(scale=0.02 + 0.1 * (i % 4), size=16) for i in range(240)] + [base[0] + r.normal(scale=0.03, size=16) for _ in range(160)]).reshape(-1, 16)
    rows = [(i, [float(np.float32(v)) for v in x[i] * (1 + i % 3)]) for i in range(len(x))]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] + [1.0] * 15), (1004, [float("inf")] * 16), (1005, [None] + [1.0] * 15), (1006, [1.0, 0.0]), (1007, [2.0, 0.0]), (5, rows[5][1]), (None, rows[6][1]), (1008, [1e300] * 16), (1009, [1e-300] * 16)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("n_links", F.lit("clash"))
    got = embedding_join.near_groups(df, block_rows=block_rows).collect()
    every = [(i, np.array(v, float)) for i, v in rows + odd if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    unit = [(i, v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())) for i, v in every]
    links = [[len(a[1]) == len(b[1]) and float(a[1] @ b[1]) >= 0.95 and p != q for q, b in enumerate(unit)] for p, a in enumerate(unit)]
    top = list(range(len(unit)))
    changed = True
    while changed:
        changed = False
        for p in range(len(unit)):
            low = min([top[q] for q in range(len(unit)) if links[p][q]] + [top[p]])
            if low < top[p]:
                top[p], changed = low, True
    smallest = {}
    for p, (i, _) in enumerate(unit):
        if i is not None:
            smallest[top[p]] = min(i, smallest.get(top[p], i))
    want = [(i, sum(links[p]), smallest.get(top[p])) for p, (i, _) in enumerate(unit)] + [(i, 0, i) for i in range(1000, 1006)]
    assert sorted(((g["vec_id"], g["n_links"], g["component_id"]) for g in got), key=repr) == sorted(want, key=repr)
    assert all(g["kept"] == (g["vec_id"] == g["component_id"]) for g in got)


def clustered(spark, clusters, each=40, dim=16):
    r = np.random.default_rng(clusters)
    centres = r.normal(size=(clusters, dim))
    rows = [(int(k), (c + r.normal(size=dim) * 0.05).tolist()) for k, c in enumerate(np.repeat(centres, each, axis=0))]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>"), np.array([v for _, v in rows])


def test_pairs_of_blocks_grow_with_clustered_vectors(spark):
    """Twice the clusters, about twice the pairs of blocks (all pairs would be four times); every link is found."""
    pairs = {}
    for clusters in (50, 100, 200):
        df, x = clustered(spark, clusters)
        _, placed = embedding_join.block_pairs(df, block_rows=40)
        both = placed.groupBy("dim", "c1", "b1", "c2", "b2").agg(F.count_distinct("side").alias("sides")).where("sides = 2 or (c1 = c2 and b1 = b2)")
        pairs[clusters] = both.count()
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        want = (x @ x.T >= 0.95).sum(axis=1) - 1
        got = {r["vec_id"]: r["n_links"] for r in embedding_join.near_groups(df, block_rows=40).collect()}
        assert [got[k] for k in range(len(x))] == want.tolist()
    assert pairs[200] < 2.6 * pairs[100] < 2.6 * 2.6 * pairs[50] and pairs[200] < 200 * 201 / 2 / 5


def test_blocks_keep_every_tree_together(spark):
    r = np.random.default_rng(3)
    x, _ = embedding_join.unit_rows(list(r.normal(size=(90, 3))))
    ids = r.permutation(90).astype(np.int64)
    for split in (None, 40):
        left, right = ((ids, x), None) if split is None else ((ids[:split], x[:split]), (ids[split:], x[split:]))
        found, n, root = embedding_join.compare(left, right, 0.95)
        hits = x @ x.T >= 0.95
        np.fill_diagonal(hits, False)
        if split:
            hits[:split, :split] = hits[split:, split:] = False
        reach = np.eye(90, dtype=bool) | hits
        for _ in range(90):
            reach = reach | (reach @ hits)
        want = {int(ids[k]): (int(hits[k].sum()), int(ids[reach[k]].min())) for k in range(90) if hits[k].any()}
        assert {int(i): (int(k), int(t)) for i, k, t in zip(found, n, root)} == want


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    for run in (queries.op3_style_tree_extraction, queries.op6_embedding_dedup, queries.op9_warc_assembly):
        assert run(spark, str(tmp_path)).count() == 0


