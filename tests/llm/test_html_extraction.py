import html
import random
import re
import time

import numpy as np

from tidewatch.llm.html_extraction import described, extract, laid_out, learn, listed, main_text, parse
from tidewatch.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def article(page):
    """The article of a page of the sample, by the marks that all of them have."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    parts = [html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))) for p in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(" ".join(p.split()) for p in parts if p.strip())


def test_articles_of_the_sample(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = QUERIES["op8_html_extraction"](spark, FOLDER).collect()
    assert len(got) == len(pages)
    right = [r.text == article(pages[r.page_id].html) for r in got]
    assert sum(right) > 0.98 * len(right)
    assert all(r.n_chars == len(r.text) and r.url == pages[r.page_id].url for r in got)


def test_other_layouts_and_parts(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    trees = learn(pages)
    rand = random.Random(77)
    texts = [article(r.html).split("\n") for r in pages.limit(40).collect()]
    bad = ["Home", "Contact us", "All rights reserved", "Subscribe now", "Read more stories"]
    right = sum(
        main_text(laid_out(t, bad, rand).replace(" data-main", ""), trees) == "\n".join(t) for t in texts
    )
    assert right >= 36
    body = " ".join(texts[0][1].split()[:60])
    page = f"""<body><header><h1>Site</h1></header><div id="sidebar"><p>{body}</p></div><div class="content"><h2>A &amp; B</h2>
      <p>{body}<p>{body} <b>bold</b><div class="advertisement"><p>Buy this</p></div><p>{body}</p></div>
      <form><p>{body}</p><input></form><div class="comments"><p>{body}</p></div><script>var x = "<p>no</p>"</script></body>"""
    assert main_text(page, trees) == "\n".join(["A & B", body, f"{body} bold", body])


def test_trees_of_broken_pages():
    order = listed(parse("<ul><li>a<li>b &lt;c&gt;</ul><p>d\n e<br>f<p>g<table><tr><td>h<td>i</table>tail<!-- no --><style>x{}</style>"))
    assert [b.text for b in order if b.text] == ["a", "b <c>", "d e f", "g", "h", "i", "tail"]


def test_places_and_neighbours_under_a_parent_of_many():
    order = listed(parse("<div>" + "".join(f"<p>{'x' * (k + 1)}</p>" for k in range(300)) + "</div>"))
    of = [k for k, b in enumerate(order) if b.tag == "p"]
    place, before, after = described(order)[of][:, 11:14].T
    assert np.allclose(place, np.arange(300) / 300)
    assert np.allclose(before, np.log1p(np.arange(300)))
    assert np.allclose(after, np.log1p([*range(2, 301), 0]))


def test_odd_rows(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "no tags", "x"), (4, "u", "<div>" * 3000 + "deep", "x")]
    rows += [(5, "u", "<p>" + "word " * 200_000, "x"), (5, "u", "<p>a</b></i><![x<", "x"), (6, "u", "<html></html>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    trees = learn(spark.read.parquet(f"{FOLDER}/pages.parquet"))
    got = extract(pages, trees).collect()
    assert len(got) == 7 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (1, 2, 6)] == ["", "", ""]
    assert extract(pages.limit(0), learn(pages.limit(0))).count() == 0


def test_pages_of_tags_that_are_never_closed():
    begin = time.process_time()
    for page in ("<p>x" + "<b>" * 100_000 + "</i>" * 100_000, "<i><div>" + "<b>" * 100_000 + "y" + "</i>" * 100_000 + "z"):
        assert "".join(b.text for b in listed(parse(page))) in ("x", "yz")
    assert time.process_time() - begin < 30  # it was quadratic: an hour
