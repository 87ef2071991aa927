from __future__ import annotations

import html
import random
import re
from collections import defaultdict

from clickloom.llm import boilerplate as B

MENU = "home news sport weather travel culture money science contact about"
LEGAL = "all rights reserved by the example company of example town"


def page(k, article=True, host="h.com"):
    body = f"<p>Story {k} of many &amp; more.</p><p>Second   part\n{k}</p>"
    body = f"<article><h1>Title {k}</h1>{body}</article>" if article else body
    return k, f"https://{host}/{k}", f"<html><head><title>T</title></head><body><div>{MENU}</div>{body}<div>{LEGAL}</div></body></html>"


SCHEMA = "page_id bigint, url string, html string"


def test_blocks_and_roles():
    text = (
        "<!DOCTYPE html><title>no</title><script>var a='</p><article>';</script><nav><p>menu<div>deep</div></nav><!-- <p>no</p> -->"
        '<article><header>by line</header><p>One <b>t</b>wo<br>three &lt;b&gt; &copy;</p><div class="ad">buy</div><p>a&nbsp;b<aside>side</aside>c</p>'
        '<section id="comments"><article><p>I think</p></article></section></article><footer>foot</footer><p>tail'
    )
    got = [(t, art) for t, art, furniture in B.blocks_of(text) if not furniture]
    assert got == [("One two three <b> ©", True), ("a b", True), ("c", True), ("tail", False)]
    assert [t for t, _, furniture in B.blocks_of(text) if furniture] == ["menu", "deep", "by line", "buy", "side", "I think", "foot"]
    assert B.blocks_of("") == [] and B.blocks_of("plain") == [("plain", False, False)]
    assert B.blocks_of("<p>cut off <b")[0][0].startswith("cut off")


def main(text):
    blocks = B.blocks_of(text)
    return [t for t, article, furniture in blocks if not furniture and (article or not any(b[1] for b in blocks))]


def test_class_names_hide_no_article():
    assert main('<article class="post no-sidebar"><p>Main text</p></article>') == ["Main text"]
    assert main('<div class="page has-header"><article><p>Main text</p></article></div>') == ["Main text"]
    assert main('<div class="menu layout"><p>home</p><article><p>Main text</p></article></div>') == ["Main text"]
    assert main('<body class="sidebar"><main class="menu"><p>Main text</p></main>') == ["Main text"]
    inside = '<article><h1 class="entry-header">Title</h1><section class="related-work"><p>Work</p></section><p class="share-price">Price</p><p class="notice">Mind</p></article>'
    assert main(inside) == ["Title", "Work", "Price", "Mind"]
    assert main('<article><p data-class="ad" class=story>Text</p><div class="box ad">buy</div></article>') == ["Text"]


def test_unclosed_elements_end_with_their_parents():
    blocks = B.blocks_of('<article><div class="ad">x<p>real text</p></article><p>after</p>')
    assert [(t, article) for t, article, furniture in blocks if not furniture] == [("real text", True), ("after", False)]
    assert main("<article><ul><li>one<li>two</ul><p>three<p>four</article>") == ["one", "two", "three", "four"]
    assert main("<head><title>t</title><body><p>Text") == ["Text"]
    assert main('<article><p>Text</p><ul class="menu"><li>a<li>b</ul><p>more</p></article>') == ["Text", "more"]
    assert main('<article><p>Text</article></div></p><nav><ul><li>x</nav>') == ["Text"]


def test_quotes_in_unquoted_values():
    assert main("<p title=it's>Main text</p>") == ["Main text"]
    assert main("<article><p title=\"a > b\">Main</p><p title='c > d'>text</p></article>") == ["Main", "text"]


def test_deeply_nested_pages_take_linear_time():
    deep = "<div class=menu>" * 50_000 + "x" + "</div>" * 50_000 + "<p>y</p>" * 50_000
    assert len(B.blocks_of(deep)) == 50_001 and len(B.blocks_of("<div class='ad'><p>z" * 50_000 + "</b></main>")) == 50_000


def test_comments_go_wherever_they_stand():
    text = '<article><p>Story</p></article><div id="comments"><article class="comment"><p>I think</p></article></div>'
    assert main(text) == ["Story"]


def test_repeated_prefixes_against_counting():
    rng = random.Random(4)
    pages = [[rng.choice("abc") for _ in range(rng.randint(0, 40))] for _ in range(30)]
    want = defaultdict(set)
    for k, words in enumerate(pages):
        for at in range(len(words) - 3):
            want[tuple(words[at : at + 4])].add(k)
    got = {tuple(pages[p][at : at + 4]): n for p, at, n in B.repeated_prefixes(pages, run=4)}
    assert got == {run: len(held) for run, held in want.items()}


def test_repeats_tell_furniture_without_markup(spark):
    rows = [page(k, article=False) for k in range(8)] + [page(k, article=True) for k in range(8, 12)] + [page(50, article=False, host="alone.org")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row", "'x' as host").repartition(3)
    for block_pages in (500, 3):  # one block a host, and many
        got = {r["page_id"]: r["text"] for r in B.main_text(df, block_pages=block_pages).collect()}
        assert got[3] == "Story 3 of many & more.\nSecond part 3"
        assert got[9] == "Title 9\nStory 9 of many & more.\nSecond part 9"
        assert got[50] == f"{MENU}\nStory 50 of many & more.\nSecond part 50\n{LEGAL}"


def test_a_page_without_an_article_stored_again_keeps_its_text(spark):
    rows = [page(k, article=False) for k in range(8)] + [page(k) for k in range(8, 12)]
    rows += [(100 + k, f"https://h.com/copy{k}", rows[3][2]) for k in range(20)]
    for block_pages in (500, 3):
        got = {r["page_id"]: r["text"] for r in B.main_text(spark.createDataFrame(rows, SCHEMA).repartition(3), block_pages=block_pages).collect()}
        assert all(got[k] == "Story 3 of many & more.\nSecond part 3" for k in (3, *range(100, 120)))
    twice = [(k, "https://h.com/x", "<p>one two three four five six seven eight nine</p>") for k in range(2)]
    assert [r["n_chars"] for r in B.main_text(spark.createDataFrame(twice, SCHEMA)).collect()] == [44, 44]


def test_the_limit_grows_with_the_host(spark):
    shared = "two pages of a huge host share this very paragraph"
    rows = [(k, f"https://h.com/{k}", f"<p>{MENU}</p><p>own {k}</p>" + (f"<p>{shared}</p>" if k < 2 else "")) for k in range(2100)]
    got = {r["page_id"]: r["text"] for r in B.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0] == f"own 0\n{shared}" and got[2000] == "own 2000"


def test_articles_keep_what_they_share(spark):
    shared = "the very same passage stands in each of these articles word by word"
    rows = [(k, f"https://h.com/{k}", f"<div>{shared}</div><article><p>{shared}</p><p>own {k}</p></article>") for k in range(5)]
    got = B.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r["text"] == f"{shared}\nown {r['page_id']}" for r in got)


def test_odd_pages_and_empty_table(spark):
    rows = [(None, None, None), (1, "http://h.com/1", ""), (2, "no address", "<article>" + "<p>x y z</p>" * 20_000 + "</article>"), (3, "http://h.com/3", "<nav>only"), (3, "http://h.com/3", "<nav>only")]
    got = sorted(((r["page_id"] or -1), r["n_chars"]) for r in B.main_text(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(-1, 0), (1, 0), (2, 20_000 * 6 - 1), (3, 0), (3, 0)]
    assert B.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_a_plain_cut(spark):
    from clickloom.llm.queries import op8_host_suffix_array

    sf_dir = "/root/testdata/sf0.001"
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in op8_host_suffix_array(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:h1|p)>", inside)]
        want = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]] == (want, len(want))


def test_repeats_decide_every_page_with_an_article_too(spark):
    """A menu without markup goes by its repeats; what stands beside the article once on the host stays, in page order."""
    rows = [(k, f"https://h.com/{k}", f"<div>{MENU}</div><div>Only page {k} opens like this</div><article><p>Story {k}</p></article><div>{LEGAL}</div>") for k in range(6)]
    for block_pages in (500, 2):
        got = {r["page_id"]: r["text"] for r in B.main_text(spark.createDataFrame(rows, SCHEMA).repartition(3), block_pages=block_pages).collect()}
        assert got == {k: f"Only page {k} opens like this\nStory {k}" for k in range(6)}


def test_given_pages_without_article_tags_and_class_names(spark):
    """The words of the article found again with the markup of articles and class names taken away."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    want = {r["page_id"]: r["text"] for r in B.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    bare = [(r["page_id"], r["url"], re.sub(r"</?article[^>]*>", "", re.sub(r' (?:class|id|role)="[^"]*"', "", r["html"]))) for r in rows]
    got = {r["page_id"]: r["text"] for r in B.main_text(spark.createDataFrame(bare, SCHEMA)).collect()}
    kept = sum(len(set(got[k].split("\n")) & set(want[k].split("\n"))) for k in want)
    found, right = sum(len(set(got[k].split("\n"))) for k in want), sum(len(set(want[k].split("\n"))) for k in want)
    print("precision", kept / found, "recall", kept / right, "pages", len(want))
    assert kept / right > 0.95 and kept / found > 0.5
