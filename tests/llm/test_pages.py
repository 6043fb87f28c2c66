import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytables.llm.templates import deduce_templates, extract_main_text, main_text
from skytables.llm.warc import archive_round_trip, build_index, look_up, read_records, surt, write_archives
from skytables.session import shared_dir

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def expected_records(rows):
    first = {}
    for key, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and key is not None:
            first[body] = min(first.get(body, key), key)
    out = []
    for key, _, html in rows:
        body = (html or "").encode()
        again = key is not None and len(body) >= 100 and first[body] != key
        out.append((key, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[body] if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    page = "<p>é " + "x" * 200
    rows = [(i, f"http://h{i % 3}.example.com/p/{i % 7}?q={i}", f"{page}{i % 5}") for i in range(1, 60)]
    rows += [(100, "http://h.example.com/", None), (101, "http://h.example.com/", ""), (102, "HTTP://WWW.H.example.com:80/#x", "short")]
    rows += [(103, None, page), (104, "not a url [", page), (None, "http://h0.example.com/p/0?q=0", page), (105, "http://x/ y\n\r", "a\r\n\r\nWARC/1.1\r\n" * 20)]
    rows += [(1, rows[0][1], rows[0][2]), (106, "http://big.example.com/", "z" * 3_000_000)]
    got = archive_round_trip(pages(spark, rows).withColumns({"digest": F.lit(1), "surt": F.lit(2)}))
    assert sorted(map(tuple, got.collect()), key=str) == expected_records(rows)
    assert archive_round_trip(pages(spark, [])).count() == 0


def test_lookup_by_url_finds_every_capture_in_small_blocks(spark):
    rows = [(i, f"http://www.site{i % 40}.example.org/{i % 4}", f"page {i} " * 20) for i in range(400)]
    folder = shared_dir(spark)
    captures = write_archives(pages(spark, rows), folder)
    directory = build_index(captures, folder, block_lines=3)
    asked = [rows[5][1], "http://site7.example.org/3", "http://nowhere.example.org/"]
    queries = spark.createDataFrame([(u, None) for u in asked], "url string, id string")
    found = look_up(queries, directory, folder)
    records = read_records(found, folder).collect()
    keys = {surt(u) for u in asked}
    want = {(str(i), html) for i, u, html in rows if surt(u) in keys}
    assert {(r.id, bytes(r.payload).decode()) for r in records} == want
    one = look_up(spark.createDataFrame([(rows[9][1], "9")], "url string, id string"), directory, folder).collect()
    assert len(one) == 1 and one[0].kind == "response"


def test_reversed_host_keys():
    assert surt("https://www.A.example.com:8080/x/y?b=1#f") == "com,example,a)/x/y?b=1"
    assert surt("http://a.example.com") == "com,example,a)/" and surt(None) == ")/"


ARTICLE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div><script>var t="</p><article>";</script>
<article><h1>A &amp; B</h1><p><b>One.<br><p>Two&nbsp;
 three <!-- no <p> --> <i>four</i></p><aside>see also</aside><div class="ad">BUY</div><ul><li>x</li><li>y</li></ul>
<form><input name=q>go</form><noscript>off</noscript><section id="comments"><p>reader</p></section></article>
<div class="sidebar">side</div><footer>&copy; f</footer></body></html>"""


def test_article_without_its_surroundings():
    assert main_text(ARTICLE, None, set(), 0.6) == "A & B\n\nOne.\n\nTwo three four\n\nx\n\ny"


def test_marks_on_single_blocks_and_beside_content():
    page = """<body><div class="content has-sidebar"><article><div class="entry-header"><h2>T</h2></div><p class="advert">Buy<p>One
    <p class="share-links">Share</p><ul><li>a<li class="ad">b<li>c</ul></article></div><p>out</p></body>"""
    assert main_text(page, None, set(), 0.6) == "T\n\nOne\n\na\n\nc"


@pytest.mark.parametrize("page", ["", "<", "<p", "text only", "<p>a<p>b", "<div><div><span>", "</div></p>x", "<a title='x>y'>z</a>", "<script>"])
def test_broken_markup(page):
    assert isinstance(main_text(page, None, set(), 0.6), str)
    assert "<" not in main_text(page, None, set(), 0.6) or page == "<" or page == "<p"


def site(i, words=60):
    body = " ".join(f"w{i}x{j}" for j in range(words))
    return f"""<html><body><div class="top"><p>The Daily Site</p></div><div class="wrap"><div class="left"><p>Links of the site</p>
<a href=1>one</a></div><div class="story"><p>{body}</p><p>More about {i}</p></div></div><div class="end"><p>All rights of the site</p></div></body></html>"""


def test_templates_are_deduced_from_a_host(spark):
    rows = [(i, f"http://daily.example.com/{i}", site(i)) for i in range(8)] + [(9, "http://other.example.com/", site(9))]
    got = {r.page_id: r.text for r in extract_main_text(pages(spark, rows)).collect()}
    for i in [*range(8), 9]:
        assert got[i] == " ".join(f"w{i}x{j}" for j in range(60)) + f"\n\nMore about {i}"
    prepared = pages(spark, rows).select(F.col("page_id").cast("string").alias("page"), F.lit("h").alias("host"), "html")
    template = deduce_templates(prepared, support=3, share=0.6).first()
    assert template.slot.endswith("/div.story") and any("/div.top\x00" in t for t in template.boilerplate)


def test_pages_edge_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "http://a/", ARTICLE), (3, "http://a/", ARTICLE), (3, "http://a/", ARTICLE)]
    rows += [(4, "http://[bad", "<p>" + "word " * 200_000)]
    out = extract_main_text(pages(spark, rows).withColumns({"text": F.lit("mine"), "host": F.lit("h"), "slot": F.lit("s")})).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    texts = {r.page_id: r.text for r in out}
    assert texts[1] == texts[2] == "" and texts[3] == texts[None] and texts[3].startswith("A & B") and len(texts[4]) == 999_999
    assert extract_main_text(pages(spark, [])).count() == 0


def test_given_pages_give_their_articles(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract_main_text(rows).join(rows.select("page_id", "html"), "page_id").collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        assert "".join(r.text.split()) == "".join(_plain(article).split())


def _plain(fragment):
    import html
    import re

    return html.unescape(re.sub(r"<[^>]+>", " ", fragment))


def test_fixed_blocks_inside_articles_and_cards_beside_the_text(spark):
    rows = []
    for i in range(6):
        body = " ".join(f"a{i}x{j}" for j in range(40))
        rows.append((i, "http://a.example.com/", f"<body><article><p>{body}</p><p>Sign up for our letter today</p></article></body>"))
        text = " ".join(f"b{i}x{j}" for j in range(60))
        card = f"<div class=box><article><p>card {i}</p></article></div>"
        rows.append((20 + i, "http://b.example.com/", f"<body><div class=body><p>{text}</p></div>{card}</body>"))
        rows.append((40 + i, "http://c.example.com/", "<body><article><p>the same page</p></article></body>"))
    got = {r.page_id: r.text for r in extract_main_text(pages(spark, rows)).collect()}
    for i in range(6):
        assert got[i] == " ".join(f"a{i}x{j}" for j in range(40))
        assert " ".join(f"b{i}x{j}" for j in range(60)) in got[20 + i]
        assert got[40 + i] == "the same page"


@pytest.mark.parametrize("odd", [None, "", "stub", "<body><table><tr><td>other</td></tr></table></body>"])
def test_odd_pages_leave_the_template_of_their_host(spark, odd):
    rows = [(i, "http://daily.example.com/", site(i, 8)) for i in range(8)] + [(50, "http://daily.example.com/", odd)]
    got = {r.page_id: r.text for r in extract_main_text(pages(spark, rows)).collect()}
    for i in range(8):
        assert got[i] == " ".join(f"w{i}x{j}" for j in range(8)) + f"\n\nMore about {i}"


def test_layouts_of_a_host_have_their_own_templates(spark):
    rows = [(i, "http://daily.example.com/", site(i, 8)) for i in range(8)]
    rows += [(50 + i, "http://daily.example.com/", f"<body><section class=photo><p>photo {i} of the day</p></section></body>") for i in range(20)]
    got = {r.page_id: r.text for r in extract_main_text(pages(spark, rows)).collect()}
    for i in range(8):
        assert got[i] == " ".join(f"w{i}x{j}" for j in range(8)) + f"\n\nMore about {i}"


def test_all_of_a_text_is_in_the_slot():
    a, b = " ".join(f"a{i}" for i in range(35)), " ".join(f"b{i}" for i in range(65))
    for left, right in ((f"<p>{a}</p>", f"<ul><li>{b}</ul>"), (f"<section>{a}</section>", f"<section class=x>{b}</section>"), ("<h1>Title</h1>", f"<div>{b}</div>"), (f"<p>{a}</p>", f"<blockquote>{b}</blockquote>")):
        text = main_text(f"<body><main>{left}{right}</main></body>", None, set(), 0.6)
        assert text.endswith("\n\n" + b) and (a in text or text.startswith("Title"))


def test_revisit_takes_the_size_of_the_payload_it_names(spark):
    first, second = "a" * 150, "b" * 400
    rows = [(1, "http://x.org/1", first), (1, "http://x.org/1b", second), (7, "http://x.org/7", second)]
    got = {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in archive_round_trip(pages(spark, rows)).collect()}
    assert got == {(1, 150, "response", None), (1, 400, "response", None), (7, 400, "revisit", 1)}
