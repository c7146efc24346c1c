"""Main text of pages, and fixity of their WARC records."""

import html
import re

import pytest
from featurespark.llm import html_templates, warc_fixity
from featurespark.llm.html_templates import Page
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.01"


def article_text(source):
    """The article of a test page by regular expressions."""
    inner = re.search(r"<article>(.*?)</article>", source, re.DOTALL)[1]
    inner = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))
    assert "<" not in inner
    return " ".join(html.unescape(inner).split())


def test_test_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r["page_id"]: r for r in html_templates.extract_main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["page_id"]]["text"] == article_text(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
        assert got[r["page_id"]]["url"] == r["url"]


CASES = {
    "": "",
    "plain &lt;b&gt; text": "plain <b> text",
    "a < b <": "a < b <",
    "<p>x<!-- never closed": "x",
    "<p>one <b>bo</b>ld<p>two": "one bold two",
    "<p>a<br>b</p>c": "a b c",
    "<ul><li>a<li>b</ul>c": "a b c",
    "<table><tr><td>a<td>b<tr><td>c</table>": "a b c",
    "<script>if (a<b) '</p>'</SCRIPT>x<style>p{}</style>": "x",
    "<script>never closed": "",
    "<nav>menu</nav><header>top</header><main>m</main><footer>f</footer>": "m",
    "<body class='has-sidebar'>kept<div id=sidebar>gone</div></body>": "kept",
    "<article>a<div class='user-comments'>c</div>b</article><p>outside": "a b",
    "<p>a</p><form>f<p>g</p></form><div role='complementary'>h</div><p hidden>i</p>": "a",
    "<div class=\"Ad-Slot\">x</div><div class='header-image'>y</div><div title='ad > x'>z</div>": "y z",
    "<article><header><h1>T</h1></header><p>t</p></article>": "T t",
    "</div></p></b>x</article>": "x",
    "<p>a&nbsp;&nbsp;b \t\n c&amp": "a b c&",
    "<i>a</p>b</i>c": "a bc",
    "<p>İ<script>x</script>after": "İafter",
    "<" * 2000: "<" * 2000,
    "<b>" * 3000 + "deep": "deep",
}


@pytest.mark.parametrize("source", CASES)
def test_markup(source):
    assert Page(source).text(set()) == CASES[source]


LABELLED = {
    "<div class='content has-sidebar'>all<p>of it</p></div>": "all of it",
    "<main class='with-sidebar'><p>m</p></main>": "m",
    "<article class='no-comments'>a</article>": "a",
    "<div id='sidebar'><article>a</article></div>": "a",
    "<div class='widget'>most of the text</div><p>a</p>": "a",
    "<div class='widget'>the only text</div><div class='menu'>m</div>": "the only text",
    "<div class='cookie-notice'>the only text</div>": "",
    "<article><p>Short real story.</p><section class='comments'>" + "word " * 60 + "</section></article>":
    "Short real story.",
    "<main><p>s</p><section id='comments'>much longer than it</section></main>": "s",
    "<p>s</p><ol class='commentlist'><li>much longer than it</ol><div id='replies'>and this too</div>": "s",
    "<article>story</article><section class='comments'><article>a longer comment on it</article></section>":
    "story",
    "<section class='comments'><article>the only article</article></section>": "the only article",
    "<div class='addressbook'>x</div><div class='siteFooter'>y</div><div id='adbox'>z</div>": "x",
    "<article><h2 id='search'>Search</h2><section id='related-work'>r</section><p>and more text</p></article>":
    "Search r and more text",
    "<article>the longer text<div class='comments'><article>c</article></div></article>": "the longer text",
    "<p>the longer text</p><div class='page-sidebar has-ads'>s</div>": "the longer text",
}


@pytest.mark.parametrize("source", LABELLED)
def test_labels_drop_no_main_text(source):
    assert Page(source).text(set()) == LABELLED[source]


def site(n, host="h.example"):
    """Pages with a menu without marks, an own text, and a quote that all have in their article."""
    return [
        (
            i,
            f"https://{host}/{i}",
            f"<div><ul><li>Home</li><li>News</li></ul></div><div><p>Own text number {i} is long enough"
            f" to be most of the page, as texts are.</p></div><div>All rights reserved</div>",
        )
        for i in range(n)
    ]


def test_recurring_subtrees_are_template(spark):
    pages = spark.createDataFrame(site(12), "page_id long, url string, html string")
    for r in html_templates.extract_main_text(pages).collect():
        assert r["text"] == f"Own text number {r['page_id']} is long enough to be most of the page, as texts are."


def test_deletion_alone_decides(spark):
    """A site without marks, whose menus hold more text than its pages, against a plain count."""
    menus = ["<div><ul>" + "".join(f"<li>Entry {k} of menu {m}</li>" for k in range(20)) + "</ul></div>" for m in range(3)]
    rows, want = [], {}
    for i in range(60):
        # The third menu is on four pages only.
        chosen = [menus[0], menus[1] if i % 2 else "", menus[2] if i < 4 else ""]
        rows.append((i, "http://plain.example/", f"{chosen[0]}{chosen[1]}<div><p>Text {i}.</p></div>{chosen[2]}"))
    count = {m: sum(m in r[2] for r in rows) for m in menus}
    for i, _, source in rows:
        for m in menus:
            if count[m] >= max(5, 0.05 * len(rows)):
                source = source.replace(m, "")
        want[i] = " ".join(re.sub("<[^>]*>", " ", source).split())
    assert sum("menu 2" in t for t in want.values()) == 4 and not [t for t in want.values() if "menu 0" in t]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_templates.extract_main_text(df).collect()}
    assert got == want
    # Without templates to delete, the menus stay.
    alone = html_templates.extract_main_text(df.where("page_id = 9")).first()["text"]
    assert "menu 0" in alone and "menu 1" in alone


def test_text_of_many_copies_stays(spark):
    rows = [
        (i, "http://w.example/", f"<div>Page {i}</div><article><div><p>An article on many pages.</p></div></article>")
        for i in range(30)
    ] + [(100 + i, "http://e.example/", f"<title>{i}</title><div>Nothing was found.</div>") for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_templates.extract_main_text(df).collect()}
    assert set(got.values()) == {"An article on many pages.", "Nothing was found."}


def test_large_hosts_keep_no_template(spark):
    rows = [
        (i, f"http://big.example/{i}", ("<div>Our section menu</div>" if i < 110 else "")
         + f"<div><p>Own text number {i} is long enough to be most of the page.</p></div>")
        for i in range(2750)
    ]
    got = html_templates.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert not [r["text"] for r in got.collect() if "menu" in r["text"]]


def test_few_pages_have_no_template(spark):
    pages = spark.createDataFrame(site(3) + site(4, "other.example"), "page_id long, url string, html string")
    assert all(r["text"].startswith("Home News Own") for r in html_templates.extract_main_text(pages).collect())


def test_flow_text_of_articles_stays(spark):
    rows = [
        (i, "http://q.example/", f"<article><p>A quote that all pages have.</p><p>Text {i}, and more of it.</p>"
         "<div>Read more on this site</div></article>")
        for i in range(10)
    ]
    got = html_templates.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r["text"] for r in got.collect()} == {f"A quote that all pages have. Text {i}, and more of it." for i in range(10)}


def test_copies_of_a_page_are_no_template(spark):
    rows = [(i, "http://c.example/p", "<div><p>The same page, many times.</p><p>Twice.</p></div>") for i in range(30)]
    got = html_templates.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert [r["text"] for r in got.collect()] == ["The same page, many times. Twice."] * 30


def test_odd_pages(spark):
    rows = [
        (1, None, None, "x"),
        (None, "no url", "<p>a", "x"),
        (2, "HTTPS://Ex.ORG:80/a", "", "x"),
        (2, "HTTPS://Ex.ORG:80/a", "", "x"),
        (3, "http://l.example/", "<p>" + "word " * 50_000, "x"),
    ]
    kind = "page_id long, url string, html string, key string"
    pages = spark.createDataFrame(rows, kind)
    got = html_templates.extract_main_text(pages).collect()
    assert sorted((r["page_id"] or 0, r["url"], r["n_chars"]) for r in got if r["url"]) == [
        (0, "no url", 1), (2, rows[2][1], 0), (2, rows[2][1], 0), (3, "http://l.example/", 249_999),
    ]
    assert html_templates.extract_main_text(pages.limit(0)).count() == 0
    hosts = pages.select(html_templates.host_of("url").alias("h")).collect()
    assert [r["h"] for r in hosts] == ["", "", "ex.org:80", "ex.org:80", "l.example"]


# WARC fixity


def leaves(spark, rows):
    return spark.createDataFrame(rows, "file string, offset long, digest string")


def brute(a, b):
    a, b = ({(f, o): d for f, o, d in rows} for rows in (a, b))
    out = []
    for key in a.keys() | b.keys():
        if a.get(key) != b.get(key):
            status = "missing" if key not in b else "extra" if key not in a else "altered"
            out.append((*key, status, a.get(key), b.get(key)))
    return sorted(out)


@pytest.mark.parametrize(("range_bytes", "fan_out"), [(1 << 20, 16), (50, 2)])
def test_audit_finds_every_fault(spark, range_bytes, fan_out):
    a = [(f"f{i % 3}", i * 37, f"d{i}") for i in range(200)] + [("f0", -1, "no offset")]
    b = [(f, o, d + "!" if o % 11 == 0 else d) for f, o, d in a if o % 13] + [("f1", 5, "new"), ("g", 0, "new")]
    found = warc_fixity.audit(leaves(spark, a), leaves(spark, b), range_bytes, fan_out)
    assert sorted(map(tuple, found.collect())) == brute(a, b)
    assert warc_fixity.audit(leaves(spark, a), leaves(spark, a[::-1]), range_bytes, fan_out).count() == 0
    assert warc_fixity.audit(leaves(spark, []), leaves(spark, [])).count() == 0
    assert warc_fixity.audit(leaves(spark, []), leaves(spark, a)).count() == len(a)


def test_intact_branches_are_not_opened(spark, monkeypatch):
    a = [("f", i * 10, f"d{i}") for i in range(1000)]
    b = [(f, o, "spoilt" if o == 5000 else d) for f, o, d in a]
    seen = []
    plain = warc_fixity.differing
    monkeypatch.setattr(warc_fixity, "differing", lambda x, y, k: seen.append(x.count()) or plain(x, y, k))
    assert warc_fixity.audit(leaves(spark, a), leaves(spark, b), 100, 4).count() == 1
    # Roots first; then the children of one node at each level, and the records of one range.
    assert seen[0] == 1 and max(seen[1:-1]) <= 4 and seen[-1] == 10


def test_records(spark):
    rows = [("f", 0, b"a"), ("f", 0, b"b"), ("f", 9, None), (None, None, b"c"), ("f", 20, b""), ("f", 20, b"")]
    one = warc_fixity.digest_records(spark.createDataFrame(rows, "file string, offset long, content binary"))
    two = warc_fixity.digest_records(spark.createDataFrame(rows[::-1], "file string, offset long, content binary"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert {(r["file"], r["offset"]) for r in one.collect()} == {("f", 0), ("", -1), ("f", 20)}


def test_many_records_without_a_place(spark):
    one = [(None, None, f"record {i % 900}".encode()) for i in range(1000)] + [("f", 3, b"x")]
    two = [r for r in one if r[2] != b"record 77"] + [(None, None, b"record 1")]
    sides = [
        warc_fixity.digest_records(spark.createDataFrame(rows, "file string, offset long, content binary").repartition(n))
        for n, rows in enumerate((one, one[::-1], two), 2)
    ]
    assert warc_fixity.audit(sides[0], sides[1]).count() == 0
    assert [(r["file"], r["offset"], r["status"]) for r in warc_fixity.audit(sides[0], sides[2]).collect()] == [
        ("", -1, "altered")
    ]


def test_ids_that_are_no_numbers(spark):
    rows = [("7", "u", "a"), ("seven", "u", "b"), (None, "u", "c"), ("seven", "u", "b")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    lost = warc_fixity.audit_pages(pages, F.coalesce("html", F.lit("")), F.coalesce(F.col("page_id") == "seven", F.lit(False)))
    assert {(r["page_id"], r["status"]) for r in lost.collect()} == {("seven", "missing")}


def test_pages_as_records(spark):
    rows = [(1, "http://a/", "<p>é</p>"), (None, None, None), (2, "u", ""), (2, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    record = pages.select(warc_fixity.warc_record("page_id", "url", F.coalesce("html", F.lit(""))).alias("r"))
    head, http, body = record.first()["r"].split("\r\n\r\n", 2)
    assert head.startswith("WARC/1.0\r\nWARC-Type: response") and http.startswith("HTTP/1.1 200 OK")
    assert body == "<p>é</p>\r\n\r\n"
    assert f"Content-Length: {len((http + '    ' + '<p>é</p>').encode())}" in head
    none = F.lit(False)
    assert warc_fixity.audit_pages(pages, F.coalesce("html", F.lit("")), none).count() == 0
    lost = warc_fixity.audit_pages(pages, F.coalesce("html", F.lit("")), F.coalesce(F.col("page_id") == 1, none))
    assert [(r["page_id"], r["status"]) for r in lost.collect()] == [(1, "missing")]
    assert warc_fixity.audit_pages(pages.limit(0), F.col("html"), none).count() == 0
