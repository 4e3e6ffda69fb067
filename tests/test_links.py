from pyspark.sql import functions as F

from quarry.operators import links

# candidate links: one per rule, none, off-domain, subdomain, /2019.html vs /2021.html,
# two URLs with one basename, one exact duplicate.
URLS = [
    "https://repo.example.org/id/eprint/1/1/Thesis_A.pdf",     # rule 1 (and 3): document
    "https://repo.example.org/view/year/2021.html",            # rule 2
    "https://repo.example.org/view/year/2019.html",            # none
    "https://repo.example.org/id/eprint/987/",                 # rule 3
    "https://repo.example.org/view/thesis_type/",              # rule 4
    "https://repo.example.org/view/document_subtype/",         # rule 5
    "https://www.example.org/about",                               # none
    "https://other.test/id/eprint/5/",                             # off-domain
    "https://example.org/x/report.pdf",                            # same basename as next
    "https://example.org/y/report.pdf",
    "https://example.org/x/report.pdf",                            # exact duplicate
]


def link_df(spark):
    return spark.createDataFrame([(1, i + 1, u) for i, u in enumerate(URLS)],
                                 "page_id BIGINT, link_no BIGINT, url STRING")


def test_classes(spark):
    rule, cls = links.classify(F.col("url"))
    got = {r.url: (r.rule, r.c) for r in link_df(spark).select("url", rule.alias("rule"), cls.alias("c")).collect()}
    assert got[URLS[0]] == (1, "document")
    assert got[URLS[1]] == (2, "follow")
    assert got[URLS[2]] == (0, "none")
    assert got[URLS[3]] == (3, "follow")
    assert got[URLS[4]] == (4, "follow")
    assert got[URLS[5]] == (5, "follow")


def test_domain(spark):
    kept = {r.url for r in link_df(spark).filter(links.in_domain(F.col("url"), "example.org")).collect()}
    assert URLS[7] not in kept and URLS[6] in kept and URLS[8] in kept and URLS[0] in kept


def test_dedupe_and_file_names(spark):
    d = links.dedupe_urls(link_df(spark))
    assert d.count() == len(set(URLS))
    first = {r.url: r.link_no for r in d.collect()}
    assert first[URLS[8]] == 9
    names = [r.n for r in link_df(spark).select(links.file_name(F.col("link_no"), F.col("url")).alias("n")).collect()]
    assert names[8] == "9_report.pdf" and names[9] == "10_report.pdf"


def test_extract_and_resolve(spark):
    pages = spark.createDataFrame(
        [(1, "https://a.example.org/dir/page?x=1",
          '<a href="/abs">x</a><a href="rel.html">y</a><a href="//cdn.example.org/z">z</a>'
          '<a href="http://b.test/q">q</a>')],
        "page_id BIGINT, url STRING, html STRING")
    got = [r.url for r in links.extract_links(pages).orderBy("link_no").collect()]
    assert got == ["https://a.example.org/abs", "https://a.example.org/dir/rel.html",
                   "https://cdn.example.org/z", "http://b.test/q"]


def test_links_as_pages_write_them(spark):
    html = ("<A HREF='/x.pdf'>1</A> <a class=q href=/y.pdf>2</a> <area href=\"../up.pdf\"> <a href=\"?p=2&amp;q=1\">4</a>"
            "<link href=\"/s.css\"> <a href=\"mailto:a@b.c\">6</a> <a href=\"#top\">7</a> <a data-href=\"/no\">8</a>"
            "<a href=\" z.html#part \">9</a> <a href=\"./a/./../b/\">10</a> <a href=\"../../../..\">11</a><abbr href=\"/n\">")
    pages = spark.createDataFrame([(1, "https://a.example.org/d/e/page?x=1#f", html), (2, "https://a.example.org", '<a href="q">')],
                                  "page_id BIGINT, url STRING, html STRING")
    got = [(r.page_id, r.url) for r in links.extract_links(pages).orderBy("page_id", "link_no").collect()]
    base = "https://a.example.org"
    assert got == [(1, base + x) for x in ("/x.pdf", "/y.pdf", "/d/up.pdf", "/d/e/page?p=2&q=1", "/d/e/z.html", "/d/e/b/", "/")] + [
        (2, base + "/q")]


def test_denied_extensions_stop_all_but_the_first_rule(spark):
    urls = ["https://r.example.org/id/eprint/7/pic.jpg", "https://r.example.org/id/eprint/7/PIC.JPG?size=2",
            "https://r.example.org/id/eprint/7/paper.pdf", "https://r.example.org/id/eprint/7/page?f=a.jpg"]
    rule, _ = links.classify(F.col("url"))
    got = {r.url: r.rule for r in spark.createDataFrame([(u,) for u in urls], "url STRING").select("url", rule.alias("rule")).collect()}
    assert [got[u] for u in urls] == [0, 0, 1, 3]


def test_selection_chain(spark):
    got = links.select_links(link_df(spark), "example.org", 4).orderBy("doc_id").collect()
    assert [(r.doc_id, r.url, r["class"]) for r in got] == [
        (1, URLS[0], "document"), (2, URLS[1], "follow"), (3, URLS[3], "follow"), (4, URLS[4], "follow")]
