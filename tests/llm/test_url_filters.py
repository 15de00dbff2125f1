from pricetide.llm.url_filters import url_filters

PAGE = "page_id long, url string, html string"


def canonical(href):
    return f'<html><head><LINK href="{href}" rel=canonical></head></html>'


def test_rules_aliases_and_odd_rows(spark):
    rows = [
        (1, "https://a.example.org/es/1", ""), (2, "http://sub.example.org/en/12?q", None),
        (3, "http://x.org", ""), (4, "http://x.org/", ""), (5, None, ""), (6, "no address", ""),
        (7, "HTTP://Shop.Example.COM/de/7#top", ""), (8, "http://b.com/fr/1", canonical("http://b.com/de/1")),
        (9, "http://one.net/a", canonical("https://two.net/b")),
        (10, "http://two.net/b", '<meta http-equiv="Refresh" content="0; url=//example.org/es/9">'),
        (11, "http://two.net/c/d", canonical("../x")), (12, "http://three.net/a?x=1&y=2", ""),
        (13, "http://four.net/", canonical("http://three.net/a?x=1&amp;y=2")),
        (9, "http://one.net/a", canonical("https://two.net/b")),
    ]
    got = {r.page_id: r for r in url_filters(spark.createDataFrame(rows, PAGE)).collect()}
    assert [(got[i].rule, got[i].verdict) for i in (1, 2, 3, 4, 7)] == [
        ("example.org/es/", "block"), ("example.org/en/1", "block"), (None, "allow"), ("org/", "allow"),
        ("com/de/", "block")]
    assert (got[7].host, got[7].path) == ("shop.example.com", "/de/7")
    assert [(got[i].host, got[i].path, got[i].verdict) for i in (5, 6)] == [("", "", "allow")] * 2
    # An explicit allow holds against a blocked alias; a chain of aliases carries a block.
    assert got[8].verdict == "allow" and not got[8].via_alias
    assert got[9].verdict == "block" and got[9].via_alias and got[10].verdict == "block"
    assert got[11].verdict == got[12].verdict == got[13].verdict == "allow"
    assert url_filters(spark.createDataFrame(rows, PAGE)).count() == len(rows)


def test_redirect_table_extra_columns_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://p.net/x", "", "mine", 3)], PAGE + ", host string, _n int")
    redirects = spark.createDataFrame([("http://p.net/x", "http://q.net/y"), ("http://q.net/y", "http://e.com/de/"),
                                       (None, "http://q.net/y"), ("http://q.net/y", "http://q.net/y")], "a string, b string")
    got = url_filters(pages, redirects=redirects).first()
    assert (got.host, got._n, got.verdict) == ("p.net", 3, "block")
    assert url_filters(pages.limit(0)).count() == 0
