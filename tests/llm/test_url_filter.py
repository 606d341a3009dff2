from cinerank.llm.url_filter import judge


def verdicts(spark, rows, redirects=None, **options):
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, rule string, node int")
    redirects = redirects and spark.createDataFrame(redirects, "url string, target string")
    return {r["page_id"]: r for r in judge(pages, redirects, **options).collect()}


def test_rules(spark):
    urls = ["http://a.net/x", "http://EXAMPLE.net/en/1", "https://b.example.net/en/?q=/x", "http://example.net/de/", "http://notexample.com/de/1",
            "http://www.example.com/de/1#top", "ftp://x.org/fr/?a", "http://x.org/fr", "http://a.net", "no scheme", None, "", "x://", "http://u?//:"]
    got = verdicts(spark, [(k, u, None) for k, u in enumerate(urls)])
    assert [got[k]["rule"] for k in range(len(urls))] == [
        "net/", "example.net/en/", "example.net/en/", "net/", None, "example.com/de/", "org/fr/", None, None, None, None, None, None, None]
    assert [got[k]["host"] for k in (1, 5, 9, 10, 12)] == ["example.net", "www.example.com", "", "", ""]
    assert [got[k]["path"] for k in (1, 2, 8, 9)] == ["/en/1", "/en/", "", ""]
    assert got[0]["verdict"] == "block" and got[6]["verdict"] == got[9]["verdict"] == "allow"


def test_blocks_pass_on_to_aliases_but_not_over_an_explicit_allow(spark):
    canonical = "<html><head><LINK href='{}' rel=canonical></head></html>"
    refresh = '<meta content="0; URL={}" http-equiv="Refresh">'
    rows = [
        (1, "http://one.com/a", canonical.format("http://two.com/b")),
        (2, "http://two.com/b/", refresh.format("http://blocked.net/z")),  # the target is no page
        (3, "https://two.com/b?utm_source=x#y", None),  # the same address
        (4, "http://two.com/b?page=2", None),  # another one
        (5, "http://three.com/a", refresh.format("/b")), (6, "http://three.com/b", canonical.format("//q.net/1")),
        (7, "http://x.org/fr/a", canonical.format("http://four.com/")), (8, "http://four.com", canonical.format("http://p.net/")),
        (9, "http://p.net/", None), (10, "http://dir.com/a/b.html", canonical.format("c.html")), (11, "http://dir.com/a/c.html", None),
        (12, None, canonical.format("http://p.net/")), (13, "http://six.com/", ""), (14, "http://self.com/", canonical.format("http://self.com/")),
    ]
    got = verdicts(spark, rows, [("http://six.com", "http://blocked.net/6"), (None, "http://six.com"), ("http://dir.com/a/c.html", None)], alike=True)
    blocked = {k for k, r in got.items() if r["verdict"] == "block"}
    assert blocked == {1, 2, 3, 5, 6, 9, 13}  # 7 and 8 share an explicit allow; 9 has its own rule


def test_targets_are_unescaped_resolved_and_all_taken(spark):
    canonical = '<link rel="canonical" href="{}">'
    refresh = '<meta http-equiv="refresh" content="0; url={}">'
    rows = [
        (1, "http://one.com/", canonical.format("http://blocked.com/x?a=1&amp;b=2")), (2, "http://two.com/", canonical.format("http://blocked.com/x?a=1&#38;b=2")),
        (3, "http://three.com/", refresh.format("http://blocked.com/x?a=1&#x26;b=2")), (4, "http://four.com/", canonical.format("http://blocked.com/x?a=1&amp;amp;b=2")),
        (5, "http://five.com/", canonical.format("/go?u=https://x.net/")), (6, "http://six.com/", canonical.format("go?u=https://x.net/")),
        (7, "http://seven.com/go?u=https://blocked.com/", None), (8, "http://seven.com/a", refresh.format("go?u=https://blocked.com/")),
        (9, "http://nine.com/", canonical.format("http://fine.com/") + canonical.format("http://x.net/1")),
        (10, "http://ten.com/", refresh.format("http://fine.com/10") + refresh.format("HTTP://x.net/2")),
        (11, "http://eleven.com/", canonical.format("http://blocked.com/&#26085;&#x1F600;")), (12, "http://twelve.com/", canonical.format("http://x.com/&#xD800;&#0;&#9999999;&nbsp;&")),
    ]
    sent = [("http://blocked.com/x?a=1&b=2", "http://q.net/"), ("http://blocked.com/日😀", "http://q.net/"), ("http://seven.com/go?u=https://blocked.com/", "http://q.net/")]
    assert {k for k, r in verdicts(spark, rows, sent).items() if r["verdict"] == "block"} == {1, 2, 3, 7, 8, 9, 10, 11}


def test_nothing_is_inherited_without_a_link(spark):
    rows = [(1, "http://example.com/de", None), (2, "http://example.com/de/", None), (3, "http://ok.com/?ref=1", None),
            (4, "http://ok.com/?ref=2", None), (5, "HTTP://OK.com?ref=2#top", None), (6, "https://ok.com/?ref=2", None)]  # 4 and 5 are one URL
    sent = [("http://ok.com/?ref=2", "http://x.net/")]
    assert {k for k, r in verdicts(spark, rows, sent).items() if r["verdict"] == "block"} == {2, 4, 5}
    assert {k for k, r in verdicts(spark, rows[:4], sent, alike=True).items() if r["verdict"] == "block"} == {1, 2, 3, 4}


def test_rules_of_redirect_sources_that_are_no_pages(spark):
    rows = [(1, "http://ok.com/y", None), (2, "http://fine.com/z", None), (3, "http://both.com/", None)]
    sent = [("http://bad.net/x", "http://ok.com/y"), ("http://bad.net/x", "http://both.com/"), ("http://a.org/fr/1", "http://fine.com/z")]
    assert {k: r["verdict"] for k, r in verdicts(spark, rows, sent).items()} == {1: "block", 2: "allow", 3: "block"}
    over = [*sent, ("http://a.org/fr/1", "http://ok.com/y")]  # an explicit allow among the aliases goes first
    assert {r["verdict"] for r in verdicts(spark, rows, over).values()} == {"allow"}


def test_repeated_rows_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", None)] * 3 + [(None, None, None)], "page_id long, url string, html string")
    assert len(judge(pages).collect()) == 4
    assert judge(pages.limit(0)).collect() == []
