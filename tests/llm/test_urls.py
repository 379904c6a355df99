import pytest

from larder.llm import urls

KIND = "page_id long, url string, html string, node string, component string, rule string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z") for i, u, h in rows], KIND)


def canonical(href):
    return f'<html><head><LINK href="{href}" data-x="1" rel="canonical"></head>'


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("HTTP://Www.Example.NET/en/x?y#z", "www.example.net", "/en/x", "example.net/en/", "allow"),
        ("http://a.net/", "a.net", "/", "net/", "block"),
        ("http://a.net", "a.net", "", None, "allow"),
        ("http://anet/x", "anet", "/x", None, "allow"),
        ("http://net/x", "net", "/x", "net/", "block"),
        ("https://example.com/de/a", "example.com", "/de/a", "example.com/de/", "block"),
        ("https://badexample.com/de/a", "badexample.com", "/de/a", None, "allow"),
        ("https://q.org/fr/?a://b", "q.org", "/fr/", "org/fr/", "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("x://ÉA.org/fr/\nb", "Éa.org", "/fr/\nb", "org/fr/", "allow"),
        ("a?u=http://b.net/x", "b.net", "/x", "net/", "block"),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    row = urls.url_verdicts(pages(spark, [(1, url, None)])).first()
    assert tuple(row) == (1, host, path, rule, verdict)


def test_decisions_reach_aliases_and_allow_comes_first(spark):
    rows = [
        (1, "http://a.io/1", canonical("https://x.net/1")),  # blocked by its canonical address
        (2, "http://b.io/2", canonical("http://A.io/1#part")),  # two steps away
        (3, "http://c.io/3", '<meta http-equiv="refresh" content="0; url=http://b.io/2">'),
        (4, "http://d.io/4", canonical("http://e.io/5")),
        (5, "http://e.io/5", canonical("https://www.example.net/en/5")),
        (6, "http://f.io/6", canonical("http://e.io/5")),
        (7, "https://y.net/7", canonical("http://e.io/5")),  # blocked itself, though an alias is allowed
        (8, "http://g.io/8", "<p>canonical</p>"),
        (9, "http://c.io/3", None),
        (10, "http://h.io/a", canonical("/b")),
        (11, "http://h.io/b", canonical("//x.net/c")),
        (12, "http://i.io/", canonical("relative")),
    ]
    found = {r["page_id"]: r["verdict"] for r in urls.url_verdicts(pages(spark, rows)).collect()}
    blocked = {1, 2, 3, 7, 9, 10, 11}
    assert {i for i, v in found.items() if v == "block"} == blocked and len(found) == 12


def test_relative_and_further_links_are_followed(spark):
    links = [
        ("http://a.io/x/y/p?q=1#f", "index.html", "http://a.io/x/y/index.html"),
        ("http://a.io/x/y/p", "../en/", "http://a.io/x/en/"),
        ("http://a.io/x/y/p", "../../../..", "http://a.io/"),
        ("http://a.io/x/y/p", "..", "http://a.io/x/"),
        ("http://a.io/x/y/p", "./a/./b?u=../c", "http://a.io/x/y/a/b?u=../c"),
        ("http://a.io/x/y/p?q=1", "?page=2", "http://a.io/x/y/p?page=2"),
        ("http://a.io/p?q=1", "#top", "http://a.io/p?q=1"),
        ("http://a.io", "n?u=http://b.net/", "http://a.io/n?u=http://b.net/"),
        ("http://a.io/x/", "/u/../v", "http://a.io/v"),
        ("http://a.io/x/", "//b.io/y", "http://b.io/y"),
        ("http://a.io/x/", "HTTP://B.io/y", "http://b.io/y"),
        ("http://a.io/x/", "mailto:me", None),
        ("http://a.io/x/", "w/éa", "http://a.io/x/w/éa"),
    ]
    for href in (canonical, lambda h: f'<meta http-equiv="refresh" content="0;url={h}">'):
        found = urls.alias_edges(pages(spark, [(k, u, href(h)) for k, (u, h, _) in enumerate(links)])).collect()
        node = lambda u: u.split("#")[0]
        assert sorted((r["a"], r["b"]) for r in found) == sorted((node(u), b) for u, _, b in links if b)
    rows = [
        (1, "http://c.io/d/1", '<base target="_top" href="../e/">' + canonical("2")),
        (2, "http://c.io/e/2", canonical("http://d.io/3") + canonical("http://x.net/4")),
        (3, "http://d.io/3", '<meta http-equiv="refresh" content="0; url=#"><meta http-equiv=refresh content="1; url=n/5">'),
        (4, "http://d.io/n/5", None),
        (5, "http://d.io/5", None),
    ]
    found = {r["page_id"]: r["verdict"] for r in urls.url_verdicts(pages(spark, rows)).collect()}
    assert {i for i, v in found.items() if v == "block"} == {1, 2, 3, 4}


def test_given_redirects(spark):
    moved = spark.createDataFrame([("http://a.io/", "http://b.net/"), (None, "http://a.io/"), ("http://a.io/", None)], "from_url string, to_url string")
    assert urls.url_verdicts(pages(spark, [(1, "http://a.io/", "")]), redirects=moved).first()["verdict"] == "block"


def test_no_pages(spark):
    assert urls.url_verdicts(pages(spark, [])).count() == 0
    plan = urls.url_verdicts(pages(spark, [(1, "http://a.net/", "")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
