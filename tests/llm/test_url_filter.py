import duckdb

from churnlake.llm.oracles import ORACLES
from churnlake.llm.url_filter import filter_urls


def link(url):
    return f'<head><LINK rel="canonical" href="{url}"></head>'


def refresh(url):
    return f"<meta http-equiv='refresh' content='0; url={url}'>"


PAGES = [
    (1, "http://a.example.org/x", link("https://b.example.com/en/1")),         # alias of a blocked URL
    (2, "https://b.example.com/en/1/", "<p>"),
    (3, "http://c.org/y#top", refresh("http://a.example.org/x?utm_source=feed")),   # two hops away
    (4, "http://d.org/", link("http://e.net/es/1")), (5, "http://d.org/?ref=x", link("//www.example.com/en/1")),  # allow wins
    (6, "http://F.org/p/q", link("/z")), (7, "https://f.org/z", refresh("http://g.net/fr/2")), (8, "http://f.org/p/q", link("r")),
    (9, None, link("http://g.net/fr/2")), (10, "no scheme", None), (11, "", ""), (12, "://", "x"), (13, "http://x.com?y", None),
    (14, "http://Net/es/", None), (15, "http://sub.net/es/a?b://c", "<link rel=canonical>"), (None, "http://f.org/p/r", None),
    (8, "http://f.org/p/q", link("r")), (16, "http://notexample.com/en/", None), (17, "http://www.example.com/en/q", link("http://e.net/es/1")),
]


def test_propagation_and_sql(spark):
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in PAGES], "page_id long, url string, html string, node string")
    rows = filter_urls(pages).collect()
    assert len(rows) == len(PAGES)
    verdict = {r["page_id"]: r["verdict"] for r in rows}
    assert [verdict[i] for i in (1, 2, 3, 4, 5, 6, 7)] == ["block", "block", "block", "allow", "allow", "block", "block"]
    assert verdict[None] == "block"      # the page that page 8 names as canonical
    assert verdict[9] == verdict[10] == "allow" and verdict[14] == verdict[15] == "block"
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    cur = con.execute(ORACLES["op2_redirect_equivalence"])
    names = [d[0] for d in cur.description]
    want = sorted(str([dict(zip(names, r))[c] for c in rows[0].asDict()]) for r in cur.fetchall())
    none = lambda v: None if v is None or v != v else v
    got = sorted(str([int(v) if isinstance(v, float) else none(v) for v in r]) for r in rows)
    assert got == [w.replace(".0,", ",").replace("nan", "None") for w in want]


def test_empty(spark):
    assert filter_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
