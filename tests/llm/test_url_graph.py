"""URL rules, link propagation, and the SQL twin."""

import duckdb

from casetrail.llm import queries, url_graph

SCHEMA = "page_id long, url string, html string"


def page(i, url, *links):
    return (i, url, "<html>" + "".join(f'<A class=x href="{u}">x</a>' for u in links))


ROWS = [
    page(1, "https://Spam.NET/x?y", "http://good.org/fr/1"),
    page(2, "http://linker.io/a", "http://spam.net/x", "//spam.net/y", "/en/local"),
    page(3, "http://far.io/a", "https://linker.io/a"),
    page(4, "http://good.org/fr/1", "http://praised.io/"),
    page(5, "http://praised.io/x#y"),
    page(6, "https://a.example.net/en/1"), page(7, "https://a.example.net/de/1"),
    page(8, "https://b.example.com/de/2"), page(9, "https://b.example.com"),
    page(10, "http://net/"), page(11, "http://net"), page(12, "http://xnet/y"),
    (13, None, None), (14, "no scheme", ""), (15, "x://h?u=http://z.net/", None),
    (None, "http://praised.io/x", "<a href='http://other.io/'>"),
    page(5, "http://praised.io/x#y"),
]
WANT = {1: ("spam.net", "/x", "net/", "block"), 2: ("linker.io", "/a", None, "block"),
        3: ("far.io", "/a", None, "block"), 4: ("good.org", "/fr/1", "org/fr/", "allow"),
        5: ("praised.io", "/x", None, "allow"),
        6: ("a.example.net", "/en/1", "example.net/en/", "allow"),
        7: ("a.example.net", "/de/1", "net/", "block"),
        8: ("b.example.com", "/de/2", "example.com/de/", "block"),
        9: ("b.example.com", "", None, "allow"), 10: ("net", "/", "net/", "block"),
        11: ("net", "", None, "allow"), 12: ("xnet", "/y", None, "allow"),
        13: ("", "", None, "allow"), 14: ("", "", None, "allow"), 15: ("h", "", None, "allow")}


def bag(rows):
    return sorted(map(repr, map(tuple, rows)))


def test_rules_and_links(spark):
    out = url_graph.judge(spark.createDataFrame([(*r, "c") for r in ROWS], SCHEMA + ", host string"))
    got = out.collect()
    assert len(got) == len(ROWS)
    for r in got:
        if r.page_id is not None and r.page_id != 5:
            assert tuple(r)[1:] == WANT[r.page_id], r
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", ROWS)
    assert bag(got) == bag(con.sql(url_graph.oracle_sql()).fetchall())


def test_query_against_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"create view pages as from '{sf_small}/pages.parquet'")
    assert (bag(queries.op6_url_graph(spark, sf_small).collect())
            == bag(con.sql(queries.ORACLE["op6_url_graph"]).fetchall()))


def test_empty(spark):
    assert url_graph.judge(spark.createDataFrame([], SCHEMA)).collect() == []


def test_seeds_beyond_the_crawl_and_long_chains(spark):
    """A blocked host without a page is a seed; distrust passes on along 30 hosts."""
    rows = [page(i, f"http://a.example.info/{i}", "http://spam.net/x") for i in range(5)]
    rows += [page(10, "http://c0.io/", "http://x.spam.net/"), page(50, "http://m.io/", "http://k.fr/")]
    rows += [page(10 + i, f"http://c{i}.io/", f"http://c{i - 1}.io/") for i in range(1, 30)]
    got = url_graph.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id for r in got if r.verdict == "allow"} == {50}
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows)
    assert bag(got) == bag(con.sql(url_graph.oracle_sql()).fetchall())
    assert url_graph.DAMPING ** url_graph.rounds_of(url_graph.DAMPING, 1e-3) <= 1e-3
