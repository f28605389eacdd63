import duckdb

from standings.llm import oracles
from standings.llm.queries import URL_RULES
from standings.llm.urls import UrlRule, canonical_form, judge_urls

PAGES = [
    (1, "https://www.A.example.com/de/x?utm_source=q&b=1&a=2#f", "<html>"),
    (2, "http://b.net/de/x", "<LINK href='https://a.example.com/de/x/?a=2&b=1' rel=canonical>"),
    (3, "http://c.org/z", '<meta http-equiv="refresh" content="0; url=http://b.net/de/x/">'),
    (4, None, None),
    (5, "nourl", "x"),
    (6, "http://d.net/q/r", '<link rel="canonical" href="http://nowhere.net/x">'),
    (7, "http://e.net", "<link rel='canonical' href='/de/x'>"),
    (8, "http://example.org/en/1", ""),
    (9, "HTTP://e.net/de/x/?ref=1", ""),
    (10, "http://m.e.net:80/de/x", None),
    (11, "x://sub.example.org/es/?", ""),
    (12, "http://notexample.org/es/", ""),
    (13, "http://a.com", ""),
    (14, "://", ""),
    (1, "https://www.A.example.com/de/x?utm_source=q&b=1&a=2#f", "<html>"),
    (None, "http://b.net/de/x", "<br>"),
]
SCHEMA = "page_id bigint, url string, html string"


def verdicts(df):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in df.collect()), key=str)


def test_aliases_inherit_blocks_but_not_over_rules(spark):
    pages = spark.createDataFrame([(*p, 1, 2) for p in PAGES], SCHEMA + ", host int, root int")
    redirects = spark.createDataFrame([("http://m.e.net/de/x", "https://b.net/de/x"), (None, "http://q.net")], "source string, target string")
    rows = {r.page_id: r for r in judge_urls(pages, URL_RULES, redirects).collect()}
    blocked = {i for i, r in rows.items() if r.verdict == "block"}
    assert blocked == {1, 2, 7, 8, 9, 10, 11, None}
    assert rows[3].rule == "org/" and rows[3].verdict == "allow" and rows[3].alias_of == rows[2].alias_of
    assert rows[12].rule == "org/" and rows[13].rule is None and rows[4].alias_of is None
    without = {r.page_id for r in judge_urls(pages, URL_RULES).collect() if r.verdict == "block"}
    assert without == {1, 2, 8, 11, None}
    assert judge_urls(pages, URL_RULES).count() == len(PAGES)
    assert judge_urls(pages.limit(0), URL_RULES, redirects.limit(0)).count() == 0
    assert {r.verdict for r in judge_urls(pages, []).collect()} == {"allow"}


def test_matches_sql_with_canonical_links(spark):
    links = [p for p in PAGES if p[0] not in (2, 7, None)]
    links += [(20, "http://f.net/1", '<link rel="canonical" href="http://g.net/2">'), (21, "http://g.net/2/", "<link rel=canonical href=https://h.com/de/3 >")]
    pages = spark.createDataFrame(links, SCHEMA)
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", links)
    sql = oracles.url_filters([(r.verdict, r.rule) for r in URL_RULES])
    names = ["page_id", "host", "path", "rule", "verdict"]
    theirs = sorted(con.execute(f"select {', '.join(names)} from ({sql})").fetchall(), key=str)
    ours = verdicts(judge_urls(pages, URL_RULES))
    assert ours == theirs and (20, "f.net", "/1", None, "block") in ours


def test_longest_rule_wins_and_ties_allow(spark):
    rules = [UrlRule("block", "a.net/x"), UrlRule("allow", "net/x/yy"), UrlRule("block", "net/")]
    pages = spark.createDataFrame([(1, "h://a.net/x/yyz", ""), (2, "h://a.net/x/z", ""), (3, "h://net/q", ""), (4, "h://anet/q", "")], SCHEMA)
    assert [r[3:] for r in verdicts(judge_urls(pages, rules))] == [
        ("net/x/yy", "allow"), ("a.net/x", "block"), ("net/", "block"), (None, "allow"),
    ]


def test_forms(spark):
    urls = ["HTTP://WWW.X.net:80/A/?b=2&a=1&utm_x=3#t", "https://m.x.net/A?a=1&b=2", "x", None]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in frame.select(canonical_form(frame.u)).collect()] == ["x.net/A?a=1&b=2", "x.net/A?a=1&b=2", None, None]


def test_every_link_of_a_page_is_an_edge(spark):
    own = '<link rel="canonical" href="http://p.net/1">'
    blocked = "http://example.org/es/1"
    pages = [
        (1, "http://p.net/1", own + f'<meta http-equiv="refresh" content="0; url={blocked}">'),
        (2, "http://p.net/2", f"<link rel=canonical href=/2><link href='{blocked}' rel='canonical'>"),
        (3, "http://p.net/3", f'<meta content="0;url={blocked}" http-equiv=refresh>'),
        (4, "http://p.net/4", '<link rel="canonical" href="http://example.net/x?a=1&amp;b=2">'),
        (5, "http://example.net/x?b=2&a=1", f'<link rel="canonical" href="{blocked}">'),
        (6, "http://p.net/6", own.replace("/1", "/6")),
    ]
    rows = {r.page_id: r.verdict for r in judge_urls(spark.createDataFrame(pages, SCHEMA), URL_RULES).collect()}
    assert rows == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow"}
